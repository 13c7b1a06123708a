"""Training-data operators: one module per operator, queries in :mod:`quirework.llm.queries`."""
