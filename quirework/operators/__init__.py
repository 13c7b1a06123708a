"""DataFrame operators: records and resume, profiles, summaries."""
