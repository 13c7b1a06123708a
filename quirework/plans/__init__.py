"""Registered queries, the page pipeline and the volume driver."""
