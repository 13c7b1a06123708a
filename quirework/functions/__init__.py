"""Column functions: keys, gates, text measures and small-grid arithmetic."""
