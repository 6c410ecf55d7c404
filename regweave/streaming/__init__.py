"""Landing extracts as they arrive."""
