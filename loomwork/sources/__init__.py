"""Sources."""
