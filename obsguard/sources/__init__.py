"""File discovery and readers."""
