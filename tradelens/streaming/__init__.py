"""streaming of the library."""
