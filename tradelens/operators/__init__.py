"""operators of the library."""
