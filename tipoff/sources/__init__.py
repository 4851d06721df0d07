"""sources of the warehouse."""
