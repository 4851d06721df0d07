"""operators of the warehouse."""
