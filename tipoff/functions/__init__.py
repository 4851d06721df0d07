"""functions of the warehouse."""
