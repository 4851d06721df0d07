"""plans of the warehouse."""
