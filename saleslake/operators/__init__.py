"""DataFrame operators of the warehouse."""
