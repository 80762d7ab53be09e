"""Column builders: no DataFrame, no action."""
