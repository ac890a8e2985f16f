"""Column-level building blocks (no DataFrame in, Column out)."""
