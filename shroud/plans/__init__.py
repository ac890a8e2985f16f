"""Composed plans: the workflow (W1) and the named queries with their oracle SQL."""
