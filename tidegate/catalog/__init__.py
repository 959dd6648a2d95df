"""Queries over the sample tables, one per operator, with independent oracle SQL."""
