"""Continuous forms of the landing load and the versioned sales table."""
