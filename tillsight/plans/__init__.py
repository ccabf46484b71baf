"""Composed jobs: marts, report datasets, and the ordered run."""
