"""Data-quality checks and catalog views."""
