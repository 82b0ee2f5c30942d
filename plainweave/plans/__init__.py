"""Whole jobs, from corpus to written result."""
