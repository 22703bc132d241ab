"""Whole flows composed from the operators, and the checked queries."""
