"""Whole queries and jobs built from the operators."""
