"""Whole programs built from the operators."""
