"""Whole jobs over tables, composed of operators."""
