"""Whole pipelines and reports made of the operators."""
