"""Workflow operators: DataFrame in, DataFrame out."""
