"""Operators: DataFrame in, DataFrame of metrics or marked rows out."""
