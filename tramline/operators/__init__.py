"""Delay operators and the questions built on them: DataFrames in, DataFrame out."""
