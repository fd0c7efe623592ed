"""The operators: plain functions, DataFrame (and parameters) in, DataFrame out."""
