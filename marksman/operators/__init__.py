"""Relational stages of the scoring pipeline, DataFrame in, DataFrame out."""
