"""Joins, searches and maintenance operators, each a function of DataFrames."""
