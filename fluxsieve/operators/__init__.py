"""Statements, data sets and metadata joins over DataFrames."""
