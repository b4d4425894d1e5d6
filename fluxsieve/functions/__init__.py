"""Builders of the expression language's functions: typed operands in, a typed column out."""
