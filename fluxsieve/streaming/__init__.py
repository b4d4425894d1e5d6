"""Measurement stream operators; each works on batch and streaming DataFrames unless it says otherwise."""
