"""Relational and time-series operators over DataFrames."""
