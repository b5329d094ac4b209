"""Relational and statistical operators over DataFrames."""
