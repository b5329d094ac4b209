"""Scalar column expressions and schema helpers (all JVM-side, no Python UDFs)."""
