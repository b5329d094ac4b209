"""Scans, typed loaders, JSON ingest, JDBC, file sinks and the model store."""
