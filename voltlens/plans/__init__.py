"""Composite jobs and the analogue-table catalog."""
