"""Composite jobs and the adapter from the driver's test tables."""
