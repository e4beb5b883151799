"""Readers of stored tables, Bronze batches, landing files and the driver's test tables."""
