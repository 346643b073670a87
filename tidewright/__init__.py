"""Tidewright: many time series at once, as plain Spark DataFrame operators."""
