"""Pipelines composed from the operators, and the driver-table query registry."""
