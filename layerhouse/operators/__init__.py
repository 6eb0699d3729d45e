"""Warehouse operators: functions from DataFrames to DataFrames, no actions inside."""
