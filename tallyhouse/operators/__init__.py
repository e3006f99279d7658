"""Operators: functions from DataFrames on the source schema to a DataFrame."""
