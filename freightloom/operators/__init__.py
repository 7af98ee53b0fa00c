"""Operators: functions from DataFrames to DataFrames, free of actions."""
