"""Operators: functions from DataFrames to a DataFrame. None of them runs an action."""
