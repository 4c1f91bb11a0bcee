"""Operators: functions from DataFrames to DataFrames. Only the gate runner starts jobs."""
