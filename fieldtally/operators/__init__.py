"""Operators: functions from DataFrame to DataFrame that take column names."""
