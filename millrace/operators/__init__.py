"""Operators: functions from DataFrame to DataFrame, for batch and, unless noted, streams."""
