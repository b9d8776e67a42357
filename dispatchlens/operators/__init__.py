"""Operators: functions from event feeds to result tables."""
