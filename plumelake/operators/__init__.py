"""Operators: functions from DataFrames and plain arguments to DataFrames.

No operator reads the clock; ``now`` and ``run_ts`` are arguments.
"""
