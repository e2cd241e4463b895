"""Table operators: functions from DataFrames to DataFrames."""
