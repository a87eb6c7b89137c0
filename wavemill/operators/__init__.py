"""Table operators: functions from DataFrames to DataFrames that only build plans unless they say otherwise."""
