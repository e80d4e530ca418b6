"""Models: functions from raw or model DataFrames to model DataFrames."""
