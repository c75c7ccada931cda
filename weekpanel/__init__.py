"""Entity x week panel analytics and multi-horizon forecasting on Spark DataFrames."""
