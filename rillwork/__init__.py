"""Analytics jobs written as plain functions from DataFrames to DataFrames."""
