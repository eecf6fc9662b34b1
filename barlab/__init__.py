"""barlab: daily price-bar research on Spark DataFrames."""
