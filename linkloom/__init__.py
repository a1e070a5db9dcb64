"""linkloom: collect, check, read and score news links with Spark DataFrames."""
