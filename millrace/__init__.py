"""millrace: table understanding, feature preparation and clustering on Spark DataFrames."""
