"""Fleet-telematics analytics on Spark: CSV extracts to marts, all as lazy DataFrames."""
