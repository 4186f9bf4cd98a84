"""beatgrid: geo-located incident analytics and classification on Spark DataFrames."""
