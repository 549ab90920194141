"""Point-in-time features, evaluation and governed batch scoring on Spark DataFrames."""
