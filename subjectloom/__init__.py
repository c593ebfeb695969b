"""Multi-label subject classification of large text collections on Spark DataFrames."""
