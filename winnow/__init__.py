"""Record triage and corpus analytics on Spark: DataFrames in, DataFrames out."""
