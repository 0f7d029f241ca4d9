"""Table transformations: DataFrames in, DataFrames out, nothing collected."""
