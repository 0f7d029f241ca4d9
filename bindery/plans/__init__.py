"""Whole jobs, built from the operators, with Parquet tables between stages."""
