"""Readers: benchmark Parquet tables, delimited text inputs, dataset profile."""
