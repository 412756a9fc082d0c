"""Layered batch tables, data-quality suites and model monitoring on Spark DataFrames."""
