"""Spark-native crosslink-site, coverage and peak analytics on DataFrames."""
