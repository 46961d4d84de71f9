"""Spark-native media curation: scan, dedup, label, cluster and lay out media assets as DataFrames."""
