"""Operators for preparing training data, each of them one Spark job over whole tables."""
