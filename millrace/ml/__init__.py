"""Distributed training and evaluation with pyspark.ml."""
