"""Learner-log analytics on Spark: DataFrame in, DataFrame out."""
