"""Dataflows: DataFrame in, DataFrame out."""
