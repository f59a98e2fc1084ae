"""Transforms: DataFrame in, DataFrame out, no actions."""
