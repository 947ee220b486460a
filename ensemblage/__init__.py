"""Conformer-ensemble analytics on Spark: DataFrame-in, DataFrame-out operators keyed by ensemble."""

__version__ = "0.1.0"
