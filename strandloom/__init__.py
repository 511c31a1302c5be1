"""Sequence analytics on Spark: DataFrame operators for reads, k-mers, contigs, graphs,
intervals, coverage, expression and coding regions."""

__version__ = "0.1.0"
