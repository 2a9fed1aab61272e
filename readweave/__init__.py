"""Sequence-overlap analytics as Spark DataFrame operators."""
