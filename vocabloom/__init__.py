"""Vocabularies, sense graphs and publication metadata as Spark DataFrame operators."""
