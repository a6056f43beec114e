"""Siltworks: intelligence curation as Spark DataFrame operators."""
