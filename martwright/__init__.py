"""Retail lakehouse operators expressed as Spark DataFrame transformations."""
