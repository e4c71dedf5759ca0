"""Relational and ``pyspark.ml`` operators: reshaping, size-checked joins,
feature stages and chronological splits."""
