"""Operators for training-data pipelines: quality, near-duplicate, leak,
toxicity, licence, mixing and sharding steps over the ``documents``-style
tables. Nothing else in the library imports this subpackage."""
