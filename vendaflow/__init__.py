"""Sales analytics on Spark: cleansing, star schema, features, propensity and call queue."""

__version__ = "0.1.0"
