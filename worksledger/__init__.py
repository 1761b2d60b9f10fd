"""Public-works contract analytics on Spark: clean, summarise, explore, check."""

__version__ = "1.0.0"
