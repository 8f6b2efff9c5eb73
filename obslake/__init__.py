"""obslake: an ocean-observation lake on Spark, as functions from DataFrame to DataFrame."""

__version__ = "0.1.0"
