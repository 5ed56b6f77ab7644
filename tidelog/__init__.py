"""tidelog: change-data-capture replay and analytics on Spark DataFrames."""

__version__ = "0.1.0"
