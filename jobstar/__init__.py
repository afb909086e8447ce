"""jobstar: job-posting ELT and star-schema analytics on Spark DataFrames."""

__version__ = "0.1.0"
