"""Text-data curation, redaction and training-set building on Spark DataFrames."""

__version__ = "0.1.0"
