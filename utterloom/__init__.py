"""utterloom: speech-dataset preparation and analytics as Spark DataFrames."""

__version__ = "0.1.0"
