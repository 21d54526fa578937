"""changeflow: operators on database change logs, as PySpark DataFrames."""

__version__ = "0.1.0"
