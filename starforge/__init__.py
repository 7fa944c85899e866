"""starforge: star-schema loading, checking and reporting on PySpark DataFrames."""

__version__ = "0.1.0"
