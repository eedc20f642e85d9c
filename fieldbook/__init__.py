"""fieldbook: PySpark operators that turn free-text observation records into
clean, typed and quality-flagged tables."""

__version__ = "0.1.0"
