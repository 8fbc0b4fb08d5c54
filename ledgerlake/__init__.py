"""Change-capture lake and ledger analytics as composable PySpark DataFrame functions."""

__version__ = "0.1.0"
