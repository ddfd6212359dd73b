"""viewpulse: television quality-of-service analytics on PySpark."""

__version__ = "0.1.0"
