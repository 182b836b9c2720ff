"""tidewater: analytics operators and named analyses as Spark DataFrame jobs."""

__version__ = "0.1.0"
