"""Supply-chain analytics as DataFrame operators for Spark."""

__version__ = "0.1.0"
