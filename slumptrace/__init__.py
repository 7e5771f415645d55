"""Crisis-trade analytics on Spark: who bought a crashed token, and what the rebound was worth."""

__version__ = "0.1.0"
