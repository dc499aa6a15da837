"""dayscout: daily place observations scored, ranked and monitored on Spark."""

__version__ = "0.1.0"
