"""quaylake: landing, decoding, compaction and analytics of append-only
market-data feeds as Spark DataFrame jobs."""

__version__ = "0.1.0"
