"""contrail — a Spark-native airline lakehouse library.

Bronze → silver → gold table builders, a one-pass data-quality engine and a
Structured Streaming ingest, all expressed with the DataFrame API so that
Catalyst plans every job end to end.
"""

__version__ = "0.1.0"
