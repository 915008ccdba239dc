"""riverbed: Spark-native change-data analytics.

Change feeds (relational, document, object store) are parsed, cleaned,
validated, folded into current state and maintained into reporting marts --
all as DataFrame / Structured Streaming plans.
"""

__version__ = "0.1.0"
