"""shelfwise — a Spark-native retail sales analytics engine.

Bronze → silver → gold medallion layers, a star schema with hash keys,
dashboard queries, replay-safe Structured Streaming and Spark ML, all
expressed as DataFrame plans that Catalyst optimises.
"""

__version__ = "0.1.0"
