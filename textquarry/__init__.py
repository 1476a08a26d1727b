"""Text-corpus preparation on Spark."""
