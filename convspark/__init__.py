"""Spark-native analytics over meeting and conversation transcripts."""
