"""parley: conversational passage retrieval on Spark."""
