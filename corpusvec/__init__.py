"""Text-to-embeddings analytics on Spark DataFrames."""
