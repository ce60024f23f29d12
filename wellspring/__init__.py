"""Retrieval over documents as Spark jobs: chunk, encode, index, search, answer."""
