"""Spark jobs that turn chat and document tables into safe periodic digests."""
