"""Structured Streaming form of the enrichment job."""
