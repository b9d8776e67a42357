"""Operators for preparing text at scale: deduplication, scoring, extraction, tokens, sharding."""
