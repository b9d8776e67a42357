"""Streaming runs of the analytics: sinks, lifecycle of queries, replays."""
