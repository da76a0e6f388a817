"""Streams: enrich and average messages, deliver micro-batches, tail a topic."""
