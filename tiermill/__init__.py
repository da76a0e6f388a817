"""Tiered batch pipelines and enrich-and-average streams as plain DataFrame functions."""
