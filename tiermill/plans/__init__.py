"""Composed jobs: the bronze/silver/gold pipeline, publishing, and the athlete presets."""
