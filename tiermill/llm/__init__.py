"""Operators for preparing training data: sharding, packing, quality, duplicates, language models, licences."""
