"""Operators of a training-data pipeline: mixing, near copies, quality, personal data, token shards,
toxicity, repeated spans, licences, page text and benchmark passages.

Nothing else in the library imports this package.
"""
