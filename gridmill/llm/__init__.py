"""Operators of a training-data pipeline: tokens, languages, pages, duplicates, vectors, mixes, quality."""
