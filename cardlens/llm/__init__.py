"""Operators of a training-data pipeline: language, privacy, tokens, duplicates, pages, mixing, search and quality."""
