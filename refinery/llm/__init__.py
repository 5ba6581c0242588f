"""Operators for training data: near-duplicates, tokens, personal data, quality, chat."""
