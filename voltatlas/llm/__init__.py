"""Operators for preparing training text: tokens, language, toxicity, quality, mixing, sharding, near copies, personal data."""
