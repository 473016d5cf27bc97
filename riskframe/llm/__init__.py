"""Operators for preparing training text: decontamination, personal data, secrets, near copies, quality, tokens, shards."""
