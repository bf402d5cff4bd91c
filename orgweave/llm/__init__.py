"""Operators for preparing training text: quality, toxicity, licences, duplicates,
benchmark leaks, language-model scores, sub-word encoding and personal data."""
