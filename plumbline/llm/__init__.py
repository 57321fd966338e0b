"""Operators for preparing training text: duplicates, chat turns, tokens, licences, sites,
quality, toxicity and packing. Nothing outside this package imports it."""
