"""Operators for training text of language models. Nothing outside this package imports it."""
