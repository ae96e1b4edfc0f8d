"""Operators for preparing training text at scale; nothing else in tidemark imports this package."""
