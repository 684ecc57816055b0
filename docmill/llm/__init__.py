"""Operators for preparing training text. Nothing else in docmill imports this package."""
