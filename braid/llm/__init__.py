"""Operators for preparing training text. Nothing else in ``braid`` imports this subpackage."""
