"""Operators for preparing training data: one module per operator, ``queries`` registers them."""
