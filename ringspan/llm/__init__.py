"""Operators for preparing training data: one module per operator, and the named queries over them."""
