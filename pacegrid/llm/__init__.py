"""Operators that prepare training data: nothing else in the package imports them."""
