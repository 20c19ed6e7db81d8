"""Operators for preparing training data, one module per operator.

Nothing outside this package imports it; ``queries`` registers one query per
operator for the driver's entry file.
"""
