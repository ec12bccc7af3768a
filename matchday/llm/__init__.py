"""Operators for preparing large training corpora, one module per operator.

Nothing outside this package imports it; ``queries`` registers the package's
queries for ``__spark_entry__``.
"""
