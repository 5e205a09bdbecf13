"""Operators for preparing language-model training data.

Each module is one operator with a general DataFrame interface; ``queries``
wraps them as the registered ``opN_*`` queries.  Nothing else in the library
imports this package.
"""
