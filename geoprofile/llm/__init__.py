"""Operators for preparing language-model training corpora.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` holds
one registered query per operator.
"""
