"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  ``queries`` registers one query
per operator; the operators themselves are general DataFrame functions.
"""
