"""Operators for large training corpora: counting, cleaning, mixing, scoring and writing.

Nothing outside this folder imports it.  ``queries`` registers one query for each operator.
"""
