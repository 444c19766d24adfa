"""Operators for preparing large text corpora, and their registered queries.

Nothing outside this subpackage imports it.
"""
