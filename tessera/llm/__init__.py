"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``queries`` registers the
contract queries. Nothing outside this subpackage imports it.
"""
