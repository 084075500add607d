"""Operators for large text corpora (training-data preparation).

Nothing outside this subpackage imports it.  Each module holds one problem's
operator; ``queries`` registers the ``pN_`` queries and their SQL.
"""
