"""Operators for building training corpora: one module per operator, all DataFrame in, DataFrame out.

Nothing outside this package imports it; ``registry`` holds the queries that apply the operators to the
tables of a folder.
"""
