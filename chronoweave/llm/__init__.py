"""Operators for building training corpora: dedup, mixing, packing, screening.

Nothing outside this folder imports it; :mod:`chronoweave.llm.queries` holds the
registered queries and their SQL.
"""
