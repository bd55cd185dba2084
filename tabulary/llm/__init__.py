"""Operators for preparing training data at corpus scale.

One module per operator; :mod:`tabulary.llm.queries` applies each to its whole
table.  Nothing outside this package imports it.
"""
