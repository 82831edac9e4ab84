"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  ``queries.QUERIES``
and ``oracle.ORACLE_SQL`` hold the registered queries and their SQL.
"""
