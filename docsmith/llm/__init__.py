"""Operators of a training-data pipeline over documents and conversations.

Each ``opN_*`` module holds one operator with a general interface;
``queries.py`` applies each of them to its whole table.  Nothing outside this
subpackage imports it.
"""
