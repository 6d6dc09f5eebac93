"""Operators for large training-data pipelines (language models).

Nothing outside this folder imports it.  Each module holds one operator with
its own general interface; ``queries.py`` registers one thin query for each.
"""
