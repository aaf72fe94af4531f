"""Operators for preparing language-model training data.

Nothing outside this folder imports it (``__spark_entry__.py`` adds its queries
when it is there). Each module holds one operator with its own general
interface; ``queries`` holds the thin registered queries and their SQL twins.
"""
