"""Operators that prepare a text corpus for language-model training.

Nothing outside this folder imports it. Each module holds one operator with its general
interface and the thin ``opN_`` query that applies it to the tables; ``catalog`` lists
the queries.
"""
