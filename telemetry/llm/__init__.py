"""Training-data operators over document, page and benchmark tables.

Thirteen operators, one module each, plus shared helpers (``textblocks``, ``frames``, ``links``).
Nothing else in the library imports this package; ``queries`` holds the registered
queries and their SQL.
"""
