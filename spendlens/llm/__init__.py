"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one operator with a
general interface (any id and text column, real outputs: texts, spans, ids, files); the thin
registered queries that derive the digest columns from those outputs are in ``queries``.
"""
