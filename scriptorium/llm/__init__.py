"""Operators for preparing training data from documents, pages and embeddings.

Nothing else in the library imports this subpackage. ``registered()`` gives the queries of the
operators and of the pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations


def registered():
    """(queries, oracle SQL) of this subpackage and of ``corpus_pipeline``."""
    from scriptorium.llm import queries as q

    return dict(q.QUERIES), dict(q.ORACLE)
