"""All registered queries."""

from __future__ import annotations

from tessera.plans import chat, corpus, files, preferences, runs, scores

ALL = {
    **chat.QUERIES,
    **corpus.QUERIES,
    **preferences.QUERIES,
    **scores.QUERIES,
    **runs.QUERIES,
    **files.QUERIES,
}


def spark_queries() -> dict:
    return {name: query for name, (query, _) in ALL.items()}


def oracles() -> dict:
    return {name: sql for name, (_, sql) in ALL.items() if sql is not None}
