"""Operators of a training-data pipeline, each by a stated method, and their queries."""


def all_queries():
    from codestrata.llm import queries

    return queries.QUERIES, queries.ORACLES
