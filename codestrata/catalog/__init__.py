"""Queries over the given tables, one per operator, with their check SQL."""


def all_queries():
    from codestrata.catalog import registry
    from codestrata.catalog import (  # noqa: F401
        column_queries,
        record_queries,
        relation_queries,
        source_queries,
        stream_queries,
    )

    return registry.QUERIES, registry.ORACLES
