"""Named queries over the driver's tables, with their DuckDB text.

A query's module registers it with ``query``; the keys start with the inventory's ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under ``key``; ``oracle`` is DuckDB SQL for the same rows, None where SQL has no form."""

    def keep(f: Query) -> Query:
        _queries[key] = f
        if oracle is not None:
            _oracles[key] = oracle
        return f

    return keep


def _load() -> None:
    from pointloom.plans import alignment_queries, detection_queries, file_queries, point_queries, table_queries  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracles)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["dom5_noise_candidates"](spark, sf_dir)
