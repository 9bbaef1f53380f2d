"""Registry of catalogue queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablehaul.catalog import Tables
from tablehaul.catalog_sql import with_views
from tablehaul.session import prepare


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(prepare(spark), sf_dir))


_QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame``; ``sql`` may name any catalogue view."""

    def register(build):
        if key in _QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        _QUERIES[key] = Query(key, build, with_views(sql) if sql else None)
        return build

    return register


def all_queries() -> dict[str, Query]:
    from tablehaul import plans

    plans.load_all()
    return dict(_QUERIES)
