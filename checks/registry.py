"""Registry of queries and their SQL twins.

``@check(name, sql)`` registers a function ``(spark, sf_dir) -> DataFrame``;
``sql=None`` marks a query SQL cannot state.
"""

from __future__ import annotations

import functools
import importlib

QUERIES: dict = {}
SQL: dict = {}
_MODULES = ("cleaning", "profiling", "features", "models")


def check(name: str, sql: str | None = None):
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            # times are compared as UTC, whatever the caller's session says
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return wrap


def _load():
    for module in _MODULES:
        importlib.import_module(f"checks.{module}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict:
    _load()
    return dict(SQL)
