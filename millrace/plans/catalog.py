"""Register of the named queries, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.roles import Roles, role_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, roles: str = "", recursive: bool = False):
    """Register a query `(Roles) -> DataFrame`.

    `sql` is the same result in DuckDB over the test tables; `roles` names the role
    tables it reads, which are put in front as common table expressions.
    """

    def register(build: Callable[[Roles], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Roles(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = role_sql(roles.split(), sql, recursive)
        return build

    return register
