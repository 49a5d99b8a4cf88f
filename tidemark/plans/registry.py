"""Names, jobs and SQL of the snapshot queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import CTE, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = "", six_digits: str = ""):
    """Register job(t) under name; sql: the same rows over the common table expressions (and ctes) in DuckDB.

    six_digits: floating-point columns that both sides round to six decimals, as logarithms and divisions may differ in the last bit.
    """
    floats = six_digits.split()

    def add(job: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: job(Tables(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in floats})
        if sql:
            body = f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in floats)}) FROM ({sql})" if floats else sql
            ORACLE_SQL[name] = f"WITH {CTE}{', ' + ctes.strip().strip(',') if ctes else ''}\n{body}"
        return job

    return add
