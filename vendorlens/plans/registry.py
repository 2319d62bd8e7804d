"""Registry of checked queries: Spark callable + DuckDB oracle SQL per operator id.

Every entry reads the driver tables at ``sf_dir`` (whole tables, no subsets). Double
columns are rounded to 10 significant digits on both sides (``canon``) so that
summation-order noise does not change the value hash; the rounding is identical IEEE
arithmetic in both engines.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from vendorlens.functions.expr import canon, canon_sql


@dataclass
class Query:
    name: str
    spark: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    floats: tuple[str, ...] = field(default_factory=tuple)
    doc: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.spark(spark, sf_dir)
        if not self.floats:
            return df
        fl = set(self.floats)
        return df.select(*[canon(c).alias(c) if c in fl else c for c in df.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        sql = bigint_counts(self.sql)
        if not self.floats:
            return sql
        rep = ", ".join(f"{canon_sql(c)} AS {c}" for c in self.floats)
        return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in ``CAST(... AS BIGINT)``: DuckDB returns HUGEINT
    where Spark's ``count_if`` is BIGINT."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("CAST(count_if(" + bigint_counts(sql[j + len(key):k]) + ") AS BIGINT)")
        i = k + 1


REGISTRY: dict[str, Query] = {}


def register(name: str, spark_fn, sql: str | None, floats=(), doc: str = "") -> None:
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name}")
    REGISTRY[name] = Query(name, spark_fn, sql, tuple(floats), doc)


def _load() -> None:
    # Importing the definition modules fills REGISTRY.
    from vendorlens.plans import queries_summary  # noqa: F401
    from vendorlens.plans import queries_analysis  # noqa: F401
    from vendorlens.plans import queries_sources  # noqa: F401


def all_queries() -> dict[str, Query]:
    if not REGISTRY:
        _load()
    return REGISTRY
