"""Named queries: a Spark plan over the domain tables, its output columns and the SQL that must agree with it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.adapters import Tables
from coverlake.session import tune

SPARK_TYPE = {"long": "bigint", "str": "string", "double": "double", "bool": "boolean"}
SQL_TYPE = {"long": "bigint", "str": "varchar", "double": "double", "bool": "boolean"}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    columns: dict[str, str]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Tables(tune(spark), folder))
        return df.select(*[F.col(c).cast(SPARK_TYPE[t]).alias(c) for c, t in self.columns.items()])

    def oracle(self, ctes: dict[str, str]) -> str | None:
        if self.sql is None:
            return None
        casts = ", ".join(f'CAST("{c}" AS {SQL_TYPE[t]}) AS "{c}"' for c, t in self.columns.items())
        parts = [f"{n} AS (\n{ctes[n].strip()}\n)" for n in needed(self.sql, ctes)]
        parts.append(f"answer AS (\n{self.sql.strip()}\n)")
        return "WITH " + ",\n".join(parts) + f"\nSELECT {casts} FROM answer"


def needed(sql: str, ctes: dict[str, str]) -> list[str]:
    """Shared tables a text mentions, each after the ones it is built from."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[dx]_\w+", text):
            if name in ctes and name not in order:
                visit(ctes[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None):
    """Register ``build`` under ``name``; ``columns`` is ``name:type`` pairs, type in long, str, double, bool."""

    def wrap(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        pairs = dict(p.split(":") for p in columns.split())
        QUERIES[name] = Query(name, build, pairs, sql)
        return build

    return wrap
