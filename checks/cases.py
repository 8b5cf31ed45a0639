"""The case registry: a Spark query and, where SQL can say it, its oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from checks.views import BASE_TABLES, VIEWS


class Tables:
    """Test tables and derived views as DataFrames: ``t.works``, ``t.orders``, ..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        sql = VIEWS[name]
        for base in BASE_TABLES:
            if re.search(rf"\bFROM {base}\b", sql):
                getattr(self, base).createOrReplaceTempView(base)
        return self.spark.sql(sql)


@dataclass(frozen=True)
class Case:
    build: Callable[[Tables], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None, views: str = ""):
    """Register a query. ``views`` names the derived views its oracle reads."""
    def keep(build: Callable[[Tables], DataFrame]):
        text = sql
        if text is not None and views:
            ctes = ", ".join(f"{v} AS ({VIEWS[v].strip()})" for v in views.split())
            body = text.strip()
            if body.upper().startswith("WITH "):
                recursive = body.upper().startswith("WITH RECURSIVE ")
                rest = body[len("WITH RECURSIVE "):] if recursive else body[len("WITH "):]
                text = f"WITH {'RECURSIVE ' if recursive else ''}{ctes}, {rest}"
            else:
                text = f"WITH {ctes} {body}"
        assert name not in CASES, name
        CASES[name] = Case(build, text)
        return build

    return keep


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = CASES[name].build
    return lambda spark, sf_dir: build(Tables(spark, sf_dir))
