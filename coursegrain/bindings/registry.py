"""Query registry: a name, a Spark function and the SQL that must agree."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import VIEWS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Sample tables and derived views by attribute; reading is lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self._folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(self.path(name))
        if name in VIEWS:
            text = VIEWS[name]
            return self.spark.sql(text, **{n: getattr(self, n) for n in _inputs(text)})
        raise AttributeError(name)


def _inputs(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{([a-z]\w*)\}", text)))


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function. ``{view}`` in ``sql`` names a derived
    view, which is put in front as a common table expression."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(build, sql and standalone(sql))
        return build

    return register


def standalone(sql: str) -> str:
    """SQL text with the definitions of the views it uses."""
    used: dict[str, str] = {}

    def collect(text: str) -> None:
        for name in _inputs(text):
            if name in VIEWS and name not in used:
                collect(VIEWS[name])
                used[name] = _plain(VIEWS[name])

    collect(sql)
    body = _plain(sql).strip()
    if not used:
        return body
    heads = ", ".join(f"{name} AS ({text})" for name, text in used.items())
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads}, {body[len('WITH RECURSIVE '):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {heads}, {body[len('WITH '):]}"
    return f"WITH {heads} {body}"


def _plain(text: str) -> str:
    return re.sub(r"\{([a-z]\w*)\}", r"\1", text)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round the named double columns, so that engines that add in another order
    agree."""
    return df.withColumns({c: F.round(c, places) for c in columns})
