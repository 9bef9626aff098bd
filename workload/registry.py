"""Registered queries: a Spark callable and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.adapters import Source, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Output types both engines share: BIGINT, DOUBLE, BOOLEAN, STRING."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            c = F.round(c, 2).cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable:
    def register(fn: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        QUERIES[name] = lambda spark, folder: plain(fn(Source(spark, folder)))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register
