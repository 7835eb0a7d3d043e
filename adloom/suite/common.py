"""Registry of runnable queries over the driver tables, each with an equivalent SQL text where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison across engines; adding zero turns -0.0 into 0.0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def s6(expr: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def joined_ids(arr: str | Column) -> Column:
    """An id array as text, so that both engines hash it alike."""
    col = F.col(arr) if isinstance(arr, str) else arr
    return F.array_join(col.cast("array<string>"), ",")


# The events table in the role of the impression table.
IMP = """imp AS (
  SELECT event_id AS id, ts, user_id, event_type,
         CAST(hour(ts) AS VARCHAR) AS hour, CAST(dayofweek(ts) AS VARCHAR) AS dow,
         value, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k,
         CAST(event_type = 'click' AS INTEGER) AS clicked,
         ((event_id * 7919) % 1000) / 1000.0::DOUBLE AS score
  FROM events)"""


def impressions(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("event_id").alias("id"), "ts", "user_id", "event_type",
        F.hour("ts").cast("string").alias("hour"), (F.dayofweek("ts") - 1).cast("string").alias("dow"),
        "value", F.get_json_object("props", "$.k").cast("double").alias("k"),
        (F.col("event_type") == "click").cast("int").alias("clicked"),
        (F.pmod(F.col("event_id") * 7919, F.lit(1000)) / F.lit(1000.0)).alias("score"),
    )


# Seeded hash order and hash split, as SQL.
def md5_sql(key: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def md5_int_sql(key: str, seed: int = 42) -> str:
    return f"(('0x' || substr({md5_sql(key, seed)}, 1, 8))::BIGINT)"


def hash_unit_sql(key: str, seed: int = 42) -> str:
    return f"({md5_int_sql(key, seed)} / 4294967296.0::DOUBLE)"


CUTS = (("train", 0.7), ("valid", 0.85), ("test", 1.0))


def hash_split_sql(key: str) -> str:
    u = hash_unit_sql(key)
    return f"CASE WHEN {u} < 0.7::DOUBLE THEN 'train' WHEN {u} < 0.85::DOUBLE THEN 'valid' ELSE 'test' END"


def tokens_sql(text: str, sep: str = " ") -> str:
    return f"(CASE WHEN coalesce({text}, '') = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({text}, '{sep}') END)"


# The white space stripped from tokens, as a SQL expression.
STRIP = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

# All tokens of all documents with their counts.
DOC_TOKENS = f"""tok AS (SELECT doc_id, unnest({tokens_sql('text')}) AS token FROM documents),
cnts AS (SELECT token, count(*) AS cnt FROM tok GROUP BY token)"""
