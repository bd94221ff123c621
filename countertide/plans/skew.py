"""Partitions that stay bounded: texts by their size, joins in which one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text in a partition whose words are counted there: the words take some twenty times their room.
TEXT_CHARS = 1 << 21


def spread_texts(df: DataFrame, key: str, text: str, chars: int = TEXT_CHARS) -> DataFrame:
    """``df`` partitioned by ``key`` into as many parts as its texts need, ``chars`` characters each.

    Words of a text take many times the room of the text, which Spark does not see when it merges small shuffle partitions: it
    fills them up to a size of shuffled bytes, and a task then holds the words of all of them. A given number is kept.
    """
    total = df.agg(F.sum(F.length(text).cast("bigint"))).first()[0] or 0
    return df.repartition(max(1, -(-total // chars)), key)


def hot_keys(fact: DataFrame, key: str, limit: int | None = None, salts: int | None = None) -> DataFrame:
    """Keys that hold at least ``1/limit`` of the rows, with the number of parts to deal them to: their share of ``salts``.

    Both are the number of shuffle partitions if not given, so a key is hot when it fills a partition of its own, and
    gets as many parts as it would fill. There are at most ``limit`` such keys, and ``salts + limit`` parts in all.
    """
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = fact.agg(F.count(F.lit(1))).scalar()
    parts = F.greatest(F.lit(2), F.ceil(F.col("_n") * (salts or partitions) / total)).cast("int")
    return per_key.filter(F.col("_n") * (limit or partitions) >= total).select(key, parts.alias("_parts"))


def join_spreading_hot_keys(
    fact: DataFrame, dim: DataFrame, key: str, spread_on: str, limit: int | None = None, salts: int | None = None
) -> DataFrame:
    """Inner join of a large ``fact`` to ``dim`` that deals the rows of hot keys over several parts each.

    Only the dimension rows of hot keys are repeated, once a part. Use it where the join feeds an aggregation
    on the same key: there the adaptive skew join does not apply, as splitting would break the
    partitioning the aggregation wants to reuse.
    """
    hot = F.broadcast(hot_keys(fact, key, limit, salts))
    dealt = (
        fact.join(hot, key, "left")
        .withColumn("_salt", F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(spread_on), F.col("_parts")).cast("int")).otherwise(0))
        .drop("_parts")
    )
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    repeated = dim.join(hot, key, "left").withColumn("_salt", F.explode(every_salt)).drop("_parts")
    return dealt.join(repeated, [key, "_salt"]).drop("_salt")
