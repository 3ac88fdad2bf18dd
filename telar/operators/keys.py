"""Per-key results over keys of very unequal size (problem 6).

Exact quantiles per key by distributed selection: values are counted into histograms whose counts merge on the
map side, and only the bin that holds the wanted rank is refined, until each bin holds one value. A hot key's
values are never gathered: every row that travels is a count of a (key, value) or a (key, bin).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from telar.session import store

#: Keys with at least this share of all weights are salted. There are at most 1 / HOT_SHARE of them, whatever the
#: size of the data: that is the proven bound of the one broadcast here.
HOT_SHARE = 0.001
SALTS = 32
BINS = 64


def key_counts(df: DataFrame, key: str, distinct: str) -> DataFrame:
    """Distinct non-null ``distinct`` per non-null ``key``: (key, n). The pairs spread by their own hash, so no key is hot."""
    pairs = df.select(F.col(key).alias("k"), F.col(distinct).alias("d")).where("k IS NOT NULL AND d IS NOT NULL").distinct()
    return pairs.groupBy("k").agg(F.count("*").alias("n")).withColumnRenamed("k", key)


def key_quantiles(df: DataFrame, key: str, value: str, probs: Sequence[float] = (0.5, 0.9, 0.99), distinct: str | None = None, bins: int = BINS) -> DataFrame:
    """Exact discrete quantiles of ``value`` per ``key``.

    Returns (key, n, n_null, v_min, v_max, q_00, q_01, ...), one row per non-null key, one ``q`` column for each of
    ``probs`` in order. A quantile p is the smallest value with at least ceil(p * n) values up to it.

    * ``distinct``: rows with an equal (key, distinct) count once, with their largest value; null ``distinct`` rows
      belong to no record and are left out.
    * Null keys belong to no group. Null values count in ``n_null`` only; a key with null values alone has n = 0 and
      null quantiles. Ties and repeated rows count as often as they occur. An empty table gives an empty result.
    * Other columns of ``df``, whatever their names, are ignored.
    """
    if not isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError("value must be an integer column; scale decimals to integers first")
    rows = df.select(F.col(key).alias("k"), F.col(value).cast("bigint").alias("v"), *([F.col(distinct).alias("d")] if distinct else [])).where("k IS NOT NULL")
    if distinct:
        rows = rows.where("d IS NOT NULL").groupBy("k", "d").agg(F.max("v").alias("v"))
    counted = store(rows.groupBy("k", "v").agg(F.count("*").alias("c")), "key-values")

    total = counted.agg(F.sum("c")).first()[0] or 0
    per_key = store(
        counted.groupBy("k").agg(
            F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("c"))), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0)).alias("n_null"),
            F.min("v").alias("v_min"),
            F.max("v").alias("v_max"),
        ),
        "key-sizes",
    )
    hot = F.broadcast(per_key.where((F.col("n") + F.col("n_null")) >= max(1.0, HOT_SHARE * total)).select("k", F.lit(True).alias("hot")))
    values = counted.where("v IS NOT NULL").join(hot, "k", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop("hot")

    # FLOOR written as the complement, so that p * n just above a whole number counts as SQL's discrete quantile does.
    n = F.col("n").cast("double")
    state = per_key.where("n > 0").select("k", "v_min", "v_max", "n", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("q", "p"))
    state = store(state.select("k", "q", F.col("v_min").alias("lo"), F.col("v_max").alias("hi"), F.greatest(F.lit(1), (n - F.floor(n - F.col("p") * n)).cast("bigint")).alias("rank")), "key-state")
    solved = state.where("lo = hi").select("k", "q", F.col("lo").alias("x"))
    parts = [solved]
    while not state.where("lo < hi").isEmpty():
        todo = state.where("lo < hi").join(hot, "k", "left").withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("hot")
        # Distances as doubles can't overflow; min and max of each bin keep the next range exact.
        place = F.least(F.lit(bins - 1), F.floor((F.col("v").cast("double") - F.col("lo").cast("double")) / (F.col("hi").cast("double") - F.col("lo").cast("double")) * bins)).cast("int")
        hist = (
            values.join(todo, ["k", "salt"])
            .where("v BETWEEN lo AND hi")
            .groupBy("k", "q", "rank", place.alias("bin"))
            .agg(F.sum("c").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        )
        upto = F.sum("c").over(W.partitionBy("k", "q").orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
        after = store(hist.withColumn("upto", upto).where("upto >= rank AND upto - c < rank").select("k", "q", "lo", "hi", (F.col("rank") - F.col("upto") + F.col("c")).alias("rank")), "key-state")
        parts.append(after.where("lo = hi").select("k", "q", F.col("lo").alias("x")))
        state = after
    answers = parts[0]
    for p in parts[1:]:
        answers = answers.unionByName(p)
    names = [f"q_{i:02d}" for i in range(len(probs))]
    wide = answers.groupBy("k").agg(*[F.max(F.when(F.col("q") == i, F.col("x"))).alias(c) for i, c in enumerate(names)])
    return per_key.join(wide, "k", "left").select(F.col("k").alias(key), "n", "n_null", "v_min", "v_max", *names)


def hot_keys(df: DataFrame, key: str, record: str, value: str, share: float = 0.02) -> DataFrame:
    """``key_quantiles`` of the keys that own at least ``share`` of all distinct ``record``, those without key included."""
    profile = key_quantiles(df, key, value, distinct=record)
    total = df.select(F.col(record).alias("d")).where("d IS NOT NULL").distinct().agg(F.count("*").alias("total"))
    return profile.crossJoin(F.broadcast(total)).where((F.col("n") + F.col("n_null")) >= F.lit(share) * F.col("total")).drop("total")
