"""Inventory look-ups, coverage and duplicates: identity is looked up, and nothing is dropped silently."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions import paths
from telar.functions.text import fingerprint


def inventory_keys(inventory: DataFrame) -> DataFrame:
    """(fuente, doc_id_oficial, codigo, fenomeno): one row per path; blank ids are no ids. Repeated rows count once."""
    path = F.concat_ws("/", F.regexp_replace(paths.posix(F.col("carpeta")), "/+$", ""), F.col("nombre_estandarizado"))
    return inventory.select(path.alias("fuente"), F.nullif(F.trim("doc_id_oficial"), F.lit("")).alias("doc_id_oficial"), F.col("codigo_observatorio").alias("codigo"), paths.topic_code(F.col("fenomeno"), path).alias("fenomeno")).groupBy("fuente").agg(
        F.min("doc_id_oficial").alias("doc_id_oficial"), F.min("codigo").alias("codigo"), F.min("fenomeno").alias("fenomeno")
    )


def identified(documents: DataFrame, inventory: DataFrame) -> DataFrame:
    """(fuente, doc_id_oficial, estado): each file with the id that the inventory has for its path, or the reason why it has none."""
    keys = inventory_keys(inventory)
    joined = documents.select("fuente").join(keys.select("fuente", F.col("doc_id_oficial").alias("id"), F.lit(True).alias("listed")), "fuente", "left")
    state = F.when(F.col("listed").isNull(), "fuera_del_indice").when(F.col("id").isNull(), "sin_id").otherwise("ok")
    return joined.select("fuente", F.col("id").alias("doc_id_oficial"), state.alias("estado"))


def inventory_errors(inventory: DataFrame) -> DataFrame:
    """(problema, clave, n): what makes an inventory no identity: rows without an id ('sin_id'), ids of several paths ('id_repetido'), paths of several rows that differ ('ruta_repetida')."""
    path = F.concat_ws("/", F.regexp_replace(paths.posix(F.col("carpeta")), "/+$", ""), F.col("nombre_estandarizado"))
    rows = inventory.select(path.alias("ruta"), F.nullif(F.trim("doc_id_oficial"), F.lit("")).alias("id")).distinct()
    none = rows.where("id IS NULL").select(F.lit("sin_id").alias("problema"), F.col("ruta").alias("clave"), F.lit(1).cast("bigint").alias("n"))
    ids = rows.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("id_repetido").alias("problema"), F.col("id").alias("clave"), "n")
    where = rows.groupBy("ruta").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("ruta_repetida").alias("problema"), F.col("ruta").alias("clave"), "n")
    return none.unionByName(ids).unionByName(where)


def require_coverage(documents: DataFrame, inventory: DataFrame, only: str | None = None) -> None:
    """An error if paths of the inventory are not among the documents. A partial run (``only`` one format) is not held to it."""
    if only is None:
        absent = missing(inventory_keys(inventory), documents, "fuente")
        n = absent.count()
        if n:
            raise ValueError(f"{n} listed files were not read, such as {[r[0] for r in absent.orderBy('fuente').limit(5).collect()]}")


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row (n_left, n_right, n_both, n_left_only, n_right_only) over the distinct non-null keys of two tables."""
    a, b = (x.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct().withColumn(n, F.lit(1)) for x, n in ((left, "l"), (right, "r")))
    j = a.join(b, "k", "full")
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    return j.agg(F.count("l").alias("n_left"), F.count("r").alias("n_right"), F.count_if(both).alias("n_both"), F.count_if(F.col("r").isNull()).alias("n_left_only"), F.count_if(F.col("l").isNull()).alias("n_right_only"))


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key): distinct keys of ``left`` that ``right`` does not have."""
    return left.select(key).where(F.col(key).isNotNull()).distinct().join(right.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > 1) & F.col(key).isNotNull())


def duplicate_content(documents: DataFrame) -> DataFrame:
    """(content_sha1, n, primero): contents that several documents share; empty ones are no duplicates of each other."""
    h = documents.select(F.col("doc_id"), fingerprint(F.col("text")).alias("content_sha1"))
    # A filter on the key itself would be pushed below and have every text normalised twice.
    by = h.groupBy("content_sha1").agg(F.count("*").alias("n"), F.min("doc_id").alias("primero"), F.max("content_sha1").alias("some"))
    return by.where("n > 1 AND some IS NOT NULL").select("content_sha1", "n", "primero")


def acceptance(documents: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row of checks: unique ids, unique paths, known formats, topics, listed paths, texts with content."""
    keys = inventory_keys(inventory).select("fuente", F.lit(1).alias("listed"))
    d = documents.select("doc_id_oficial", "fuente", "formato", "fenomeno", "text").join(keys, "fuente", "left")
    return d.agg(
        F.count("*").alias("n"),
        (F.count("*") == F.count_distinct("doc_id_oficial")).alias("unique_ids"),
        (F.count("*") == F.count_distinct("fuente")).alias("unique_paths"),
        F.bool_and(F.coalesce(F.col("formato").isin("json", "pdf", "pbf", "csv", "jpg", "xlsx", "avif", "txt"), F.lit(False))).alias("known_formats"),
        F.bool_and(F.coalesce(F.col("fenomeno").between(1, 3), F.lit(False))).alias("known_topics"),
        F.count_if(F.col("listed").isNull()).alias("n_unlisted"),
        F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("n_empty"),
    )
