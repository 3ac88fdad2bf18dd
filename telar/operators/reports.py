"""Reports: the top of a table, groups of copies, labels, redundancy, chunks over the limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar import config as C
from telar.functions import paths
from telar.functions.text import fingerprint


def top(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The n rows with the largest value, equals by the ties: every task hands on its n best."""
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(n)


def copies(documents: DataFrame) -> DataFrame:
    """(tipo, valor, grupos, sobrantes): groups of documents of one content, and how many copies are to spare, in all, by format and by institution of the first of each group by path."""
    h = documents.select(fingerprint(F.col("text")).alias("h"), "fuente", "formato")
    groups = h.groupBy("h").agg(F.count("*").alias("n"), F.min_by(F.struct("formato", paths.institution(F.col("fuente")).alias("inst")), "fuente").alias("first"), F.max("h").alias("some")).where("n > 1 AND some IS NOT NULL")
    kinds = F.explode(F.array(F.struct(F.lit("todos").alias("tipo"), F.lit("").alias("valor")), F.struct(F.lit("formato").alias("tipo"), F.col("first.formato").alias("valor")), F.struct(F.lit("institucion").alias("tipo"), F.col("first.inst").alias("valor"))))
    return groups.select("n", kinds.alias("k")).groupBy("k.tipo", "k.valor").agg(F.count("*").alias("grupos"), F.sum(F.col("n") - 1).alias("sobrantes"))


def unlabelled(documents: DataFrame, lang: str = "lang", mixed: str | None = None) -> DataFrame:
    """(doc_id, motivo): documents whose language is undetermined ('und') or mixed ('mixto')."""
    und = F.when(F.col(lang).isNull() | F.col(lang).isin("", "und"), "und")
    why = F.coalesce(und, F.when(F.col(mixed), "mixto")) if mixed else und
    return documents.select("doc_id", why.alias("motivo")).where("motivo IS NOT NULL")


def redundancy(features: DataFrame) -> DataFrame:
    """One row (tiles, features, emitidas, redundancia, minimo, mediana, maximo): features against those emitted once each, in percent, and how often a feature is repeated."""
    per = features.where("fid IS NOT NULL").groupBy("fid").agg(F.count("*").alias("k"))
    # The median of counts is found from how many features have each count.
    sizes = per.groupBy("k").agg(F.count("*").alias("c"))
    n = sizes.agg(F.sum("c").alias("emitidas"), F.sum(F.col("c") * F.col("k")).alias("n"), F.min("k").alias("minimo"), F.max("k").alias("maximo"), F.expr("percentile(k, 0.5, c)").alias("mediana"))
    tiles = features.agg(F.count_distinct("fuente").alias("tiles"), F.count("*").alias("features"))
    share = F.round(100.0 * (F.col("n") - F.col("emitidas")) / F.col("n"), 4)
    return tiles.crossJoin(n).select("tiles", "features", "emitidas", share.alias("redundancia"), "minimo", "mediana", "maximo")  # one row each


def long_chunks(chunks: DataFrame, most: int = C.LONGEST) -> DataFrame:
    """(doc_id, formato, n_chunks, n_largos, mayor): the documents with chunks of more words than may be put out; catalogues have them on purpose."""
    by = chunks.groupBy("doc_id", "formato").agg(F.count_distinct("chunk_id").alias("n_chunks"), F.count_distinct(F.when(F.col("num_words") > most, F.col("chunk_id"))).alias("n_largos"), F.max("num_words").alias("mayor"))
    return by.where("n_largos > 0")
