"""Reports on texts and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telar import config as C
from telar.functions.text import word_count
from telar.session import store

TERMINATED = r"[.!?…:;。！？।؟][\"'”»)\]]*\s*$"
SALTS = 32
RECORD_LINE = r"^[A-Za-zÀ-ɏ0-9_.\- ]{1,40}:"


def terminators(chunks: DataFrame) -> DataFrame:
    """(formato, n, abiertos, pct): chunks that do not end with a terminator."""
    open_ = ~F.trim("texto").rlike(TERMINATED)
    return chunks.groupBy("formato").agg(F.count("*").alias("n"), F.count_if(open_).alias("abiertos"), F.round(100.0 * F.count_if(open_) / F.count("*"), 4).alias("pct"))


def open_documents(chunks: DataFrame, least: int = 3) -> DataFrame:
    """(doc_id, n, abiertos): documents of prose most of whose chunks are open."""
    open_ = ~F.trim("texto").rlike(TERMINATED)
    d = chunks.where(~F.lower("formato").isin(*C.RECORD_FORMATS) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(open_).alias("abiertos"))
    return d.where((F.col("n") >= least) & (F.col("abiertos") * 2 > F.col("n")))


def residual(text: Column) -> Column:
    """Why an open chunk is open: nota (a footnote mark), anio (a year or figure), numerico (mostly numbers), corte (a real cut)."""
    t = F.trim(text)
    last = F.slice(F.split(t, r"\s+"), -F.least(F.lit(15), F.size(F.split(t, r"\s+"))), 15)
    numeric = F.size(F.filter(last, lambda x: x.rlike(r"^[^A-Za-z]*[0-9][0-9.,;:%/-]*$")))
    return F.when(t.rlike(TERMINATED), "cerrado").when(t.rlike(r"[\[(][0-9]{1,3}[\])]$|[¹²³]$"), "nota").when(t.rlike(r"\b(19|20)[0-9]{2}$"), "anio").when(numeric >= 0.4 * F.size(last), "numerico").otherwise("corte")


def residual_classes(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(residual(F.col("texto")).alias("clase")).agg(F.count("*").alias("n"))


def orphan_lines(chunks: DataFrame) -> DataFrame:
    """(formato, n_docs, n_lineas, huerfanas): lines of record chunks without a field name in front."""
    lines = chunks.where(F.lower("formato").isin(*C.RECORD_FORMATS)).select("formato", "doc_id", F.explode(F.split("texto", "\n")).alias("l")).where("trim(l) <> ''")
    return lines.groupBy("formato").agg(F.count_distinct("doc_id").alias("n_docs"), F.count("*").alias("n_lineas"), F.count_if(~F.col("l").rlike(RECORD_LINE)).alias("huerfanas"))


def characters(documents: DataFrame, pattern: str) -> DataFrame:
    """(codigo, n, n_docs): how often each character of a class occurs, by its code point."""
    hits = documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1))).alias("c"))
    return hits.groupBy(F.hex(F.encode("c", "utf-32")).alias("codigo")).agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


def alphabets(documents: DataFrame) -> DataFrame:
    """(doc_id, latin, cirilico, arabe, han, portador): letters per alphabet; carriers are Latin texts with a few Cyrillic letters."""
    n = lambda p: F.coalesce(F.regexp_count("text", F.lit(p)), F.lit(0))
    d = documents.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("largo"), n(r"\p{IsLatin}").alias("latin"), n(r"\p{IsCyrillic}").alias("cirilico"), n(r"\p{IsArabic}").alias("arabe"), n(r"\p{IsHan}").alias("han"))
    all_ = F.greatest(F.col("latin") + F.col("cirilico") + F.col("arabe") + F.col("han"), F.lit(1))
    carrier = (F.col("cirilico") > 0) & (F.col("cirilico") / all_ < 0.02) & (F.col("latin") / all_ > 0.5) & (F.col("largo") >= 200)
    return d.select("doc_id", "latin", "cirilico", "arabe", "han", carrier.alias("portador"))


def order_statistics(df: DataFrame, value: str, key: str | None = None) -> DataFrame:
    """(key?, n, minimo, mediana, p95, maximo, media) of an integer column; ranks are exact, found by counting values.

    The median is element n // 2 and the other element floor(0.95 n) of the sorted values: as (value, count) pairs, not
    as gathered rows.
    """
    keys = [key] if key else []
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    w = W.partitionBy(*keys)
    run = counts.withColumn("upto", F.sum("c").over(w.orderBy("v"))).withColumn("n", F.sum("c").over(w))
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
    return run.groupBy(*keys).agg(F.max("n").alias("n"), F.min("v").alias("minimo"), at(F.floor(F.col("n") / 2)).alias("mediana"), at(F.floor(F.col("n") * 0.95)).alias("p95"), F.max("v").alias("maximo"), F.round(F.sum(F.col("v") * F.col("c")) / F.max("n"), 3).alias("media"))


def token_ratio(chunks: DataFrame) -> DataFrame:
    """One row on tokens per word, in thousandths."""
    r = chunks.where("num_tokens IS NOT NULL AND num_words > 0").select(F.round(1000.0 * F.col("num_tokens") / F.col("num_words")).cast("bigint").alias("milesimas"))
    return order_statistics(r, "milesimas")


def deltas(base: DataFrame, variant: DataFrame, key: str, value: str) -> DataFrame:
    """(key, base, variante, delta, mejor): two variants of a per-key figure side by side; less is better."""
    j = base.select(key, F.col(value).alias("base")).join(variant.select(key, F.col(value).alias("variante")), key)
    return j.select(key, "base", "variante", (F.col("variante") - F.col("base")).alias("delta"), (F.col("variante") < F.col("base")).alias("mejor"))


def stratified_sample(df: DataFrame, key: str, stratum: str, n: int, seed: int = 7) -> DataFrame:
    """(key, stratum): about n rows, each stratum by its share and at least one: those with the lowest hashes of the key, so twice the same.

    Exact at every size: a stratum is ranked in SALTS parts by the hash, and what each keeps, no more than the quota, is ranked again.
    """
    d = df.select(F.col(key).alias("_key"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"))
    sizes = d.groupBy("_stratum").agg(F.count("*").alias("_size"))
    total = sizes.agg(F.sum("_size").alias("_total"))
    quota = F.least(F.col("_size"), F.greatest(F.lit(1), F.bround(F.lit(float(n)) * F.col("_size") / F.col("_total")).cast("bigint")))
    q = sizes.crossJoin(F.broadcast(total)).select("_stratum", quota.alias("_quota"))  # one row
    h = F.md5(F.concat(F.col("_key").cast("string"), F.lit(f"#{seed}")))
    drawn = d.withColumn("_h", h).join(F.broadcast(q), "_stratum")  # a row per stratum
    r = F.row_number().over(W.partitionBy("_stratum").orderBy("_h", "_key"))
    # A stratum of a third of the rows is ranked in SALTS parts first; what is left of it is its quota from each.
    salted = drawn.withColumn("_salt", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int") % SALTS)
    low = F.row_number().over(W.partitionBy("_stratum", "_salt").orderBy("_h", "_key"))
    few = salted.withColumn("_r", low).where(F.col("_r") <= F.col("_quota"))
    return few.withColumn("_r", r).where(F.col("_r") <= F.col("_quota")).select(F.col("_key").alias(key), F.col("_stratum").alias(stratum))


def fingerprint(df: DataFrame, *keys: str, order: tuple[str, ...] = ()) -> DataFrame:
    """One row (n, huella): a fingerprint of the rows in the order of ``order`` (of the keys themselves, if none is given).

    Every row is hashed with its place in the order, so the same rows in another order have another fingerprint, and
    equal rows don't cancel. Places come from sizes: rows are sorted in ranges, and each range begins where the sizes of
    those before it end; no rows are brought to one task.
    """
    by = list(order or keys)
    low = (1 << 33) - 1
    at = F.monotonically_increasing_id()
    cols = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}") for i, k in enumerate(keys)]
    ranged = df.select(*cols, *[F.col(k).alias(f"_o{i}") for i, k in enumerate(by)])
    names = [f"_o{i}" for i in range(len(by))]
    rows = store(ranged.repartitionByRange(*names).sortWithinPartitions(*names).select(*[f"_k{i}" for i in range(len(keys))], F.shiftright(at, 33).alias("_part"), at.bitwiseAND(F.lit(low)).alias("_place")), "ordered")
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_size"))  # as many rows as ranges
    start = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    n = (F.col("_start") + F.col("_place")).cast("string")
    h = F.conv(F.substring(F.md5(F.concat_ws("\x1f", n, *[f"_k{i}" for i in range(len(keys))])), 1, 15), 16, 10).cast("bigint")
    return rows.join(F.broadcast(start), "_part").agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("huella"))


def vote(labels: DataFrame) -> DataFrame:
    """(doc_id, lang, parte): the label with most weight of each document's blocks (doc_id, bloque, lang, peso), the first block among equals."""
    by = labels.groupBy("doc_id", "lang").agg(F.sum("peso").alias("peso"), F.min("bloque").alias("primero"))
    total = by.groupBy("doc_id").agg(F.sum("peso").alias("total"), F.min_by("lang", F.struct(-F.col("peso"), F.col("primero"))).alias("lang"), F.max("peso").alias("peso"))
    return total.select("doc_id", "lang", F.round(F.col("peso") / F.col("total"), 6).alias("parte"))


def integrity(lines: DataFrame, required: list[str], key: str | None = None) -> DataFrame:
    """One row of checks over the lines of a JSONL file (value): blank ones, those that are no JSON, missing fields, separators and invisible characters inside, keys that come again."""
    ok = F.try_parse_json("value").isNotNull()
    absent = F.lit(False)
    for k in required:
        absent = absent | F.get_json_object("value", f"$.{k}").isNull()
    blank = F.trim("value") == ""
    keys = F.get_json_object("value", f"$.{key}") if key else F.lit(None)
    return lines.agg(F.count("*").alias("lineas"), F.count_if(blank).alias("vacias"), F.count_if(~blank & ~ok).alias("no_json"), F.count_if(ok & absent & ~blank).alias("sin_campo"), F.count_if(F.col("value").rlike(r"[\x{2028}\x{2029}]")).alias("separadores"), F.count_if(F.col("value").rlike(r"[\p{Cf}]")).alias("invisibles"), (F.count(keys) - F.count_distinct(keys)).alias("repetidos"))
