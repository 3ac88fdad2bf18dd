"""Queries over the operators for training text, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telar.session import table as _t


def _p1_found(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.repetition import found

    return found(_t(spark, sf, "documents"))


def _p1_repetition(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.repetition import repetition

    return repetition(_t(spark, sf, "documents"))


def _p2_found(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.language import found

    return found(_t(spark, sf, "documents"))


def _p2_passages(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.language import languages

    return languages(_t(spark, sf, "documents"))


def _p3_found(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.quality import found

    return found(_t(spark, sf, "chunks"))


def _p3_statistics(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.quality import chunk_quality

    return chunk_quality(_t(spark, sf, "chunks"))


def _p4_found(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.sentences import found

    return found(_t(spark, sf, "documents"), _t(spark, sf, "muestra"))


def _p4_documents(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.sentences import corpus_lexicon, sentences

    documents = _t(spark, sf, "documents")
    return sentences(documents, corpus_lexicon(documents))


def _p4_chunks(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.sentences import corpus_lexicon, sentences

    chunks = _t(spark, sf, "chunks").select("chunk_id", "texto").dropDuplicates(["chunk_id"])
    return sentences(chunks, corpus_lexicon(chunks.withColumnRenamed("texto", "text")), "chunk_id", "texto", "string")


def _p5_found(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.scans import found

    return found(_t(spark, sf, "documents"))


def _p5_noise(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.scans import noise

    return noise(_t(spark, sf, "documents"))


def _p5_repaired(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.scans import repaired

    return repaired(_t(spark, sf, "documents"))


def _p7_found(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.lookalike import lookalike_pairs

    return lookalike_pairs(_t(spark, sf, "documents"))


def _p7_classes(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.lookalike import lookalike_classes

    return lookalike_classes(_t(spark, sf, "documents")).select("doc_id", "representante", "n")


def _p7_normalised(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.lookalike import normalised

    return normalised(_t(spark, sf, "documents"))


def _p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.encoding import encode

    return encode(_t(spark, sf, "documents"))


def _p9_found(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.leakage import leaked

    return leaked(_t(spark, sf, "documents"), _t(spark, sf, "eval_items"))


def _p9_leaks(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.leakage import leaks

    return leaks(_t(spark, sf, "documents"), _t(spark, sf, "eval_items"))


def _p10_found(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.mojibake import found

    return found(_t(spark, sf, "documents"))


def _p10_restored(spark: SparkSession, sf: str) -> DataFrame:
    from telar.llm.mojibake import restored

    return restored(_t(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": _p1_found,
        "p1_repetition": _p1_repetition,
        "p2_found": _p2_found,
        "p2_passages": _p2_passages,
        "p3_found": _p3_found,
        "p3_statistics": _p3_statistics,
        "p4_found": _p4_found,
        "p4_documents": _p4_documents,
        "p4_chunks": _p4_chunks,
        "p5_found": _p5_found,
        "p5_noise": _p5_noise,
        "p5_repaired": _p5_repaired,
        "p7_found": _p7_found,
        "p7_classes": _p7_classes,
        "p7_normalised": _p7_normalised,
        "p8_ids": _p8_ids,
        "p9_found": _p9_found,
        "p9_leaks": _p9_leaks,
        "p10_found": _p10_found,
        "p10_restored": _p10_restored,
    }


# The look of a text, worked out character by character: full-width signs by their distance to ASCII, look-alike letters
# by a table of their own, ligatures spelled out. It shares nothing with the operator's expression.
_LOOK = """WITH alike(a, b) AS (SELECT unnest(string_split('А В Е Ѕ І Ј К М Н О Р С Т У Х а е о р с у х ѕ і ј һ ё Ё ї Ї Α Β Ε Ζ Η Ι Κ Μ Ν Ο Ρ Τ Υ Χ ο ν ό ρ ‐ ‑', ' ')), unnest(string_split('A B E S I J K M H O P C T Y X a e o p c y x s i j h ë Ë ï Ï A B E Z H I K M N O P T Y X o v ó p - -', ' '))),
m AS (SELECT map(list(a), list(b)) AS m FROM alike),
spelled AS (SELECT doc_id, text, replace(replace(replace(replace(replace(nfc_normalize(text), 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl') AS t FROM documents WHERE text IS NOT NULL),
chars AS (SELECT doc_id, text, list_transform(string_split(regexp_replace(t, '[\\p{Cf}]', '', 'g'), ''), lambda c: CASE WHEN c <> '' AND unicode(c) BETWEEN 65281 AND 65374 THEN chr(unicode(c) - 65248) ELSE coalesce(m.m[c], c) END) AS cs FROM spelled, m),
look AS (SELECT doc_id, text, trim(regexp_replace(nfc_normalize(array_to_string(cs, '')), '[\\s\\p{Z}]+', ' ', 'g'), ' ') AS f FROM chars)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p7_found": f"{_LOOK} SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM look a JOIN look b ON a.f = b.f AND a.doc_id < b.doc_id AND a.text <> b.text WHERE a.f <> ''",
        "p7_classes": f"{_LOOK}, d AS (SELECT DISTINCT doc_id, text, f FROM look WHERE f <> '') SELECT doc_id, min(doc_id) OVER w AS representante, count(*) OVER w AS n FROM d WHERE f IN (SELECT f FROM d GROUP BY f HAVING count(DISTINCT text) > 1) WINDOW w AS (PARTITION BY f, text)",
    }
