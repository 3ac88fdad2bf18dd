"""Visually identical text with different characters (problem 7).

Each Arrow batch is handed to an embedded DuckDB, whose SQL brings the text to one form: canonical composition,
compatibility forms of the same look, invisible characters, blanks and look-alike letters. Equal forms meet by the
hash of the form; the documents' texts never travel.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.session import ship, store

# Letters of other alphabets that have the look of a Latin letter, each above the letter it looks like.
_CYRILLIC = "АВЕЅІЈКМНОРСТУХаеорсухѕіјһԁԛԝёЁїЇѵүҮӏӀԌ"
_AS_LATIN = "ABESIJKMHOPCTYXaeopcyxsijhdqwëËïÏvyYlIG"
_GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονόϳρϲϹ"
_AS_LATIN2 = "ABEZHIKMNOPTYXovójpcC"
_ARMENIAN, _AS_LATIN3 = "օսհոՕՍԼՏ", "ouhnOULS"
_CHEROKEE, _AS_LATIN4 = "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ", "ABCDEGHJKLMPRSTVWZ"
_PHONETIC, _AS_LATIN5 = "ɡɑ", "ga"
_LETTERS = _CYRILLIC + _GREEK + _ARMENIAN + _CHEROKEE + _PHONETIC
_LATIN = _AS_LATIN + _AS_LATIN2 + _AS_LATIN3 + _AS_LATIN4 + _AS_LATIN5
_HYPHENS = "‐‑﹣"
LOOKS = str.maketrans(_LETTERS, _LATIN)
#: A form with so many documents is hot: its pairs are made in SALTS parts.
HOT = 500
SALTS = 32


def _compatible() -> tuple[str, str]:
    """Single characters whose compatibility form is one character of the same look: other widths, radicals, presentation forms."""
    spans = [(0x2E80, 0x2FD5), (0xF900, 0xFAFF), (0xFF01, 0xFF9F), (0xFFE0, 0xFFEE), (0xFE70, 0xFEFC), (0xFB50, 0xFBB1)]
    pairs = [(chr(c), n) for a, b in spans for c in range(a, b + 1) if len(n := unicodedata.normalize("NFKC", chr(c))) == 1 and n != chr(c) and not n.isspace()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_COMPAT = _compatible()
# What stands for several letters: ligatures, and Roman numerals by their letters. Letters in bold, script or circles differ to a reader.
_LIGATURES = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xFB00, 0xFB07), *range(0x2160, 0x2180), *range(0xFEF5, 0xFEFD))}
_INVISIBLE = r"[\p{Cf}\x{00}-\x{08}\x{0E}-\x{1B}\x{7F}-\x{84}\x{86}-\x{9F}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}]"
_BLANKS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}\x{2800}\x{3164}\x{FFA0}]+"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def form_sql(column: str = "text") -> str:
    """The DuckDB expression that brings ``column`` to one form."""
    x = f"nfc_normalize({column})"
    frm, to = _COMPAT[0] + _LETTERS + _HYPHENS, _COMPAT[1] + _LATIN + "-" * len(_HYPHENS)
    frm, to = frm + "".join(a for a, b in _LIGATURES.items() if len(b) == 1), to + "".join(b for b in _LIGATURES.values() if len(b) == 1)
    for a, b in _LIGATURES.items():
        if len(b) == 1:
            continue
        x = f"replace({x}, {_quoted(a)}, {_quoted(b)})"
    # Plain Latin-1 text has nothing to map: the tables are built only for rows that need them.
    x = f"CASE WHEN regexp_matches({column}, '[^\\x{{00}}-\\x{{FF}}]') THEN nfc_normalize(regexp_replace(translate({x}, {_quoted(frm)}, {_quoted(to)}), {_quoted(_INVISIBLE)}, '', 'g')) ELSE regexp_replace({column}, {_quoted(_INVISIBLE)}, '', 'g') END"
    return f"trim(regexp_replace({x}, {_quoted(_BLANKS)}, ' ', 'g'))"


def _in_duckdb(df: DataFrame, sql: str, schema: str) -> DataFrame:
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                con.register("part", pa.Table.from_batches([batch.slice(at, 2000)]))
                got = con.execute(sql).to_arrow_table()
                con.unregister("part")
                yield from got.to_batches()

    return df.mapInArrow(run, schema)


def normalised(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, texto): every text in its one form. Null stays null; empty and blank texts become ''."""
    src = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return _in_duckdb(src, f"SELECT doc_id, {form_sql()} AS texto FROM part", "doc_id bigint, texto string")


def lookalike_classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, forma, grafia, representante, n): documents whose look is shared by texts of other characters, one row each.

    ``forma`` names the look, ``grafia`` the spelling of the document, ``representante`` the smallest doc_id of that
    spelling and ``n`` how many documents have it. Null texts and texts without a visible character are in no class; a
    repeated row counts once. An empty table gives no classes.
    """
    src = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    sql = f"SELECT doc_id, md5(f) AS forma, md5(text) AS grafia FROM (SELECT doc_id, text, {form_sql()} AS f FROM part) WHERE f <> ''"
    hashed = store(_in_duckdb(src, sql, "doc_id bigint, forma string, grafia string").distinct(), "forms")
    # Only forms of more than one spelling go on; min, max and counts are mergeable, so a form shared by a third of the rows is no burden.
    mixed = hashed.groupBy("forma").agg(F.min("grafia").alias("x"), F.max("grafia").alias("y")).where("x <> y").select("forma")
    kept = hashed.join(mixed, "forma", "left_semi")
    spellings = kept.groupBy("forma", "grafia").agg(F.min("doc_id").alias("representante"), F.count("*").alias("n"))
    return kept.join(spellings, ["forma", "grafia"]).select("doc_id", "forma", "grafia", "representante", "n")


def lookalike_pairs(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents whose texts look the same but are made of different characters.

    Identical texts are no pair, nor are null texts and texts without a visible character. A repeated document row
    counts once. An empty table gives no pairs. Pairs come from the classes; those of a form with many documents are
    made in parts, so that no task has all of them.
    """
    classes = store(lookalike_classes(documents, doc_id, text), "classes")
    size = classes.groupBy("forma").agg(F.count("*").alias("k")).where(F.col("k") >= hot).select("forma", F.lit(SALTS).alias("parts"))
    members = classes.select("doc_id", "forma", "grafia").join(size, "forma", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    a = members.select(F.col("doc_id").alias("doc_id_a"), "forma", F.col("grafia").alias("ga"), F.pmod(F.xxhash64("doc_id"), "parts").cast("int").alias("part"))
    b = members.select(F.col("doc_id").alias("doc_id_b"), "forma", F.col("grafia").alias("gb"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return a.join(b, ["forma", "part"]).where("doc_id_a < doc_id_b AND ga <> gb").select("doc_id_a", "doc_id_b")
