"""Encoding of the corpus with a public byte-level vocabulary (problem 8), by overlapping chunks.

A text longer than one chunk is cut into chunks that overlap, so that no single task has to hold a huge text. Chunks
are pre-tokenised in parallel. The pattern looks only forward, so two neighbours that share one pre-token boundary
share all that follow: there the text is cut, and the pieces are encoded on their own. Where neighbours share no
boundary (one pre-token longer than the overlap), the pieces stay joined. Decoding concatenates raw bytes.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from telar.session import ship

TOKENIZERS = "/opt/tokenizers"
CHUNK = 16_384
OVERLAP = 512
_cache: dict[str, tuple] = {}


def _load(folder: str, vocabulary: str) -> tuple:
    """(pattern, encoder) of a rank file; one per Python worker."""
    if (folder, vocabulary) not in _cache:
        import tiktoken

        spec = importlib.util.spec_from_file_location("_public_tokenizers", os.path.join(folder, "__init__.py"))
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        with open(os.path.join(folder, f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _cache[folder, vocabulary] = module.PATTERN, tiktoken.Encoding(vocabulary, pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _cache[folder, vocabulary]


def _encoder(folder: str, vocabulary: str, text: str):
    """An Arrow function that replaces the column ``text`` by ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        _, enc = _load(folder, vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                i = part.schema.get_field_index(text)
                flat: list[int] = []
                ends = [0]
                for t in part.column(i).to_pylist():
                    if t:
                        flat += enc.encode_ordinary(t)
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(np.asarray(ends, np.int32)), pa.array(np.asarray(flat, np.int32)))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(part.num_columns) if k != i), ids], [*(n for n in part.schema.names if n != text), "ids"])

    return run


def _boundaries(folder: str, vocabulary: str, overlap: int):
    """Adds to each chunk the absolute pre-token boundaries in its first and in its last ``overlap`` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern, _ = _load(folder, vocabulary)
        rx = regex.compile(pattern)
        ints = pa.list_(pa.int32())
        for batch in batches:
            for r in range(0, batch.num_rows, 64):
                part = batch.slice(r, 64)
                cols = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                heads, tails = [], []
                for t, at, last in zip(cols["piece"].to_pylist(), cols["at"].to_pylist(), cols["last"].to_pylist()):
                    ends = [m.end() for m in rx.finditer(t)]
                    # The last two pre-tokens may end elsewhere once the text goes on.
                    sure = ends if last else [e for e in ends[:-2] if e < len(t) - 1]
                    heads.append([at, *(at + e for e in sure if e <= overlap)])
                    tails.append([at + e for e in sure if e >= len(t) - overlap])
                yield pa.RecordBatch.from_arrays([cols["who"], cols["k"], cols["at"], cols["piece"], pa.array(heads, ints), pa.array(tails, ints)], ["who", "k", "at", "piece", "head", "tail"])

    return run


def encode(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids): the token ids of every text, without special tokens; their strings in a text are ordinary text.

    Null and empty texts give an empty list; blanks are encoded as they are. Equal rows give equal rows, as many as
    come in; rows with a null doc_id are encoded like any other. Chunks of ``chunk`` characters reach ``overlap``
    characters into the next one.
    """
    ship(documents.sparkSession)
    src = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    long = F.length("text") > chunk
    short = src.where(~long | F.col("text").isNull()).mapInArrow(_encoder(folder, vocabulary, "text"), "doc_id bigint, ids array<int>")

    # A row of its own name per long text: doc_id may be null or repeated.
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / F.lit(chunk)).cast("int"))
    cut = src.where(long).withColumn("row", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.monotonically_increasing_id()))
    cut = cut.select("row", "doc_id", "text", F.explode(starts).alias("k"))
    cut = cut.select("row", "doc_id", "k", (F.col("k") * chunk).cast("int").alias("at"), F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("piece"), ((F.col("k") + 1) * chunk >= F.length("text")).alias("last"))
    # The name of a row rides along with its number, so the Python side needs to know neither.
    keys = cut.select(F.struct("row", "doc_id").alias("who"), "k", "at", "piece", "last")
    marked = keys.mapInArrow(_boundaries(folder, vocabulary, overlap), "who struct<row: string, doc_id: bigint>, k int, at int, piece string, head array<int>, tail array<int>")
    w = W.partitionBy("who").orderBy("k")
    # The first boundary that a chunk shares with the one before; the first chunk starts at 0.
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(w)))
    begun = marked.select("who", "k", "at", "piece", F.when(F.col("k") == 0, F.lit(0)).otherwise(shared).alias("cut"))
    begun = begun.withColumn("group", F.count("cut").over(w))
    # Text up to the next cut: the following chunk's start where there is none to share, so that joined pieces meet end to end.
    following, next_at = F.lead("cut").over(w), F.lead("at").over(w)
    begin = F.coalesce(F.col("cut"), F.col("at"))
    end = F.coalesce(following, next_at, F.col("at") + F.length("piece"))
    pieces = begun.select("who", "k", "group", F.substring("piece", begin - F.col("at") + 1, end - begin).alias("piece"))
    whole = pieces.groupBy("who", "group").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "piece"))), lambda x: x["piece"]), "").alias("text"))
    coded = whole.mapInArrow(_encoder(folder, vocabulary, "text"), "who struct<row: string, doc_id: bigint>, group bigint, ids array<int>")
    joined = coded.groupBy("who").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("group", "ids"))), lambda x: x["ids"])).alias("ids"))
    return short.unionByName(joined.select(F.col("who.doc_id").alias("doc_id"), "ids"))


def decode(encoded: DataFrame, folder: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, text) of (doc_id, ids): the raw bytes of all ids, concatenated, read as UTF-8. A null list gives null."""
    from telar.functions.batches import map_rows

    def make():
        _, enc = _load(folder, vocabulary)
        return lambda c: {"doc_id": c["doc_id"], "text": [None if x is None else b"".join(enc.decode_single_token_bytes(i) for i in x).decode("utf-8", "replace") for x in c["ids"]]}

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id bigint, text string", rows=500)
