"""Exact inner-product search, document ranking, fusion with the graph, fragments with their evidence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telar import config as C
from telar.operators.chunking import subdivide
from telar.functions.batches import map_rows
from telar.session import ship

#: Queries per scan of the vectors. Each block is carried to the tasks: at 4,096 x 1,024 doubles 32 MB.
QUERY_BLOCK = 4_096
#: Queries that are scored against a batch at once: 64 x 10,000 doubles are 5 MB.
QUERY_SLICE = 64


def _best(old_s: np.ndarray | None, old_i: np.ndarray | None, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores of each row, of those held and the new ones; equals at the edge by the smaller id, as in the final ranking."""
    s, i = scores, np.broadcast_to(ids, scores.shape)
    if old_s is not None:
        s, i = np.hstack([old_s, s]), np.hstack([old_i, i])
    if s.shape[1] <= k:
        return s, np.ascontiguousarray(i)
    kth = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
    out_s, out_i = np.empty((len(s), k)), np.empty((len(s), k), np.int64)
    for r in range(len(s)):
        over, even = np.flatnonzero(s[r] > kth[r]), np.flatnonzero(s[r] == kth[r])
        if len(over) + len(even) > k:
            even = even[np.argsort(i[r, even], kind="stable")[: k - len(over)]]
        pick = np.concatenate([over, even])
        out_s[r], out_i[r] = s[r, pick], i[r, pick]
    return out_s, out_i


def knn(vectors: DataFrame, queries: DataFrame, k: int = C.TOP_K, vec_id: str = "vec_id", embedding: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, vec_id, score, rank): the k rows of largest inner product for each query (query_id, embedding), ties by id.

    A stated set of queries against all rows, in blocks of queries: every task multiplies its batch with the block and
    keeps its k best per query, so that only those are shuffled. Null vectors are no candidates.
    """
    spark = vectors.sparkSession
    ship(spark)
    src = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    rows = queries.select(F.col("query_id").cast("bigint"), F.col("embedding").cast("array<double>")).where("query_id IS NOT NULL AND embedding IS NOT NULL").orderBy("query_id").toLocalIterator()
    out = None
    held: list = []

    def scan(ids: np.ndarray, matrix: np.ndarray) -> DataFrame:
        shared = spark.sparkContext.broadcast((ids, matrix))

        def run(batches):
            ids, q = shared.value
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                e = batch.column(1)
                m = e.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                v = batch.column(0).to_numpy(zero_copy_only=False)
                for at in range(0, len(ids), QUERY_SLICE):
                    part = slice(at, at + QUERY_SLICE)
                    best[at] = _best(*best.get(at, (None, None)), q[part] @ m.T, v, k)
            for at, (s, i) in best.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[at : at + QUERY_SLICE], s.shape[1])), pa.array(i.ravel()), pa.array(s.ravel())], ["query_id", "vec_id", "score"])

        return src.mapInArrow(run, "query_id bigint, vec_id bigint, score double")

    def flush() -> None:
        nonlocal out
        part = scan(np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.float64))
        out = part if out is None else out.unionByName(part)
        held.clear()

    for r in rows:
        held.append((r[0], r[1]))
        if len(held) == block:
            flush()
    if held or out is None:
        flush() if held else None
    if out is None:
        return spark.createDataFrame([], "query_id bigint, vec_id bigint, score double, rank int")
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def document_ranking(hits: DataFrame, how: str = "max") -> DataFrame:
    """(query_id, doc_id, score, rank) of hits (query_id, doc_id, score): max, sum or mean of a document's scores."""
    agg = {"max": F.max, "sum": F.sum, "mean": F.avg}[how]("score")
    scores = hits.where("doc_id IS NOT NULL").groupBy("query_id", "doc_id").agg(agg.alias("score"))
    return scores.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")))


def fuse(vector: DataFrame, graph: DataFrame, k0: int = C.RRF_K) -> DataFrame:
    """(query_id, doc_id, rrf, rank): reciprocal rank fusion of two rankings (query_id, doc_id, rank); ties by vector rank, then graph rank."""
    a = vector.where("doc_id IS NOT NULL").select("query_id", "doc_id", F.col("rank").alias("v"))
    b = graph.where("doc_id IS NOT NULL").select("query_id", "doc_id", F.col("rank").alias("g"))
    j = a.join(b, ["query_id", "doc_id"], "full")
    part = lambda c: F.coalesce(1.0 / (k0 + F.col(c)), F.lit(0.0))
    s = j.withColumn("rrf", part("v") + part("g"))
    far = F.lit(2_000_000_000)
    w = W.partitionBy("query_id").orderBy(F.desc("rrf"), F.coalesce("v", far), F.coalesce("g", far), "doc_id")
    return s.withColumn("rank", F.row_number().over(w)).select("query_id", "doc_id", "rrf", "rank")


def ranked(candidates: DataFrame) -> DataFrame:
    """Graph candidates (query_id, doc_id) as a ranking; they have no score, so the id decides."""
    return candidates.distinct().withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("doc_id")))


def evidence(edges: DataFrame, most: int = 3, chars: int = 180) -> DataFrame:
    """(doc_id, evidencia): the first edges that each document states, in order, with the beginning of what it says."""
    w = W.partitionBy("doc_id").orderBy("chunk_id", "orden", "subject", "object")
    e = edges.withColumn("r", F.row_number().over(w)).where(F.col("r") <= most)
    line = F.concat_ws(" ", "subject", "relation", "object")
    text = F.concat(line, F.lit(": "), F.left("evidence", F.lit(chars)))
    return e.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", text.alias("t")))), lambda x: x["t"]), " | ").alias("evidencia"))


def sidecar(documents: DataFrame, triplets_: DataFrame, most: int = 3) -> DataFrame:
    """(query_id, rank, doc_id, graph_evidence): the chosen documents (query_id, rank, doc_id) with the first edges that each states, as rows within the row."""
    w = W.partitionBy("doc_id").orderBy("chunk_id", "orden", "subject", "object")
    first = triplets_.join(documents.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("r", F.row_number().over(w)).where(F.col("r") <= most)
    said = F.transform(F.array_sort(F.collect_list(F.struct("r", "subject", "relation", "object", "evidence"))), lambda x: x.dropFields("r"))
    per = first.groupBy("doc_id").agg(said.alias("graph_evidence"))
    return documents.select("query_id", "rank", "doc_id").join(per, "doc_id", "left").select("query_id", "rank", "doc_id", F.coalesce("graph_evidence", F.array().cast(per.schema["graph_evidence"].dataType)).alias("graph_evidence"))


def fragments(hits: DataFrame, evidence_: DataFrame, most: int = C.FRAGMENTS_PER_QUERY, words: int = C.FRAGMENT_WORDS) -> DataFrame:
    """(query_id, rank, chunk_id, doc_id, text): the first hits (query_id, rank, doc_id, chunk_id, texto) with content.

    The text is the first piece of at most ``words`` words; the evidence of the document follows while it fits, the
    words that announce it included. Pieces are made only of the rows that remain.
    """
    full = hits.where("texto IS NOT NULL AND trim(texto) <> ''").withColumn("r", F.row_number().over(W.partitionBy("query_id").orderBy("rank", "chunk_id"))).where(F.col("r") <= most)
    rows = full.join(evidence_, "doc_id", "left").select("query_id", F.col("r").alias("rank"), "chunk_id", "doc_id", "texto", "evidencia")
    head = "Evidencia del grafo:"

    def make():
        def f(c):
            out = []
            for t, e in zip(c["texto"], c["evidencia"]):
                first = (subdivide(t, words) or [""])[0]
                room = words - len(first.split()) - len(head.split())
                if e and room > 0:
                    first = f"{first}\n{head} {' '.join(e.split()[:room])}"
                out.append(first)
            return {k: c[k] for k in ("query_id", "rank", "chunk_id", "doc_id")} | {"text": out}

        return f

    kind = dict(rows.dtypes)
    return map_rows(rows, make, f"query_id {kind['query_id']}, rank int, chunk_id string, doc_id {kind['doc_id']}, text string")


def check_result(documents: DataFrame, fragments_: DataFrame, queries: int, n_docs: int = C.DOCUMENTS_PER_QUERY, n_fragments: int = C.FRAGMENTS_PER_QUERY, words: int = C.FRAGMENT_WORDS) -> DataFrame:
    """One row of checks over the results of ``queries`` queries: sizes, consecutive ranks, lengths."""
    d = documents.groupBy("query_id").agg(F.count("*").alias("n"), F.max("rank").alias("m"))
    f = fragments_.groupBy("query_id").agg(F.count("*").alias("n"), F.max("rank").alias("m"), F.max(F.size(F.filter(F.split("text", r"\s+"), lambda x: x != ""))).alias("w"))
    a = d.agg((F.count("*") == queries).alias("all_queries"), F.bool_and((F.col("n") == F.col("m")) & (F.col("n") <= n_docs)).alias("document_ranks"))
    b = f.agg(F.bool_and((F.col("n") == F.col("m")) & (F.col("n") <= n_fragments)).alias("fragment_ranks"), F.bool_and(F.col("w") <= words).alias("fragment_words"))
    return a.crossJoin(b)  # one row each


def norm_check(vectors: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """One row (n, n_bad): vectors whose length is not 1."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return vectors.agg(F.count("embedding").alias("n"), F.count_if(F.abs(norm - 1) > tolerance).alias("n_bad"))


def index_check(vectors: DataFrame, metadata: DataFrame, size: int, key: str = "vec_id", tolerance: float = 1e-3) -> DataFrame:
    """One row (n_vectors, n_metadata, n_alone, n_size, n_norm, ok): whether each row of the metadata has one vector of ``size`` numbers and length 1."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    v = vectors.select(F.col(key).alias("k"), F.coalesce(F.size("embedding") != size, F.lit(True)).alias("bad"), F.coalesce(F.abs(norm - 1) > tolerance, F.lit(True)).alias("off")).groupBy("k").agg(F.count("*").alias("n"), F.bool_or("bad").alias("bad"), F.bool_or("off").alias("off"))
    m = metadata.select(F.col(key).alias("k")).groupBy("k").agg(F.count("*").alias("m"))
    j = v.join(m, v.k.eqNullSafe(m.k), "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = j.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_vectors"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_metadata"), F.count_if(zero("n") != zero("m")).alias("n_alone"), F.count_if("bad").alias("n_size"), F.count_if("off").alias("n_norm"))
    return out.withColumn("ok", (F.col("n_vectors") > 0) & (F.col("n_alone") == 0) & (F.col("n_size") == 0) & (F.col("n_norm") == 0))


def reencode_check(vectors: DataFrame, rows: DataFrame, key: str, text: str, model, sample: int = 32, least: float = 0.999, seed: int = 7) -> DataFrame:
    """(key, coseno, ok): the vectors of a sample of rows against those that the model gives now; a table that slipped by one row shows here. The sample is those with the lowest hashes of the key."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    chosen = rows.select(key, text, h.alias("_h")).orderBy("_h", key).limit(sample).drop("_h")
    now = encode(chosen, key, text, model).withColumnRenamed("embedding", "now")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    cos = dot(F.col("embedding"), F.col("now")) / F.sqrt(dot(F.col("embedding"), F.col("embedding")) * dot(F.col("now"), F.col("now")))
    return now.join(vectors.select(key, "embedding"), key, "left").select(key, F.coalesce(cos, F.lit(0.0)).alias("coseno")).withColumn("ok", F.col("coseno") >= least)


def encode(rows: DataFrame, key: str, text: str, model, size: int = 16) -> DataFrame:
    """(key, embedding) by a model that is plugged in: ``model()`` runs once per task and returns a function from texts to unit vectors."""

    def make():
        predict = model()

        def f(c):
            return {"key": c["key"], "embedding": [[float(x) for x in v] for v in predict([t or "" for t in c["text"]])]}

        return f

    kind = dict(rows.dtypes)[key]
    return map_rows(rows.select(F.col(key).alias("key"), F.col(text).alias("text")), make, f"key {kind}, embedding array<float>", rows=size).withColumnRenamed("key", key)
