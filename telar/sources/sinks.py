"""Ordered JSONL, GraphML, manifests, and runs that go on where they stopped."""

from __future__ import annotations

import json
import platform
from xml.sax.saxutils import quoteattr

import pyarrow
import pyspark
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, *order: str) -> None:
    """JSON lines in the order of the keys. Files are ranges of that order, so their names sort like their rows; no task holds all rows."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value")).write.mode("errorifexists").text(path)


def write_triplets(edges: DataFrame, path: str) -> None:
    """The edges as JSON lines of subject, relation (the first one), object, with what states them."""
    rows = edges.select(F.col("source").alias("subject"), "relation", F.col("target").alias("object"), "doc_ids", "chunk_ids", "evidence")
    write_jsonl(rows, path, "subject", "object")


def write_graphml(edges: DataFrame, path: str) -> None:
    """A GraphML folder: head, nodes, edges and foot as parts whose names sort; edges keep relation and counts as data."""
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    spark = edges.sparkSession
    keys = [c for c in edges.columns if c not in ("source", "target")]
    head = ['<?xml version="1.0" encoding="utf-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">', *[f'<key id={quoteattr(k)} for="edge" attr.name={quoteattr(k)} attr.type="string"/>' for k in keys], '<graph edgedefault="directed">']
    lines = lambda rows: spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1)
    lines(head).write.text(f"{path}/part=0")
    names = edges.select(F.col("source").alias("n")).unionByName(edges.select(F.col("target").alias("n"))).distinct()
    names.select(F.concat(F.lit('<node id="'), esc(F.col("n")), F.lit('"/>')).alias("value")).write.text(f"{path}/part=1")
    data = [F.concat(F.lit(f'<data key="{k}">'), esc(F.coalesce(F.col(k).cast("string"), F.lit(""))), F.lit("</data>")) for k in keys]
    edges.select(F.concat(F.lit('<edge source="'), esc(F.col("source")), F.lit('" target="'), esc(F.col("target")), F.lit('">'), *data, F.lit("</edge>")).alias("value")).write.text(f"{path}/part=2")
    lines(["</graph>", "</graphml>"]).write.text(f"{path}/part=3")


def read_graphml(spark: SparkSession, path: str) -> DataFrame:
    """(source, target, and the edge's data) of GraphML files; the first relation of an edge stands for it."""
    e = spark.read.format("xml").option("rowTag", "edge").option("recursiveFileLookup", "true").schema("_source string, _target string, data array<struct<_key: string, _VALUE: string>>").load(path)
    m = F.map_from_entries(F.transform(F.coalesce("data", F.array()), lambda x: F.struct(x["_key"], x["_VALUE"])))
    return e.select(F.col("_source").alias("source"), F.col("_target").alias("target"), m.alias("data"))


def _at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path (local, or by its URI) and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _write(path: str, text: str) -> None:
    """The file as a whole or not at all: written aside, then moved."""
    where, p = _at(path)
    with where.open_output_stream(f"{p}.new") as f:
        f.write(text.encode())
    where.move(f"{p}.new", p)


def _read(path: str) -> str | None:
    where, p = _at(path)
    if where.get_file_info(p).type == fs.FileType.NotFound:
        return None
    with where.open_input_stream(p) as f:
        return f.read().decode()


def manifest(path: str, settings: dict, artefacts: DataFrame | None = None, **figures: object) -> dict:
    """Write settings, versions, figures and the SHA-256 of artefacts (from ``corpus_files``; a stated set, such as the parts of an index) as one JSON file."""
    out = {"versiones": {"python": platform.python_version(), "pyspark": pyspark.__version__, "pyarrow": pyarrow.__version__}, "ajustes": settings, "cifras": figures, "artefactos": {r["fuente"]: r["sha256"] for r in artefacts.select("fuente", "sha256").orderBy("fuente").toLocalIterator()} if artefacts is not None else {}}
    _write(path, json.dumps(out, ensure_ascii=False, indent=1, sort_keys=True))
    return out


def pending(state_file: str, settings: dict, total: int, batch: int) -> int:
    """How many rows of an interrupted run are done, in whole batches. Another configuration than before is refused."""
    raw = _read(state_file)
    if raw is None:
        return 0
    state = json.loads(raw)
    if state["ajustes"] != settings or state["total"] != total or state["lote"] != batch:
        changed = sorted(k for k in settings.keys() | state["ajustes"].keys() if settings.get(k) != state["ajustes"].get(k))
        raise ValueError(f"the earlier run had other settings: {changed or ['total', 'lote']}")
    return min(total, state["hechos"] // batch * batch)


def checkpoint(state_file: str, settings: dict, total: int, batch: int, done: int) -> None:
    """Note how far a run has come; written aside and renamed, so that it is whole or not there."""
    _write(state_file, json.dumps({"ajustes": settings, "total": total, "lote": batch, "hechos": done}, ensure_ascii=False))
