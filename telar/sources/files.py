"""Files of a corpus as documents: text, JSON by field paths, CSV, XLSX, JSONL; other formats through decoders that are plugged in."""

from __future__ import annotations

import csv
import fnmatch
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, StringType

from telar.functions import paths
from telar.functions.batches import map_rows
from telar.mappings import CATALOGUE_NAMES, MAPPINGS, NOISE_FIELDS

JUNK = (r"^\.", r"^~\$", r"(?i)^(thumbs\.db|desktop\.ini)$")
DOCUMENT = "fuente string, formato string, text string, title string, extra map<string,string>, error string"


def corpus_files(spark: SparkSession, root: str, excluded: tuple[str, ...] = (), only: str | None = None) -> DataFrame:
    """(fuente, nombre_archivo, formato, bytes, sha256, content): all files below a folder by their path in it, without system junk and excluded names.

    With ``only``, those of one format, for a partial run: its files alone are opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split("://")[-1].lstrip("/")
    rel = F.regexp_replace(F.regexp_replace("path", r"^[a-z0-9]+:/*", ""), f"^{re.escape(base)}/", "")
    f = files.select(rel.alias("fuente"), F.element_at(F.split("path", "/"), -1).alias("nombre_archivo"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), "content")
    for p in JUNK:
        f = f.where(~F.col("nombre_archivo").rlike(p))
    if excluded:
        f = f.where(~F.col("nombre_archivo").isin(*excluded))
    f = f.withColumn("formato", paths.format_of(F.col("fuente")))
    return f.where(F.col("formato") == only) if only else f


def values_at(data: object, path: str) -> list[str]:
    """Texts at a path such as ``a.b``, ``a[]`` or ``a[].b[]``. Missing keys and lone booleans give nothing; a scalar stands for a list of one."""
    now = [data]
    for step in path.split("."):
        name, many = (step[:-2], True) if step.endswith("[]") else (step, False)
        after: list[object] = []
        for x in now:
            v = x.get(name) if isinstance(x, dict) else None
            if v is None:
                continue
            after += v if many and isinstance(v, list) else [v]
        now = after
    out: list[str] = []
    for v in now:
        for x in v if isinstance(v, list) else [v]:
            if isinstance(x, bool) or x is None or isinstance(x, dict):
                continue
            t = str(x).strip()
            if t:
                out.append(t)
    return out


def strings_in(data: object, noise: frozenset[str] = frozenset()) -> list[str]:
    """All texts of a nested value in order, keys that are noise left out; booleans as sí or no."""
    if isinstance(data, dict):
        return [t for k, v in data.items() if k.strip().lower() not in noise for t in strings_in(v, noise)]
    if isinstance(data, list):
        return [t for v in data for t in strings_in(v, noise)]
    if data is None:
        return []
    t = ("sí" if data else "no") if isinstance(data, bool) else str(data).strip()
    return [t] if t else []


def json_values(df: DataFrame, column: str, path: str, alias: str) -> DataFrame:
    """``df`` with the texts at a path of its JSON column, as an array; a text that is no JSON has none."""
    fields = [c for c in df.columns if c != column]

    def make():
        def one(raw: str | None) -> list[str]:
            try:
                data = json.loads(raw) if raw else None
            except ValueError:
                return []
            return [v for x in (data if isinstance(data, list) else [data]) for v in values_at(x, path)]

        def f(c):
            return {k: c[k] for k in fields} | {alias: [one(x) for x in c[column]]}

        return f

    kept = df.select(*fields, column)
    return map_rows(kept, make, kept.drop(column).schema.add(alias, ArrayType(StringType())))


def json_document(raw: str, mapping: dict[str, list[str]], noise: frozenset[str] = frozenset()) -> tuple[str, str | None, dict[str, str]]:
    """(text, title, extra) of a JSON file by a mapping of field paths; without a hit, all its texts."""
    data = json.loads(raw)
    rows = data if isinstance(data, list) else [data]
    texts = [t for r in rows for p in mapping.get("texto", []) for t in values_at(r, p)]
    title = next((t for r in rows for p in mapping.get("titulo", []) for t in values_at(r, p)), None)
    extra = {p.split(".")[-1].rstrip("[]"): "; ".join(v) for p in mapping.get("extra", []) if (v := [t for r in rows for t in values_at(r, p)])}
    return "\n".join(texts or strings_in(rows, noise)), title, extra


def flat(value: str) -> str:
    """A cell of several lines as one; items with bullets are joined by semicolons, the field separator is replaced."""
    lines = [x.strip() for x in value.replace("\r\n", "\n").replace("\r", "\n").split("\n") if x.strip()]
    bullets = [re.sub(r"^[-•▪◦·*–]\s*", "", x) for x in lines]
    out = "; ".join(bullets) if bullets != lines else " ".join(lines)
    return re.sub(r"\s+", " ", out.replace("|", "/")).strip()


def records(rows: list[list[str]]) -> list[str]:
    """``column: value | column: value`` lines of a table whose first row with content names its columns; blanks are left out."""
    rows = [r for r in rows if any(c.strip() for c in r)]
    if not rows:
        return []
    head = [flat(c) for c in rows[0]]
    out = []
    for r in rows[1:]:
        line = " | ".join(f"{h}: {v}" for h, c in zip(head, r) if h and (v := flat(c)))
        if line:
            out.append(line)
    return out


def csv_document(raw: bytes) -> tuple[str, dict[str, str]]:
    t = raw.decode("utf-8-sig", "replace")
    try:
        delimiter = csv.Sniffer().sniff(t[:8192], ",;\t|").delimiter
    except csv.Error:
        delimiter = ","
    rows = list(csv.reader(io.StringIO(t, newline=""), delimiter=delimiter))
    lines = records(rows)
    return "\n".join(lines), {"filas": str(len(lines)), "columnas": str(len(rows[0]) if rows else 0), "delimitador": delimiter}


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheets(raw: bytes) -> Iterator[tuple[str, list[list[str]]]]:
    """(name, rows) of the sheets of an XLSX file, with the standard library alone."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_NS}sheet"):
            target = rels[s.get(_REL)].lstrip("/")
            target = target if target.startswith("xl/") else f"xl/{target}"
            rows = []
            for row in ElementTree.fromstring(z.read(target)).iter(f"{_NS}row"):
                cells: dict[int, str] = {}
                for k, c in enumerate(row.iter(f"{_NS}c")):
                    ref = re.match(r"[A-Z]+", c.get("r") or "")
                    col = k
                    if ref:
                        col = 0
                        for ch in ref[0]:
                            col = col * 26 + ord(ch) - 64
                        col -= 1
                    kind, v = c.get("t"), c.find(f"{_NS}v")
                    if kind == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{_NS}t"))
                    elif v is None or v.text is None:
                        value = ""
                    elif kind == "s":
                        value = shared[int(v.text)]
                    elif kind == "b":
                        value = "sí" if v.text == "1" else "no"
                    else:
                        value = v.text[:-2] if re.fullmatch(r"-?\d+\.0", v.text) else v.text
                    cells[col] = value
                rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
            yield s.get("name") or "", rows


def xlsx_document(raw: bytes) -> tuple[str, dict[str, str]]:
    out, useful, count = [], [], 0
    for name, rows in sheets(raw):
        count += 1
        lines = records(rows)
        if lines:
            useful.append(name)
            out += [f"hoja: {name}", *lines]
    return "\n".join(out), {"hojas": str(count), "hojas_utiles": "; ".join(useful)}


def documents(files: DataFrame, mappings: dict[str, dict[str, list[str]]] | None = None, decoders: dict[str, Callable[[bytes], tuple[str, dict[str, str]]]] | None = None) -> DataFrame:
    """Documents (DOCUMENT) of ``corpus_files``: a file that can't be read gives a row with the error and empty text; none is dropped.

    ``mappings`` are field paths by institution (the first two folders), those of ``mappings.MAPPINGS`` if none are
    given; an institution without one is an error, but for catalogues, which give all their texts without the noise.
    With an empty mapping every JSON file gives all its texts. ``decoders`` read the formats that need a library of
    their own (pdf, jpg, avif).
    """
    mappings, decoders = MAPPINGS if mappings is None else mappings, decoders or {}
    src = files.select("fuente", "formato", "content", paths.institution(F.col("fuente")).alias("institucion"), paths.is_catalogue_file(F.col("fuente"), CATALOGUE_NAMES).alias("catalogo"))

    def make():
        def one(form: str | None, raw: bytes, inst: str, catalogue: bool) -> tuple[str, str | None, dict[str, str]]:
            if form in decoders:
                t, extra = decoders[form](raw)
                return t, None, extra
            if form == "json":
                if catalogue:
                    return json_document(raw.decode("utf-8", "replace"), {}, NOISE_FIELDS)
                if mappings and inst not in mappings:
                    raise ValueError(f"no mapping for {inst}")
                return json_document(raw.decode("utf-8", "replace"), mappings.get(inst, {}))
            if form == "csv":
                t, extra = csv_document(raw)
                return t, None, extra
            if form == "xlsx":
                t, extra = xlsx_document(raw)
                return t, None, extra
            if form == "pbf":
                from telar.sources.tiles import tile_document

                t, extra = tile_document(raw)
                return t, None, extra
            if form == "txt":
                return raw.decode("utf-8", "replace"), None, {}
            raise ValueError(f"no decoder for {form}")

        def f(c):
            out: dict[str, list] = {k: [] for k in ("fuente", "formato", "text", "title", "extra", "error")}
            for path, form, raw, inst, catalogue in zip(c["fuente"], c["formato"], c["content"], c["institucion"], c["catalogo"]):
                try:
                    t, title, extra = one(form, bytes(raw), inst, catalogue)
                    error = None
                except Exception as e:  # a row of the log, not the end of the run
                    t, title, extra, error = "", None, {}, f"{type(e).__name__}: {e}"[:300]
                for k, v in (("fuente", path), ("formato", form), ("text", t), ("title", title), ("extra", list(extra.items())), ("error", error)):
                    out[k].append(v)
            return out

        return f

    return map_rows(src, make, DOCUMENT, rows=16)


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSONL file by an explicit schema; blank lines are skipped, lines that don't parse keep their text in ``_corrupt_record``."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    return lines.select(F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE"}).alias("r")).select("r.*")


def required(df: DataFrame, *columns: str) -> DataFrame:
    """``df``, if it has rows and all of these columns, and none of them is null or blank in any row; else an error."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns missing: {absent}")
    empty = {c: F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").alias(c) for c in columns}
    row = df.agg(F.count("*").alias("_rows"), *empty.values()).first()
    if not row["_rows"]:
        raise ValueError("no rows")
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise ValueError(f"rows without a value: {bad}")
    return df


QUERY_KEYS = ("texto", "text", "consulta", "pregunta", "query")


def query_file(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, texto): queries as JSONL under one of several keys; if any line is no JSON, every line is a query. Missing ids are numbered."""
    rows = [r[0] for r in spark.read.text(path, wholetext=False).toLocalIterator() if r[0].strip()]  # a stated query set
    try:
        data = [json.loads(x) for x in rows]
        if not all(isinstance(x, dict) for x in data):
            raise ValueError
    except ValueError:
        data = [{"texto": x} for x in rows]
    out = []
    for i, x in enumerate(data, 1):
        t = next((str(x[k]).strip() for k in QUERY_KEYS if x.get(k) and str(x[k]).strip()), None)
        if t:
            out.append((str(x.get("query_id") or f"q{i:03d}"), t))
    return spark.createDataFrame(sorted(out), "query_id string, texto string")


def chunks_or_documents(df: DataFrame) -> DataFrame:
    """Chunks as they are, documents chunked first; anything else is an error."""
    from telar.operators.chunking import chunk_documents

    if {"chunk_id", "texto", "doc_id"} <= set(df.columns):
        return df
    if {"doc_id", "text"} <= set(df.columns):
        return chunk_documents(df.where("doc_id IS NOT NULL"))
    raise ValueError("rows are neither chunks nor documents")


class _SheetReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        folder, name = base.rsplit("/", 1) if "/" in base else (".", base)
        if "*" not in name and where.get_file_info(base).type == fs.FileType.Directory:
            folder, name = base, "*.xlsx"
        scheme = self.path.split("://", 1)[0] + "://" if "://" in self.path else ""
        found = [x.path for x in where.get_file_info(fs.FileSelector(folder)) if x.is_file and fnmatch.fnmatch(x.base_name, name)]
        return [InputPartition(scheme + p) for p in sorted(found)]

    def read(self, partition):
        from pyarrow import fs

        p = partition.value
        where, base = fs.FileSystem.from_uri(p) if "://" in p else (fs.LocalFileSystem(), p)
        with where.open_input_stream(base) as f:
            for name, rows in sheets(f.read()):
                for i, r in enumerate(rows):
                    yield (p, name, i, r)


class XlsxSource(DataSource):
    """``spark.read.format("xlsx").load("folder/*.xlsx")``: (path, sheet, row_no, cells), one task per file."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        return "path string, sheet string, row_no int, cells array<string>"

    def reader(self, schema):
        return _SheetReader(self.options["path"])


def inventory_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The inventory from XLSX files, with the columns of the table ``inventory``: the sheets that have its columns, each by its own header; that none has them is an error."""
    from telar.session import ship

    ship(spark)
    spark.dataSource.register(XlsxSource)
    rows = spark.read.format("xlsx").load(path)
    want = {"Carpeta": "carpeta", "Nombre estandarizado": "nombre_estandarizado", "DOC_ID": "doc_id_oficial", "Fenómeno": "fenomeno"}
    more = {"Observatorio": "observatorio", "Código observatorio": "codigo_observatorio"}
    # Each sheet has a header of its own: as many rows as sheets.
    heads = [(r["path"], r["sheet"], [c.strip() for c in r["cells"]]) for r in rows.where("row_no = 0").select("path", "sheet", "cells").toLocalIterator()]
    found = sorted(h for h in heads if all(k in h[2] for k in want))
    if not found:
        raise ValueError(f"columns missing: {sorted({k for k in want for h in heads if k not in h[2]} or want)}")
    out = None
    for at, sheet, head in found:
        cells = [(F.try_element_at("cells", F.lit(head.index(k) + 1)) if k in head else F.lit(None).cast("string")).alias(v) for k, v in (want | more).items()]
        part = rows.where((F.col("path") == at) & (F.col("sheet") == sheet) & (F.col("row_no") > 0) & F.exists("cells", lambda x: F.trim(x) != "")).select(*cells)
        out = part if out is None else out.unionByName(part)
    return out
