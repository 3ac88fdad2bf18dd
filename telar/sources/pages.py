"""Paged files (PDF, scans, pictures) as pages, by engines that are plugged in.

An engine is a function from the bytes of a file to the texts of its pages. The first one that gives pages is taken;
where these hold too few characters for their number, the file is a picture of text and goes to the OCR engine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions.batches import map_rows

Engine = Callable[[bytes], Sequence[str]]

#: Characters a page, on average, below which a file has no text layer.
LEAST_CHARS = 50
PICTURES = ("jpg", "avif")


def read_pages(raw: bytes, formato: str, engines: Sequence[tuple[str, Engine]], ocr: Engine | None, least: int = LEAST_CHARS) -> tuple[list[str], str]:
    """(pages, the name of what read them). Pictures go to the OCR engine alone; an engine that fails leaves the file to the next."""
    errors = []
    best: tuple[list[str], str] | None = None
    for name, engine in () if formato in PICTURES else engines:
        try:
            best = [p or "" for p in engine(raw)], name
            break
        except Exception as e:  # the next engine may do
            errors.append(f"{name}: {e}")
    if best and sum(len(p.strip()) for p in best[0]) >= least * max(len(best[0]), 1):
        return best
    if ocr is not None:
        try:
            seen = [p or "" for p in ocr(raw)]
            if best is None or sum(map(len, seen)) > sum(map(len, best[0])):
                return seen, "ocr"
        except Exception as e:
            errors.append(f"ocr: {e}")
    elif formato in PICTURES:
        errors.append("no OCR engine")
    if best is None:
        raise ValueError("; ".join(errors) or "no engine")
    return best


def document_pages(files: DataFrame, engines: Sequence[tuple[str, Engine]] = (), ocr: Engine | None = None, least: int = LEAST_CHARS) -> DataFrame:
    """(fuente, page_no, text, lector, error) of ``corpus_files`` in paged formats: one row per page; a file that can't be read gives one row with the error."""

    def make():
        def f(c):
            out: dict[str, list] = {k: [] for k in ("fuente", "page_no", "text", "lector", "error")}
            for path, form, raw in zip(c["fuente"], c["formato"], c["content"]):
                try:
                    pages, name = read_pages(bytes(raw or b""), form, engines, ocr, least)
                    rows = [(path, i, p, name, None) for i, p in enumerate(pages)] or [(path, 0, "", name, None)]
                except Exception as e:
                    rows = [(path, 0, "", None, f"{type(e).__name__}: {e}"[:300])]
                for r in rows:
                    for k, v in zip(out, r):
                        out[k].append(v)
            return out

        return f

    paged = files.where(F.col("formato").isin("pdf", *PICTURES)).select("fuente", "formato", "content")
    return map_rows(paged, make, "fuente string, page_no int, text string, lector string, error string", rows=8)


def page_lines(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, line_no, line): the pages as the operators on repeated lines take them; ``doc_id`` is the path."""
    lines = pages.where("error IS NULL").select(F.col("fuente").alias("doc_id"), "page_no", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "page_no", "line_no", F.trim("line").alias("line")).where("line <> ''")
