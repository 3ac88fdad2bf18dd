"""Fields of a source path, as column expressions. Where a path says nothing the result is null; strict callers check for null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telar.config import FORMATS
from telar.mappings import CATALOGUE_NAMES


def posix(path: Column) -> Column:
    return F.regexp_replace(path, r"\\", "/")


def topic(path: Column) -> Column:
    """1, 2 or 3: the number that the first folder begins with."""
    return F.regexp_extract(posix(path), r"^(?:.*[/:])?([1-3])_[^/]+/", 1).try_cast("int")


def topic_code(code: Column, path: Column) -> Column:
    """A topic written as a number, as F and a number, or as a number with a title; else that of the path."""
    return F.coalesce(F.regexp_extract(F.trim(code), r"(?i)^(?:F|fen[oó]meno\s*)?\s*0*([0-9]+)", 1).try_cast("int"), topic(path))


def format_of(path: Column) -> Column:
    """The format of the extension, whatever its case; null for extensions outside the vocabulary."""
    known = F.create_map(*[F.lit(x) for kv in FORMATS.items() for x in kv])
    return F.try_element_at(known, F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1)))


def is_page(path: Column) -> Column:
    return posix(path).rlike(r"(^|/)(?i:page|pagina)_[0-9]+(/|$)")


def is_tile(path: Column) -> Column:
    return posix(path).rlike(r"(^|/)tiles/(.*/)?[0-9]+(/|$)")


def tile_place(path: Column) -> Column:
    """Struct of zoom, x and y behind the folder ``tiles``; y is the last piece of the file's stem."""
    at = lambda i: F.regexp_extract(posix(path), r"(?:^|/)tiles/([0-9]+)/([0-9]+)/(?:[^/]*_)?([0-9]+)\.[^./]+$", i).try_cast("int")
    return F.struct(at(1).alias("zoom"), at(2).alias("x"), at(3).alias("y"))


def institution(path: Column) -> Column:
    return F.array_join(F.slice(F.split(posix(path), "/"), 1, 2), "/")


def strict(value: Column, path: Column, what: str) -> Column:
    """The value, or an error that names the path where there is none."""
    return F.coalesce(value, F.raise_error(F.concat(F.lit(f"no {what} in "), F.coalesce(path, F.lit("null")))).cast("string"))


def is_catalogue_file(path: Column, names: tuple[str, ...] = CATALOGUE_NAMES, tile_index: str = "index") -> Column:
    """Whether a file is a catalogue by a piece of its name; the index of a tile series is none."""
    name = F.lower(F.element_at(F.split(posix(path), "/"), -1))
    hit = F.lit(False)
    for n in names:
        hit = hit | F.contains(name, F.lit(n.lower()))
    return hit & ~(is_tile(path) | F.contains(name, F.lit(tile_index)) & posix(path).rlike(r"(^|/)tiles/"))
