"""Entities, relation triplets and the directed evidence graph."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telar import config as C
from telar.functions.batches import map_rows

_UP, _LOW = "A-ZÁÉÍÓÚÜÑ", "a-záéíóúüñ"
#: A capitalised word and up to four more. (A capitalised word with small ones behind it is never longer than this finds it: the first word matches here.)
_PHRASE = re.compile(rf"[{_UP}][{_UP}{_LOW}]+(?:\s+[{_UP}][{_UP}{_LOW}]+){{0,4}}")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_STRIP = " ,;:.-_()[]{}\n"
_TAIL = re.compile(r"\s+(?:para|con|en|de|del|por|y)\s", re.I)
_ARTICLE = re.compile(r"^(?:el|la|los|las|un|una|unos|unas)\s+", re.I)
_AROUND = {s: re.compile(rf"([{_UP}][{_UP}{_LOW} .-]+?)\s+{s}\s+([^.;!?]+)", re.I) for s, _ in C.RELATIONS}
_VERB = {s: re.compile(rf"\s+{s}(?=\s)", re.I) for s, _ in C.RELATIONS}

TRIPLET = "doc_id string, chunk_id string, orden int, subject string, relation string, object string, evidence string"


def normal(entity: str) -> str:
    return re.sub(r"\s+", " ", entity).strip(_STRIP)


def lexicon(entities: dict[str, tuple[str, ...]] = C.ENTITIES) -> list[str]:
    """All dictionary terms, long ones first, equals by the alphabet."""
    return sorted({t for ts in entities.values() for t in ts}, key=lambda t: (-len(t), t))


def entities_of(text: str, terms: list[str]) -> list[str]:
    """Dictionary terms that the text holds anywhere, then capitalised phrases; what contains or is contained in one found before is left out.

    Stopwords are no phrases, nor are one or two words that hold a linking word, in whatever place of them.
    """
    text = re.sub(r"\s+", " ", text).strip()
    low = text.lower()
    found = [t for t in terms if t in low]
    for m in _PHRASE.finditer(text):
        p = normal(m[0])
        k = p.lower()
        if k not in C.ENTITY_STOPWORDS and not (len(p.split()) <= 2 and any(g in k for g in C.ENTITY_GLUE)):
            found.append(p)
    out: list[str] = []
    seen: list[str] = []
    for e in found:
        k = normal(e).lower()
        if k and not any(k in s or s in k for s in seen):
            seen.append(k)
            out.append(normal(e))
    return out


def _stated(sentence: str, entities_: list[str], surfaces: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(subject, relation, object) where an entity ends right before a relation and another begins right behind it."""
    out = []
    for surface, relation in surfaces:
        subjects, objects = set(), set()
        pairs = set()
        for m in _VERB[surface].finditer(sentence):
            left, right = sentence[: m.start()].lower(), sentence[m.end() :].lstrip().lower()
            subjects = {i for i, e in enumerate(entities_) if left.endswith(e.lower()) and e[-1].isalnum() and not (left[: len(left) - len(e)][-1:].isalnum() and e[0].isalnum())}
            objects = {j for j, e in enumerate(entities_) if right.startswith(e.lower()) and e[0].isalnum() and not (right[len(e) : len(e) + 1].isalnum() and e[-1].isalnum())}
            pairs |= {(i, j) for i in subjects for j in objects if i != j}
        out += [(entities_[i], relation, entities_[j]) for i, j in sorted(pairs)]
    return out


def triplets_of(text: str, terms: list[str]) -> list[tuple[str, str, str, str]]:
    """(subject, relation, object, evidence): entity, relation, entity in one sentence; without any, what stands around a relation."""
    low = text.lower()
    # Every relation needs its surface; texts without one have no triplets at all.
    surfaces = [(s, r) for s, r in C.RELATIONS if s in low]
    if not surfaces:
        return []
    parts = []
    for s in map(str.strip, _SENTENCE.split(text)):
        here = [(a, r) for a, r in surfaces if a in s.lower()]
        if here:
            parts.append((s, here))
    out = [(*t, s[:300]) for s, here in parts for t in _stated(s, entities_of(s, terms), here)]
    if not out:
        for s, here in parts:
            for surface, relation in here:
                m = _AROUND[surface].search(s)
                if m:
                    said = _TAIL.split(m[2].strip().rstrip(".,;: "), maxsplit=1)[0]
                    subject, object_ = normal(m[1]), normal(_ARTICLE.sub("", said))
                    if subject and object_:
                        out.append((subject, relation, object_, s[:300]))
    first: dict[tuple[str, str, str], tuple[str, str, str, str]] = {}
    for t in out:
        first.setdefault((t[0].lower(), t[1], t[2].lower()), t)
    return list(first.values())


def entities(chunks: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """(doc_id, chunk_id, orden, entity) of every chunk (doc_id, chunk_id, texto)."""
    terms = lexicon() if terms is None else terms

    def make():
        def f(c):
            out: dict[str, list] = {k: [] for k in ("doc_id", "chunk_id", "orden", "entity")}
            for d, k, t in zip(c["doc_id"], c["chunk_id"], c["texto"]):
                for i, e in enumerate(entities_of(t or "", terms)):
                    for n, v in (("doc_id", d), ("chunk_id", k), ("orden", i), ("entity", e)):
                        out[n].append(v)
            return out

        return f

    return map_rows(chunks.select("doc_id", "chunk_id", "texto"), make, "doc_id string, chunk_id string, orden int, entity string")


def triplets(chunks: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """Triplets of every chunk (doc_id, chunk_id, texto), in order of appearance.

    Texts without the surface of any relation have none: they are left out before anything goes to Python.
    """
    terms = lexicon() if terms is None else terms
    surfaces = "|".join(dict.fromkeys(s for s, _ in C.RELATIONS))

    def make():
        def f(c):
            out: dict[str, list] = {k: [] for k in ("doc_id", "chunk_id", "orden", "subject", "relation", "object", "evidence")}
            for d, k, t in zip(c["doc_id"], c["chunk_id"], c["texto"]):
                for i, (s, r, o, e) in enumerate(triplets_of(t or "", terms)):
                    for n, v in (("doc_id", d), ("chunk_id", k), ("orden", i), ("subject", s), ("relation", r), ("object", o), ("evidence", e)):
                        out[n].append(v)
            return out

        return f

    return map_rows(chunks.select("doc_id", "chunk_id", "texto").where(F.lower("texto").rlike(surfaces)), make, TRIPLET)


def once(rows: DataFrame) -> DataFrame:
    """Triplets or entities of chunks that were delivered several times, each once; the largest doc_id counts. Small rows meet here, not texts."""
    return rows.groupBy(*[c for c in rows.columns if c != "doc_id"]).agg(F.max("doc_id").alias("doc_id")).select(*rows.columns)


def edges(triplets_: DataFrame, sources: int = C.EDGE_SOURCES) -> DataFrame:
    """One edge per ordered pair: first relation, all relations, first source, how many documents and triplets, and what its first ``sources`` places say.

    Counts are mergeable, and places are ranked before any is put beside another; ``edge_sources`` has all of them as
    rows, so that no edge, however popular, is ever gathered whole.
    """
    t = triplets_.where("trim(subject) <> '' AND trim(object) <> ''").withColumnsRenamed({"subject": "source", "object": "target"})
    place = ("doc_id", "chunk_id", "orden", "relation")
    key = F.struct(*place)
    all_ = t.groupBy("source", "target").agg(
        F.min(key)["relation"].alias("relation"), F.array_join(F.array_sort(F.collect_set("relation")), ";").alias("relations"), F.min(key)["doc_id"].alias("doc_id"), F.min(key)["chunk_id"].alias("chunk_id"), F.count("*").alias("n_triplets"), F.count_distinct("doc_id").alias("n_docs")
    )
    ranked = t.withColumn("r", F.row_number().over(W.partitionBy("source", "target").orderBy(*place))).where(F.col("r") <= sources)
    row = F.array_sort(F.collect_list(F.struct("r", "evidence", "doc_id", "chunk_id")))
    joined = lambda c, sep: F.array_join(F.transform("rows", lambda x: x[c]), sep)
    first = ranked.groupBy("source", "target").agg(row.alias("rows")).select("source", "target", joined("evidence", " || ").alias("evidence"), joined("doc_id", ";").alias("doc_ids"), joined("chunk_id", ";").alias("chunk_ids"))
    return all_.join(first, ["source", "target"])


def edge_sources(triplets_: DataFrame) -> DataFrame:
    """(source, target, doc_id, chunk_id, orden, relation, evidence): every edge with each place it was stated, one row per place."""
    return triplets_.where("trim(subject) <> '' AND trim(object) <> ''").select(F.col("subject").alias("source"), F.col("object").alias("target"), "doc_id", "chunk_id", "orden", "relation", "evidence")


def nodes(triplets_: DataFrame) -> DataFrame:
    """(name, type): the ends of all edges, each once."""
    t = triplets_.where("trim(subject) <> '' AND trim(object) <> ''")
    return t.select(F.explode(F.array("subject", "object")).alias("name")).distinct().withColumn("type", F.lit("entity"))


def candidates(query_entities: DataFrame, triplets_: DataFrame) -> DataFrame:
    """(query_id, doc_id): documents that state an edge at a node which holds, or is held by, an entity of the query.

    Nodes are matched first, each distinct name once, by an inverted join: a name that holds an entity holds the
    entity's first three characters, and the other way round. Documents join on the names that matched.
    """
    ends = triplets_.select(F.explode(F.array("subject", "object")).alias("name"), "doc_id").where("doc_id IS NOT NULL AND name <> ''").distinct()
    names = ends.select("name", F.lower("name").alias("low")).distinct()
    q = query_entities.select("query_id", F.lower("entity").alias("e")).where("e <> ''").distinct()
    holds = names.withColumn("g", F.explode(_grams(F.col("low")))).join(q.withColumn("g", F.left("e", F.lit(3))), "g").where(F.contains(F.col("low"), F.col("e")))
    held = names.withColumn("g", F.left("low", F.lit(3))).join(q.withColumn("g", F.explode(_grams(F.col("e")))), "g").where(F.contains(F.col("e"), F.col("low")))
    hit = holds.select("query_id", "name").unionByName(held.select("query_id", "name")).distinct()
    return hit.join(ends, "name").select("query_id", "doc_id").distinct()


def _grams(text: Column) -> Column:
    """The distinct runs of one to three characters."""
    of = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1)), lambda i: F.substring(text, i, F.lit(n)))
    return F.array_distinct(F.concat(of(1), of(2), of(3)))
