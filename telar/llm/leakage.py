"""Evaluation texts leaking into training text (problem 9), by canonical templates.

Tokens are reduced to what a template keeps: words of the evaluation vocabulary stay, numbers, units of measure and
names become typed slots. Windows of templates are hash-joined with those of the evaluation passages; the slots of the
windows that meet are then compared. Equal slots are a leak of the passage itself; slots that differ, but map one to
one, are a re-parameterised copy of it.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Container

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions.batches import map_rows
from telar.llm.filters import bit_filter, bit_of
from telar.session import store

WORDS = 12  # consecutive words of a leak
CHARS = 20  # consecutive characters of one where words aren't spaced
#: The windows of the items are sent to every task if their table is no larger than this; beyond it both sides are shuffled. The rows are the same.
SENT_BYTES = 32 << 20

_UNSPACED = "฀-໿々-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}]+")
_BREAK = re.compile(r"(?<=[^\W\d_])[-‐‑¬­][ \t]*\r?\n[ \t]*(?=[^\W\d_])")
_BEFORE, _BEHIND = re.compile(r"[^\W_]+$"), re.compile(r"[^\W_]+")
_MARKS = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u2060\ufeff]+")
_UNITS = frozenset("kg km cm mm mhz ghz hz kw mw gb mb tb ms seg min h usd eur cop brl".split())
_DIGITS = re.compile(r"\d")


def plain(text: str) -> str:
    """Text without accents, invisible characters and differences of case or width."""
    if text.isascii():
        return text
    return _MARKS.sub("", unicodedata.normalize("NFKD", text))


def readings(text: str, vocabulary: Container[str] = ()) -> list[list[str]]:
    """The text as tokens in their own spelling; more readings where words are broken at a line end.

    A mark at a line end may break one word or join two: all of them joined, all apart, and each as the vocabulary has it.
    """
    text = plain(text)
    whole = _BREAK.sub("", text)
    out = [_TOKEN.findall(whole)]
    if whole != text:
        out.append(_TOKEN.findall(text))

        def known(m: re.Match) -> str:
            left, right = _BEFORE.search(text, max(0, m.start() - 60), m.start()), _BEHIND.match(text, m.end())
            return "" if f"{left[0] if left else ''}{right[0] if right else ''}".lower() in vocabulary else m[0]

        mixed = _BREAK.sub(known, text)
        if mixed != whole and mixed != text:
            out.append(_TOKEN.findall(mixed))
    return out


def slot(token: str, low: str, vocabulary: Container[str], names: Container[str]) -> str | None:
    """The typed placeholder of a token; the word itself where the vocabulary has it; None for other words."""
    if low in vocabulary:
        return low
    if _DIGITS.search(low):
        return "<num>"
    if low in _UNITS:
        return "<unit>"
    if low in names or len(low) > 1 and token[0].isupper():
        return "<name>"
    return None


def _word_rows(passage: str) -> set[tuple[str, str]]:
    """(word, what it shows): 'word' in any form, 'low' if it stands in small letters, 'name' if with a capital inside a sentence."""
    out = set()
    for w in readings(passage)[0]:
        out.add((w.lower(), "word"))
        if w == w.lower():
            out.add((w, "low"))
    for m in re.finditer(r"(?<=[\w,;:] )([^\W\d_]+)", plain(passage)):
        if m[1][0].isupper():
            out.add((m[1].lower(), "name"))
    return out


def eval_words(items: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """The template vocabulary of the passages (column ``passage``), and their names: distinct words of a stated query set.

    A token of a passage is a name if it is written with a capital inside a sentence, and never without one.
    """

    def make():
        def f(c):
            rows = [r for t in c["passage"] if t for r in _word_rows(t)]
            return {"word": [r[0] for r in rows], "shows": [r[1] for r in rows]}

        return f

    by = map_rows(items.select("passage"), make, "word string, shows string").groupBy("word").agg(F.bool_or(F.col("shows") == "low").alias("low"), F.bool_or(F.col("shows") == "name").alias("name"), F.bool_or(F.col("shows") == "word").alias("word2"))
    vocabulary, names = set(), set()
    for r in by.toLocalIterator():
        if r["name"] and not r["low"]:
            names.add(r["word"])
        elif r["word2"] and not _DIGITS.search(r["word"]) and r["word"] not in _UNITS:
            vocabulary.add(r["word"])
    return frozenset(vocabulary), frozenset(names)


class Templates:
    """Numbers for the kinds of tokens, and rolling hashes of the windows over them."""

    _WIDE = 1 << 40  # added to the number of an unspaced character

    def __init__(self, vocabulary: frozenset[str], names: frozenset[str]):
        self.vocabulary, self.names = vocabulary, names
        self.known: dict[str, int] = {}

    def numbers(self, tokens: list[str]) -> list[int]:
        """One number per token by its kind, the same in every worker; 0 for a word that no template has."""
        known = self.known
        if len(known) > 300_000:
            known.clear()
        out = []
        for t in tokens:
            n = known.get(t)
            if n is None:
                k = slot(t, t.lower(), self.vocabulary, self.names)
                n = known[t] = 0 if k is None else (zlib.crc32(k.encode()) + 1) | (self._WIDE if len(t) == 1 and t >= "\u0e00" else 0)
            out.append(n)
        return out

    def hashes(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, hash) of every window without a 0; a window is longer if it ends with an unspaced character."""
        wide = numbers >= self._WIDE
        starts, sizes, keys = [], [], []
        for n, last_wide in ((WORDS, False), (CHARS, True)):
            if len(numbers) < n:
                continue
            ok = (numbers != 0).astype(np.int32)
            full = np.cumsum(np.concatenate([[0], ok]))
            begin = np.flatnonzero((full[n:] - full[:-n] == n) & (wide[n - 1 :] == last_wide))
            if len(begin) == 0:
                continue
            h = np.zeros(len(begin), np.uint64)
            for j in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + numbers[begin + j].astype(np.uint64)
                h ^= h >> np.uint64(29)
            starts.append(begin)
            sizes.append(np.full(len(begin), n))
            keys.append(h)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(sizes), np.concatenate(keys).view(np.int64)


def _slots_map(vocabulary: frozenset[str], a: list[str], b: list[str]) -> str:
    """'same' words, 'reworded' slots that map one to one, or 'other'."""
    if a == b:
        return "same"
    there: dict[str, str] = {}
    back: dict[str, str] = {}
    for x, y in zip(a, b):
        if x in vocabulary or y in vocabulary:
            if x != y:
                return "other"
        elif there.setdefault(x, y) != y or back.setdefault(y, x) != x:
            return "other"
    return "reworded"


def _scan(templates: Templates, texts: list[str]):
    """The windows of all texts, hashed at once, and where each reading begins among their tokens."""
    numbers: list[int] = []
    where = []
    for row, text in enumerate(texts):
        for r, tokens in enumerate(readings(text, templates.vocabulary)):
            where.append((len(numbers), row, r, tokens))
            numbers += templates.numbers(tokens)
            numbers.append(0)
    return *templates.hashes(np.asarray(numbers, np.int64)), where


def _windows(texts: DataFrame, shared, first_reading: bool) -> DataFrame:
    """(id, reading, at, key, words) of the windows of (id, text) that pass the filter, if there is one."""

    def make():
        vocabulary, names, bits = shared.value
        templates = Templates(vocabulary, names)
        if bits is not None:
            bits = np.frombuffer(bits, np.uint8)

        def f(c):
            out: dict[str, list] = {"id": [], "reading": [], "at": [], "key": [], "words": []}
            starts, sizes, keys, where = _scan(templates, c["text"])
            if bits is not None and len(keys):
                place = bit_of(keys)
                hit = np.flatnonzero(bits[place >> 3] >> (place & 7) & 1)
                starts, sizes, keys = starts[hit], sizes[hit], keys[hit]
            offsets = np.asarray([w[0] for w in where], np.int64)
            for s, n, k, j in zip(starts.tolist(), sizes.tolist(), keys.tolist(), (np.searchsorted(offsets, starts, "right") - 1).tolist()):
                begin, row, r, tokens = where[j]
                if first_reading and r:
                    continue
                for name, v in zip(out, (c["id"][row], r, s - begin, k, [t.lower() for t in tokens[s - begin : s - begin + n]])):
                    out[name].append(v)
            return out

        return f

    return map_rows(texts, make, "id bigint, reading int, at int, key bigint, words array<string>")


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "pasaje", sent: int = SENT_BYTES, reworded: bool = True) -> DataFrame:
    """(doc_id, item_id, ventanas, reparametrizadas): per document and item, the windows that leaked as they are, and those with other slots.

    Every document is scanned whole, against all windows of all items: windows whose hash passes a filter of fixed size
    meet the items' windows in a hash join on the hash, and the slots of those that meet are compared. Null and empty
    texts hold no window; passages shorter than a window can't leak; repeated rows of a document count once; null ids
    are ignored. Without ``reworded`` only windows as they are count, which needs no look at their slots.
    """
    spark = documents.sparkSession
    src = documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL AND text <> ''")
    asked = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(passage).alias("passage")).where("id IS NOT NULL AND passage IS NOT NULL").distinct()
    vocabulary, names = eval_words(asked)
    carry = spark.sparkContext.broadcast
    theirs = store(_windows(asked.select("id", F.col("passage").alias("text")), carry((vocabulary, names, None)), True), "item-windows")
    ours = _windows(src, carry((vocabulary, names, bit_filter(theirs.select("key").distinct(), "key"))), False)
    theirs = theirs.select("key", F.col("id").alias("item_id"), F.col("words").alias("words2")).distinct()
    # Either side of the join may be the larger one; a hot window is split by the engine's skew join where nothing is sent.
    small = (theirs.agg(F.sum(F.lit(24) + F.length(F.array_join("words2", "  ")))).first()[0] or 0) <= sent
    pairs = ours.join(F.broadcast(theirs) if small else theirs.hint("merge"), "key").select(F.col("id").alias("doc_id"), "item_id", "reading", "at", "words", "words2")

    def make():
        def f(c):
            same = [_slots_map(vocabulary, b, a) for a, b in zip(c["words"], c["words2"])]
            keep = [i for i, k in enumerate(same) if k != "other"]
            return {n: [c[n][i] for i in keep] for n in ("doc_id", "item_id", "reading", "at")} | {"same": [same[i] == "same" for i in keep]}

        return f

    if reworded:
        met = map_rows(pairs, make, "doc_id bigint, item_id bigint, reading int, at int, same boolean")
    else:
        met = pairs.where("words = words2").select("doc_id", "item_id", "reading", "at", F.lit(True).alias("same"))
    met = met.groupBy("doc_id", "item_id", "reading", "at").agg(F.max("same").alias("same"))
    per_reading = met.groupBy("doc_id", "item_id", "reading").agg(F.count_if("same").cast("int").alias("v"), F.count_if(~F.col("same")).cast("int").alias("r"))
    return per_reading.groupBy("doc_id", "item_id").agg(F.max("v").alias("ventanas"), F.max("r").alias("reparametrizadas"))


def leaked(documents: DataFrame, items: DataFrame, **names) -> DataFrame:
    """(doc_id, item_id): the documents that hold a window of an item as it is."""
    return leaks(documents, items, reworded=False, **names).where("ventanas > 0").select("doc_id", "item_id")
