"""Repetition inside a single document (problem 1).

Every document gets the share of its words that lie in passages seen before in it, and statistics of its repetition
at other scales. Boosted trees over the statistics, with scores that can only rise with the repeated shares, give
the class; they are fitted on a bounded sample, whose labels follow from the exact share.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions.batches import map_rows
from telar.llm import trees
from telar.llm.chars import FIRST_UNSPACED, INVISIBLE, TOKEN, is_wide

PASSAGE_WORDS = 8
PASSAGE_CHARS = 20
CASE_SHARE = 0.4
#: Labelled rows to fit the trees on, at most (in expectation: rows are chosen by the hash of their id).
SAMPLE = 3_000
#: Documents that score less are no cases.
BAR = 0.5
RECORD_FORMATS = ("csv", "xlsx", "pbf")

FEATURES = ("repeated", "distinct", "top_word", "top_pair", "twice_4", "line_twice", "line_chars_twice", "packed", "log_words")
#: With more distinct words the score may only fall; with more repetition it may only rise.
MONOTONE = [1, -1, 0, 1, 1, 1, 1, -1, 0]
_P = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[str]:
    """Words, and single characters where words aren't spaced; without case and invisible characters, all numbers equal."""
    low = text.lower()
    if not low.isascii():
        low = INVISIBLE.sub("", low)
    return ["0" if w.isdigit() else w for w in TOKEN.findall(low)]


def _join(h: np.ndarray, g: np.ndarray, shift: int) -> np.ndarray:
    """Hashes of the passages that begin in ``h`` and go on, ``shift`` words later, in ``g``."""
    n = min(len(h), len(g) - shift)
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n] * np.uint64(_P) + g[shift : shift + n]
    return out ^ (out >> np.uint64(31))


def _passages(ids: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all passages of 2 words, of 4, and of the size that counts as repeated."""
    two = _join(ids, ids, 1)
    four = _join(two, two, 2)
    eight = _join(four, four, 4)
    return two, four, _join(_join(eight, eight, 8), four, 16) if wide else eight


def _again(h: np.ndarray) -> np.ndarray:
    """True where a value occurred before."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    out = np.zeros(len(h), bool)
    out[order[1:]] = s[1:] == s[:-1]
    return out


def _most(h: np.ndarray) -> int:
    """How often the most frequent value occurs."""
    s = np.sort(h)
    ends = np.flatnonzero(s[1:] != s[:-1])
    return int(np.diff(np.concatenate([[-1], ends, [len(s) - 1]])).max())


def _covered(again: np.ndarray, n: int, size: int) -> np.ndarray:
    d = np.zeros(size + 1, np.int32)
    at = np.flatnonzero(again)
    np.add.at(d, at, 1)
    np.add.at(d, at + n, -1)
    return np.cumsum(d[:-1]) > 0


def numbered(words: list[str]) -> tuple[np.ndarray, int]:
    """Numbers of the words, equal for equal ones, and how many differ."""
    seen = dict.fromkeys(words)
    seen.update(zip(seen, range(1, len(seen) + 1)))
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words)), len(seen)


def _is_wide(words: list[str]) -> bool:
    """Whether passages are counted in characters: most of the text is unspaced."""
    return bool(words) and max(words) >= FIRST_UNSPACED and sum(map(is_wide, words)) > len(words) / 2


def repeated_share(passages: np.ndarray, wide: bool, size: int) -> float:
    """The exact share: words in passages that occurred earlier."""
    return float(_covered(_again(passages), PASSAGE_CHARS if wide else PASSAGE_WORDS, size).mean()) if len(passages) else 0.0


def statistics(text: str, ids: np.ndarray, distinct: int, pairs: np.ndarray, four: np.ndarray, share: float) -> list[float]:
    """The document's statistics, in the order of FEATURES."""
    n = len(ids)
    if n == 0:
        return [0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    counts = np.bincount(ids.astype(np.int64))
    top_pair = _most(pairs) / len(pairs) if len(pairs) else 0.0
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    often = Counter(lines)
    twice = [(x, k - 1) for x, k in often.items() if k > 1]
    raw = text.encode()
    return [
        share,
        distinct / n,
        counts.max() / n,
        float(top_pair),
        float(_again(four).mean()) if len(four) else 0.0,
        sum(k for _, k in twice) / max(len(lines), 1),
        sum(len(x) * k for x, k in twice) / max(len(text), 1),
        len(zlib.compress(raw, 1)) / max(len(raw), 1),
        float(np.log1p(n)),
    ]


def _measured(texts: list[str | None]) -> tuple[list[int], list[float], np.ndarray]:
    sizes, shares, stats = [], [], []
    for t in texts:
        words = words_of(t) if t else []
        ids, distinct = numbered(words)
        sizes.append(len(words))
        wide = _is_wide(words)
        two, four, long = _passages(ids, wide)
        shares.append(repeated_share(long, wide, len(ids)))
        stats.append(statistics(t or "", ids, distinct, two, four, shares[-1]))
    return sizes, shares, np.asarray(stats, np.float64).reshape(len(texts), len(FEATURES))


def fit(documents: DataFrame, sample: int = SAMPLE) -> trees.Forest:
    """Trees fitted on about ``sample`` documents, and on as many made repetitive from them, so that both classes are there."""
    total = documents.count()
    share = min(1.0, sample / max(total, 1))
    bound = int(share * (1 << 31))
    chosen = documents.where((F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 31)) < bound) & F.col("text").isNotNull()).select("text")

    def make():
        def f(c):
            rows, labels = [], []
            for t in c["text"]:
                made = [t]
                if len(t) > 40:
                    k = zlib.crc32(t.encode()) % 7
                    piece = t[: max(40, len(t) // (3 + k))]
                    made.append(t[: len(t) // 2] + "\n" + "\n".join([piece] * (2 + k)) if k % 2 else t + (" " + piece) * (1 + k))
                _, shares, stats = _measured(made)
                rows += stats.tolist()
                labels += [float(s >= CASE_SHARE) for s in shares]
            return {"x": rows, "y": labels}

        return f

    got = map_rows(chosen, make, "x array<double>, y double").orderBy("x").toPandas()
    x = np.array(got["x"].tolist(), np.float64).reshape(len(got), len(FEATURES))
    return trees.fit(x, got["y"].to_numpy(np.float64), MONOTONE)


def repetition(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", formato: str | None = "formato", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, palabras, repetido, puntaje, formato): words, exact repeated share and fitted score of every document.

    Null, empty and blank texts have no words, a share of 0 and the score of a text without repetition. Repeated rows
    stay; null ids are measured like others. Texts are read whole. An empty table gives an empty result.
    """
    src = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), (F.col(formato) if formato else F.lit(None)).cast("string").alias("formato"))
    forest = fit(src, sample)

    def make():
        def f(c):
            sizes, shares, stats = _measured(c["text"])
            return {"doc_id": c["doc_id"], "palabras": sizes, "repetido": shares, "puntaje": forest.score(stats).tolist(), "formato": c["formato"]}

        return f

    return map_rows(src, make, "doc_id bigint, palabras int, repetido double, puntaje double, formato string")


def found(documents: DataFrame) -> DataFrame:
    """(doc_id): documents that the trees hold for repetitive; those at the edge, where a tree's cuts are coarse, must bear the exact share. Records never are."""
    r = repetition(documents)
    return r.where((F.col("puntaje") >= BAR) & (F.col("repetido") >= CASE_SHARE) & ~F.coalesce(F.lower("formato").isin(*RECORD_FORMATS), F.lit(False))).select("doc_id").distinct()
