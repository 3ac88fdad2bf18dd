"""Language labels by rules around a labeller that is plugged in."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telar import config as C
from telar.functions.batches import map_rows

#: Function words that few other languages have; enough for whole blocks of text where no model is plugged in.
_WORDS = {
    "es": "el los las del con para según entre una por pero más como", "en": "the of and with for from which that was were by according", "pt": "os das dos com para segundo entre uma não mais pelo em",
    "fr": "les des avec pour selon entre une dans est sur par et du", "de": "der die das und mit für nach zwischen eine nicht ist des",
}
_BY_WORD = {w: [k for k, v in _WORDS.items() if w in v.split()] for v in _WORDS.values() for w in v.split()}
_SCRIPTS = (("ja", "[぀-ヿ]"), ("zh", "[㐀-鿿]"), ("ru", "[Ѐ-ӿ]"), ("ar", "[؀-ۿ]"), ("hi", "[ऀ-ॿ]"), ("th", "[฀-๿]"))


def by_words(text: str) -> tuple[str, float]:
    """(label, confidence) by script, then by function words; the one that most hits point to."""
    letters = sum(map(str.isalpha, text)) or 1
    for k, p in _SCRIPTS:
        share = len(re.findall(p, text)) / letters
        if share > (0.1 if k == "ja" else 0.3):
            return k, min(1.0, share + 0.3)
    hits: Counter[str] = Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        for k in _BY_WORD.get(w, ()):
            hits[k] += 1
    if not hits:
        return "und", 0.0
    (k, n), total = min(hits.most_common(), key=lambda x: (-x[1], x[0])), sum(hits.values())
    return k, n / total


@dataclass
class Profiles:
    """Log-probabilities of letter triples by language; a labeller to plug in."""

    names: list[str]
    logs: dict[str, list[float]]
    rare: list[float]  # of a triple that a language is not known to have

    def __call__(self, text: str) -> tuple[str, float]:
        """(label, posterior). The triples of a block overlap, so that their evidence is damped."""
        sums = list(self.rare)
        n = 0
        for g, k in triples(text).items():
            row = self.logs.get(g)
            if row is not None:
                n += k
                for j, v in enumerate(row):
                    sums[j] += k * v
        if not n or not self.names:
            return "und", 0.0
        top = max(sums)
        odds = [math.exp(max(-700.0, (s - top) / 4)) for s in sums]
        best = min(range(len(sums)), key=lambda j: (-sums[j], self.names[j]))
        return self.names[best], odds[best] / sum(odds)


def triples(text: str) -> Counter[str]:
    """How often each run of three characters occurs, words in small letters with a blank around each; scripts without blanks by single characters as well."""
    out: Counter[str] = Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        if "\u0e00" <= w[0] <= "\u0eff" or w[0] >= "\u3000":
            out.update(w)
        w = f" {w} "
        out.update(w[i : i + 3] for i in range(len(w) - 2))
    return out


def trained(documents: DataFrame, lang: str = "lang", per_label: int = 300, most: int = 3_000, least: int = 20) -> Profiles:
    """A labeller fitted on the labelled documents (text, lang): at most ``per_label`` distinct texts of a label, drawn by their hash, of labels with ``least``.

    Counts are sums over the tasks; of each language the ``most`` frequent triples are kept. A label names the language of
    its first two letters, so regions and case make no difference; names of languages are labels of their own.
    """
    code = F.lower(F.trim(F.col(lang)))
    code = F.when(code.rlike(r"^[a-z]{2}([-_].*)?$"), F.left(code, F.lit(2))).otherwise(code)
    rows = documents.select(code.alias("lang"), "text").where("lang IS NOT NULL AND lang NOT IN ('', 'und', 'xx', '-', 'n/a', 'unknown') AND length(trim(text)) >= 80")
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("size")).where(F.col("size") >= least)  # as many rows as labels
    share = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 31)) < F.lit(float(per_label)) / F.col("size") * (1 << 31)
    drawn = rows.join(F.broadcast(sizes), "lang").where(share).select("lang", "text").distinct()

    def make():
        def f(c):
            out: dict[str, list] = {"lang": [], "g": [], "n": []}
            for k, t in zip(c["lang"], c["text"]):
                own = triples(t)
                out["lang"] += [k] * len(own)
                out["g"] += own.keys()
                out["n"] += own.values()
            return out

        return f

    counts = map_rows(drawn, make, "lang string, g string, n bigint").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    first = counts.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "g"))).where(F.col("r") <= most)
    by: dict[str, dict[str, int]] = {}
    for r in first.toLocalIterator():  # ``most`` rows a label
        by.setdefault(r["lang"], {})[r["g"]] = r["n"]
    names = sorted(by)
    total = {k: sum(v.values()) for k, v in by.items()}
    logs = {g: [math.log((by[k].get(g, 0) + 0.5) / (total[k] + 0.5 * most)) for k in names] for g in {g for v in by.values() for g in v}}
    return Profiles(names, logs, [0.0] * len(names))


def mixed_report(labelled_: DataFrame) -> DataFrame:
    """(lang, n, mixtos, indeterminados, parte_media): how many documents of each label are mixed or undetermined, and the mean share of the label's blocks."""
    return labelled_.groupBy("lang").agg(F.count("*").alias("n"), F.count_if("mixto").alias("mixtos"), F.count_if(F.col("lang") == "und").alias("indeterminados"), F.round(F.avg("parte"), 6).alias("parte_media"))


def blocks(text: str, least: int = C.LANGUAGE_BLOCK) -> list[str]:
    """Paragraphs gathered until they hold so many characters."""
    out, held, n = [], [], 0
    for p in re.split(r"\n\s*\n", text):
        if p.strip():
            held.append(p.strip())
            n += len(p)
            if n >= least:
                out.append("\n".join(held))
                held, n = [], 0
    return out + (["\n".join(held)] if held else [])


def label(text: str | None, formato: str | None, labeller: Callable[[str], tuple[str, float]] = by_words) -> tuple[str, float, bool]:
    """(lang, share, mixed): records, short texts and texts without enough letters are 'und'; else the blocks vote by their length."""
    t = (text or "").strip()
    if (formato or "").lower() in C.RECORD_FORMATS or len(t) < C.LANGUAGE_CHARS or sum(map(str.isalpha, t)) / max(len(t), 1) < C.LANGUAGE_ALPHA:
        return "und", 0.0, False
    weight: dict[str, int] = {}
    sure = 0.0
    for b in blocks(t):
        k, sure = labeller(b)
        weight[k] = weight.get(k, 0) + len(b)
    best = max(weight, key=lambda k: weight[k])  # the first block's label among equals
    share = weight[best] / sum(weight.values())
    if len(t) < C.LANGUAGE_SHORT and sure < C.LANGUAGE_SHORT_SURE:
        return "und", share, False
    return best, share, share < C.LANGUAGE_MIXED


def labelled(documents: DataFrame, labeller: Callable[[str], tuple[str, float]] = by_words) -> DataFrame:
    """(doc_id, lang, parte, mixto) of documents (doc_id, text, formato). Null and empty texts are 'und'."""

    def make():
        def f(c):
            got = [label(t, k, labeller) for t, k in zip(c["text"], c["formato"])]
            return {"doc_id": c["doc_id"], "lang": [g[0] for g in got], "parte": [round(g[1], 6) for g in got], "mixto": [g[2] for g in got]}

        return f

    src = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "formato")
    return map_rows(src, make, "doc_id bigint, lang string, parte double, mixto boolean")
