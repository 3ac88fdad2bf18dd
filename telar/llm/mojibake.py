"""Text garbled by a wrong character encoding (problem 10).

Words that are equal once non-ASCII characters are stripped are near-twins: the rare spelling may be the garbled form
of the frequent one. Aligning the two, between their ASCII characters, tells which characters became which, and from
that which encoding was read as which other. What is learned that way is then applied to all remaining words, those of
other scripts included; a restored word counts if the corpus knows it, or if the decoding is one that chance can't pass.
"""

from __future__ import annotations

import codecs
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Container

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions.batches import map_rows
from telar.llm.filters import bit_filter, bit_of_word
from telar.llm.lookalike import LOOKS
from telar.session import store

#: A document is a case from so many garbled characters on.
CASE_CHARS = 3
#: A transformation is learned from so many distinct near-twins that no better supported one explains, and from this share of all, as chance gives more of them the more words there are.
SUPPORT = 3
CHANCE = 1e-3
#: How much more frequent a word must be than the spelling that is taken for its garbled form.
ODDS = 3
#: A character counts as known in the corpus from so many documents on, and this share of all. There are at most as many as Unicode has.
KNOWN_DOCUMENTS = 3
KNOWN_SHARE = 2e-4
#: Words whose answer of the filter a task remembers.
REMEMBERED = 200_000
#: Counts are handed on at so many words, or so many characters of the texts they are from.
HELD_WORDS = 100_000
HELD_CHARS = 20_000_000

_WRITTEN = ("utf-8", "cp1252", "cp1250", "cp1251", "koi8-r", "mac_roman", "cp437", "cp850", "cp866", "cp1253", "cp1256", "cp874", "gb18030", "big5", "shift_jis", "euc_jp", "euc_kr")
_READ = ("cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8-r", "cp1254", "cp1253")
_MULTIBYTE = ("utf-8", "gb18030", "big5", "shift_jis", "euc_jp", "euc_kr")
_SPLIT = re.compile(r"[ \t\r\n\f\v]+|(?<=[\x00-\x7fЀ-ӿͰ-Ͽ])[\xa0   ]")
_ASCII_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_WIDE = re.compile("[฀-໿぀-ヿ㐀-鿿가-힯豈-﫿＀-￯]")
_HIGH = re.compile(r"[^\x00-\x7f]+")
_PAIR = re.compile(r"[^\x00-\x7f]{2}")
_C1 = re.compile("[\x80-\x9f]")
_LOST = "�"


def _maps() -> dict[str, object]:
    """For each encoding that text was read with: a map from characters to its bytes. Bytes it leaves undefined stand for themselves, as browsers read them."""
    out = {}
    for name in _READ:
        chars = []
        for b in range(256):
            try:
                chars.append(bytes([b]).decode(name))
            except UnicodeDecodeError:
                chars.append(chr(b))
        out[name] = codecs.charmap_build("".join(chars))
    return out


_MAPS = _maps()
_script: dict[str, str] = {}
_category: dict[str, str] = {}


def undo(word: str, written: str, read: str) -> str | None:
    """The word as it was before it, written in one encoding, was read with another; None if it can't have been."""
    try:
        back = codecs.charmap_encode(word, "strict", _MAPS[read])[0].decode(written)
    except (UnicodeEncodeError, UnicodeDecodeError):
        return None
    return back if back != word else None


def undo_utf8(word: str) -> str | None:
    """The word with all its layers of UTF-8 read as something else taken off; None if there is none."""
    best = None
    while True:  # each layer makes the word shorter
        backs = [b for b in (undo(word, "utf-8", read) for read in _READ) if b is not None]
        good = next((b for b in backs if sane(b)), None)
        best = good or best
        # Between two layers there may be bytes that stand for themselves.
        word = good or next((b for b in backs if sane(_C1.sub("", b))), None)
        if word is None:
            return best


def undo_parts(word: str, known: Container[str]) -> str | None:
    """The word with its runs of garbled characters restored, where most of what comes out is known to the corpus.

    Signs alone prove nothing: a run must hold a letter or stand beside one.
    """
    out, at, some = [], 0, False
    for m in _HIGH.finditer(word):
        a, b = m.span()
        if b - a < 2 or not (any([_kind(c)[0] == "L" for c in m[0]]) or a and word[a - 1].isalpha() or b < len(word) and word[b].isalpha()):
            continue
        back = undo_utf8(m[0])
        if back is not None:
            high = [c for c in back if c > "\x7f"]
            if sum([c in known for c in high]) >= 0.8 * len(high):
                out += [word[at:a], back]
                at, some = b, True
    return "".join(out) + word[at:] if some else None


def _kind(c: str) -> str:
    k = _category.get(c)
    if k is None:
        k = _category[c] = unicodedata.category(c)
    return k


def sane(text: str) -> bool:
    """Whether a decoding gave characters that text is made of: no controls, no private or unassigned ones."""
    return all([_kind(c)[0] != "C" or c in "­​‌‍﻿" for c in text])


def _letters(text: str) -> bool:
    """Whether all characters beyond ASCII are letters or marks."""
    return all([c <= "\x7f" or _kind(c)[0] in "LM" for c in text])


def _cased(word: str) -> bool:
    """Whether capitals stand where words have them: none behind the first letter, or all are."""
    return word[1:] == word[1:].lower() or word == word.upper()


def script(text: str) -> str | None:
    """The alphabet of the letters, by the first word of their Unicode names; 'mixed' if there are several."""
    found = set()
    for c in text:
        k = _script.get(c)
        if k is None:
            k = unicodedata.name(c, "?").split(" ")[0] if c.isalpha() else ""
            k = _script[c] = "CJK" if k in ("HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA", "FULLWIDTH", "HALFWIDTH", "HANGUL") else k
        if k:
            found.add(k)
    return found.pop() if len(found) == 1 else "mixed" if found else None


def skeleton(word: str) -> str:
    return _HIGH.sub("", word)


def aligned(garbled: str, clean: str) -> list[tuple[str, str]]:
    """Runs of non-ASCII characters that stand between the same ASCII characters in both words; empty if they don't correspond."""
    a, b = _HIGH.split(garbled), _HIGH.split(clean)
    if a != b:
        return []
    return [(x, y) for x, y in zip(_HIGH.findall(garbled), _HIGH.findall(clean)) if x != y]


def changed(word: str, back: str) -> int:
    """How many characters of the original were garbled."""
    return sum((Counter(c for c in back if c > "\x7f") - Counter(c for c in word if c > "\x7f")).values())


def words_of(text: str) -> list[str]:
    """Words with a character beyond ASCII, of any length, without ASCII punctuation at their edges.

    Characters of scripts without blanks part words as blanks do: a garbled line may stand right beside them.
    """
    found = [x for x in _SPLIT.split(text) if not x.isascii()]
    if _WIDE.search(text):
        found = [p for x in found for p in (_WIDE.split(x) if _WIDE.search(x) else (x,)) if not p.isascii()]
    return [w for w in (x.strip(_ASCII_EDGE) for x in found) if w and not w.isascii()]


def _word_counts(src: DataFrame) -> DataFrame:
    """(word, n): documents per word with a character beyond ASCII, per such character, and, under the word '', with any. Words in scripts without blanks are left out."""

    def make():
        seen: Counter[str] = Counter()
        held = 0

        def flush():
            nonlocal held
            out = {"word": list(seen), "n": list(seen.values())}
            seen.clear()
            held = 0
            return out

        def f(c):
            nonlocal held
            for t in c["text"]:
                if t and not t.isascii():
                    mine = {c for c in set(t) if c > "\x7f"}
                    mine.add("")
                    mine.update(words_of(t))
                    seen.update(mine)
                    held += len(t)
            return flush() if len(seen) > HELD_WORDS or held > HELD_CHARS else None

        f.rest = flush
        return f

    return map_rows(src.select("text"), make, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def looks_latin(word: str) -> bool:
    """Whether a word of several alphabets is a Latin one with letters that only look Latin: no case of wrong decoding."""
    return script(word) == "mixed" and script(word.translate(LOOKS)) == "LATIN"


def learn(counts: DataFrame) -> DataFrame:
    """(escrito, leido, apoyo): the encodings that near-twins show to have been read as others, and how many show it.

    A near-twin that several pairs of encodings explain speaks for the one that explains most, so that pairs which share
    some of their characters with it, or meet it by chance, are not learned beside it.
    """
    keyed = counts.where(F.length("word") >= 4).withColumn("key", F.regexp_replace("word", r"[^\x00-\x7f]+", "")).where(F.length("key") >= 3)
    # Of the spellings of one skeleton, each against the most frequent one: no pairs within the group.
    top = keyed.groupBy("key").agg(F.max_by("word", F.struct("n", "word")).alias("clean"), F.max("n").alias("most"), F.count("*").alias("k")).where("k > 1")
    twins = keyed.join(top, "key").where(F.col("n") * ODDS <= F.col("most")).select("key", "word", "clean")

    def make():
        def f(c):
            out: dict[str, list] = {"escrito": [], "leido": [], "key": [], "word": []}
            for k, g, w in zip(c["key"], c["word"], c["clean"]):
                pairs = aligned(g, w)
                if not pairs or script(w) == "mixed" or looks_latin(g):
                    continue
                ways = [(a, b) for a in _WRITTEN for b in _READ if all(undo(x, a, b) == y for x, y in pairs)]
                for a, b in [("", ""), *ways]:  # '' for each that was tried
                    for n, v in zip(out, (a, b, k, g)):
                        out[n].append(v)
            return out

        return f

    shown = store(map_rows(twins, make, "escrito string, leido string, key string, word string"), "twins")
    tried = shown.where("escrito = ''").select(F.count_distinct("key")).first()[0]
    shown = shown.where("escrito <> ''")
    weight = F.broadcast(shown.groupBy("escrito", "leido").agg(F.count_distinct("key").alias("all")))  # as many rows as pairs of encodings
    best = shown.join(weight, ["escrito", "leido"]).groupBy("key", "word").agg(F.max_by(F.struct("escrito", "leido"), F.struct("all", "escrito", "leido")).alias("way"))
    return best.groupBy("way.escrito", "way.leido").agg(F.count_distinct("key").alias("apoyo")).where(F.col("apoyo") >= max(SUPPORT, CHANCE * tried))


def _pair_counts(counts: DataFrame, least: float) -> dict[str, int]:
    """How often two characters stand side by side in words, one of them beyond ASCII: those that do so ``least`` times. A document has a bounded number of pairs, so at most that number over the share can."""
    low = F.lower("word")
    pairs = counts.where(F.length("word") > 1).select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(low, i, F.lit(2)))).alias("pair"))
    often = pairs.where(F.col("pair").rlike(r"[^\x00-\x7f]")).groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return {r[0]: r[1] for r in often.toLocalIterator()}


def _usual(counts: list[int | None], floor: float) -> float:
    """The mean logarithm of counts; those that are too rare to be known count half of what it takes."""
    return sum(math.log(n or floor / 2) for n in counts) / len(counts) if counts else 0.0


def restorations(counts: DataFrame, learned: DataFrame) -> DataFrame:
    """(word, restaurado, k, way): garbled words of the corpus, what they were, and how many of their characters were garbled."""
    spark = counts.sparkSession
    documents = counts.where("word = ''").agg(F.sum("n")).first()[0] or 0
    least = max(KNOWN_DOCUMENTS, KNOWN_SHARE * documents)
    known_chars = {r[0]: r[1] for r in counts.where((F.length("word") == 1) & (F.col("n") >= least)).select("word", "n").toLocalIterator()}  # single characters: no more than Unicode has
    shared = spark.sparkContext.broadcast((known_chars, _pair_counts(counts, least)))
    # An encoding that was misread once may have been misread by any reader that was seen, and any script by such a reader.
    readers = sorted({r[0] for r in learned.select("leido").collect()})  # one per encoding at most
    tried = sorted({(a, b) for a in _WRITTEN for b in (readers or ["cp1252", "latin-1"]) if a != b and (a, b) != ("utf-8", b)})

    def make():
        known, pairs = shared.value

        def pairs_of(w: str) -> float:
            low = w.lower()
            return _usual([pairs.get(low[i : i + 2]) for i in range(len(low) - 1) if not low[i : i + 2].isascii()], least)

        def f(c):
            out: dict[str, list] = {"word": [], "n": [], "restaurado": [], "k": [], "certain": [], "way": []}

            def put(w, n, back, certain, way):
                for name, v in (("word", w), ("n", n), ("restaurado", back), ("k", changed(w, back)), ("certain", certain), ("way", way)):
                    out[name].append(v)

            for w, n in zip(c["word"], c["n"]):
                back = undo_parts(w, known) if _PAIR.search(w) else None
                if back is not None:
                    # Text without blanks holds Latin letters, as in numbers of versions; they are no part of the garbled runs.
                    if script(back) != "mixed" or script("".join(_HIGH.findall(back))) == "CJK":
                        put(w, n, back, True, "utf-8")
                    continue
                if looks_latin(w):
                    continue
                usual = None
                for written, read in tried:
                    back = undo(w, written, read)
                    if back is None:
                        continue
                    if written in _MULTIBYTE:
                        wide = _WIDE.findall(back)
                        # All characters of the decoded text are characters of the corpus, and far more usual there than what stands in the word: a word of letters that are often neighbours is one.
                        if len(wide) >= 3 and sane(back) and script(back) == "CJK" and sum(x in known for x in wide) >= 0.9 * len(wide):
                            usual = pairs_of(w) if usual is None else usual
                            if _usual([known.get(x) for x in wide], least) >= usual + math.log(ODDS):
                                put(w, n, back, True, f"{written}>{read}")
                    elif len(w) >= 3 and _letters(back) and _cased(back) and script(back) not in (None, "mixed"):
                        usual = pairs_of(w) if usual is None else usual
                        if pairs_of(back) >= usual:
                            put(w, n, back, False, f"{written}>{read}")
            return out

        return f

    tried_words = store(map_rows(counts.where(F.length("word") > 1).repartition(spark.sparkContext.defaultParallelism), make, "word string, n bigint, restaurado string, k int, certain boolean, way string"), "restored")
    certain = tried_words.where("certain AND k > 0").select("word", "n", "restaurado", "k", "way")
    # Of single-byte encodings only words the corpus knows count, in whatever case, and only ways that lead to several of them.
    vocabulary = counts.where(F.length("word") > 1).groupBy(F.lower("word").alias("low")).agg(F.sum("n").alias("m"))
    maybe = tried_words.where("NOT certain AND k > 0").withColumn("low", F.lower("restaurado"))
    met = store(maybe.join(vocabulary, "low").where(F.col("m") >= F.col("n") * ODDS), "met")
    # What is a garbled word itself is no word to restore another to.
    met = met.join(tried_words.where("certain").select(F.lower("word").alias("low")).unionByName(met.select(F.lower("word").alias("low"))).distinct(), "low", "left_anti")
    ways = met.groupBy("way").agg(F.count_distinct("low").alias("apoyo")).join(F.broadcast(maybe.groupBy("way").agg(F.count_distinct("word").alias("tried"))), "way")
    ways = ways.where(F.col("apoyo") >= F.greatest(F.lit(SUPPORT), CHANCE * F.col("tried"))).select("way")
    sure = met.join(F.broadcast(ways), "way").select("word", "n", "restaurado", "k", "way", "m")  # as many ways as pairs of encodings
    every = certain.withColumn("m", F.lit(1 << 40)).unionByName(sure)
    return every.groupBy("word").agg(F.max_by(F.struct("restaurado", "k", "way"), F.struct("m", -F.col("k"), "restaurado", "way")).alias("best")).select("word", "best.restaurado", "best.k", "best.way")


def _document_words(src: DataFrame, fixes: DataFrame) -> DataFrame:
    """(doc_id, word, n) of the words of each document that pass the filter, and its number of lost characters under the word ''."""
    shared = src.sparkSession.sparkContext.broadcast(bit_filter(fixes, "word"))

    def make():
        bits = shared.value
        seen_before: dict[str, bool] = {}

        def wanted(w: str) -> bool:
            hit = seen_before.get(w)
            if hit is None:
                if len(seen_before) >= REMEMBERED:
                    seen_before.clear()
                b = bit_of_word(w)
                hit = seen_before[w] = bool(bits[b >> 3] >> (b & 7) & 1)
            return hit

        def f(c):
            out: dict[str, list] = {"doc_id": [], "word": [], "n": []}
            for d, t in zip(c["doc_id"], c["text"]):
                if not t or t.isascii():
                    continue
                seen = Counter([w for w in words_of(t) if wanted(w)])
                lost = len(re.findall(f"(?<=[^\\W_]){_LOST}|{_LOST}(?=[^\\W_])", t)) if _LOST in t else 0
                if lost:
                    seen[""] = lost
                out["doc_id"] += [d] * len(seen)
                out["word"] += seen.keys()
                out["n"] += seen.values()
            return out

        return f

    return map_rows(src, make, "doc_id bigint, word string, n int")


def _met(documents: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, k, word, restaurado, way) of the garbled words of each document, and (doc_id, perdidos)."""
    src = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    counts = store(_word_counts(src), "words")
    fixes = store(restorations(counts, learn(counts)), "fixes")
    # Repeated documents meet here, by their few garbled words, and not by their texts.
    words = store(_document_words(src, fixes).distinct(), "garbled")
    met = words.where("word <> ''").join(fixes, "word").select("doc_id", "n", "k", "word", "restaurado", "way")
    return met, words.where("word = ''").groupBy("doc_id").agg(F.sum("n").alias("perdidos"))


def _sums(met: DataFrame, lost: DataFrame, *more) -> DataFrame:
    a = met.groupBy("doc_id").agg(F.sum(F.col("n") * F.col("k")).alias("danados"), *more)
    j = a.join(lost, "doc_id", "full")
    return j.withColumn("danados", F.coalesce("danados", F.lit(0))).withColumn("perdidos", F.coalesce("perdidos", F.lit(0)))


def garbled(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, danados, perdidos, pares): per document with any, the garbled characters that can be restored, those that are lost, and the words with their restored forms.

    Null, empty and pure ASCII texts have none. Repeated document rows count once per distinct text. Null ids are left
    out. An empty table gives an empty result.
    """
    met, lost = _met(documents, doc_id, text)
    return _sums(met, lost, F.collect_set(F.struct("word", "restaurado", "way")).alias("pares")).select("doc_id", "danados", "perdidos", "pares")


def found(documents: DataFrame) -> DataFrame:
    """(doc_id): the documents with at least CASE_CHARS garbled characters, restorable or not."""
    return _sums(*_met(documents, "doc_id", "text")).where(F.col("danados") + F.col("perdidos") >= CASE_CHARS).select("doc_id")


def restored(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, texto, danados, perdidos): the documents with garbled characters, as far as restored."""
    g = garbled(documents, doc_id, text)
    src = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).distinct().join(g, "doc_id")

    def make():
        def f(c):
            texts = []
            for t, pairs in zip(c["text"], c["pares"]):
                fixes = {p["word"]: p["restaurado"] for p in pairs or []}
                ways = Counter(p["way"] for p in pairs or [] if ">" in p["way"])
                if ways:
                    # Words too short to prove anything alone follow the rest of their document.
                    way = ways.most_common(1)[0][0]
                    kinds = {script(p["restaurado"]) for p in pairs if p["way"] == way}
                    for w in set(words_of(t)) - fixes.keys():
                        back = undo(w, *way.split(">"))
                        if back is not None and _letters(back) and script(back) in kinds:
                            fixes[w] = back
                if fixes:
                    # Whole words only, long ones first: a short one may be part of another.
                    words = "|".join(re.escape(w) for w in sorted(fixes, key=lambda w: (-len(w), w)))
                    t = re.sub(words, lambda m: fixes[m[0]], t)
                texts.append(t)
            return {"doc_id": c["doc_id"], "texto": texts, "danados": c["danados"], "perdidos": c["perdidos"]}

        return f

    return map_rows(src, make, "doc_id bigint, texto string, danados bigint, perdidos bigint", rows=200)
