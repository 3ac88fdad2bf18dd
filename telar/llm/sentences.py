"""Sentence boundaries across languages and scripts (problem 4), centred on the document.

Whether a full stop ends a sentence hangs on two questions: is the word before it an abbreviation, and is the capital
after it that of a name? Both are answered from unambiguous places: a word followed by a full stop and a small letter,
a digit or a comma is an abbreviation; a word seen in small letters is no name. The document itself is asked first, the
whole corpus where the document is silent. Scripts have terminators of their own; Thai has blanks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions.batches import map_rows

#: Words and abbreviations of the corpus are carried if they occur in this share of the documents (and in MIN_DOCUMENTS).
#: A document has a bounded number of distinct words on average, so that at most that number over the share qualify.
SHARE = 2e-4
MIN_DOCUMENTS = 3
#: A word is no name if the documents that have it in small letters are at least this share of those that have it with a capital.
SMALL_SHARE = 0.1
#: Words joined by full stops without blanks are one abbreviation, as in "e.g.", while they are shorter than this; addresses are longer.
DOTTED = 40

_WORD = r"[^\W\d_](?:[^\W_]|[̀-ͯ])*"
_LOWER = re.compile(rf"(?<![^\W_])[^\W\d_](?:[^\W_]|[̀-ͯ])*(?![^\W_])")
_LETTERS = re.compile(r"(?:[^\W\d_]|[̀-ͯऀ-ॿ])+")
_END = re.compile(r"(?<![^\W_])(?:[^\W\d_]|[̀-ͯऀ-ॿ])+$")
_RUN = re.compile(r"[.…]+")
_TERMINAL = ".!?…。！？．।॥؟۔"
_FULL = "。！？．।॥"
_CLOSE = {"»": "«", "”": "“", "」": "「", "』": "『", ")": "(", "）": "（", "]": "[", "】": "【", "》": "《", "›": "‹"}
_OPEN = {v: k for k, v in _CLOSE.items()} | {"„": "“"}
_QUOTES = "»”」』\"“›"
_CLOSERS = "»”」』\"“›)）]】》’'"
_SPECIAL = re.compile(r"[.!?…。！？．।॥؟۔\n«»“”„\"「」『』()（）\[\]【】《》‹›]|(?<=[฀-๿\d?!.])[ \t]+(?=[฀-๿\d])")
_MARKER = re.compile(r"[ \t]*(?:[-–—•▪◦·‣*●○■→]|\(?\d{1,3}[.)]|\d{1,3} [-–]|\(?[a-zа-я][.)]|[ivxIVX]{1,5}[.)]|\([a-zа-я\d]{1,3}\)|[（(]?[一二三四五六七八九十]{1,3}[、）)])[ \t]*\S")
_LETTER = re.compile(r"[^\W\d_]")
_THAI = re.compile("[฀-๿]")
_WIDE = re.compile("[぀-ヿ㐀-鿿豈-﫿]")
_GOES_ON = "とって"  # after a Japanese quotation these carry the sentence on


@dataclass
class Lexicon:
    """What the corpus says: words seen in small letters, abbreviations, and those among them that stand before names."""

    lower: frozenset[str] = frozenset()
    short: frozenset[str] = frozenset()


@dataclass
class Evidence:
    """What one document says about itself."""

    lower: set[str] = field(default_factory=set)
    short: set[str] = field(default_factory=set)


def evidence(text: str) -> Evidence:
    e = Evidence()
    for m in _LOWER.finditer(text):
        if m[0][0].islower():
            e.lower.add(m[0])
    for w, gap, after in _stops(text):
        # A digit may begin a sentence behind a long word.
        if _unambiguous(gap, after[:1]) and (len(w) <= 4 or not after[:1].isdigit()):
            e.short.add(w)
    return e


def _ending(part: str) -> str:
    """The word at the end of a text; looked for in a window that grows while the word fills it."""
    size = 16
    while True:
        m = _END.search(part[-size:])
        if not m:
            return ""
        if len(m[0]) < size or size >= len(part):
            return m[0]
        size *= 4


def _stops(text: str) -> Iterator[tuple[str, str, str]]:
    """(word, blanks, what follows) at every full stop behind a word; dotted abbreviations are one word, up to DOTTED characters of it."""
    parts = text.split(".")
    before = ""
    for a, b in zip(parts, parts[1:]):
        word = _ending(a)
        if word and before and len(word) == len(a) and len(before) + len(word) < DOTTED:
            word = f"{before}.{word}"
        before = word
        if word:
            after = b.lstrip(" \t\u00a0\u202f")
            yield word, b[: len(b) - len(after)] + ("\n" if after[:1] == "\n" else ""), after


def _unambiguous(gap: str, first: str) -> bool:
    """Whether what follows a word and its full stop shows that no sentence ends there: a small letter, a digit or a comma in the same line."""
    if "\n" in gap or not first:
        return False
    return first in ",;:" and not gap or bool(gap) and (first.islower() or first.isdigit())


def corpus_lexicon(documents: DataFrame, share: float = SHARE, least: int = MIN_DOCUMENTS) -> Lexicon:
    """The lexicon of all texts of ``documents`` (column ``text``)."""

    def make():
        seen: Counter[tuple[str, str]] = Counter()

        def flush():
            out = {"word": [k[0] for k in seen], "kind": [k[1] for k in seen], "n": list(seen.values())}
            seen.clear()
            return out

        def f(c):
            for t in c["text"]:
                if not t:
                    continue
                mine = {("", "documents")}
                words = _LETTERS.findall(t)
                often = Counter(words)
                for w in often:
                    if w[0].islower():
                        mine.add((w, "lower"))
                    elif len(w) == 1 or not w.isupper():
                        mine.add((w.lower(), "upper"))
                dotted: Counter[str] = Counter()
                for w, gap, after in _stops(t):
                    dotted[w] += 1
                    first = after[:1]
                    if _unambiguous(gap, first):
                        mine.add((w, "short"))
                    elif first.isupper() and after[1:2].isalpha():
                        mine.add((w, "name"))
                        mine.add((f"{w}\x1f{_LETTERS.match(after)[0]}", "next"))
                    else:
                        mine.add((w, "end"))
                mine.update((w, "only") for w, k in dotted.items() if often[w] <= k)
                seen.update(mine)
            return flush() if len(seen) > 200_000 else None

        f.rest = flush
        return f

    counts = map_rows(documents.select("text"), make, "word string, kind string, n bigint").groupBy("word", "kind").agg(F.sum("n").alias("n"))
    total = counts.where("kind = 'documents'").agg(F.sum("n"))
    kept = counts.crossJoin(F.broadcast(total.toDF("total"))).where((F.col("kind") != "documents") & (F.col("n") >= F.greatest(F.lit(float(least)), F.lit(share) * F.col("total"))))  # one row
    by: dict[str, dict[str, int]] = {"lower": {}, "short": {}, "name": {}, "end": {}, "only": {}, "next": {}, "upper": {}}
    for r in kept.select("word", "kind", "n").toLocalIterator():
        by[r["kind"]][r["word"]] = r["n"]
    # Texts in small letters throughout write names small too: a few such are no evidence against many capitals.
    lower = frozenset(w for w, n in by["lower"].items() if n >= SMALL_SHARE * by["upper"].get(w, 0))
    # What follows an abbreviation that stands before names is rarely a word that has a small form.
    common: Counter[str] = Counter()
    for k, n in by["next"].items():
        w, follower = k.split("\x1f")
        if follower.lower() in lower:
            common[w] += n
    short = set()
    for w in by["short"].keys() | by["name"].keys():
        yes, other, bare = by["short"].get(w, 0), by["name"].get(w, 0) + by["end"].get(w, 0), max(0, by["lower"].get(w, by["upper"].get(w.lower(), 0)) - by["only"].get(w, 0))
        if "." in w and yes:
            short.add(w)
        elif yes >= 0.2 * (yes + other) and yes >= 0.5 * bare:
            short.add(w)
        elif len(w) <= 5 and bare <= 0.1 * (yes + other) and common[w] <= 0.3 * (yes + other) and by["name"].get(w, 0) - common[w] + yes >= 0.5 * (yes + other):
            # Never without its full stop, and before names or scattered followers: a title.
            short.add(w)
    return Lexicon(lower, frozenset(short))


def _is_short(word: str, own: Evidence, corpus: Lexicon) -> bool:
    """Whether a word with a full stop is an abbreviation: single letters and dotted ones are, then the document, then the corpus decides."""
    if len(word) == 1 and not _WIDE.match(word) or "." in word:
        return True
    return word in own.short or word in corpus.short


def _is_common(word: str, own: Evidence, corpus: Lexicon) -> bool:
    """Whether a capitalised word is one that is otherwise written small."""
    low = word.lower()
    return low in own.lower or low in corpus.lower


_LAST = re.compile(r"((?:[^\W_]|[̀-ͯऀ-ॿ])+(?:\.(?:[^\W\d_]|[̀-ͯ])+)*)$")
_FIRST = re.compile(r"[\s\"'“”«„‹(\[¿¡*–—-]*((?:[^\W_]|[̀-ͯऀ-ॿ’'])+)?")


def _lines(text: str, own: Evidence, corpus: Lexicon) -> set[int]:
    """Places of the line breaks that end a unit: all but those that only wrap a sentence.

    A writer who wraps lines breaks where the next word does not fit. A break before a word that would have fitted into
    the width of its paragraph is meant.
    """
    hard = set()
    begins = [0]
    for m in re.finditer("\n", text):
        begins.append(m.end())
    lines = [text[a : b - 1] for a, b in zip(begins, [*begins[1:], len(text) + 1])]
    width = 0
    widths = []
    wrapped = []
    block: list[int] = []
    sizes = [len(x.rstrip()) for x in lines]
    longest = max(sizes)
    for i, x in enumerate([*lines, ""]):
        if x.strip():
            block.append(i)
        else:
            width = max((sizes[k] for k in block), default=0)
            widths += [width if len(block) >= 3 else longest] * len(block) + ([0] if i < len(lines) else [])
            wrapped += [len(block) >= 3] * len(block) + [False]
            block = []
    for i in range(len(lines) - 1):
        a, b = lines[i].rstrip(), lines[i + 1]
        at = begins[i + 1] - 1
        if not a.strip() or not b.strip() or _MARKER.match(b) or a.count("|") >= 2 or b.count("|") >= 2:
            hard.add(at)
            continue
        if re.search(r"[^\W\d_][-‐¬­]$|,$", a) and b.lstrip()[:1].islower():
            continue
        first = b.strip(" \t\r\f\v").split(" ", 1)[0]  # no-break blanks hold a word together
        wide = _WIDE.match(first)
        need = 1 if wide else len(first)
        if len(a) + (0 if wide else 1) + need <= widths[i]:
            hard.add(at)
            continue
        if _THAI.match(b) and _THAI.search(a[-6:]):
            hard.add(at)  # where a blank ends a sentence, so does the break in its place
            continue
        m = _FIRST.match(b)
        word = m[1] or ""
        if wrapped[i] and not _MARKER.match(a) or a[-1] in _TERMINAL:
            continue
        if word[:1].isupper() and _is_common(word, own, corpus) and a[-1] not in ",;:":
            # Behind an item, or in a paragraph of two lines, a capital that no name accounts for begins something new.
            hard.add(at)
    return hard


def boundaries(text: str, corpus: Lexicon) -> list[int]:
    """The ends of the sentences of a text, in code points from its start, without the blanks between them."""
    if not text or text.isspace():
        return []
    own = evidence(text)
    hard = _lines(text, own, corpus)
    # Quotations and brackets that are closed before their paragraph ends; others are ignored.
    inside = _enclosed(text, hard)
    ends: list[int] = []
    start = 0
    thai = bool(_THAI.search(text))
    dots = 0  # the end of the last run of full stops

    def close(end: int) -> None:
        nonlocal start
        last = len(text[start:end].rstrip()) + start
        if last > start and text[start:last].strip():
            ends.append(last)
        start = end

    for m in _SPECIAL.finditer(text):
        at = m.start()
        if at < start:
            continue
        c = m[0]
        if c == "\n":
            if at in hard:
                close(at)
            continue
        if c[0] in " \t":
            if thai and not inside[at] and (_THAI.match(text[at - 1]) or _THAI.match(text[m.end()])) and not text.startswith("ดร.", at - 3):
                close(at)
            continue
        if c in _CLOSE or c in '"“':
            # Behind a closing quotation mark a sentence may end if a terminator stands before it.
            if inside[at] != 1 or not _closes(text, at, inside):
                continue
            last = _solid_before(text, at)
            if last < start or text[last] not in _TERMINAL or c in ")）]】" and text[_solid_from(text, start)] not in "(（[【":
                continue
            at += 1
        elif c in _TERMINAL:
            if inside[at]:
                continue
            if c in ".…":
                fresh = at >= dots
                if fresh:
                    dots = _RUN.match(text, at).end()
                end = dots
                if end - at > 3 and text.find("…", at, end) < 0:
                    continue
                if at and text[at - 1] == "." and c == ".":
                    continue
                if end - at > 1 or c == "…":
                    if not _begins(text, _skip(text, end), own, corpus, hard, dots=True):
                        continue
                    at = end
                elif not _stop_ends(text, at, start, own, corpus, hard):
                    continue
                else:
                    at += 1
            else:
                at += 1
                while at < len(text) and text[at] in "!?！？؟…。":
                    at += 1
                if c not in _FULL and not _begins(text, _skip(text, at), own, corpus, hard, dots=False):
                    continue
        else:
            continue
        end = _skip(text, at)
        if _WIDE.match(text[end - 1 : end]) is None and end < len(text) and text[end] in _GOES_ON and text[end - 1] in "」』":
            continue
        if end < len(text) and text[end] in ",;:，、；：":
            continue
        close(end)
    close(len(text))
    return ends


def _solid_before(text: str, at: int) -> int:
    """The place of the last character before ``at`` that is no blank; -1 if there is none."""
    at -= 1
    while at >= 0 and text[at].isspace():
        at -= 1
    return at


def _solid_from(text: str, at: int) -> int:
    """The place of the first character from ``at`` on that is no blank, or the last place."""
    while at < len(text) - 1 and text[at].isspace():
        at += 1
    return at


def _skip(text: str, at: int) -> int:
    """The end of the closing marks behind a terminator, French ones after a blank included."""
    while at < len(text):
        if text[at] in _CLOSERS and not (text[at] in "\"“'’" and at + 1 < len(text) and text[at + 1].isalnum()):
            at += 1
        elif text[at] in "   " and at + 1 < len(text) and text[at + 1] in "»›":
            at += 2
        else:
            break
    return at


def _enclosed(text: str, hard: set[int]) -> list[int]:
    """For each place, how many quotations and brackets are open there; a mark counts as inside."""
    change = [0] * (len(text) + 2)
    stack: list[tuple[str, int]] = []
    waiting: Counter[str] = Counter()  # what the stack holds

    def pop() -> tuple[str, int]:
        top = stack.pop()
        waiting[top[0]] -= 1
        return top

    def push(c: str, at: int) -> None:
        stack.append((c, at))
        waiting[c] += 1

    def pair(opener: str, at: int) -> None:
        while stack[-1][0] != opener:
            pop()
        change[pop()[1]] += 1
        change[at + 1] -= 1

    for m in re.finditer("[«»“”„\"「」『』()（）\\[\\]【】《》‹›\n]", text):
        c, at = m[0], m.start()
        if c == "\n":
            if at in hard:
                stack.clear()
                waiting.clear()
            continue
        if c == '"':
            if stack and stack[-1][0] == '"':
                pair('"', at)
            else:
                push(c, at)
        elif c == "“" and waiting["„"]:
            pair("„", at)
        elif c in _OPEN:
            push(c, at)
        elif waiting[_CLOSE[c]]:
            pair(_CLOSE[c], at)
    return list(accumulate(change[:-1]))


def _closes(text: str, at: int, inside: list[int]) -> bool:
    return inside[at] > (inside[at + 1] if at + 1 < len(text) else 0) or at + 1 < len(text) and text[at + 1] in "«“„「『(（[\""


def _begins(text: str, at: int, own: Evidence, corpus: Lexicon, hard: set[int], dots: bool) -> bool:
    """Whether a new sentence may begin behind a place: not with a small letter, nor with a mark that goes on."""
    k = at
    while k < len(text) and text[k].isspace():
        if text[k] == "\n" and k in hard:
            return True
        k += 1
    if k >= len(text):
        return True
    c = text[k]
    if c in ",;:，、；：)）]】—–-" and not (c in "—–-" and k > at and "\n" in text[at:k]):
        return False
    m = _FIRST.match(text, k)
    word = m[1] or ""
    if not word:
        return not dots
    first = word[0]
    if first.islower():
        return False
    if first.isupper():
        return True
    if dots:
        # Ellipses in scripts without capitals go on: what a new sentence would look like can't be told.
        return first.isdigit()
    return True


def _stop_ends(text: str, at: int, start: int, own: Evidence, corpus: Lexicon, hard: set[int]) -> bool:
    """Whether the single full stop at a place ends a sentence."""
    after = _skip(text, at + 1)
    if after >= len(text):
        return True
    before = _word_before(text, start, at)
    if before and _opens_line(text, at - len(before), at):
        return False  # the number of a list item
    k = after
    while k < len(text) and text[k].isspace():
        if text[k] == "\n" and k in hard:
            return True
        k += 1
    if k >= len(text):
        return True
    f = _FIRST.match(text, k)
    word = f[1] or ""
    glued = k == after
    if glued:
        # No blank: only a word, its full stop and a capitalised word make two sentences.
        if not word or not word[0].isupper() or len(word) > 1 and not word[1].islower() and word[1] not in "’'" or after > at + 1 and text[k] not in "¿¡«“„":
            return bool(word) and word[0].isupper() and after > at + 1 or text[k] in "¿¡«“„" and not _is_short(before, own, corpus)
        if text[at - 1] in _CLOSERS:
            return True
        if not before or before[-1].isupper() or _is_short(before, own, corpus) or re.search(r"[/:@]\S*$", text[max(start, at - 60) : at]):
            return False
        return True
    if not _begins(text, after, own, corpus, hard, dots=False):
        return False
    if not before:
        return True
    if "ऀ" <= before[-1] <= "ॿ":
        return False  # sentences end with a danda there
    if before.isdigit():
        # German ordinals: a small number before a capitalised word that has no small form.
        return not (len(before) <= 2 and int(before) <= 31 and word[:1].isupper() and not _is_common(word, own, corpus) and re.search(r"(?:[Aa]m|[Dd]en|[Vv]om|[Zz]um|[Bb]is|[Dd]er|[Dd]em|[Ss]eit|[Aa]b)\s+\d+$", text[max(start, at - 12) : at]))
    if not _is_short(before, own, corpus):
        return True
    if not word or word[0].isdigit():
        return not word
    if word[0].isupper():
        return _is_common(word, own, corpus) and not (len(before) == 1 and re.search(r"(?:^|[\s(«“\"])[^\W\d_]\.\s?$", text[max(start, k - 3) : k]) and len(word) == 1)
    return False  # an abbreviation in a script without capitals


def _word_before(text: str, start: int, at: int) -> str:
    """The word, or the dotted words, right before a place; looked for in a window that grows while the word fills it."""
    size = 40
    while True:
        begin = max(start, at - size)
        m = _LAST.search(text, begin, at)
        if m is None or m.start() > begin or begin == start:
            return m[1] if m else ""
        size *= 4


def _opens_line(text: str, begin: int, at: int) -> bool:
    """Whether a word and its full stop are the number of an item: nothing but blanks and a bracket stand before them in their line."""
    line = begin
    while line > 0 and text[line - 1] != "\n" and (text[line - 1].isspace() or text[line - 1] == "("):
        line -= 1
    return (line == 0 or text[line - 1] == "\n") and _MARKER.match(text, line, at + 3) is not None


def sentences(texts: DataFrame, corpus: Lexicon, key: str = "doc_id", text: str = "text", kind: str = "bigint") -> DataFrame:
    """(key, n, fin, oracion): the sentences of every text in order, where they end, and what they say.

    Null, empty and blank texts have none. Repeated rows give repeated sentences. Texts are read whole.
    """
    src = texts.select(F.col(key).cast(kind).alias("key"), F.col(text).alias("text"))
    shared = texts.sparkSession.sparkContext.broadcast(corpus)  # bounded by SHARE

    def make():
        corpus = shared.value

        def f(c):
            out: dict[str, list] = {"key": [], "n": [], "fin": [], "oracion": []}
            for k, t in zip(c["key"], c["text"]):
                begin = 0
                for n, end in enumerate(boundaries(t or "", corpus)):
                    out["key"].append(k)
                    out["n"].append(n)
                    out["fin"].append(end)
                    out["oracion"].append(t[begin:end].strip())
                    begin = end
            return out

        return f

    return map_rows(src, make, f"key {kind}, n int, fin int, oracion string").withColumnRenamed("key", key)


def found(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, fin): the sentences of the documents of ``sample``; abbreviations and names are learned from all documents."""
    corpus = corpus_lexicon(documents)
    chosen = documents.select("doc_id", "text").join(sample.select("doc_id").where("doc_id IS NOT NULL").distinct(), "doc_id", "left_semi")
    return sentences(chosen, corpus).select("doc_id", "fin").distinct()
