"""Noise in text from scanned pages (problem 5).

Corrections come from the corpus itself. Rare words meet frequent words of the corpus by an inverted join on their
rarest character q-grams, and any word of the corpus by the letters that signs within them may stand for; boosted trees,
fitted on frequent words damaged the way scanners damage them, choose the replacement, and a word counts as misread if
they do. Pairs of lines are classified by trees as well: whether a mark at a line end breaks a word, and
whether a line that comes back is page furniture or text that repeats.
"""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions.batches import map_rows
from telar.llm import trees
from telar.llm.filters import bit_filter, bit_of_word
from telar.session import store

KINDS = ("guion", "caracteres", "cabecera", "pagina")
LEAST = {"guion": 3, "caracteres": 8, "cabecera": 3, "pagina": 3}
#: A word belongs to the lexicon from this share of the documents on (and LEAST_DOCUMENTS). As a document has a bounded
#: number of distinct words on average, no more than that number over the share can.
LEXICON_SHARE = 3e-4
LEAST_DOCUMENTS = 4
#: Words of the lexicon that are damaged to fit the ranking on.
FIT_WORDS = 1_200
#: Texts that pages are made of to fit the classifier of furniture on, at most (in expectation).
FIT_TEXTS = 200
#: A lexicon of at most so many words is sent to all tasks (some 50 MB with its q-grams); with a larger one, the words of each q-gram are spread over SALTS parts.
SENT_WORDS = 100_000
SALTS = 8
#: Words whose answer of the filter a task remembers.
REMEMBERED = 200_000
Q = 3

MARKS = "-‐‑¬­"
_PAGE = re.compile(r"^\W*(?:(?:p[aá]g(?:ina|e|\.)?|page|seite|s\.|стр(?:аница|\.)?|p\.|页|第|ページ|صفحة|पृष्ठ|หน้า)\s*)?\d{1,4}\s*(?:(?:/|de|of|von|из|sur|di|页|頁|ページ)\s*\d{0,4})?\W*$", re.I)
_BREAK = re.compile(rf"[{MARKS}][ \t]*\n[ \t]*(?=([^\W\d_]+))")
_BEFORE = re.compile(r"[^\W\d_]+$")
_WORD = re.compile(r"[\w@|]+")
_INSIDE = re.compile(r"[^\W\d_][0-9@|]|[0-9@|][^\W\d_]")
_PLAIN = re.compile(r"[^\W\d_]+$")
_LETTERS = re.compile(r"[^\W\d_].*[^\W\d_]")
_WIDE = re.compile("[฀-໿぀-ヿ㐀-鿿]")
# How scanners misread: what is on the page, and what comes out. Single letters first, then those that merge or split.
CONFUSED = (("o", "0"), ("l", "1"), ("l", "|"), ("i", "l"), ("i", "1"), ("e", "c"), ("a", "@"), ("s", "5"), ("g", "9"), ("u", "v"), ("t", "f"), ("h", "b"), ("b", "6"), ("ó", "6"), ("é", "6"), ("m", "rn"), ("n", "ri"), ("rn", "m"), ("ri", "n"), ("d", "cl"), ("cl", "d"), ("z", "2"), ("q", "9"))
_SINGLE = defaultdict(set)
for _a, _b in CONFUSED:
    if len(_a) == len(_b) == 1:
        _SINGLE[_a].add(_b)
_SKELETON = str.maketrans({"0": "o", "1": "i", "|": "i", "l": "i", "5": "s", "9": "g", "@": "a", "c": "e", "v": "u", "f": "t", "b": "h", "6": "o", "ó": "o", "é": "e"})


def skeleton(line: str) -> str:
    """A line as it stays under misreading: letters that scanners take for each other are one, numbers are gone."""
    words = " ".join([w for w in _WORD.findall(line.lower()) if not w.isdigit()])
    return words.replace("rn", "m").replace("ri", "n").replace("cl", "d").translate(_SKELETON)


def breaks(text: str) -> list[tuple[int, int, str, str, str]]:
    """(begin, end, left, mark, right) of each mark between letters at a line end."""
    out = []
    for m in _BREAK.finditer(text):
        left = _BEFORE.search(text, max(0, m.start() - 40), m.start())
        if left:
            out.append((m.start(), m.end(), left[0], m[0][0], m[1]))
    return out


def rejoined(text: str) -> str:
    """The text with words that a mark breaks at a line end put together."""
    return _BREAK.sub(lambda m: "" if m.start() and text[m.start() - 1].isalpha() else m[0], text)


def words_of(text: str) -> list[str]:
    """Words in small letters, with the signs that scanners put in the place of letters."""
    words = _WORD.findall(text.lower())
    if "_" in text:
        words = [p for w in words for p in w.split("_") if p]
    if "|" in text or "@" in text:
        words = [w for w in words if not w.strip("|@") == ""]
    return words


def _lexicon_counts(src: DataFrame) -> DataFrame:
    """(word, n): documents per word of letters, from rejoined text, and, under '', documents."""

    def make():
        seen: Counter[str] = Counter()

        def flush():
            out = {"word": list(seen), "n": list(seen.values())}
            seen.clear()
            return out

        def f(c):
            for t in c["text"]:
                mine = {w for w in set(words_of(rejoined(t) if "\n" in t else t)) if not _WIDE.search(w)}
                mine.add("")
                seen.update(mine)
            return flush() if len(seen) > 150_000 else None

        f.rest = flush
        return f

    return map_rows(src.select("text"), make, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# --- line pairs: joins -------------------------------------------------------------------------------------------

_JOIN_FEATURES = ("joined_known", "left_known", "right_known", "left_size", "right_size", "small", "soft")
_JOIN_MONOTONE = [1, -1, -1, 0, 0, 1, 1]


def _join_row(left: str, mark: str, right: str, lexicon: frozenset[str]) -> list[float]:
    return [
        float((left + right).lower() in lexicon), float(left.lower() in lexicon), float(right.lower() in lexicon),
        min(len(left), 12), min(len(right), 12), float(right[0].islower()), float(mark in "‐¬­"),
    ]


def fit_joins(lexicon: frozenset[str]) -> trees.Forest:
    """Trees that tell broken words from words with a mark of their own; fitted on words of the lexicon, broken here, and on pairs of its words."""
    rng = random.Random(5)
    words = sorted(w for w in lexicon if len(w) >= 5) or ["palabra", "ejemplo", "documento"]
    known = lexicon or frozenset(words)
    x, y = [], []
    for k in range(1_500):
        w = words[rng.randrange(len(words))]
        at = rng.randrange(2, len(w) - 1)
        row = _join_row(w[:at], rng.choice("---‐¬­"), w[at:], known)
        if k % 4 == 0:
            row[0] = 0.0  # a name, or a word damaged as well
        x.append(row)
        y.append(1.0)
        a, b = words[rng.randrange(len(words))], words[rng.randrange(len(words))]
        x.append(_join_row(a, "-", b.capitalize() if k % 3 == 0 else b, known))
        y.append(0.0)
    return trees.fit(np.array(x), np.array(y), _JOIN_MONOTONE, trees=25)


# --- line pairs: furniture ---------------------------------------------------------------------------------------

_FURNITURE_FEATURES = ("times", "gap", "spread", "cuts", "short", "others")
_FURNITURE_MONOTONE = [0, 1, -1, 1, 0, -1]


_FILLER = "the office reviewed the plan and published a list of incidents near the river according to minutes while nobody answered before noon"


def _wrapped(text: str, width: int) -> list[str]:
    lines, held = [], ""
    for w in text.split():
        if held and len(held) + 1 + len(w) > width:
            lines.append(held)
            held = w
        else:
            held = f"{held} {w}" if held else w
    return lines + [held] if held else lines


def _pages(lines: list[str], rng: random.Random) -> tuple[list[str], set[str]]:
    """The lines as pages with running headers, footers or both, which may be damaged and bear the number of the page; and what these say."""
    words = [w for x in lines for w in x.split() if len(w) > 2 and w[0].isalpha()] or ["informe"]

    def running() -> str:
        said = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))
        return rng.choice((said, said.upper(), said.capitalize()))

    head, foot = rng.choice(((True, False), (False, True), (True, True), (True, True)))
    heads = [running() for _ in range(rng.choice((1, 1, 2)))] if head else []
    feet = [running()] if foot else []
    size, number, numbered = rng.randrange(4, 45), rng.randrange(1, 90), rng.random()
    out = []
    for k in range(0, len(lines), size):
        own = [damaged(x, rng, rng.randrange(1, 3)) if rng.random() < 0.3 else x for x in heads + feet]
        own = [f"{x} {number}" if numbered < 0.3 else x for x in own]
        out += own[: len(heads)] + lines[k : k + size] + own[len(heads) :] + ([f"- {number} -"] if numbered > 0.6 else []) + ([""] if rng.random() < 0.3 else [])
        number += 1
    return out, set(heads + feet)


def _refrains(lines: list[str], rng: random.Random) -> list[str]:
    """The lines with one that comes back as text does: behind a full stop, or in every entry of a list, or all text over again."""
    line = rng.choice([x for x in lines if len(x) > 1])
    kind = rng.randrange(3)
    if kind == 0:
        line = line.rstrip(".") + "."
        out = []
        for x in lines:
            out.append(x)
            if x.endswith((".", "!", "?")) and rng.random() < 0.7:
                out.append(line)
        return out
    if kind == 1:
        size = rng.randrange(1, 4)
        return [y for k in range(0, len(lines), size) for y in (line.split(" ")[0] + ":", *[f"{x[:1].upper()}{x[1:].rstrip('.')}." for x in lines[k : k + size]])]
    return lines * 3


def fit_furniture(texts: tuple[str, ...] | list[str] = ()) -> trees.Forest:
    """Trees that tell a running header from lines that repeat for other reasons.

    Fitted on texts of the corpus that repeat no line, wrapped and put on pages with a header here, and on the same
    texts with lines that come back in other ways; where the corpus has few, on filler.
    """
    rng = random.Random(9)
    texts = list(texts)
    while len(texts) < 60:
        texts.append(" ".join(" ".join(rng.choice(_FILLER.split()) for _ in range(rng.randrange(5, 20))).capitalize() + "." for _ in range(rng.randrange(20, 120))))
    x, y, weight = [], [], []
    for k, t in enumerate(texts * (1 + 400 // len(texts))):
        lines = _wrapped(t, rng.randrange(40, 100))
        if len(lines) < 12 or max(Counter(map(skeleton, lines)).values()) > 1:
            continue
        made, heads = _pages(lines, rng) if k % 2 else (_refrains(lines, rng), set())
        _, rows, keys, _ = _candidates([v.strip() for v in made])
        # Of pages only the running lines are known for what they are; where text comes back, all of it is.
        known = set(map(skeleton, heads))
        told = [row for key, row in zip(keys, rows) if key in known or not k % 2]
        x += told
        y += [float(k % 2)] * len(told)
        weight += [1 / max(len(told), 1)] * len(told)
    return trees.fit(np.array(x, np.float64).reshape(len(x), len(_FURNITURE_FEATURES)), np.array(y), _FURNITURE_MONOTONE, trees=25, weight=np.array(weight))


def _number_lines(lines: list[str]) -> list[int]:
    return [i for i, x in enumerate(lines) if x and _PAGE.match(x)]


def _candidates(lines: list[str]) -> tuple[list[int], list[list[float]], list[str], dict[str, list[int]]]:
    """Places of page numbers; and of lines that come back, by their skeleton: what is known of each, and where it stands."""
    numbers = _number_lines(lines)
    if len(lines) < 5:
        return numbers, [], [], {}  # three pages with a header hold more lines
    skip = set(numbers)
    places: dict[str, list[int]] = defaultdict(list)
    for i, x in enumerate(lines):
        # Wording of its own: two letters at least.
        if i not in skip and len(x) > 1:
            s = skeleton(x)
            if len(s) > 1 and _LETTERS.search(s):
                places[s].append(i)
    rows, keys = [], []
    width = max(map(len, lines))
    again = sum([len(at) for at in places.values() if len(at) >= 3])
    for s, at in places.items():
        if len(at) < 3:
            continue
        gaps = np.diff(at)
        own = set(at)
        cuts = 0
        for i in at:
            before = next((lines[k] for k in range(i - 1, max(-1, i - 4), -1) if lines[k] and k not in skip and k not in own), "")
            after = next((lines[k] for k in range(i + 1, min(len(lines), i + 4)) if lines[k] and k not in skip and k not in own), "")
            # Furniture stands in the middle of sentences, or beside the number of its page.
            cuts += bool(before) and before[-1] not in ".!?…:;|»”" or bool(after) and after[0].islower() or i - 1 in skip or i + 1 in skip or i == 0
        rows.append([len(at), float(np.median(gaps)), float(np.std(gaps) / max(np.mean(gaps), 1)), cuts / len(at), len(lines[at[0]]) / max(width, 1), (again - len(at)) / len(lines)])
        keys.append(s)
    return numbers, rows, keys, places


def furniture(lines: list[str], forest: trees.Forest) -> tuple[list[int], dict[str, list[int]]]:
    """Places of the lines with nothing but a page number, and of running headers and footers by their skeleton."""
    numbers, rows, keys, places = _candidates(lines)
    score = forest.score(np.array(rows)) if rows else []
    return numbers, {k: places[k] for k, p in zip(keys, score) if p >= 0.5}


# --- corrections -------------------------------------------------------------------------------------------------

_RANK_FEATURES = ("cost", "edits", "shared", "longer", "common", "odds", "sign")
_RANK_MONOTONE = [-1, -1, 1, 0, 1, 1, 1]
_MERGES = [(a, b) for a, b in CONFUSED if len(a) != len(b)]


def _far(seen: str, meant: str) -> bool:
    """Whether two words can't be a few misreadings apart: too many letters differ even with look-alikes taken as one."""
    a, b = (x.translate(_SKELETON).replace("rn", "m").replace("ri", "n").replace("ci", "d") for x in (seen, meant))
    return sum((Counter(a) - Counter(b)).values()) > 2


def misreading_cost(seen: str, meant: str) -> tuple[float, int]:
    """(weighted, plain) edits from ``meant`` to ``seen``: a known confusion costs little, any other edit a full step."""
    n, m = len(meant), len(seen)
    if abs(n - m) > 3:
        return 9.0, 9
    inf = 99.0
    cost = [[inf] * (m + 1) for _ in range(n + 1)]
    steps = [[99] * (m + 1) for _ in range(n + 1)]
    cost[0][0], steps[0][0] = 0.0, 0
    for i in range(n + 1):
        for j in range(m + 1):
            c, k = cost[i][j], steps[i][j]
            if c >= inf or abs(i - j) > 3:
                continue

            def go(a: int, b: int, price: float, k: int = k, c: float = c) -> None:
                if c + price < cost[a][b]:
                    cost[a][b], steps[a][b] = c + price, k + (price > 0)

            if i < n and j < m:
                go(i + 1, j + 1, 0.0 if meant[i] == seen[j] else 0.2 if seen[j] in _SINGLE[meant[i]] else 1.0)
            if i < n:
                go(i + 1, j, 1.0)
            if j < m:
                go(i, j + 1, 1.0)
            for a, b in _MERGES:
                if meant.startswith(a, i) and seen.startswith(b, j):
                    go(i + len(a), j + len(b), 0.25)
    return cost[n][m], steps[n][m]


def grams(word: str) -> list[str]:
    w = f"^{word}$"
    return sorted({w[i : i + Q] for i in range(len(w) - Q + 1)})


def _rank_row(seen: str, meant: str, shared: float, n_seen: float, n_meant: float) -> list[float]:
    cost, edits = misreading_cost(seen, meant)
    return [cost, edits, shared, len(meant) - len(seen), float(np.log1p(n_meant)), float(np.log((n_meant + 1) / (n_seen + 1))), float(bool(_INSIDE.search(seen)))]


def damaged(word: str, rng: random.Random, times: int) -> str:
    """A word as a scanner may misread it."""
    for _ in range(times):
        places = [(i, a, b) for a, b in CONFUSED for i in range(len(word)) if word.startswith(a, i)]
        if places:
            i, a, b = rng.choice(places)
            word = word[:i] + b + word[i + len(a) :]
    return word


_MEANT = defaultdict(set)
for _a, _b in CONFUSED:
    if len(_a) == len(_b) == 1 and not _b.isalpha():
        _MEANT[_b].add(_a)
#: So many confusions may lie between a word and what it is taken for, at the price of one plain edit.
SIGNS = 5


def variants(word: str) -> list[str]:
    """The words of letters that the signs within a word may stand for; none if a sign stands for no letter, or there are more than SIGNS."""
    places = [c for c in word if not c.isalpha()]
    if not places or len(places) > SIGNS or any(c not in _MEANT for c in places):
        return []
    out = [""]
    for c in word:
        out = [x + y for x in out for y in (sorted(_MEANT[c]) if c in _MEANT else (c,))]
    return out


def fit_ranking(counts: dict[str, int]) -> trees.Forest:
    """Trees that score a correction candidate. Right ones are words of the lexicon damaged here; wrong ones are its other neighbours, and neighbours of words that are right as they are."""
    rng = random.Random(3)
    words = sorted(w for w in counts if len(w) >= 4)
    rng.shuffle(words)
    by: dict[str, list[str]] = defaultdict(list)
    for w in words:
        for g in grams(w):
            by[g].append(w)
    x, y = [], []
    for w in words[:FIT_WORDS]:
        for seen, true in ((damaged(w, rng, rng.choice((1, 1, 2))), w), (w, None)):
            own = grams(seen)
            near = Counter(c for g in own for c in by[g] if abs(len(c) - len(seen)) <= 2 and c != seen)
            picked = {c for c, _ in near.most_common(4)} | ({true} if true in near else set())
            for c in sorted(picked):
                # A damaged form is rare beside its word; a right word may be as rare beside its neighbours.
                n = counts[w] * rng.choice((1.0, 0.1, 0.01) if true is None else (0.0, 0.002, 0.01, 0.03))
                x.append(_rank_row(seen, c, near[c] / len(own), n, counts[c]))
                y.append(float(c == true and seen != true))
    return trees.fit(np.array(x).reshape(len(x), len(_RANK_FEATURES)), np.array(y), _RANK_MONOTONE, trees=50, depth=4)


@dataclass
class Models:
    lexicon: dict[str, int]
    joins: trees.Forest
    furniture: trees.Forest
    ranking: trees.Forest


def _fit_texts(src: DataFrame) -> list[str]:
    """About FIT_TEXTS distinct texts with sentences, drawn by their hash."""
    usable = src.where((F.length("text") >= 600) & F.col("text").rlike(r"\p{L}[.!?]\s"))
    size = usable.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0] or 1
    bound = int(min(1.0, FIT_TEXTS / size) * (1 << 31))
    drawn = usable.where(F.pmod(F.xxhash64("text", F.lit(13)), F.lit(1 << 31)) < bound).select("text").distinct()
    return sorted(r[0] for r in drawn.toLocalIterator())


def fit(counts: DataFrame, src: DataFrame) -> Models:
    """The lexicon (its size is bounded by LEXICON_SHARE) and the three forests."""
    total = counts.where("word = ''").agg(F.sum("n")).first()[0] or 0
    often = counts.where((F.col("n") >= max(LEAST_DOCUMENTS, LEXICON_SHARE * total)) & F.col("word").rlike(r"^\p{L}[\p{L}\p{M}]+$"))
    lexicon = {r[0]: r[1] for r in often.toLocalIterator()}
    known = dict(lexicon)
    # Damaged forms may be frequent enough to slip in: a word that is far rarer than the one it may be misread from is out.
    by: dict[str, list[str]] = defaultdict(list)
    for w in lexicon:
        by[skeleton(w)].append(w)
    for ws in by.values():
        most = max(ws, key=lambda w: lexicon[w])
        for w in ws:
            if w != most and lexicon[w] * 25 <= lexicon[most] and misreading_cost(w, most)[0] <= 0.8:
                del known[w]
    return Models(known, fit_joins(frozenset(known)), fit_furniture(_fit_texts(src)), fit_ranking(known))


def structure(src: DataFrame, models: Models, fixes: DataFrame | None = None) -> DataFrame:
    """(doc_id, guion, cabecera, pagina, palabras): broken words, furniture and page numbers of the documents, and words of theirs with how often they occur.

    Without ``fixes``, the documents that show any of the three, with their words outside the lexicon. With ``fixes``,
    also those that hold any of its words alone, with the words that pass its filter.
    """

    bits = None if fixes is None else bit_filter(fixes, "word")
    shared = src.sparkSession.sparkContext.broadcast((frozenset(models.lexicon), models.joins, models.furniture, bits))  # bounded by LEXICON_SHARE

    def make():
        lexicon, joins, forest, bits = shared.value
        keys = ("doc_id", "guion", "cabecera", "pagina", "palabras")
        asked: dict[str, bool] = {}

        def wanted(w: str) -> bool:
            hit = asked.get(w)
            if hit is None:
                if len(asked) >= REMEMBERED:
                    asked.clear()
                k = bit_of_word(w)
                hit = asked[w] = bool(bits[k >> 3] >> (k & 7) & 1)
            return hit

        def f(c):
            out: dict[str, list] = {k: [] for k in keys}
            rows, owner = [], []
            broken = [0] * len(c["text"])
            for i, t in enumerate(c["text"]):
                for _, _, left, mark, right in breaks(t):
                    rows.append(_join_row(left, mark, right, lexicon))
                    owner.append(i)
            for i, p in zip(owner, joins.score(np.array(rows)) if rows else ()):
                broken[i] += p >= 0.5
            for i, t in enumerate(c["text"]):
                lines = [x.strip() for x in t.split("\n")]
                numbers, heads = furniture(lines, forest)
                head = max(map(len, heads.values()), default=0)
                shows = broken[i] >= LEAST["guion"] or head or len(numbers) >= LEAST["pagina"]
                if not shows and bits is None:
                    continue
                skip = {k for at in heads.values() for k in at} | set(numbers)
                body = rejoined("\n".join(x for k, x in enumerate(lines) if k not in skip) if skip else t)
                odd = Counter(w for w in words_of(body) if w not in lexicon and len(w) > 2 and not w.isdigit() and (bits is None or wanted(w)) and not _WIDE.search(w))
                if shows or odd or broken[i] or numbers:
                    for k, v in zip(keys, (c["doc_id"][i], broken[i], head, len(numbers), [{"word": w, "n": n} for w, n in odd.items()])):
                        out[k].append(v)
            return out

        return f

    return map_rows(src, make, "doc_id bigint, guion int, cabecera int, pagina int, palabras array<struct<word: string, n: int>>", rows=300)


def corrections(odd: DataFrame, counts: DataFrame, models: Models) -> DataFrame:
    """(word, corregida, puntaje): words and what they are taken for.

    ``odd`` has the distinct words. They meet the lexicon on q-grams: two misreadings touch at most 2 Q of the grams of
    a word, and one more where letters merge, so it is enough to look with its rarest 2 Q + 2 grams, which no other
    word of the corpus shares with many; and they meet all words of the corpus by what their signs may stand for.
    """
    spark = odd.sparkSession
    words = odd.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(1)).alias("n")).where(~F.col("word").rlike(r"^\d+$"))
    listed = [(w, int(n), grams(w)) for w, n in models.lexicon.items() if len(w) >= 3]
    per_gram = Counter(g for _, _, gs in listed for g in gs)
    lexicon = spark.createDataFrame(listed or [("", 0, [])], "meant string, m bigint, g array<string>").where("m > 0").select("meant", "m", F.explode("g").alias("g"))
    shared = spark.sparkContext.broadcast((models.ranking, dict(per_gram)))  # bounded as the lexicon is

    def make_grams():
        often = shared.value[1]

        def f(c):
            out: dict[str, list] = {"word": [], "n": [], "g": [], "meant": []}
            for w, n in zip(c["word"], c["n"]):
                g = grams(w)
                least = max(1, len(g) - 2 * Q - 1)
                rare = sorted(g, key=lambda x: (often.get(x, 0), x))[: len(g) - least + 1]
                hits = [(x, None) for x in rare if x in often] + [(None, v) for v in variants(w)]
                out["word"] += [w] * len(hits)
                out["n"] += [n] * len(hits)
                out["g"] += [h[0] for h in hits]
                out["meant"] += [h[1] for h in hits]
            return out

        return f

    probes = store(map_rows(words, make_grams, "word string, n bigint, g string, meant string"), "probes")
    looking = probes.where("g IS NOT NULL").select("word", "n", "g")
    if len(listed) <= SENT_WORDS:
        near = looking.join(F.broadcast(lexicon), "g")
    else:
        # A gram that many words look with is hot: its words are spread over SALTS parts, and the lexicon's are there in each.
        salted = looking.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
        near = salted.join(lexicon.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["g", "salt"])
    near = near.where(F.abs(F.length("meant") - F.length("word")) <= 2)
    spelled = probes.where("meant IS NOT NULL").select("word", "n", "meant").join(counts.select(F.col("word").alias("meant"), F.col("n").alias("m")), "meant")
    # A rare word has one document to vouch for it: the misread form may be in as many.
    pairs = near.select("word", "n", "meant", "m").where(F.col("m") > 4 * F.col("n")).unionByName(spelled.select("word", "n", "meant", "m")).distinct()

    def make():
        ranking = shared.value[0]

        def f(c):
            if not c["word"]:
                return None
            rows, keep = [], []
            for i, (w, meant) in enumerate(zip(c["word"], c["meant"])):
                if _far(w, meant):
                    continue
                own = grams(w)
                together = len(set(own).intersection(grams(meant)))
                bare = any(not x.isalpha() for x in w)
                if not bare and together < max(1, len(own) - 2 * Q - 1):
                    continue
                row = _rank_row(w, meant, together / len(own), c["n"][i], c["m"][i])
                if row[0] <= 1.0:
                    rows.append(row)
                    keep.append(i)
            p = ranking.score(np.array(rows)).tolist() if rows else []
            return {"word": [c["word"][i] for i in keep], "corregida": [c["meant"][i] for i in keep], "puntaje": p, "m": [c["m"][i] for i in keep]}

        return f

    scored = map_rows(pairs, make, "word string, corregida string, puntaje double, m bigint", rows=4000).where("puntaje >= 0.5")
    best = scored.groupBy("word").agg(F.max_by(F.struct("corregida", "puntaje"), F.struct("puntaje", "m", "corregida")).alias("best"))
    return best.select("word", "best.corregida", "best.puntaje")


def _prepared(documents: DataFrame, doc_id: str, text: str, scanned_only: bool = False):
    """Texts, models, what the documents show, and the corrections of their words.

    A case of ``found`` shows two kinds of noise, and so one beside misread words: with ``scanned_only`` words are looked
    at in the documents that show another kind. Else those of all documents are, and documents meet the corrections.
    """
    src = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    counts = store(_lexicon_counts(src), "lexicon")
    models = fit(counts, src)
    if scanned_only:
        scanned = store(structure(src, models), "scanned")
        odd = scanned.select(F.explode("palabras").alias("p")).select("p.word").distinct()
        return src, models, scanned, store(corrections(odd, counts, models), "corrections")
    known = counts.sparkSession.createDataFrame([(w,) for w in models.lexicon] or [("",)], "word string")
    odd = counts.where("length(word) > 2").join(known, "word", "left_anti").select("word")
    fixes = store(corrections(odd, counts, models), "corrections")
    return src, models, store(structure(src, models, fixes), "scanned"), fixes


def noise(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, guion, caracteres, cabecera, pagina): how much noise of each kind the documents show that show any.

    Words broken at a line end, words with misread characters, pages with a running header, lines with a page number.
    Null and empty texts show none; null ids are left out; a repeated row counts once. Texts are read whole. Scripts
    without blanks have no words to be misread.
    """
    _, _, scanned, fixes = _prepared(documents, doc_id, text)
    return _noise(scanned, fixes).where("guion > 0 OR caracteres > 0 OR cabecera > 0 OR pagina > 0")


def _noise(scanned: DataFrame, fixes: DataFrame) -> DataFrame:
    words = scanned.select("doc_id", F.explode("palabras").alias("p")).select("doc_id", "p.word", "p.n").distinct()
    hit = words.join(fixes.select("word"), "word")
    misread = hit.groupBy("doc_id").agg(F.sum("n").cast("int").alias("caracteres"))
    once = scanned.groupBy("doc_id").agg(*[F.max(k).alias(k) for k in ("guion", "cabecera", "pagina")])
    return once.join(misread, "doc_id", "left").select("doc_id", "guion", F.coalesce("caracteres", F.lit(0)).alias("caracteres"), "cabecera", "pagina")


def found(documents: DataFrame) -> DataFrame:
    """(doc_id, ruido): the kinds of noise of the documents that show at least two."""
    _, _, scanned, fixes = _prepared(documents, "doc_id", "text", scanned_only=True)
    n = _noise(scanned, fixes)
    kinds = F.filter(F.array(*[F.when(F.col(k) >= LEAST[k], F.lit(k)) for k in KINDS]), lambda k: k.isNotNull())
    return n.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") >= 2).select("doc_id", F.explode("kinds").alias("ruido"))


def repaired(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, texto): the documents of ``noise`` as continuous paragraphs: without furniture, with words rejoined and misread words replaced."""
    src, models, scanned, fixes = _prepared(documents, doc_id, text)
    scanned = scanned.where("guion > 0 OR cabecera > 0 OR pagina > 0 OR size(palabras) > 0")
    words = scanned.select("doc_id", F.explode("palabras").alias("p")).select("doc_id", "p.word").distinct()
    own = words.join(fixes, "word").groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct("word", "corregida"))).alias("fixes"))
    rows = src.distinct().join(scanned.select("doc_id").distinct(), "doc_id").join(own, "doc_id", "left")
    shared = src.sparkSession.sparkContext.broadcast((frozenset(models.lexicon), models.joins, models.furniture))

    def make():
        lexicon, joins, forest = shared.value

        def cased(seen: str, fix: str) -> str:
            return fix.upper() if seen.isupper() and len(seen) > 1 else fix.capitalize() if seen[:1].isupper() else fix

        def f(c):
            out = []
            for t, fixes in zip(c["text"], c["fixes"]):
                fixes = dict(fixes or [])
                lines = [x.strip() for x in t.split("\n")]
                numbers, heads = furniture(lines, forest)
                skip = {k for at in heads.values() for k in at} | set(numbers)
                kept = []
                for k, x in enumerate(lines):
                    if k in skip or not x and (k - 1 in skip or k + 1 in skip):
                        continue
                    kept.append(x)
                body = "\n".join(kept)
                for a, b, left, mark, right in reversed(breaks(body)):
                    if joins.score(np.array([_join_row(left, mark, right, lexicon)]))[0] >= 0.5:
                        body = body[:a] + body[b:]
                # A line without a full stop goes on in the next one.
                body = re.sub(r"(?<=[^\s.!?…:。！？।])\n(?=[^\n\s])", " ", body)
                out.append(_WORD.sub(lambda m: cased(m[0], fixes[m[0].lower()]) if m[0].lower() in fixes else m[0], body))
            return {"doc_id": c["doc_id"], "texto": out}

        return f

    return map_rows(rows.select("doc_id", "text", "fixes"), make, "doc_id bigint, texto string", rows=200)
