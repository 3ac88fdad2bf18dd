"""Languages of documents and of passages in them (problem 2).

Multinomial naive Bayes over hashed character n-grams. Texts are put one behind another, up to BATCH_CHARS of them, and
folded and hashed at once; every n-gram takes its row of the log-probability matrix, which is broadcast, and one sum per
sentence or line gives the scores of all of them. A path through the sentences with a price for each change of language
gives the passages; a background class takes what no language explains.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.functions.batches import map_rows
from telar.llm.chars import TOKEN, UNSPACED

BUCKETS = 1 << 17
#: Labelled texts to fit on, at most, of each label, whatever its spelling (in expectation: distinct texts are chosen by their hash).
PER_LABEL = 300
#: Texts are scored together up to so many characters; a longer one is scored alone, and whole.
BATCH_CHARS = 40_000
#: A label that is not among the SEEDS is a language of its own if its texts are better explained by each other than by any other class: by so many nats for each n-gram.
OWN_GAIN = 0.15
#: Lengths, in characters, of the pieces of held-out texts that confidences are calibrated on.
PIECES = (20, 40, 80, 160)
#: Longer texts are not used to fit; all texts are scored whole.
FIT_CHARS = 20_000
PASSAGE_WORDS = 25
PASSAGE_CHARS = 50
CHANGE = 14.0  # price of a change of language, in nats
BACKGROUND = -9.3  # log-probability of an n-gram in no language
RECORD_FORMATS = ("csv", "xlsx", "pbf")
_UNSPACED_LANGS = ("zh", "ja", "th", "lo", "km", "my")

# A few sentences of each language that the corpus is known to have, so that each has a class even where labels are rare.
SEEDS = {
    "es": "El comité publicó el informe anual y la oficina revisó los datos de las estaciones. No se sabe por qué, pero según el acta hubo más casos que antes, y los vecinos pidieron ayuda a las autoridades.",
    "en": "The committee published the annual report and the office reviewed the data of the stations. Nobody knows why, but according to the minutes there were more cases than before, and they asked for help.",
    "pt": "O comitê publicou o relatório anual e o escritório revisou os dados das estações. Não se sabe por quê, mas segundo a ata houve mais casos do que antes, e os moradores pediram ajuda às autoridades.",
    "fr": "Le comité a publié le rapport annuel et le bureau a révisé les données des stations. On ne sait pas pourquoi, mais selon le procès-verbal il y avait plus de cas qu’avant, et ils ont demandé de l’aide.",
    "de": "Der Ausschuss hat den Jahresbericht veröffentlicht und das Amt prüfte die Daten der Stationen. Niemand weiß warum, aber laut Protokoll gab es mehr Fälle als zuvor, und sie haben um Hilfe gebeten.",
    "ru": "Комитет опубликовал годовой отчёт, и бюро проверило данные станций. Никто не знает почему, но по протоколу случаев было больше, чем раньше, и жители попросили о помощи.",
    "zh": "委员会公布了年度报告，办公室审查了各站的数据。没有人知道为什么，但根据记录，案件比以前多，居民请求帮助。",
    "ja": "委員会は年次報告を公表し、事務局は各局のデータを見直した。なぜかは誰も知らないが、記録によると件数は以前より多く、住民は助けを求めた。",
    "ar": "نشرت اللجنة التقرير السنوي وراجع المكتب بيانات المحطات. لا أحد يعلم لماذا، لكن وفقا للمحضر كانت الحالات أكثر من قبل، وطلب السكان المساعدة.",
    "hi": "समिति ने वार्षिक रिपोर्ट प्रकाशित की और कार्यालय ने केंद्रों के आँकड़ों की जाँच की। किसी को नहीं पता क्यों, लेकिन कार्यवाही के अनुसार पहले से अधिक मामले थे और लोगों ने मदद माँगी।",
    "th": "คณะกรรมการเผยแพร่รายงานประจำปีและสำนักงานทบทวนข้อมูลของสถานี ไม่มีใครรู้ว่าทำไม แต่ตามบันทึกมีกรณีมากกว่าก่อน และชาวบ้านขอความช่วยเหลือ",
}

_UNIT = re.compile(r"[^\n.!?…。！？।؟]*(?:[.!?…。！？।؟]+[\"'”»’)\]」]*|\n|$)\s*")
_GAPS = re.compile(r"\S {3,}(?=\S)")


def _is_row(line: str) -> bool:
    """Whether a line is a row of a table: fields, not sentences."""
    return line.count("|") >= 2 or "\t" in line or line.count("=") >= 2 or ";" in line and line.count(";") - line.count("; ") >= 2 or "   " in line and len(_GAPS.findall(line)) >= 2


def _fold_table() -> np.ndarray:
    """For each code point: its lower case, of plain width, if it is a letter or a mark, else a blank. The first plane; others are blanks."""
    out = np.full(0x10001, 32, np.uint32)
    for c in range(0x80, 0x10000):
        one = unicodedata.normalize("NFKC", chr(c))
        one = one if len(one) == 1 else chr(c)
        if unicodedata.category(one)[0] in "LM":
            low = one.lower()
            out[c] = ord(low) if len(low) == 1 else ord(one)
    for c in range(ord("a"), ord("z") + 1):
        out[c] = out[c - 32] = c
    return out


_fold: list[np.ndarray] = []


def fold(text: str) -> np.ndarray:
    if not _fold:
        _fold.append(_fold_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _fold[0][np.minimum(points, 0x10000)]


def grams(points: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams of 1 to 4 characters that begin at each place; bucket 0 for those that are blank."""
    p = points.astype(np.uint32)
    blank = p == 32
    out = []
    h = p * np.uint32(0x9E3779B1)
    for n in range(1, 5):
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + p[n - 1 :] * np.uint32(0xC2B2AE3D)
        b = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)
        b = (b >> np.uint32(15)).astype(np.int32) % np.int32(BUCKETS - 1) + 1
        b[blank[: len(b)]] = 0  # n-grams begin with a letter; those of one length with a word's end are enough
        if n != 2:
            out.append(b)
    return out


_PAD = "\n\n\n"  # behind each text: no n-gram that begins in one reaches the next


@dataclass
class Languages:
    names: list[str]
    logs: np.ndarray  # BUCKETS x classes, float32; row 0 is zero
    heat: float = 1.0  # what scores are multiplied by before they are read as log-probabilities

    def score_all(self, texts: list[str], ends: list[np.ndarray]) -> list[np.ndarray]:
        """For each text, sums of log-probabilities over its parts, which end at ``ends``; the last column is the background."""
        begins, at = [], 0
        for t, e in zip(texts, ends):
            begins.append(at + np.concatenate([[0], e[:-1]]))
            at += len(t) + len(_PAD)
        first = np.concatenate(begins)
        total = np.zeros((len(first), len(self.names) + 1), np.float64)
        for b in grams(fold("".join([t + _PAD for t in texts]))):
            total[:, :-1] += np.add.reduceat(np.take(self.logs, b, axis=0), first, axis=0)
            total[:, -1] += BACKGROUND * np.add.reduceat((b > 0).astype(np.float64), first)
        return np.split(total, np.cumsum([len(e) for e in ends])[:-1])

    def score(self, text: str, ends: np.ndarray) -> np.ndarray:
        return self.score_all([text], [ends])[0]

    def sure(self, sums: np.ndarray) -> float:
        """The posterior of the best class, by calibrated scores."""
        x = self.heat * (sums - sums.max())
        return float(1 / np.exp(x).sum())


@dataclass
class Counted:
    """The n-grams of a text: which buckets, and how often each."""

    buckets: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, text: str) -> Counted:
        b, n = np.unique(np.concatenate(grams(fold(text + _PAD))), return_counts=True)
        return cls(b[b > 0], n[b > 0].astype(np.float32))

    def scores(self, logs: np.ndarray) -> np.ndarray:
        return self.counts @ logs[self.buckets]


_seed_counts: dict[str, Counted] = {}


def _model(by: dict[str, list[Counted]]) -> Languages:
    """The model of the texts of each class and of the seeds."""
    if not _seed_counts:
        _seed_counts.update({k: Counted.of(t) for k, t in SEEDS.items()})
    names = sorted(by.keys() | SEEDS.keys())
    logs = np.zeros((BUCKETS, len(names)), np.float32)
    for j, k in enumerate(names):
        c = np.zeros(BUCKETS, np.float64)
        for t in [*by.get(k, ()), *([_seed_counts[k]] * 3 if k in SEEDS else [])]:
            c[t.buckets] += t.counts
        logs[:, j] = np.log((c + 0.02) / (c.sum() + 0.02 * BUCKETS))
    logs[0] = 0
    return Languages(names, logs)


def _grouped(texts: list[tuple[str, Counted]]) -> dict[str, list[Counted]]:
    by: dict[str, list[Counted]] = defaultdict(list)
    for k, t in texts:
        by[k].append(t)
    return by


def _kept(texts: list[tuple[str, Counted]]) -> set[str]:
    """The labels that name languages of their own: each half of their texts is explained by the other half, and clearly better than by any other class.

    A label that was put on texts of another language by mistake is none: its texts are explained as well by that one.
    """
    right: dict[str, list[bool]] = defaultdict(list)
    for half in (0, 1):
        model = _model(_grouped(texts[half::2]))
        for label, t in texts[1 - half :: 2]:
            if label in SEEDS or label not in model.names:
                continue
            s = t.scores(model.logs)
            own = model.names.index(label)
            rest = np.delete(s, own).max()
            right[label].append(s[own] - rest >= OWN_GAIN * t.counts.sum())
    return set(SEEDS) | {k for k, v in right.items() if sum(v) >= 0.5 * len(v)}


def fit(texts: list[tuple[str, str]], rounds: int = 3) -> Languages:
    """(label, text) pairs, with some wrong labels. Texts move to the class that explains them best; a class that loses nearly all of them goes."""
    counted = [(k, Counted.of(t)) for k, t in texts]
    kept = _kept(counted)
    counted = [(k, t) for k, t in counted if k in kept and len(t.buckets)]
    given = Counter(k for k, _ in counted)
    model = _model(_grouped(counted))
    for _ in range(rounds if counted else 0):
        moved = []
        for _, t in counted:
            s = t.scores(model.logs)
            k = int(s.argmax())
            if s[k] > BACKGROUND * t.counts.sum():
                moved.append((model.names[k], t))
        sizes = Counter(k for k, _ in moved)
        model = _model(_grouped([(k, t) for k, t in moved if k in SEEDS or sizes[k] >= max(3, 0.3 * given[k])]))
    if texts:
        model.heat = _calibrated(model, [t for _, t in texts])
    return model


def _calibrated(model: Languages, texts: list[str]) -> float:
    """How much scores must be damped to be read as log-probabilities: n-grams that overlap count the same evidence several times.

    Pieces of each half of the texts are scored by the model of the other half; right is the class of the whole text.
    """
    whole = [Counted.of(t) for t in texts]
    best = [model.names[int(t.scores(model.logs).argmax())] for t in whole]
    rows, right = [], []
    for half in (0, 1):
        other = _model(_grouped(list(zip(best, whole))[half::2]))
        for t, k in list(zip(texts, best))[1 - half :: 2]:
            at = 0
            for size in PIECES:
                piece = t[at : at + size]
                at += size
                if len(piece) == size and k in other.names:
                    rows.append({n: v for n, v in zip(other.names, Counted.of(piece).scores(other.logs))})
                    right.append(k)
    if not rows:
        return 1.0
    s = np.array([[r.get(n, -np.inf) for n in model.names] for r in rows])
    s -= s.max(1, keepdims=True)
    y = np.array([model.names.index(k) if k in model.names else 0 for k in right])
    heats = np.geomspace(0.02, 1.0, 30)
    loss = [-(np.maximum(h * s[np.arange(len(y)), y], -30) - np.log(np.exp(h * s).sum(1))).mean() for h in heats]
    return float(heats[int(np.argmin(loss))])


def _best(model: Languages, text: str) -> str | None:
    k = int(model.score(text, np.array([max(len(text), 1)]))[0].argmax())
    return model.names[k] if k < len(model.names) else None


@dataclass
class Passage:
    begin: int
    end: int
    lang: str | None
    words: int
    wide: bool
    sure: float


def _ends(text: str) -> list[int]:
    ends = []
    for m in _UNIT.finditer(text):
        if m.end() > (ends[-1] if ends else 0):
            ends.append(m.end())
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return ends


def _path(s: np.ndarray) -> np.ndarray:
    """The best class of each part, changes having a price."""
    best = s.argmax(1)
    if (best == best[0]).all():
        return best
    back = np.zeros(s.shape, np.int32)
    v = s[0].copy()
    for i in range(1, len(s)):
        k = int(v.argmax())
        change = v[k] - CHANGE > v
        back[i] = np.where(change, k, np.arange(len(v)))
        v = np.where(change, v[k] - CHANGE, v) + s[i]
    out = np.zeros(len(s), np.int64)
    out[-1] = int(v.argmax())
    for i in range(len(s) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def passages_all(model: Languages, texts: list[str]) -> list[list[Passage]]:
    """The passages of each text; texts are scored together up to BATCH_CHARS of them."""
    out: list[list[Passage]] = []
    held: list[str] = []
    size = 0

    def flush() -> None:
        ends = [np.array(_ends(t)) for t in held]
        out.extend(_passages(model, t, e, s) for t, e, s in zip(held, ends, model.score_all(held, ends)))
        held.clear()

    for t in texts:
        if held and size + len(t) > BATCH_CHARS:
            flush()
            size = 0
        held.append(t or "\n")
        size += len(t)
    if held:
        flush()
    return [p if t else [] for p, t in zip(out, texts)]


def passages(model: Languages, text: str) -> list[Passage]:
    """The text as passages of one language each; ``lang`` is None where it is in none. Rows of tables are in none."""
    return passages_all(model, [text])[0]


def _passages(model: Languages, text: str, ends: np.ndarray, s: np.ndarray) -> list[Passage]:
    if "|" in text or "\t" in text or ";" in text or "=" in text or "   " in text:
        at = 0
        for line in text.split("\n"):
            if _is_row(line):
                a, b = np.searchsorted(ends, [at, at + len(line) - 1], "right")
                s[a : b + 1] = 0
                s[a : b + 1, -1] = 1e-6  # in no language, unless what is around it is in one
            at += len(line) + 1
    best = _path(s)
    none = len(model.names)
    out = []
    begin = first = 0
    for i in range(len(ends)):
        if i + 1 == len(ends) or best[i + 1] != best[i]:
            k = int(best[i])
            tokens = TOKEN.findall(text, begin, int(ends[i]))
            name = None if k == none or not tokens else model.names[k]
            wide = name in _UNSPACED_LANGS
            if not wide and 2 * sum([len(t) > 1 for t in tokens]) < len(tokens):
                name = None  # letters strewn over signs are no words
            sure = model.sure(s[first : i + 1, :none].sum(0)) if name else 0.0
            out.append(Passage(begin, int(ends[i]), name, len(tokens), wide, sure))
            begin, first = int(ends[i]), i + 1
    return out


def label_codes(spark: SparkSession) -> dict[str, str]:
    """Lower-case spellings of languages and their two-letter codes: codes of two and three letters, and names in the known languages, as Java has them."""
    locale = spark.sparkContext._jvm.java.util.Locale
    out: dict[str, str] = {}
    codes = list(locale.getISOLanguages())
    readers = [locale.forLanguageTag(k) for k in SEEDS]
    for c in codes:
        one = locale.forLanguageTag(c)
        out[c] = c
        for spelling in {one.getISO3Language(), one.getDisplayLanguage(one), *(one.getDisplayLanguage(r) for r in readers)}:
            out.setdefault(spelling.lower(), c)
    # The bibliographic codes that differ from those above.
    for a, b in {"ger": "de", "fre": "fr", "chi": "zh", "dut": "nl", "gre": "el", "cze": "cs", "rum": "ro", "per": "fa", "iw": "he", "in": "id"}.items():
        out[a] = b
    return out


def normal_label(label: str | None, codes: dict[str, str]) -> str | None:
    """The two-letter code that a label names, whatever its spelling or region; None if it names no language."""
    low = (label or "").strip().lower()
    return codes.get(low) or codes.get(re.split(r"[-_ (/,;]", low)[0])


def _fitted(documents: DataFrame, codes: dict[str, str], per_label: int) -> Languages:
    """``documents`` has doc_id, text, lang, formato."""
    usable = documents.where(F.col("text").isNotNull() & (F.length("text") <= FIT_CHARS) & (F.length("text") >= 80) & ~F.coalesce(F.lower("formato").isin(*RECORD_FORMATS), F.lit(False)))
    # Copies of one text count once, however many there are.
    counts = {r[0]: r[1] for r in usable.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"))).collect() if normal_label(r[0], codes)}
    sizes: dict[str, int] = defaultdict(int)
    for k, n in counts.items():
        sizes[normal_label(k, codes)] += n
    if not counts:
        return fit([])
    share = F.create_map(*[F.lit(x) for k in counts for x in (k, min(1.0, per_label / sizes[normal_label(k, codes)]))])
    drawn = usable.where(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 31)) < F.coalesce(F.try_element_at(share, F.col("lang")), F.lit(0.0)) * (1 << 31))
    # A text under several labels has the one it bears most often.
    votes = drawn.groupBy("text", "lang").agg(F.count("*").alias("n")).groupBy("text").agg(F.max_by("lang", F.struct("n", "lang")).alias("lang"))
    rows = sorted((r[0], r[1]) for r in votes.select("lang", "text").toLocalIterator())
    return fit([(normal_label(k, codes), t) for k, t in rows])


def _passage_rows(documents: DataFrame, doc_id: str, text: str, lang: str, formato: str | None, per_label: int) -> DataFrame:
    spark = documents.sparkSession
    src = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), (F.col(formato) if formato else F.lit(None)).cast("string").alias("formato"))
    codes = label_codes(spark)
    model = spark.sparkContext.broadcast(_fitted(src, codes, per_label))  # BUCKETS rows, whatever the corpus

    def make():
        m = model.value

        def f(c):
            keys = ("doc_id", "etiqueta", "formato", "inicio", "fin", "idioma", "palabras", "ancho", "confianza")
            out: dict[str, list] = {k: [] for k in keys}
            for d, found_, label, form in zip(c["doc_id"], passages_all(m, [t or "" for t in c["text"]]), c["lang"], c["formato"]):
                for p in found_ or [Passage(0, 0, None, 0, False, 0.0)]:
                    for k, v in zip(keys, (d, normal_label(label, codes), form, p.begin, p.end, p.lang, p.words, p.wide, p.sure)):
                        out[k].append(v)
            return out

        return f

    return map_rows(src, make, "doc_id bigint, etiqueta string, formato string, inicio int, fin int, idioma string, palabras int, ancho boolean, confianza double")


def languages(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", formato: str | None = "formato", per_label: int = PER_LABEL) -> DataFrame:
    """(doc_id, etiqueta, formato, inicio, fin, idioma, palabras, ancho, confianza): the passages of every document, in code points.

    ``etiqueta`` is the code that the label names. ``palabras`` counts words, or characters where ``ancho``. A null,
    empty or blank text has one passage without language; ``idioma`` is null where a passage is in no language, and its
    confidence 0. Repeated rows give repeated passages. An empty table gives an empty result.
    """
    return _passage_rows(documents, doc_id, text, lang, formato, per_label)


def found(documents: DataFrame) -> DataFrame:
    """(doc_id, lang): the languages of each document whose label is missing, wrong, or blind to a second language."""
    p = languages(documents).where(~F.coalesce(F.lower("formato").isin(*RECORD_FORMATS), F.lit(False)) & F.col("idioma").isNotNull())
    long = F.col("palabras") >= F.when(F.col("ancho"), PASSAGE_CHARS).otherwise(PASSAGE_WORDS)
    # Words of scripts without blanks weigh half, so that sizes of passages compare.
    weight = F.when(F.col("ancho"), F.col("palabras") / 2).otherwise(F.col("palabras"))
    by = p.groupBy("doc_id", "idioma").agg(F.first("etiqueta", True).alias("etiqueta"), F.max(long).alias("long"), F.sum(weight).alias("weight"), F.sum("palabras").alias("n"), F.max("ancho").alias("ancho"))
    doc = by.groupBy("doc_id").agg(
        F.first("etiqueta", True).alias("etiqueta"),
        F.max_by(F.struct("idioma", "n", "ancho"), F.struct("weight", "idioma")).alias("main"),
        F.collect_set(F.when(F.col("long"), F.col("idioma"))).alias("long"),
    )
    enough = F.col("main.n") >= F.when(F.col("main.ancho"), PASSAGE_CHARS).otherwise(PASSAGE_WORDS)
    rows = doc.where(enough).select("doc_id", "etiqueta", F.col("main.idioma").alias("main"), F.array_union("long", F.array("main.idioma")).alias("all"))
    case = F.col("etiqueta").isNull() | (F.col("etiqueta") != F.col("main")) | (F.size("all") > 1)
    return rows.where(case).select("doc_id", F.explode("all").alias("lang"))
