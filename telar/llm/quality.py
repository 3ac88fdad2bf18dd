"""Text statistics that tell prose from lists, tables and junk (problem 3).

A text is cut where the shape of its lines changes. The statistics of the parts are standardised, and a Gaussian
mixture is fitted by expectation maximisation to those of all parts: each round sums over them in Spark and moves the
components on the driver. Inspected examples are where the components begin, and give each its class; every part of every
text then takes the class of most of its probability, and the text that of most of its characters. Words are counted over all
texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions.batches import map_rows
from telar.llm import mixture
from telar.llm.chars import TOKEN, is_wide, solid, tokens
from telar.session import drop, store

CLASSES = ("prosa", "lista", "tabla", "basura")
#: To the mixture a word is common if two in so many of all distinct texts hold it.
SAMPLE = 10_000
COMPONENTS = 40
ROUNDS = 60
#: Word forms that count as common: those in most of all distinct texts. So many are gathered at most.
COMMON = 20_000
#: Texts whose vectors lie in one partition while the mixture is fitted, in expectation.
PACK = 50_000
#: Tasks that sum over the vectors, at most: the driver gets 14 KB from each.
TASKS = 1000
#: Words whose numbers a task keeps at hand, at most, and the longest of them.
KEPT, LONGEST = 100_000, 64
#: Sums of a block are rounded to this, so that their order can't tell.
GRAIN = 2.0**-20

_ITEM = re.compile(r"(?:[-–—•▪◦·‣*●○■]|\(?\d{1,3}[.)]|\d{1,3} [-–]|[(]?[a-zа-я][.)]|[(]?[A-ZА-Я]\)|[ivx]{1,5}[.)])\s+\S")
_LEADER = re.compile(r"(?:\.{4,}|…{2,}|(?: \.){4,}|_{4,})\s*\d+\s*$")
_PAIR = re.compile(r"[^\W\d_][\w ]{0,25}(?:=|: )")
#: What stands before the sign in a match of _PAIR: it can't hold "=" or ":", so there is a match for each sign with this before it.
_NAME = re.compile(r"[^\W\d_][\w ]{0,25}\Z")
_GAP = re.compile(r"\S(?: {2,}|\t+)(?=\S)")
_STOP = re.compile(r"[.!?।؟。！？…](?:(?<=[。！？…])|(?=[\s\"'”»)\]]|$))")
_CODES = re.compile(r"/g\d+|\(cid:\d+\)|\b(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f])[0-9a-f]{12,}\b|[�□▯◇■◆▢]")
_BOXES = "�□▯◇■◆▢"
_VOWELS = re.compile(r"[aeiouyáéíóúàèìòùâêîôûãõäëïöüæœåø]")
_ENDS = frozenset(".!?。！？।؟…:”»\"’)）」")
#: Bits of a sum over the words of a text, which has fewer than 2**31 characters.
_BITS = 32
_MASK = (1 << _BITS) - 1

STATS = (
    "palabras", "largo_palabra", "simbolos", "cifras", "fin_linea", "comunes", "frases", "palabras_linea", "items", "guias", "puntoycoma", "pares", "columnas", "barras", "huecos", "codigos", "sin_vocal", "letras", "renglones", "ajeno", "sin_punto",
)


def _paired(line: str) -> bool:
    """Two names at least, each with a value after it."""
    if line.count("=") + line.count(": ") < 2:
        return False
    names = 0
    for before in line.replace(": ", "=").split("=")[:-1]:
        names += _NAME.search(before[-26:]) is not None
        if names == 2:
            return True
    return False


def _mute(word: str) -> int:
    """The length of a word with hardly a vowel, 0 for others."""
    v = len(_VOWELS.findall(word))
    return len(word) if v == 0 or len(word) > 6 and 5 * v < len(word) else 0


class _Words(dict):
    """What each word adds to the sums over a text, by one or two lists of common words: numbers of _BITS bits, packed into one."""

    def __init__(self, common: frozenset[str], other: frozenset[str] = frozenset()):
        super().__init__()
        self.lists = common, other

    def __missing__(self, w: str) -> int:
        common, other = self.lists
        n = len(w)
        # What is rarely above 0 comes last, so that most numbers are small.
        out = n + (1 << _BITS if w in common else 0) + (1 << 2 * _BITS if w in other else 0)
        if w[0].isdigit():
            out += n << 3 * _BITS
        if n > 3 and "a" <= w[0] <= "ÿ":
            out += _mute(w) << 4 * _BITS
        if is_wide(w):
            out += 1 << 5 * _BITS
        if n > 11 and not w.isalpha():
            out += 1 << 6 * _BITS
        if n <= LONGEST:
            if len(self) >= KEPT:
                self.clear()
            self[w] = out
        return out

    def sums(self, words: list[str]) -> list[int]:
        """Their characters, how many either list holds, the characters of numbers and of words with hardly a vowel, the unspaced ones, those that may be codes."""
        total = sum(map(self.__getitem__, words))
        return [total >> _BITS * i & _MASK for i in range(7)]


def statistics(text: str, common: frozenset[str]) -> list[float]:
    """The statistics of one text, in the order of STATS; shares are of characters in lines unless said otherwise."""
    return _statistics(text, _Words(common))[0]


def _statistics(text: str, known: _Words) -> list[list[float]]:
    """The statistics by either list of common words."""
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    chars = sum(map(len, lines))
    if not chars:
        return [[0.0] * len(STATS)] * 2
    low = text.lower()
    found = tokens(low)
    n = len(found)
    letters, usual, other, digits, mute, wide, long = known.sums(found)
    # An unspaced word is taken as two characters.
    words = max(n - wide / 2, 1)
    full = max(solid(text), 1)
    # What no line can hold isn't looked for in each.
    dotted = "...." in text or "…" in text
    gapped = "  " in text or "\t" in text
    split = gapped or ";" in text or "|" in text
    items = leaders = semis = pairs = columns = bars = gaps = ended = 0
    before: tuple[int, int, int, int] | None = None
    for line in lines:
        size = len(line)
        if line[-1] in _ENDS:
            ended += size
        if _ITEM.match(line):
            items += size
        if dotted and line[-1].isdigit() and ("...." in line or "…" in line) and _LEADER.search(line):
            leaders += size
        if _paired(line):
            pairs += size
        if not split:
            continue
        s = line.count("; ")
        if s >= 2 and s >= line.count(". "):
            semis += size
        b = line.count("|")
        if b >= 2:
            bars += size
        g = len(_GAP.findall(line)) if gapped and ("  " in line or "\t" in line) else 0
        if g:
            gaps += size * min(1.0, 6.0 * g / max(1, len(line.split())))
        now = (b, line.count(";"), line.count("\t"), g)
        # Neighbouring lines with equally many separators are rows of one table.
        if before is not None and any(x >= 1 and x == y for x, y in zip(now, before)) and (now[0] >= 2 or now[1] >= 2 and not s or now[2] >= 1 or now[3] >= 1):
            columns += size
        before = now
    stops = len(_STOP.findall(low))
    # Of the codes, only those without a sign of their own need a long word with a digit.
    coded = "/g" in low or "(cid:" in low or any([c in low for c in _BOXES]) or long
    codes = sum(map(len, _CODES.findall(low))) if coded else 0
    return [
        [
            math.log1p(words),
            min(letters / words, 40.0),
            1 - letters / full if letters < full else 0.0,
            digits / full,
            ended / chars,
            share,
            min(stops / words, 0.3) * 20,
            math.log1p(words / len(lines)),
            items / chars,
            leaders / chars,
            semis / chars,
            pairs / chars,
            columns / chars,
            bars / chars,
            gaps / chars,
            codes / full,
            mute / full,
            letters / full,
            math.log1p(len(lines)),
            float(n >= 8 and share < 0.3),
            float(stops == 0),
        ]
        for share in (usual / max(n, 1), other / max(n, 1))
    ]


def _shape(line: str) -> str:
    """i(tem), g(uide to a page), t(able row), s(emicolon list), p(rose with a full stop), or nothing to tell it by."""
    if line[-1].isdigit() and ("...." in line or "…" in line) and _LEADER.search(line):
        return "g"
    if line.count("|") >= 2 or "\t" in line:
        return "t"
    if _paired(line):
        return "t"
    if "  " in line and len(_GAP.findall(line)) >= 2:
        return "t"
    if line.count(";") >= 2:
        if "; " not in line:
            return "t"
        if line.count("; ") >= line.count(". "):
            return "s"
    if _ITEM.match(line):
        return "i"
    return "p" if _STOP.search(line) else ""


def parts(text: str) -> list[str]:
    """The text, cut where the shape of its lines changes; a short part goes with the one after it."""
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    if len(lines) < 2:
        return [text]
    shapes = []
    stopped = True
    for line in lines:
        line = line.strip()
        k = _shape(line)
        if not k:
            # A line without a full stop goes on with the sentence before it, unless none is open and no capital begins one.
            k = "u" if (shapes[-1] == "u" if shapes else False) or (stopped and line[0].islower()) else "p" if not stopped or line[0].isupper() else "u"
        shapes.append(k)
        stopped = line[-1] in _ENDS or k not in "pu"
    out: list[list[str]] = []
    kinds: list[str] = []
    for line, k in zip(lines, shapes):
        if kinds and (k == kinds[-1] or sum(map(len, out[-1])) < 40):
            out[-1].append(line)
            kinds[-1] = k
        else:
            out.append([line])
            kinds.append(k)
    if len(out) > 1 and sum(map(len, out[-1])) < 40:
        last = out.pop()
        out[-1] += last
    return ["\n".join(x) for x in out]


# Examples of each class, written after inspection of texts of that class.
EXAMPLES = {
    "prosa": [
        "El comité publicó el informe anual. Según el acta, la red de estaciones revisó el plan durante el segundo semestre. No hubo respuesta.",
        "The committee reviewed the plan and published a report. According to the minutes, the board rejected the budget. Nobody answered.",
        "O comitê publicou o relatório. Segundo a ata, a rede de estações revisou o plano antes da estação seca. Ninguém respondeu.",
        "Le comité a publié le rapport. Selon le bureau, l’institut a révisé le plan avant la saison sèche. Personne n’a répondu.",
        "Der Ausschuss prüfte den Bericht. Zwischen 2010 und 2015 galt das nicht, denn das Amt verteidigte die Regeln. Niemand antwortete.",
        "Комитет обновляет список происшествий. По данным бюро, центр проверяет план во втором полугодии. Никто не ответил.",
        "وفقا للتقرير، ينسق فريق الرصد خطة إزالة الألغام قرب الحدود. من بين 40 حالة يراجع المكتب 12 فقط. لا أحد يعلم.",
        "समिति ने सूची प्रकाशित की। निगरानी समिति केवल 24 पर योजना जाँच रही है। किसी को पता नहीं।",
        "委员会审查了报告，并公布了计划。据介绍，研究所在边境地区修正了清单。没有人知道。",
        "委員会は報告を公表した。一方、研究所は地域の協力を得て計画を修正した。誰も知らない。",
        "คณะกรรมการประกาศแผนในสามระยะ มหาวิทยาลัยทบทวนรายงานประจำปีก่อนฤดูแล้ง ดัชนีเพิ่มเป็น62.70",
        "La oficina revisó la lista de incidentes y actualizó\nel mapa de riesgos en la zona de frontera. Con todo, la\nmesa técnica rechazó el plan. Nadie respondió.",
        "¡Que nadie toque el informe! Nadie lo sabe.",
        "The office, based in the south, revised the plan.",
    ],
    "lista": [
        "- el plan de desminado\n- la lista de incidentes\n- el mapa de riesgos en tres etapas\n- las licencias de espectro",
        "1. the farm census\n2. the rules on small satellites\n3. the budget for the next campaign\n4. operator training",
        "a) el cable submarino\nb) los censos agrícolas\nc) el acuerdo de cooperación\nd) la cadena de custodia",
        "(1) 证据保管链\n(2) 事件清单\n(3) 疏散路线\n(4) 快速反应指南",
        "• комитет по наблюдению\n• список происшествий\n• план разминирования\n• пути эвакуации",
        "el plan de desminado .................. 4\nla lista de incidentes ............... 12\nel cable submarino .............. 27\nlos censos ........ 30",
        "the border risk map .......... 4\nthe farm census until further notice ............... 19\nthe chain of custody .......... 25",
        "el cable submarino; la lista de incidentes en tres etapas; los censos agrícolas; el mapa de riesgos; el plan de desminado",
        "the farm census; the border risk map of national scope; operator training; the undersea cable; a cloud platform",
        "la auditoría de proveedores\nel mapa de riesgos\nlas rutas de evacuación en la franja costera\nlos drones de reconocimiento",
        "реестр переселенцев\nсписок происшествий во внутренних районах\nплан разминирования\nпути эвакуации",
        "农业普查数据\n跟踪天线\n事件清单\n快速反应指南\n云计算平台",
        "قائمة الحوادث\nمنصة سحابية\nهوائيات التتبع\nخطة إزالة الألغام",
        "मार्च की टक्कर का विवरण\nसीमा जोखिम का नक्शा\nक्लाउड मंच तीन चरणों में\nटोही ड्रोन",
    ],
    "tabla": [
        "zona: Norte | cupo: 21899 | lote: 50544\nzona: Sur | cupo: 56884 | lote: 92817\nzona: Este | cupo: 92313 | lote: 88595",
        "| zona | puerto | equipo |\n|---|---|---|\n| Norte | Sur | la mesa técnica |\n| Este | Oeste | el archivo nacional |",
        "nivel=690.75, equipo=la oficina, cupo=24775, banda=, zona=Norte\nnivel=726.49, equipo=el instituto, cupo=58222, banda=, zona=Sur",
        "turno;fecha;sensor;banda\n47855;2018-12-19;212.08;477.98\n40509;2007-12-15;642.42;281.60\n36092;2016-08-08;207.31;355.23",
        "nivel\truta\tzona\tsensor\n178.67\tNorte\tSur\t103.71\n538.46\tEste\tOeste\t211.09",
        "cupo  sensor  nivel  banda\n69688          708.32         208.01         14.62\n43323          272.23         412.81         379.30",
        "zona  equipo  estado\nNorte          la oficina     Abierto\nSur            el archivo     Cerrado",
        "puerto: Norte | nivel: 294.08 | equipo: la fuerza fluvial | fecha: 2008-08-26",
        "zona;equipo;estado\nNorte;la oficina de datos abiertos;Sur\nEste;el archivo nacional;Oeste",
    ],
    "basura": [
        "/g203 /g135 /g55 /g160 /g208 /g151 /g89 /g93 /g43 /g62 /g57 /g126 /g159 /g139",
        "(cid:194)(cid:214)(cid:91)(cid:71)(cid:43)(cid:118)(cid:357)(cid:350)(cid:161)(cid:348)(cid:19)",
        "2b1763e6a551dda91b0f70d3a1df4a17af4fa4b9b9\n421a681753927a61f22a7cc9\n372cc6e1f737938a92bcd088b10e90",
        "TO3Phos7YyiJa4E/hkYK8+6mK6kvslI+55Ns5L8XYLUdBmwiKXHqFkBuzIN1pRXn2NtFZ43f\nu1Ac/fNxlyFteHFRYx8S+umKWBhegGpM",
        "q1s bmk mkq nsfd1ckzvjv q1vxflqhsvb hfvpsrxklh vtmncdñvn jñ 1kmwzxrxbd tqcpgn z1 1cdbhjhgvd1 ddhgxw dmlx",
        "□◇?□■?■□.?a?□□■?1□?■a■a▯▯◇■■▯a■□a1■e?◇◇??a□.◇□□◇ 1■ a? .▯?e□□a□aa□ ■■??■□.□a■□.■▯1?◇1▯",
        "^__$}#=*¤} |{}@$>&·/]>¤[¬^%#^^°%[*[>=<&%*¬@&<[%%_¤~}$_$</$_+*]*@°·}$**=%@>%<#+°$]{#*|",
        "(O FRPLWp SXEOLFy HO LQIRUPH DQXDO FXDQGR OD UHG GH HVWDFLRQHV FRVWHUDV SUHVHQWy HO SODQ",
    ],
}


def _word_counts(chunks: DataFrame) -> DataFrame:
    """(word, n): distinct texts per word, and all of them for the word ''."""

    def make():
        seen: Counter[str] = Counter()

        def flush():
            out = {"word": list(seen), "n": list(seen.values())}
            seen.clear()
            return out

        def f(c):
            seen[""] += len(c["texto"])
            for t in c["texto"]:
                seen.update(set(tokens(t.lower())))
            return flush() if len(seen) > 150_000 else None

        f.rest = flush
        return f

    texts = chunks.where(F.col("texto").isNotNull()).select("texto").distinct()
    return map_rows(texts, make, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _common(chunks: DataFrame, sample: int) -> tuple[frozenset[str], frozenset[str]]:
    """The COMMON words that most distinct texts hold, of those that at least two do; of them, those that two in ``sample`` texts hold."""
    # The word '' is in all texts, so it comes first.
    top = [tuple(r) for r in _word_counts(chunks).where("n > 1 OR word = ''").orderBy(F.desc("n"), "word").limit(COMMON + 1).collect()]
    total = top[0][1] if top else 0
    words = top[1:]
    return frozenset(w for w, _ in words), frozenset(w for w, n in words if n * sample >= 2 * total)


def common_words(chunks: DataFrame) -> frozenset[str]:
    """The COMMON words that most distinct texts hold, of those that at least two do."""
    return _common(chunks, SAMPLE)[0]


def _measured(src: DataFrame, common: frozenset[str], words: frozenset[str] | None) -> DataFrame:
    """Per chunk_id the hash of its text, the sizes and the statistics of its parts by ``common``, and those of the whole text by ``words`` if given."""

    def make():
        known = _Words(common, words or frozenset())

        def f(c):
            rows: list[list[float]] = []
            ends = [0]
            sizes = []
            whole: list[list[float]] = []
            for t in c["texto"]:
                cut: list[str] = []
                given = [0.0] * len(STATS)
                if t and not t.isspace():
                    cut = parts(t)
                    got = [_statistics(p, known) for p in cut]
                    rows += [x[0] for x in got]
                    if words is not None:
                        given = (got[0] if len(cut) == 1 else _statistics(t, known))[1]
                sizes.append([len(p) for p in cut])
                ends.append(len(rows))
                whole.append(given)
            x = np.array(rows, np.float64).reshape(-1, len(STATS))
            out = {"chunk_id": c["chunk_id"], "k": c["k"], "sizes": sizes, "own": [x[i:j].tobytes() for i, j in zip(ends, ends[1:])]}
            return out if words is None else out | {"whole": [w.tobytes() for w in np.array(whole, np.float64)]}

        return f

    schema = "chunk_id string, k bigint, sizes array<int>, own binary" + (", whole binary" if words is not None else "")
    got = map_rows(src.select("chunk_id", "texto", F.xxhash64("texto").alias("k")), make, schema)
    # Small rows, not texts, meet here; equal ids have equal texts.
    return store(got.groupBy("chunk_id").agg(*[F.first(n).alias(n) for n in got.columns[1:]]), "quality")


def _rows(blobs: list[bytes], kind: type = np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind).reshape(-1, len(STATS))


def _blocks(measured: DataFrame) -> DataFrame:
    """The vectors of the parts of all distinct texts, packed in single precision: what is in a block depends on the texts alone."""
    texts = measured.where(F.length("own") > 0).select("k", "own").distinct()
    n = max(1, math.ceil(measured.count() / PACK))
    placed = texts.repartition(n, "k").sortWithinPartitions("k", "own")
    return store(map_rows(placed, lambda: lambda c: {"block": [_rows(c["own"]).astype(np.float32).tobytes()]}, "block binary"), "quality")


def _grains(x: np.ndarray) -> np.ndarray:
    return np.rint(x / GRAIN).astype(np.int64)


def _total(blocks: DataFrame, sums: Callable[[np.ndarray], np.ndarray], more: np.ndarray) -> np.ndarray:
    """``sums`` of all blocks and of the rows ``more``, added; whole numbers of grains add up to the same in any order."""

    def make():
        got: list[np.ndarray] = []

        def f(c):
            for b in c["block"]:
                one = _grains(sums(_rows([b], np.float32).astype(np.float64)))
                got[:] = [got[0] + one if got else one]

        f.rest = lambda: {"sums": [got[0].tobytes()]} if got else None
        return f

    out = _grains(sums(more))
    for r in map_rows(blocks.coalesce(TASKS), make, "sums binary").collect():
        out = out + np.frombuffer(r[0], np.int64).reshape(out.shape)
    return out * GRAIN


def _moments(x: np.ndarray) -> np.ndarray:
    return np.vstack([np.full(x.shape[1], len(x)), x.sum(0), (x**2).sum(0)])


def fit(measured: DataFrame, common: frozenset[str]) -> tuple[mixture.Mixture, np.ndarray]:
    """The mixture of all parts, and the class of each component (rows: components, columns: CLASSES)."""
    # The words of readable examples are common by themselves, whatever the corpus is about.
    own = {c: common | {w for t in ts for w in TOKEN.findall(t.lower())} if c != "basura" else common for c, ts in EXAMPLES.items()}
    known = [(CLASSES.index(c), statistics(t, own[c])) for c, ts in EXAMPLES.items() for t in ts]
    e = np.array([v for _, v in known])
    blocks = _blocks(measured)
    n, one, two = _total(blocks, _moments, e)
    mean = one / n
    scale = np.sqrt(np.maximum(two / n - mean**2, 0))
    scale = np.where(scale > 1e-4, scale, 1.0)
    m = mixture.begin(mean, scale, mixture.apart((e - mean) / scale, COMPONENTS))
    m = mixture.climb(m, ROUNDS, lambda m: _total(blocks, replace(m).sums, e))
    drop(blocks)
    votes = np.zeros((len(m.weights), len(CLASSES)))
    np.add.at(votes.T, np.array([c for c, _ in known]), m.posterior(e))
    # A component that no example belongs to goes with the example nearest to its centre.
    gap = ((m.centres[:, None, :] - m.standard(e)[None, :, :]) ** 2).sum(2)
    near = np.zeros_like(votes)
    near[np.arange(len(near)), np.array([known[i][0] for i in gap.argmin(1)])] = 1
    votes += 0.05 * near
    return m, votes / votes.sum(1, keepdims=True)


def chunk_quality(chunks: DataFrame, chunk_id: str = "chunk_id", texto: str = "texto", sample: int = SAMPLE) -> DataFrame:
    """One row per distinct non-null chunk_id: its statistics, ``clase`` and ``certeza`` (the share of its characters of that class).

    ``clase`` is 'prosa' unless most of the characters lie in parts of other classes; then it is the largest of those.
    Null, empty and blank texts count as prose with statistics of 0 and certainty 1. Rows that repeat a chunk_id are
    taken to have its text. Texts are read whole; an empty table gives an empty result. ``comunes`` and ``ajeno`` go by
    the common words of all texts; the mixture goes by those of them that two in ``sample`` of all texts hold.
    """
    src = chunks.select(F.col(chunk_id).alias("chunk_id"), F.col(texto).alias("texto")).where("chunk_id IS NOT NULL")
    words, common = _common(src, sample)
    return _classified(_measured(src, common, words), common)


def _classified(measured: DataFrame, common: frozenset[str]) -> DataFrame:
    """The rows of ``_measured`` with their class and its certainty."""
    m, classes = fit(measured, common)
    given = "whole" in measured.columns

    def make():
        def f(c):
            rows = _rows(c["own"])
            best = (m.posterior(rows) @ classes).argmax(1)
            at = np.repeat(np.arange(len(c["sizes"])), [len(x) for x in c["sizes"]])
            weight = np.zeros((len(c["sizes"]), len(CLASSES)))
            np.add.at(weight, (at, best), [n for x in c["sizes"] for n in x])
            total = weight.sum(1)
            k = np.where(weight[:, 0] * 2 < total, weight[:, 1:].argmax(1) + 1, 0)
            sure = np.where(total > 0, weight[np.arange(len(k)), k] / np.maximum(total, 1), 1.0)
            out = {"chunk_id": c["chunk_id"], "clase": [CLASSES[i] for i in k], "certeza": sure}
            return out | dict(zip(STATS, _rows(c["whole"]).T.copy())) if given else out

        return f

    return map_rows(measured, make, "chunk_id string, clase string, certeza double" + "".join(f", {n} double" for n in STATS if given))


def found(chunks: DataFrame) -> DataFrame:
    """(chunk_id, clase): the chunks most of whose text is not running prose."""
    src = chunks.select("chunk_id", "texto").where("chunk_id IS NOT NULL")
    common = _common(src, SAMPLE)[1]
    # No statistic is given out here, so those of whole texts need no count.
    return _classified(_measured(src, common, None), common).where("clase <> 'prosa'").select("chunk_id", "clase")
