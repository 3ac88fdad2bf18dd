"""Sentences of a text by the rules of its language: a compact segmenter for the packing of chunks."""

from __future__ import annotations

import re

# Words that a full stop belongs to, by language; those under '' count in every language.
ABBREVIATIONS = {
    "": "etc vs cf ed eds vol nr fig figs al dr prof st jr sr inc ltd co approx ca pp",
    "es": "sra srta sres dra ing lic arq gral cnel art arts pág págs pag núm num cap ej aprox av avda dpto depto tel ee uu ss min máx ref admón ud uds",
    "pt": "sra srs dra eng arq gen art arts pág págs núm cap ex aprox av dep tel ref exmo exma",
    "en": "mr mrs ms rev gen col sgt capt lt gov sen rep dept univ assn bros est ave blvd mt art sec ch e.g i.e u.s u.k",
    "fr": "m mm mme mlle mgr me av bd boul chap art env p.ex réf tél",
    "de": "bzw ca d.h dipl evtl ggf hr fr inkl max min mio mrd nr sog str tel u.a usw vgl z.b abs art bd",
    "ru": "г гг им т.е т.д т.п др стр см рис тыс млн млрд руб ул акад проф",
}
_KNOWN = {k: frozenset(v.split()) for k, v in ABBREVIATIONS.items()}
_CLOSERS = "\"'”’»)\\]}」』）】"
# A terminator with what closes behind it; where words are spaced, a blank must follow.
_STOP = re.compile(rf"(?:[。！？]+[{_CLOSERS}]*|[।॥۔؟]+[{_CLOSERS}]*(?=\s)|[.!?…]+[{_CLOSERS}]*(?=\s))")
_BARE = "\"'”’»)]}」』）】"
_LAST = re.compile(r"[^\s(\[\"'«“¿¡]+$")


def _goes_on(text: str, stop: re.Match, known: frozenset[str], begin: int) -> bool:
    """Whether a sentence runs on behind a terminator: an ellipsis before a small letter, and full stops that are no sentence's."""
    if stop[0] != ".":
        return stop[0][0] in "….!?" and stop[0].rstrip(_BARE) not in (".", "!", "?") and text[stop.end() : stop.end() + 40].lstrip()[:1].islower()
    before = _LAST.search(text, max(begin, stop.start() - 40), stop.start())
    word = before[0] if before else ""
    # Initials, the numbers of items, abbreviations.
    return len(word) == 1 and word.isalpha() or word.isdigit() and before.start() == begin or word.lower() in known


def sentences(text: str, lang: str | None = None) -> list[str]:
    """The sentences of ``text``, without the blanks between them. An unknown language has the common rules."""
    known = _KNOWN[""] | _KNOWN.get((lang or "")[:2].lower(), frozenset())
    out, begin = [], 0
    while begin < len(text) and text[begin].isspace():
        begin += 1
    for stop in _STOP.finditer(text):
        if stop.end() <= begin or _goes_on(text, stop, known, begin):
            continue
        out.append(text[begin : stop.end()])
        begin = stop.end()
        while begin < len(text) and text[begin].isspace():
            begin += 1
    if begin < len(text):
        out.append(text[begin:].rstrip())
    return out
