"""Text kernels as column expressions; only canonical composition needs Python, and only for rows beyond Latin-1."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s\x{1C}-\x{1F}\x{85}\p{Z}]"


def nfc(text: Column) -> Column:
    """Canonical composition. Text without combining marks or rare code points is composed already."""

    @F.pandas_udf("string")
    def compose(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    return F.when(text.rlike(r"[\x{0300}-\x{FFFF}\x{10000}-\x{10FFFF}]"), compose(text)).otherwise(text)


def normalise(text: Column) -> Column:
    """Line ends and separators to LF, format characters out, all blanks one space, at most one empty line, no blanks at the ends. Null becomes ''."""
    t = nfc(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(t, r"\r\n|\r|\x{2028}|\x{2029}", "\n")
    t = F.regexp_replace(t, r"\p{Cf}", "")
    t = F.regexp_replace(t, r"\p{Zs}", " ")
    t = F.regexp_replace(t, r"[\x{00}-\x{08}\x{0B}-\x{1F}\x{7F}-\x{9F}]", "")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, r" ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"^[ \n]+|[ \n]+$", "")


def fingerprint(text: Column, size: int = 12) -> Column:
    """The first ``size`` hex digits of the SHA-1 of the normalised text; null for text without content."""
    # The lambda's variable holds the normalised text, which is then computed once.
    one = F.transform(F.array(normalise(text)), lambda n: F.when(n != "", F.left(F.sha1(n), F.lit(size))))
    return F.element_at(one, 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.size(words(F.coalesce(text, F.lit("")))))


def usable(text: Column, least: int = 20) -> Column:
    return word_count(normalise(text)) >= least


def canonical_line(line: Column) -> Column:
    """A line with blanks collapsed and runs of digits as #."""
    return F.regexp_replace(F.regexp_replace(F.trim(line), r"\s+", " "), r"[0-9]+", "#")


def is_page_number(line: Column) -> Column:
    return line.rlike(r"(?i)^[\s\-–—.|\[(]*(?:(?:page|p[aá]gina|p[aá]g\.?|p\.)\s*)?[0-9]{1,4}(?:\s*(?:/|de|of)\s*[0-9]{1,4})?[\s\-–—.|\])]*$")


def flatten_value(text: Column) -> Column:
    """A cell of several lines as one: items with bullets joined by '; ', others by a blank; '|' becomes '/'."""
    lines = F.filter(F.transform(F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n"), F.trim), lambda x: x != "")
    bullet = r"^[-•▪◦·*–]\s*"
    clean = F.transform(lines, lambda x: F.regexp_replace(x, bullet, ""))
    joined = F.when(F.exists(lines, lambda x: x.rlike(bullet)), F.array_join(clean, "; ")).otherwise(F.array_join(lines, " "))
    return F.trim(F.regexp_replace(F.regexp_replace(joined, r"\|", "/"), r"\s+", " "))


def format_value(value: Column, kind: str) -> Column:
    """A typed cell as text: null '', booleans sí/no, whole floats as integers, dates without time."""
    if kind == "boolean":
        out = F.when(value, "sí").otherwise("no")
    elif kind in ("double", "float"):
        out = F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(value.cast("string"))
    elif kind.startswith("timestamp") or kind == "date":
        out = F.date_format(value, "yyyy-MM-dd")
    else:
        out = value.cast("string")
    return F.when(value.isNull(), "").otherwise(out)


def record_line(fields: dict[str, tuple[Column, str]]) -> Column:
    """``name: value | name: value`` without the blank ones."""
    parts = []
    for name, (value, kind) in fields.items():
        shown = format_value(value, kind)
        parts.append(F.when(F.trim(shown) != "", F.concat(F.lit(f"{name}: "), shown)))
    return F.concat_ws(" | ", *parts)


def markdown_text(text: Column) -> Column:
    """Fences, images, links, inline code and headings out, in that order."""
    t = F.regexp_replace(text, r"(?s)```.*?```", "")
    t = F.regexp_replace(t, r"!\[[^\]]*\]\([^)]*\)", "")
    t = F.regexp_replace(t, r"\[([^\]]*)\]\([^)]*\)", "$1")
    t = F.regexp_replace(t, r"`([^`]*)`", "$1")
    return F.regexp_replace(F.regexp_replace(t, r"(?m)^#{1,6}\s*", ""), r"^\s+|\s+$", "")


def html_text(text: Column) -> Column:
    """Scripts and styles out, tags to blanks, common entities to their characters, blanks collapsed."""
    t = F.regexp_replace(text, r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"[ \t\x{A0}]+", " "))


def alpha_share(text: Column) -> Column:
    """Letters over characters; 0 for empty text."""
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, r"\P{L}", "")) / F.length(text)).otherwise(0.0)


def vowel_share(text: Column) -> Column:
    """Vowels over Latin letters; null without letters."""
    letters = F.length(F.regexp_replace(F.lower(text), r"[^a-záéíóúüñ]", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(F.lower(text), r"[^aeiouáéíóúü]", "")) / letters)


def legibility(text: Column) -> Column:
    return 1 - F.abs(vowel_share(text) - 0.39) / 0.39


def _shift_tables(offset: int) -> tuple[str, str]:
    span = [c for c in range(33, 127) if 33 <= c + offset <= 126]
    return "".join(map(chr, span)), "".join(chr(c + offset) for c in span)


def repair_shift(line: Column) -> Column:
    """A line whose code points were shifted: the first of three offsets with the vowel share of text, if one has it."""
    best = line
    tries = []
    for offset in (28, 29, -1):
        moved = F.translate(line, *_shift_tables(offset))
        tries.append(F.struct(F.coalesce(F.abs(vowel_share(moved) - 0.39), F.lit(9.0)).alias("d"), F.lit(len(tries)).alias("k"), moved.alias("t")))
    first = F.array_min(F.array(*tries))
    letters = F.length(F.regexp_replace(F.lower(line), r"[^a-záéíóúüñ]", ""))
    fine = F.abs(vowel_share(line) - 0.39) <= 0.09
    return F.when((letters < 12) | fine, best).otherwise(F.when(first["d"] <= 0.09, first["t"]).otherwise(best))


def _ascii_vowels(text: Column) -> Column:
    """Vowels over the letters a to z; null without any."""
    n = F.length(F.regexp_replace(text, r"[^A-Za-z]", ""))
    return F.when(n > 0, F.length(F.regexp_replace(text, r"[^AEIOUaeiou]", "")) / n)


def broken_map(text: Column) -> Column:
    """Whether a whole document reads like one whose character map is broken: far fewer vowels than text has."""
    return F.coalesce(_ascii_vowels(text) < 0.25, F.lit(False))


def repair_document(text: Column) -> Column:
    """``repair_shift`` for the lines of documents whose character map is broken; others stay as they are."""
    return F.when(broken_map(text), F.array_join(F.transform(F.split(text, "\n"), repair_shift), "\n")).otherwise(text)


def blank_unreadable(text: Column) -> Column:
    """Documents whose character map is broken without the lines that can't be read; others stay as they are."""

    def readable(line: Column) -> Column:
        letters = F.length(F.regexp_replace(line, r"[^A-Za-z]", ""))
        return (letters < 12) | (F.abs(_ascii_vowels(line) - 0.39) <= 0.09)

    return F.when(broken_map(text), F.array_join(F.filter(F.split(text, "\n"), readable), "\n")).otherwise(text)


def move_closers(text: Column) -> Column:
    """In lines of right-to-left text, closing marks that lead the line go to its end."""
    arabic = r"[\x{0600}-\x{06FF}]"

    def fix(x: Column) -> Column:
        n = F.regexp_count(x, F.lit(arabic))
        run = F.regexp_extract(x, r"^([.,;:!?،؛؟)\]»]+)", 1)
        is_rtl = (n >= 8) & (n * 2 >= F.regexp_count(x, F.lit(r"\p{L}")))
        return F.when((run != "") & is_rtl & ~x.rlike(r"[.,;:!?،؛؟)\]»]$"), F.concat(F.ltrim(F.substring(x, F.length(run) + 1, F.length(x))), run)).otherwise(x)

    return F.array_join(F.transform(F.split(text, "\n"), fix), "\n")


def join_wrapped(text: Column) -> Column:
    """Words broken at line ends put together; a line that goes on in small letters joined to the next."""
    t = F.regexp_replace(text, r"(?U)(\w)-\n(?=\w)", "$1")
    return F.regexp_replace(t, r"([^.!?:;…\n])\n(?=\p{Ll})", "$1 ")


def sentences(text: Column) -> Column:
    """Sentences at a terminator and a blank."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?…。！？])\s+"), F.trim), lambda x: x != "")


def homoglyph(text: Column) -> Column:
    """Whether a word mixes Latin and Cyrillic letters."""
    return text.rlike(r"\p{IsLatin}\p{IsCyrillic}|\p{IsCyrillic}\p{IsLatin}")


def tokens_estimate(n_words: Column) -> Column:
    from telar.config import TOKENS_PER_WORD

    return F.bround(n_words * TOKENS_PER_WORD).cast("int")


def alert_title(code: Column, places: Column) -> Column:
    """The title of an alert that has none: its code and its places, whatever of them there is."""
    c, p = F.nullif(F.trim(code), F.lit("")), F.nullif(F.trim(places), F.lit(""))
    return F.when(c.isNotNull() | p.isNotNull(), F.concat_ws(" ", F.lit("Alerta"), F.concat_ws(" — ", c, p)))
