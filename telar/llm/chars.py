"""Character classes by rule, for the plain ``re`` module, which is the fastest here but knows no combining marks."""

from __future__ import annotations

import re
import unicodedata

#: Scripts without blanks between words: Thai to Lao, kana, Han.
UNSPACED = "฀-໿々〇぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ"
_unspaced = re.compile(f"[{UNSPACED}]")
FIRST_UNSPACED = "฀"


def _ranges(keep) -> str:
    """The members of a class as ranges. Of the first plane only: ``re`` tests such a class by one table look-up."""
    out, start, last = [], None, None
    for c in range(0x10000):
        if keep(chr(c)):
            if last is None or c != last + 1:
                if start is not None:
                    out.append((start, last))
                start = c
            last = c
    out.append((start, last))
    esc = lambda c: "\\U%08x" % c
    return "".join(esc(a) if a == b else f"{esc(a)}-{esc(b)}" for a, b in out)


#: Letters, digits and marks of the scripts with blanks.
SPACED = _ranges(lambda c: unicodedata.category(c)[0] in "LMN" and not _unspaced.match(c))
#: A word, or one character of a script without blanks.
TOKEN = re.compile(f"[{UNSPACED}]|[{SPACED}]+")
_KEPT = bytes(c if re.match(f"[{SPACED}]", chr(c)) else 32 for c in range(256))
_BLANKS = bytes(c for c in range(256) if chr(c).isspace())
INVISIBLE = re.compile("[­؀-؅؜᠎​-‏‪-‮⁠-⁤⁦-⁯﻿￹-￻]+")


def is_wide(token: str) -> bool:
    return len(token) == 1 and token >= FIRST_UNSPACED and _unspaced.match(token) is not None


def tokens(text: str) -> list[str]:
    """The words of a text as TOKEN finds them; Latin-1 has none without blanks, and is cut without ``re``."""
    try:
        return text.encode("latin-1").translate(_KEPT).decode("latin-1").split()
    except UnicodeEncodeError:
        return TOKEN.findall(text)


def solid(text: str) -> int:
    """The number of characters that are no blanks."""
    try:
        return len(text.encode("latin-1").translate(None, _BLANKS))
    except UnicodeEncodeError:
        return len("".join(text.split()))
