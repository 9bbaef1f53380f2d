"""Personal data in texts, plain or disguised, with spans in the source's code points.

Identifiers are found twice: in the text as it is (base spans) and in a normalised text. Two
transducers make the latter and keep, for every character, the source span it came from:

* characters: homoglyphs, other forms (full-width, mathematical, enclosed) and letters with marks
  to ASCII, one for one; marks of their own and invisible characters vanish;
* words: ``[at]``, ``(dot)``, ``x at y dot z``, and spelled digits (``plus one five five``).

The words transducer runs twice. The wide one also takes a bare ``at`` before a dotted domain,
``plus`` before a numeral, single spelled digits, and gaps of any length; as it may join a
number to its neighbours, it adds to what the strict one finds and replaces nothing.

A span found in a normalised text is mapped back and added unless a base span of its kind
covers it. Base spans always stay. Texts of any length are searched whole, in time linear in their
length; repeated rows are searched as they come, and an empty table gives no row.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# Letters that look like ASCII ones, and other forms of the signs used in
# addresses and numbers. Full-width forms and foreign decimal digits follow a rule below.
LOOKALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M",
    "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ɑ": "a", "ı": "i",
    "․": ".", "。": ".", "｡": ".", "﹒": ".", "﹫": "@",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
    " ": " ", " ": " ", " ": " ", " ": " ",
}
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
INVISIBLE = "­​‌‍⁠﻿"


#: Ways in which Unicode says that a character is another one in a different form. Raised and
#: lowered digits are left out: they are footnotes rather than disguises.
FORMS = ("<font>", "<circle>", "<wide>", "<narrow>", "<noBreak>", "<compat>", "<square>")


def _one_for_one() -> dict[int, str | None]:
    """Characters that stand for one ASCII character; marks and invisible ones for none.

    Foreign decimal digits, other forms of a character, and letters with marks follow from the
    Unicode tables; only look-alikes of other scripts are listed by hand.
    """
    table: dict[int, str | None] = {ord(k): v for k, v in LOOKALIKES.items()}
    for c in range(0x80, 0x1FC00):
        char = chr(c)
        form, _, rest = unicodedata.decomposition(char).rpartition("> ")
        plain = unicodedata.normalize("NFKD", char)
        bare = "".join(x for x in plain if not unicodedata.combining(x))
        digit = unicodedata.decimal(char, None)
        if unicodedata.combining(char):
            table.setdefault(c, None)
        elif digit is not None:
            table.setdefault(c, str(digit))
        elif len(bare) == 1 and " " <= bare <= "~" and (rest and not form or f"{form}>" in FORMS):
            table.setdefault(c, bare)
    return table | {ord(c): None for c in INVISIBLE}


FOLD_ALL = _one_for_one()
FOLD = {c: v for c, v in FOLD_ALL.items() if v is not None}
GONE = "".join(chr(c) for c, v in FOLD_ALL.items() if v is None)
_FOREIGN = frozenset(map(chr, FOLD_ALL))


def folded(text: str) -> str:
    """The text with foreign characters folded and marks dropped; a text has few different ones."""
    for c in _FOREIGN.intersection(set(text)):
        text = text.replace(c, FOLD_ALL[ord(c)] or "")
    return text


_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A digit run that fails from its start fails from any later digit too, so the look-behind
# and the possessive repeats change nothing but keep long digit runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and dotted domain, found from the @ signs in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start; matches that fail their check are dropped."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        # A part of more than a few digits is compared by length first: int() has a limit.
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 2 * 19:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


_DIGIT = f"(?:{'|'.join(DIGITS)})"
_OPEN, _CLOSE = r"[\[({<]\s{0,3}", r"\s{0,3}[\])}>]"
_WORDS = re.compile(
    rf"(?P<gone>[{GONE}]+)"
    rf"|(?P<at>\s{{0,3}}{_OPEN}(?:at|@){_CLOSE}\s{{0,3}}"
    r"|(?<=[a-z0-9._%+-])\s{1,3}at\s{1,3}(?=[a-z0-9-]++\s{1,3}dot\s{1,3}[a-z0-9-]))"
    rf"|(?P<dot>\s{{0,3}}{_OPEN}(?:dot|\.){_CLOSE}\s{{0,3}}"
    r"|(?<=[a-z0-9-])\s{1,3}dot\s{1,3}(?=[a-z0-9-]))"
    rf"|(?P<plus>\bplus\s{{1,3}}(?={_DIGIT}\b))"
    rf"|(?P<run>\b{_DIGIT}(?:[\s-]{{1,3}}(?:dot[\s-]{{1,3}})?{_DIGIT})+\b)",
    re.IGNORECASE | re.ASCII,
)
_IN_RUN = re.compile(rf"{_DIGIT}|dot", re.IGNORECASE | re.ASCII)
# The wide transducer takes gaps by possessive repeats from where they begin, so that long ones
# stay linear. Between two spelled digits they close, beside a numeral they become one blank.
_BRACKET = r"[\[({{<]\s*+(?:{})\s*+[\])}}>]"
_AT, _DOT = _BRACKET.format("at|@"), _BRACKET.format(r"dot|\.")
_LABEL = r"[a-z0-9-]++"
_ANY_DOT = rf"(?:\.|\s++dot\s++|\s*+{_DOT}\s*+)"
_SPELLED = rf"(?<![a-z_]){_DIGIT}(?![a-z_])"
_WIDE = re.compile(
    rf"(?P<gone>[{GONE}]+)"
    rf"|(?P<at>(?:(?<!\s)\s++)?{_AT}\s*+"
    rf"|(?<=[a-z0-9._%+-])\s++at\s++"
    rf"(?={_LABEL}\s++dot\s++{_LABEL}|(?:{_LABEL}{_ANY_DOT})+[a-z]{{2,}}+(?![a-z0-9-])))"
    rf"|(?P<dot>(?:(?<!\s)\s++)?{_DOT}\s*+|(?<=[a-z0-9-])\s++dot\s++(?=[a-z0-9-]))"
    rf"|(?P<plus>\bplus(?:\s*+(?=[0-9])|\s++(?={_SPELLED})))"
    rf"|(?P<blank>(?<=[0-9])\s++(?={_SPELLED}))"
    rf"|(?P<digit>{_SPELLED})(?:[\s-]++(?={_SPELLED})|(?P<gap>\s++)(?=[0-9]))?",
    re.IGNORECASE | re.ASCII,
)
_VALUE = {word: str(i) for i, word in enumerate(DIGITS)} | {"dot": "."}


class Normalised:
    """A normalised text and the source span of each of its characters, kept by pieces."""

    def __init__(self, source: str, words: re.Pattern[str] = _WORDS):
        folded = source.translate(FOLD) if not source.isascii() else source
        self._at: list[int] = []      # where a piece begins in the normalised text
        self._from: list[tuple[int, int, bool]] = []  # its source span; copied one for one?
        parts, length, done = [], 0, 0

        def add(text: str, start: int, end: int, copied: bool) -> None:
            nonlocal length
            if text:
                self._at.append(length)
                self._from.append((start, end, copied))
                parts.append(text)
                length += len(text)

        for m in words.finditer(folded):
            add(folded[done:m.start()], done, m.start(), True)
            done = m.end()
            if m.lastgroup == "run":
                for d in _IN_RUN.finditer(folded, m.start(), m.end()):
                    add(_VALUE[d.group().lower()], d.start(), d.end(), False)
            elif m.lastgroup in ("digit", "gap"):
                add(_VALUE[m["digit"].lower()], *m.span("digit"), False)
                if m["gap"]:
                    add(" ", *m.span("gap"), False)
            elif m.lastgroup != "gone":
                add({"at": "@", "dot": ".", "plus": "+", "blank": " "}[m.lastgroup], m.start(), m.end(), False)
        add(folded[done:], done, len(folded), True)
        self.text = "".join(parts)

    def source_span(self, start: int, end: int) -> tuple[int, int]:
        """The source span that a non-empty span of the normalised text came from."""
        first = bisect_right(self._at, start) - 1
        last = bisect_right(self._at, end - 1) - 1
        a, _, copied = self._from[first]
        start = a + start - self._at[first] if copied else a
        a, b, copied = self._from[last]
        return start, a + end - self._at[last] if copied else b


# Every match of the words transducers on folded text has one of these, but for spelled digits
# that stand alone. Plain substrings are looked for first, so that most texts need no pattern.
_BRACKETED = re.compile(_BRACKET.format(r"at|@|dot|\."), re.IGNORECASE | re.ASCII)
_NUMBERS = re.compile(rf"(?<![a-z_]){_DIGIT}[\s().-]*+(?:[0-9]|{_DIGIT})", re.ASCII)
_AMONG = re.compile(rf"[0-9][\s().-]*+{_DIGIT}(?![a-z_])", re.ASCII)
_AT_DOMAIN = re.compile(rf"at\s++{_LABEL}\.[a-z0-9-]", re.ASCII)
_PLUS = re.compile(r"\bplus[\s0-9]", re.ASCII)
_WORD_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz_")


def _whole_word(lower: str, word: str) -> bool:
    """Whether a word stands without a letter beside it."""
    at = lower.find(word)
    while at >= 0:
        end = at + len(word)
        if not (at and lower[at - 1] in _WORD_LETTERS) and lower[end:end + 1] not in _WORD_LETTERS:
            return True
        at = lower.find(word, at + 1)
    return False


def _in_words(text: str) -> bool:
    """Whether the words transducers may change a text without foreign characters."""
    lower = text.lower()
    return (
        "dot" in lower and _whole_word(lower, "dot")
        or "plus" in lower and _PLUS.search(lower) is not None
        or any(b in text for b in "[({<") and _BRACKETED.search(text) is not None
        or any(m.start() and lower[m.start() - 1].isspace() for m in _AT_DOMAIN.finditer(lower))
        or any(_whole_word(lower, d) for d in DIGITS)
        and (_NUMBERS.search(lower) is not None or _AMONG.search(lower) is not None)
    )


def disguised(text: str, base: list[tuple[int, int, int]]) -> bool:
    """Whether a transducer may change the text so that more is found; else False, nearly always.

    ``base`` are the text's base spans. Foreign characters matter only if the folded text has
    other identifiers.
    """
    if not text.isascii():
        plain = folded(text)
        if plain != text and [(k, text[a:b]) for k, a, b in base] != [
            (k, plain[a:b]) for k, a, b in base_spans(plain)
        ]:
            return True
        text = plain
    return _in_words(text)


def find(text: str | None) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of all spans by kind, start and end; NULL counts as empty."""
    text = text or ""
    base = base_spans(text)
    out = {(*s, True) for s in base}
    for words in (_WORDS, _WIDE) if disguised(text, base) else ():
        normal = Normalised(text, words)
        for kind, a, b in base_spans(normal.text):
            a, b = normal.source_span(a, b)
            # Base spans of a kind do not overlap, so only the last one up to here can cover it.
            last = bisect_right(base, (kind, a, len(text))) - 1
            if last < 0 or base[last][0] != kind or base[last][2] < b:
                out.add((kind, a, b, False))
    return sorted(out)


def spans(text: Column) -> Column:
    """Array of (kind, start, end, base) for a text column, sorted; kinds index ``KINDS``."""

    @F.pandas_udf("array<struct<kind:int,start:long,end:long,base:boolean>>")
    def found(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "base")
        return pd.Series([[dict(zip(names, s)) for s in find(t)] for t in texts], dtype=object)

    return found(text)
