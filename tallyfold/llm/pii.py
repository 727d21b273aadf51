"""Personal data in whole texts, disguised forms included, with offsets into the source.

Four kinds are found on the text itself. Then a chain of transducers rewrites
the text and keeps, for every character it writes, the range of source
characters it came from: homoglyphs, other scripts' digits and zero-width
characters; at and dot in brackets, between spaces or underscores; dots set
apart between digits; digits spelled out in four languages. The same detectors run on the rewritten text. A span that holds something rewritten
is mapped back to the source and added, unless it overlaps one of its kind that
was found on the text itself; those always stay.

Texts that hold neither a digit, an at or plus sign, nor anything a transducer
could rewrite are told apart by byte tests and take no further part.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import texts, trees

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind:string,start:int,end:int,added:boolean>>"

# Letters of other scripts that look like ASCII ones.
HOMOGLYPHS = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Χ": "X", "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p",
    "\u2024": ".", "\u3002": ".", "\uff61": ".", "\u00b7": ".", "\u2219": ".",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-",
    "\u00a0": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ",
}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Digits as words, in English, German, Spanish and French.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4",
    "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4",
    "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4",
    "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
}
PLUS = ("plus", "mas", "más")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
# a run of digits is taken or left whole, so that a long one is read once
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match lies around an at sign: the run of local characters before it, and a domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not _LOCAL_END.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.group().split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.findall(m.group())) <= 15:
            yield m.span()


DETECTORS = dict(zip(KINDS, (_emails, _ips, _cards, _phones), strict=True))


class Rewritten:
    """A text and, for each of its characters, the source range it came from."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1

    def apply(self, pattern: re.Pattern[str], write: Callable[[re.Match[str]], str | None]) -> None:
        """Replace each match by what `write` makes of it; None leaves it. All its characters get the match's range."""
        parts, starts, ends, done = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = write(m)
            if new is None or new == m.group():
                continue
            a, b = m.span()
            parts += [self.text[done:a], new]
            starts += [self.starts[done:a], np.full(len(new), self.starts[a])]
            ends += [self.ends[done:a], np.full(len(new), self.ends[b - 1])]
            done = b
        if done:
            self.text = "".join([*parts, self.text[done:]])
            self.starts = np.concatenate([*starts, self.starts[done:]])
            self.ends = np.concatenate([*ends, self.ends[done:]])

    def spell(self, pattern: re.Pattern[str], word: re.Pattern[str], write: Callable[[str], str]) -> None:
        """Replace the words within each match one by one, so that every character keeps its own word's range."""
        parts, starts, ends, done = [], [], [], 0
        for m in pattern.finditer(self.text):
            if not re.search("[A-Za-z]", m.group()):
                continue
            parts.append(self.text[done : m.start()])
            starts.append(self.starts[done : m.start()])
            ends.append(self.ends[done : m.start()])
            for w in word.finditer(m.group()):
                new, a, b = write(w.group()), m.start() + w.start(), m.start() + w.end()
                parts.append(new)
                if len(new) == b - a:
                    starts.append(self.starts[a:b])
                    ends.append(self.ends[a:b])
                else:
                    starts.append(np.full(len(new), self.starts[a]))
                    ends.append(np.full(len(new), self.ends[b - 1]))
            done = m.end()
        if done:
            self.text = "".join([*parts, self.text[done:]])
            self.starts = np.concatenate([*starts, self.starts[done:]])
            self.ends = np.concatenate([*ends, self.ends[done:]])


def _plain(m: re.Match[str]) -> str | None:
    c = m.group()
    if c in HOMOGLYPHS:
        return HOMOGLYPHS[c]
    if c in INVISIBLE:
        return ""
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    other = unicodedata.normalize("NFKC", c) if c >= "\u2000" else c
    return other if len(other) == 1 and other.isascii() else None


_FOREIGN = re.compile(r"[^\x00-\x7f]")
# a run of white space is tried from its beginning alone, so that a long one is read once
_BRACKET_AT = re.compile(r"(?i)(?<!\s)\s*+[\[({<]\s*+(?:at|arroba|arobase)\s*+[\])}>]\s*")
_BRACKET_DOT = re.compile(r"(?i)(?<!\s)\s*+[\[({<]\s*+(?:dot|punto|point|punkt)\s*+[\])}>]\s*")
_NAME = r"[A-Za-z0-9-]+"
_BARE_AT = re.compile(rf"(?i)(?<=[A-Za-z0-9])\s+at\s+(?=({_NAME}(?:(?:\.|\s+dot\s+){_NAME})+))")
_BARE_DOT = re.compile(r"(?i)(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9])")
_JOINED_AT = re.compile(r"(?i)(?<=[A-Za-z0-9])_at_(?=[A-Za-z0-9-]+(?:(?:_dot_|\.)[A-Za-z0-9-]+)*_dot_[A-Za-z0-9-]+)")
_JOINED_DOT = re.compile(r"(?i)(?<=[A-Za-z0-9])_dot_(?=[A-Za-z0-9])")
_SPACED_DOT = re.compile(r"(?<=[0-9])\s++\.\s++(?=[0-9])")
_NUMBER = rf"(?:{'|'.join(SPELLED)}|[0-9]+)"
_NUMBERS = re.compile(rf"(?i)(?<![A-Za-z0-9])(?:(?:plus|m[aá]s)\s+)?{_NUMBER}(?:(?:\s+|-|\.){_NUMBER})+(?![A-Za-z0-9])")
_NUMBER_WORD = re.compile(r"[^\W\d_]+|[0-9]+|\.")


def _disguised(source: str, out: Rewritten, start: int, end: int) -> bool:
    """Whether a dot of the domain out.text[start:end] stands there as a word or was something else in the source."""
    if re.search(r"\s", out.text[start:end]):
        return True
    dots = (i for i in range(start, end) if out.text[i] == ".")
    return any(source[out.starts[i] : out.ends[i]] != "." for i in dots)


def rewritten(text: str) -> Rewritten:
    out = Rewritten(text)
    out.apply(_FOREIGN, _plain)
    out.apply(_BRACKET_AT, lambda m: "@")
    out.apply(_BRACKET_DOT, lambda m: ".")
    out.apply(_BARE_AT, lambda m: "@" if _disguised(text, out, *m.span(1)) else None)
    out.apply(_BARE_DOT, lambda m: ".")
    out.apply(_JOINED_AT, lambda m: "@")
    out.apply(_JOINED_DOT, lambda m: ".")
    out.apply(_SPACED_DOT, lambda m: ".")
    out.spell(_NUMBERS, _NUMBER_WORD, lambda w: "+" if w.lower() in PLUS else SPELLED.get(w.lower(), w))
    return out


def spans_of(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, added) by start, then kind as listed; code points, end exclusive."""
    found = [(kind, a, b, False) for kind, detect in DETECTORS.items() for a, b in detect(text)]
    other = rewritten(text)
    if other.text != text:
        for kind, detect in DETECTORS.items():
            own = [(a, b) for k, a, b, _ in found if k == kind]
            for a, b in detect(other.text):
                start, end = int(other.starts[a]), int(other.ends[b - 1])
                same = text[start:end] == other.text[a:b]
                if not same and not any(x < end and start < y for x, y in own):
                    found.append((kind, start, end, True))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_OPENING, _CLOSING, _FIRST, _BLANK = (np.zeros(256, bool) for _ in range(4))
_OPENING[[ord(c) for c in "[({<"]] = True
_CLOSING[[ord(c) for c in "])}>"]] = True
# first letters of the words for at and dot
_FIRST[[ord(c) for c in "adp"]] = True
# what \s takes in ASCII; other white space begins with a byte of _SIGN
_BLANK[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[48:58] = _SIGN[64] = _SIGN[43] = True
# first bytes, in UTF-8, of the characters that _plain rewrites; those of accented Latin letters are not among them
_SIGN[0xC2] = True
_SIGN[0xCE:0xF5] = True


def _number_words() -> trees.Index:
    """Runs of ASCII letters that digit words are made of; one with an accent is made of two."""
    runs = sorted({run for w in SPELLED for run in re.findall("[a-z]+", w)})
    data = np.frombuffer("".join(runs).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in runs])
    return trees.Index(texts.hashes(data, np.concatenate([[0], ends[:-1]]), ends))


def _bracketed(low: np.ndarray) -> np.ndarray:
    """Opening brackets before a short run of bytes, white space aside, that begins like a word for at or dot and is closed."""
    solid = np.flatnonzero(~_BLANK[low])
    # "at" takes two bytes, "arobase" seven
    there = np.append(low[solid], np.zeros(9, np.uint8))
    at = np.flatnonzero(_OPENING[there])
    at = at[_FIRST[there[at + 1]]]
    closed = np.zeros(len(at), bool)
    for size in range(2, 8):
        closed |= _CLOSING[there[at + 1 + size]]
    return solid[at[closed]]


def suspects(column: pa.Array) -> np.ndarray:
    """Which rows could hold a span. False is certain. Texts that come in several pieces are suspects."""
    out = np.zeros(len(column), bool)
    pieces = np.zeros(len(column), np.int64)
    numbers = _number_words()
    for block in texts.blocks(column):
        signs = np.flatnonzero(_SIGN[block.data])
        out[block.rows[np.searchsorted(block.offsets, signs, "right") - 1]] = True
        low = texts.LOWER[block.data]
        pieces[block.rows] += 1
        found = texts.words(block, ~_LETTER)
        keys = texts.hashes(low, found.starts, found.ends)
        number = numbers.find(keys) >= 0
        three = np.flatnonzero(number[:-2] & number[1:-1] & number[2:])
        length = found.ends - found.starts
        dots = np.flatnonzero(length == 3)
        dots = dots[(low[found.starts[dots]] == 100) & (low[found.starts[dots] + 1] == 111) & (low[found.starts[dots] + 2] == 116)]
        for positions in (_bracketed(low), found.starts[three], found.starts[dots]):
            out[block.rows[np.searchsorted(block.offsets, positions, "right") - 1]] = True
    return out | (pieces > 1)


def find(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The frame with its spans; none for null and empty texts. A column of that name is replaced."""
    kept = [c for c in df.columns if c != spans]
    rows = df.select(*kept, F.col(text).alias("_text"))
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(kept))
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(suspects(column)):
                found[i] = [dict(zip(("kind", "start", "end", "added"), s, strict=True)) for s in spans_of(column[i].as_py())]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names=[*kept, spans])

    return rows.mapInArrow(run, texts.extended(df.select(*kept).schema, **{spans: SPAN}))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping ones, replaced by the kind of its first in angle brackets."""
    out, done = [], 0
    for kind, start, end in spans:
        if start < done:
            if end > done:
                done = end
            continue
        out += [text[done:start], f"<{kind.upper()}>"]
        done = end
    return "".join([*out, text[done:]])


def mask(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The frame with personal data masked in the text; n_chars becomes the length of changed texts."""
    columns = df.columns
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            changed = {}
            for i in np.flatnonzero(suspects(column)):
                source = column[i].as_py()
                found = spans_of(source)
                if found:
                    changed[int(i)] = masked(source, [s[:3] for s in found])
            if changed:
                mine = np.zeros(batch.num_rows, bool)
                mine[list(changed)] = True
                new = pa.array([changed[i] for i in sorted(changed)], column.type)
                arrays = list(batch.columns)
                arrays[at] = pc.replace_with_mask(column, pa.array(mine), new)
                if n_chars in columns:
                    k = columns.index(n_chars)
                    size = pa.array([len(changed[i]) for i in sorted(changed)], arrays[k].type)
                    arrays[k] = pc.replace_with_mask(arrays[k], pa.array(mine), size)
                batch = pa.RecordBatch.from_arrays(arrays, names=columns)
            yield batch

    return df.mapInArrow(run, df.schema)
