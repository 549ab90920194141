"""Secrets in texts: fixed patterns, and guess costs of values that stand in a credential context.

The cost of a value is the least log10 of guesses over all ways to cut it into words, dates,
repeats, keyboard walks and brute-force spans (Wheeler, 2016), found by dynamic programming over its
characters. A value that costs more than a word or a date would is reported as a secret.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.llm.text import arrow_column, fresh, settle

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")

# A wider context than the base's: more names, also as parts of an identifier (aws_secret_access_key, dbPassword), a
# verb instead of a sign, and any visible characters. Parts of an identifier end at signs and before capitals.
# Those after the name go as far as the next name, which opens a context itself, so that no part is
# read twice.
_NAME = r"(?:password|passwd|passphrase|pwd|secret|token|credentials?|(?:api|access|private|auth)[_-]?key)"
_HUMP = r"(?-i:(?<=[a-z0-9])(?=[A-Z]))"
_WHOLE_NAME = rf"{_NAME}(?:(?![A-Za-z0-9])|{_HUMP})"
_PART = rf"(?:[_.-]++|{_HUMP})(?!{_WHOLE_NAME})(?-i:[A-Z]*[a-z0-9]+|[A-Z]+)"
CONTEXT = re.compile(
    rf"""(?:(?<![A-Za-z0-9])|{_HUMP}){_WHOLE_NAME}(?:{_PART})*+_*+["']?"""
    r"""(?:[ \t]*(?::=|=>|[:=])[ \t]*|[ \t]+(?:is|was)[ \t]+)["'`]?([^\s"'`<>,;]{4,})""",
    re.I | re.A,
)
# Log10 of guesses from which a value counts as a secret: 10^8 takes more than a common word, a year
# and a digit or two, and less than seven random characters.
THRESHOLD = 8.0
# Rows of a keyboard, common passwords and words next to them, most common first.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
WORDS = (
    "password", "the", "and", "you", "that", "this", "with", "from", "admin", "welcome", "login",
    "letmein", "monkey", "dragon", "master", "shadow", "hello", "secret", "token", "love", "sun",
    "moon", "star", "summer", "winter", "spring", "autumn", "user", "root", "test", "guest", "pass",
    "word", "key", "access", "changeme", "default", "example", "none", "null", "true", "false",
    "your", "my", "here", "value", "string", "text", "field", "required", "reset", "new", "old", "not",
    "empty", "blue", "red", "green", "black", "white", "dog", "cat", "horse", "battery", "staple",
    "correct", "house", "apple", "orange", "computer", "system", "server", "data", "base", "public",
    "private", "enter", "forgot", "wrong", "right", "strong", "weak", "long", "short", "please",
)
_RANK = {w: i + 1 for i, w in enumerate(WORDS)}
# A lone run of letters in one case that can be spoken is an unlisted word, of a million.
_UNLISTED, _UNLISTED_COST = range(4, 19), 6.0
_SPOKEN = re.compile(r"(?=.*[aeiouy])(?!.*[^aeiouy]{5})(?!.*[aeiouy]{4})[a-z]+")
_LETTERS = re.compile(r"[A-Za-z]+")
_LONGEST_WORD = max(map(len, WORDS))
# No word or date is longer; all other spans are open ended.
_BOUNDED = max(_LONGEST_WORD, _UNLISTED[-1], 10)
_CUT = 0.3  # a further piece costs a factor for its place, so that cutting finely does not pay
_DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?")
_NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:])}
_NEXT |= {(b, a) for a, b in _NEXT}


def _spread(value: str) -> int:
    """Size of the alphabet a guesser must try."""
    kinds = ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10))
    found = sum(n for test, n in kinds if any(map(test, value)))
    return max(10, found + 33 * any(not c.isalnum() for c in value))


# Log10 of guesses per character of a brute-force span of one class: letters follow each other as in
# speech, at about three bits each; digits are free.
_CLASS_COST = {"a": 0.9, "A": 0.9, "0": 1.0, "": math.inf}


def _class(c: str) -> str:
    return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else ""


def _words_and_dates(value: str, low: str):
    """Spans of bounded length with a pattern: start, end, log10 of guesses."""
    for i in range(len(value)):
        for j in range(i + 3, min(len(value), i + _LONGEST_WORD) + 1):
            if rank := _RANK.get(low[i:j]):
                yield i, j, math.log10(rank * (1 if value[i:j] in (low[i:j], low[i:j].title()) else 2))
        if value[i] in "12" and (date := _DATE.match(value, i)):
            yield i, date.end(), math.log10(200 if date.end() - i == 4 else 200 * 372)
    for letters in _LETTERS.finditer(value):
        text = letters[0]
        one_case = text.islower() or text.isupper() or text.istitle()
        if one_case and len(text) in _UNLISTED and _SPOKEN.fullmatch(text.lower()):
            yield letters.start(), letters.end(), _UNLISTED_COST


def _low(value: str) -> str:
    low = value.lower()
    return low if len(low) == len(value) else value


def _walk_cost(length: int) -> float:
    return math.log10(40 * 2 * length)


def _unit_cost(unit: str) -> float:
    return len(unit) * math.log10(_spread(unit))


def _pieces(value: str):
    """All spans with a pattern, by definition; ``guess_cost`` takes the open-ended ones as they grow."""
    low, n = _low(value), len(value)
    yield from _words_and_dates(value, low)
    for i in range(n):
        j = i + 1
        while j < n and (low[j - 1], low[j]) in _NEXT:
            j += 1
            if j - i >= 3:
                yield i, j, _walk_cost(j - i)
        for unit in range(1, 5):
            j = i + unit
            while value[j : j + unit] == value[i : i + unit] and j + unit <= n:
                j += unit
                if j - i >= 3:
                    yield i, j, _unit_cost(value[i : i + unit]) + math.log10((j - i) // unit)


class _Growing:
    """Starts of a span that grows: cost before it and of its pattern, and the start.

    What a span costs grows with the logarithm of its length, the same for all, so the lead of an
    earlier start over a later one never shrinks: a start that is not the best of all earlier ones is dropped.
    """

    def __init__(self):
        self.starts: list[tuple[float, int]] = []

    def best(self, end: int, cost) -> float:
        least, kept = math.inf, []
        for base, start in self.starts:
            total = base + cost(end - start)
            if total < least:
                least = total
                kept.append((base, start))
        self.starts = kept
        return least


def guess_cost(value: str, enough: float = math.inf) -> float:
    """Least log10 of guesses over all segmentations of ``value``; 0 for an empty one.

    Every character is read once: brute-force spans, repeats and walks are extended as they grow, whatever
    their length. From ``enough`` on, a lower bound of the cost may be returned.
    """
    n, low = len(value), _low(value)
    if not n:
        return 0.0
    single = math.log10(_spread(value))
    ends: dict[int, list] = {}
    for i, j, cost in _words_and_dates(value, low):
        ends.setdefault(j, []).append((i, cost))
    best = [0.0] + [math.inf] * n
    enter = lambda i: best[i] + (_CUT if i else 0.0)
    mixed = alike = math.inf  # open brute-force spans: of any characters, of one class
    walk, walked = _Growing(), 0
    repeats = {unit: [_Growing() for _ in range(unit)] for unit in range(1, 5)}
    repeated = dict.fromkeys(repeats, 0)
    last = None
    for j in range(1, n + 1):
        kind = _class(value[j - 1])
        mixed = min(mixed, enter(j - 1)) + single
        alike = (min(alike, enter(j - 1)) if kind == last else enter(j - 1)) + min(single, _CLASS_COST[kind])
        last = kind
        found = min(mixed, alike)
        for i, cost in ends.get(j, ()):
            found = min(found, enter(i) + cost)
        walked = walked + 1 if j > 1 and (low[j - 2], low[j - 1]) in _NEXT else 0
        if walked >= 2:
            walk.starts.append((enter(j - 3), j - 3))
            found = min(found, walk.best(j, _walk_cost))
        else:
            walk.starts.clear()
        open_ = [base for base, _ in walk.starts]
        for unit, grown in repeats.items():
            if j > unit and value[j - 1] == value[j - 1 - unit]:
                repeated[unit] += 1
                at = j - max(3, 2 * unit)
                if repeated[unit] >= j - at - unit:
                    place = grown[j % unit]
                    place.starts.append((enter(at) + _unit_cost(value[at : at + unit]), at))
                    found = min(found, place.best(j, lambda length: math.log10(length // unit)))
                open_ += [base for place in grown for base, _ in place.starts]
            else:
                repeated[unit] = 0
                for place in grown:
                    place.starts.clear()
        best[j] = found
        # What covers this place starts shortly before it, or is open now.
        if enough < math.inf and found >= enough:
            least = min(mixed, alike, *best[max(0, j - _BOUNDED) : j + 1], *open_)
            if least >= enough:
                return least
    return best[n]


_SHORT = 256  # characters of a value whose verdict is remembered


@lru_cache(maxsize=4096)
def _remembered(value: str, threshold: float) -> bool:
    return guess_cost(value, threshold) >= threshold


def _guessed(value: str, threshold: float) -> bool:
    return _remembered(value, threshold) if len(value) <= _SHORT else guess_cost(value, threshold) >= threshold


def find(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of every span in code points, in order; kinds by their place in KINDS."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".:!?)]}")
        if len(value) >= 4 and _guessed(value, threshold):
            spans.append((m.start(1), 3, m.start(1) + len(value)))
    return sorted(spans)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def _scan(threshold: float):
    def run(texts: pa.Array) -> pa.Array:
        rows = [
            [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find(t or "", threshold)]
            for t in texts.to_pylist()
        ]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return pa.array(rows, pa.list_(kind))

    return run


def with_secrets(
    docs: DataFrame, text: str = "text", out: str = "secrets", threshold: float = THRESHOLD
) -> DataFrame:
    """Adds the spans of secrets in ``text``: kind, start and end in code points.

    They come in the order of start and kind; the same place may carry several kinds. A null or
    empty text has none. Values are costed whole, however long. A column named ``out`` is replaced, all others stay.
    """
    settle(docs.sparkSession)
    return docs.withColumn(out, arrow_column(_scan(threshold), _SPANS)(F.col(text)))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _redact(threshold: float, mark: str):
    def clean(text: str) -> str:
        out, at = [], 0
        for start, _, end in find(text, threshold):
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], mark]
            at = end
        return "".join(out) + text[at:]

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else clean(t) for t in texts.to_pylist()], pa.string())

    return run


def redact(
    docs: DataFrame, text: str = "text", size: str = "n_chars", threshold: float = THRESHOLD, mark: str = "[secret]"
) -> DataFrame:
    """Replaces each run of overlapping spans by ``mark`` and sets ``size`` anew, where there is
    such a column, for changed texts. No row goes; a null text stays null. Very long values are costed whole."""
    settle(docs.sparkSession)
    clean = fresh(docs, "clean_text")
    made = docs.withColumn(clean, arrow_column(_redact(threshold, mark), "string")(F.col(text)))
    if size in docs.columns:
        kept = F.col(text).eqNullSafe(F.col(clean))
        made = made.withColumn(
            size, F.when(kept, F.col(size)).otherwise(F.length(clean).cast(docs.schema[size].dataType))
        )
    return made.withColumn(text, F.col(clean)).select(docs.columns)
