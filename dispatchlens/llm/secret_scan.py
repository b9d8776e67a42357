"""Secrets in texts: fixed patterns, and credential values that take many guesses.

A value that stands where a credential stands (``pwd: ...``, ``Bearer ...``, ``//user:...@``) is a
secret if it is hard to guess.  Its guess cost is the least cost of any segmentation into words,
dates, repeats, keyboard walks, runs of the alphabet and single characters by brute force, found by
dynamic programming over the places of the value.  Words cost by their rank among the words of
all documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.llm import words, worker
from dispatchlens.llm.frames import tidy
from dispatchlens.llm.source_audit import count_terms

KINDS = ("assign", "access", "hex", "guess")
SPANS = "spans array<struct<kind: string, start: int, end: int, cost: double>>"

# The three patterns and the least length of what they find
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_LEAST_VALUE = 12
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{16,}")

# Where credentials stand; group 1 is the value
_VALUE = r"""([^\s"'`,;<>()\[\]{}|\\]+)"""
_CONTEXTS = (
    re.compile(
        r"""(?:password|passwd|passphrase|passcode|(?<![a-z])pwd|secret|token|credentials?"""
        r"""|(?:api|access|private|secret)[_-]?key)["'`]?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*["'`]?""" + _VALUE,
        re.IGNORECASE | re.ASCII,
    ),
    re.compile(r"(?<![a-z])bearer\x20+" + _VALUE, re.IGNORECASE | re.ASCII),
    re.compile(r"://[^\s/:@]+:([^\s/@]+)@"),
)
#: a text without any of these, in lower case, holds no context
_HINTS = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"bearer", b"://")

#: words of other passwords than those in texts, by how often they are met
_COMMON = (
    "password", "passwd", "admin", "root", "user", "test", "guest", "login", "welcome", "letmein",
    "changeme", "default", "secret", "token", "example", "sample", "dummy", "none", "null", "true", "false",
    "your", "here", "redacted", "hidden", "master", "monkey", "dragon", "qwerty",
)
_LEET = str.maketrans("@4310$57!", "aaeiossti")
_LONGEST_WORD = 24
_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_KEYS = {c: (y, x) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
#: steps to the six neighbours of a key; each row stands half a key to the right of the one above
_STEPS = {(0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)}
_DATES = (
    (re.compile(r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"), math.log10(365 * 120)),
    (re.compile(r"(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\1(?:19|20)\d\d"), math.log10(365 * 120)),
    (re.compile(r"(?:19|20)\d\d"), math.log10(120)),
)
#: a pattern costs this more, so that fewer of them win
_PIECE = 0.3
#: powers of ten for one character: in prose, among others, digit, any other
_IN_PROSE, _LETTER, _DIGIT, _OTHER = 0.6, math.log10(26), 1.0, math.log10(33)


def _brute(value: str) -> list[float]:
    """Cost of each character by itself; a letter beside one of its case may be prose."""
    found = []
    for i, c in enumerate(value):
        if c.isalpha():
            beside = value[max(0, i - 1) : i] + value[i + 1 : i + 2]
            prose = any(d.isalpha() and d.islower() == c.islower() for d in beside)
            found.append(_IN_PROSE if prose else _LETTER)
        else:
            found.append(_DIGIT if c.isdigit() else _OTHER)
    return found


def _runs(value: str) -> tuple[list[int], list[int], list[int]]:
    """For each place, where the keyboard walk from it ends and its turns, and where the run of the
    alphabet or of digits from it ends; found from the last place on, each in one step."""
    n, low = len(value), value.lower()
    walk, turns, run = list(range(1, n + 1)), [0] * n, list(range(1, n + 1))
    ways: list = [None] * n
    step = [0] * n
    for i in range(n - 2, -1, -1):
        a, b = _KEYS.get(low[i]), _KEYS.get(low[i + 1])
        way = a and b and (b[0] - a[0], b[1] - a[1])
        if way in _STEPS:
            ways[i], walk[i] = way, walk[i + 1]
            turns[i] = turns[i + 1] + (ways[i + 1] is not None and ways[i + 1] != way)
        by = ord(low[i + 1]) - ord(low[i])
        if by in (1, -1) and low[i].isalnum() and low[i + 1].isalnum():
            step[i] = by
            run[i] = run[i + 1] if step[i + 1] == by else i + 2
    return walk, turns, run


def _repeats(value: str, unit: int) -> list[int]:
    """For each place, how often the ``unit`` characters there stand in a row."""
    n = len(value)
    same = [0] * (n + 1)
    for i in range(n - unit - 1, -1, -1):
        same[i] = same[i + 1] + 1 if value[i] == value[i + unit] else 0
    return [1 + s // unit for s in same[:n]]


def pieces(value: str, ranks: Mapping[str, int]) -> Iterator[tuple[int, int, float]]:
    """All pieces that a segmentation may take: first place, end, cost as a power of ten."""
    single, (walk, turns, run) = _brute(value), _runs(value)
    before = [0.0]
    for cost in single:
        before.append(before[-1] + cost)
    units = {m: _repeats(value, m) for m in range(1, 5)}
    low = value.lower()
    plain = low.translate(_LEET)
    for i, cost in enumerate(single):
        yield i, i + 1, cost
        for j in range(i + 3, min(len(value), i + _LONGEST_WORD) + 1):
            for text, more in ((low[i:j], 0.0), (plain[i:j], 0.6)):
                rank = ranks.get(text)
                if rank is not None:
                    part = value[i:j]
                    case = 0.0 if part == text or part.islower() else 0.3 if part.istitle() else 0.6
                    yield i, j, math.log10(rank + 1) + more + case + _PIECE
                    break
        if walk[i] - i >= 3:
            yield i, walk[i], math.log10(47 * (walk[i] - i)) + turns[i] * math.log10(5) + _PIECE
        if run[i] - i >= 3:
            yield i, run[i], math.log10(26 * (run[i] - i)) + _PIECE
        for m, many in units.items():
            if many[i] >= (3 if m == 1 else 2):
                yield i, i + m * many[i], before[i + m] - before[i] + math.log10(many[i]) + _PIECE
        if value[i].isdigit():
            for pattern, date in _DATES:
                match = pattern.match(value, i)
                if match:
                    yield i, match.end(), date + _PIECE


def guess_cost(value: str, ranks: Mapping[str, int]) -> float:
    """Guesses for ``value`` as a power of ten: the least sum over all its segmentations."""
    best = [0.0] + [math.inf] * len(value)
    for i, j, cost in pieces(value, ranks):  # by first place, so best[i] is settled
        if best[i] + cost < best[j]:
            best[j] = best[i] + cost
    return best[-1]


def base_spans(text: str, folded: bytes) -> Iterator[tuple[int, int, str]]:
    """Spans of the fixed patterns."""
    if any(h in folded for h in (b"pass", b"secret", b"token", b"key")):
        for match in _ASSIGN.finditer(text):
            if match.end(2) - match.start(2) >= _LEAST_VALUE:
                yield *match.span(2), "assign"
    if b"akia" in folded:
        yield from ((*m.span(), "access") for m in _ACCESS.finditer(text))
    yield from ((*m.span(), "hex") for m in _HEX.finditer(text))


def scan(text: str, ranks: Mapping[str, int], least: float) -> list[dict]:
    """All spans of a text, by start and kind."""
    folded = text.encode().lower()
    found = list(base_spans(text, folded))
    taken = sorted({(a, b) for a, b, _ in found})
    spans = [(a, KINDS.index(kind), b, guess_cost(text[a:b], ranks)) for a, b, kind in found]
    if any(h in folded for h in _HINTS):
        values = set()
        for pattern in _CONTEXTS:
            for match in pattern.finditer(text):
                value = match[1].rstrip(".:!?")
                if value and "://" not in value:
                    values.add((match.start(1), match.start(1) + len(value)))
        at = 0
        for a, b in sorted(values):
            while at < len(taken) and taken[at][1] < b:
                at += 1
            if at < len(taken) and taken[at][0] <= a:
                continue  # one of the fixed patterns holds it
            cost = guess_cost(text[a:b], ranks)
            if cost >= least:
                spans.append((a, KINDS.index("guess"), b, cost))
    return [
        {"kind": KINDS[kind], "start": a, "end": b, "cost": cost} for a, kind, b, cost in sorted(spans)
    ]


def common_words(docs: DataFrame, text: str = "text", most: int = 20_000) -> DataFrame:
    """The words of 3 to 24 bytes met in most documents, all of them counted: ``word`` and ``rank``."""
    counted = count_terms(tidy(docs, [text]).select(text), [], text)
    falling = Window.orderBy(F.desc("docs"), "term")  # over the few rows that are left
    in_range = F.octet_length("term").between(3, _LONGEST_WORD)
    return (
        counted.where(in_range)
        .groupBy("term")
        .agg(F.sum("docs").alias("docs"))
        .where("docs > 1")
        .orderBy(F.desc("docs"), "term")
        .limit(most)
        .select(F.col("term").alias("word"), F.row_number().over(falling).alias("rank"))
    )


def find_secrets(
    docs: DataFrame, dictionary: DataFrame, text: str = "text", least_cost: float = 10.0
) -> DataFrame:
    """Find secrets in whole texts; adds ``spans``, an array of ``kind``, ``start``, ``end`` (code points,
    end exclusive) and ``cost`` (guesses as a power of ten), by start, then in the order of kinds:

    * ``assign``: a value of 12 or more characters set to a password, secret, token or key
    * ``access``: an access key, AKIA and 14 or more capitals and digits
    * ``hex``: 16 or more digits and letters a-f in a row
    * ``guess``: another value in the place of a credential whose cost is ``least_cost`` or more and
      that no span of the other kinds holds

    Each fixed pattern is matched from left to right without overlaps.  ``dictionary``: ``word`` and
    ``rank``, see ``common_words``; it is collected and broadcast, so its rows must be few.  Null counts
    as the empty text, without spans.  Equal rows are scanned each.  An empty table gives an empty
    result.  An input column named like the added one is replaced.
    """
    docs = tidy(docs, [text], ["spans"])
    ranks = {w: i for i, w in enumerate(_COMMON, 1)}
    for row in dictionary.collect():
        ranks.setdefault(row["word"], row["rank"])
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(SPANS).fields)
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("cost", pa.float64())]
        )
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.give_back()
        ranks = shared.value
        for batch in batches:
            for piece in words.pieces(batch, text):
                spans = [scan(t or "", ranks, least_cost) for t in piece[text].to_pylist()]
                kept = {c: piece[c] for c in piece.schema.names}
                yield pa.RecordBatch.from_pydict(kept | {"spans": pa.array(spans, kind)})

    return docs.mapInArrow(find, schema)
