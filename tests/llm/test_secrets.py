import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import queries
from dispatchlens.llm.secret_scan import KINDS, common_words, find_secrets, guess_cost, scan

ASSIGN = re.compile(
    "(" + "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
        for word in ("password", "passwd", "secret", "token", "api_?key")
    ) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
RANKS = {"dragon": 3, "house": 40, "ab": 7, "pass": 2, "monkey": 9}


def base(text):
    found = [(m.start(2), 0, m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def odd_texts():
    rng = random.Random(5)
    parts = [
        "token = \"", "PassWord:", "api_key", "apikey=", "secret", "passwd", "'", '"', " ", "=", ":", "x", "AKIA",
        "0123456789abcdef", "ABCDEFGHIJKLMN", "deadbeef", "é你", "\n", "abcdefghijklmnop", "token=secret:", "/+_.-",
        "ſecret=abcdefghijklmnop", "toKen=abcdefghijklmnop",
    ]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(3000)]


def test_fixed_patterns_against_plain_ones():
    for text in odd_texts():
        found = [f"{s['kind']}:{s['start']}:{s['end']}" for s in scan(text, {}, 10.0) if s["kind"] != "guess"]
        assert found == base(text)


def test_whole_table_against_plain_patterns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.secret_scan(spark, tables).collect()}
    assert len(found) == len(docs)
    for row in docs:
        own, wanted = found[row.doc_id], base(row.text or "")
        kinds = [s.split(":")[0] for s in wanted]
        assert (own.n_assign, own.n_access, own.n_hex) == tuple(map(kinds.count, KINDS[:3]))
        assert own.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        listed = own.spans.split(",") if own.spans else []
        assert [s for s in listed if not s.startswith("guess")] == wanted
        assert all(s.split(":")[0] in KINDS for s in listed)


ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")


def near(a, b):
    at = {c: (y, x) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    if a not in at or b not in at:
        return None
    step = (at[b][0] - at[a][0], at[b][1] - at[a][1])
    return step if step in ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)) else None


def slow_pieces(value):
    """All pieces by their definition, each looked at by itself."""
    n, low = len(value), value.lower()
    leet = low.translate(str.maketrans("@4310$57!", "aaeiossti"))

    def single(i):
        c = value[i]
        if c.isalpha():
            beside = [value[j] for j in (i - 1, i + 1) if 0 <= j < n and value[j].isalpha()]
            return 0.6 if any(d.islower() == c.islower() for d in beside) else math.log10(26)
        return 1.0 if c.isdigit() else math.log10(33)

    for i in range(n):
        yield i, i + 1, single(i)
        for j in range(i + 3, min(n, i + 24) + 1):
            for text, more in ((low[i:j], 0), (leet[i:j], 0.6)):
                if text in RANKS:
                    part = value[i:j]
                    case = 0 if part == text or part.islower() else 0.3 if part.istitle() else 0.6
                    yield i, j, math.log10(RANKS[text] + 1) + more + case + 0.3
                    break
        j, turns, way = i + 1, 0, None
        while j < n and near(low[j - 1], low[j]):
            step = near(low[j - 1], low[j])
            turns += way is not None and step != way
            way, j = step, j + 1
        if j - i >= 3:
            yield i, j, math.log10(47 * (j - i)) + turns * math.log10(5) + 0.3
        for by in (1, -1):
            j = i + 1
            while j < n and ord(low[j]) - ord(low[j - 1]) == by and low[j].isalnum() and low[j - 1].isalnum():
                j += 1
            if j - i >= 3:
                yield i, j, math.log10(26 * (j - i)) + 0.3
        for m in range(1, 5):
            k = 1
            while i + m <= n and value[i + k * m : i + (k + 1) * m] == value[i : i + m]:
                k += 1
            if k >= (3 if m == 1 else 2):
                yield i, i + m * k, sum(map(single, range(i, i + m))) + math.log10(k) + 0.3
        for pattern, cost in (
            (r"(19|20)\d\d([-/._]?)(0?[1-9]|1[0-2])\2(0[1-9]|[12]\d|3[01])", math.log10(365 * 120)),
            (r"(0?[1-9]|[12]\d|3[01])([-/._]?)(0?[1-9]|1[0-2])\2(19|20)\d\d", math.log10(365 * 120)),
            (r"(19|20)\d\d", math.log10(120)),
        ):
            match = re.compile(pattern).match(value, i)
            if match:
                yield i, match.end(), cost + 0.3


def least(value):
    pieces = list(slow_pieces(value))

    def all_sums(i):  # every segmentation, none left out
        if i == len(value):
            yield 0.0
        for a, b, cost in pieces:
            if a == i:
                for rest in all_sums(b):
                    yield cost + rest

    return min(all_sums(0))


@pytest.mark.parametrize("value", [
    "", "a", "dragon", "Dr4g0n1", "aaaaaa", "abab", "abcabcabc", "qwerty", "qazxsw", "12345678", "987zyx",
    "2024-01-31", "31121999", "pass1999", "xK9#mQ2$v", "hhouse", "zxcvfr", "ababab1", "MONKEYmon", "é你好é",
])
def test_least_cost_against_all_segmentations(value):
    assert guess_cost(value, RANKS) == pytest.approx(least(value))


def test_strong_values_are_told_and_weak_ones_not():
    strong = [
        "pwd: xK9#mQ2$vL7!", "Authorization: Bearer gh7Xq2LmZ0pTr9", "postgres://app:Zq8!rT5#wPx2@db/x",
        "secret_key => 'v8$Lq2@nR5%t'", "password = Ab3$x9Qz!7",
    ]
    weak = [
        "password: dragon", "The secret: unthinkable", "token: 12345678", "pwd=qwertyuiop", "password = aaaaaaaaaaaaaaaa"[:20],
        "compass: x", "token: see https://example.com/a1b2", "key words: none", "passcode: 2024-01-31", "bearer of news",
    ]
    for text in strong:
        (span,) = scan(text, RANKS, 10.0)
        assert span["kind"] == "guess" and span["cost"] >= 10 and span["end"] <= len(text)
    for text in weak:
        assert scan(text, RANKS, 10.0) == []


def test_long_values_take_time_in_proportion():
    for unit in ("a", "as", "qwe1", "0", "x9#Q", "2024"):
        start = time.time()
        guess_cost(unit * (200_000 // len(unit)), RANKS)
        assert time.time() - start < 20
    text = "token=" + "aB3$" * 50_000 + " password " * 50_000
    start = time.time()
    assert [s["kind"] for s in scan(text, RANKS, 11.0)] == []
    assert time.time() - start < 20


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "token: 0123456789abcdef0123"), (2, "pwd: xK9#mQ2$vL7!")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumn("SPANS", F.lit("mine")).withColumn("kind", F.lit(1))
    found = find_secrets(frame, common_words(frame))
    assert found.columns == ["doc_id", "text", "kind", "spans"]
    spans = sorted((r.text or "", [(s.kind, s.start, s.end) for s in r.spans]) for r in found.collect())
    assert spans == [
        ("", []), ("", []), ("", []), ("pwd: xK9#mQ2$vL7!", [("guess", 5, 16)]),
        ("token: 0123456789abcdef0123", [("assign", 7, 27), ("hex", 7, 27)]),
    ]
    empty = frame.limit(0)
    assert find_secrets(empty, common_words(empty)).count() == 0


def test_common_words_of_all_documents(spark):
    rows = [("The the cat",), ("cat CAT dog",), ("cat dog a an",), (None,), ("x" * 30 + " dog",)]
    frame = spark.createDataFrame(rows, "text string")
    assert [tuple(r) for r in common_words(frame).orderBy("rank").collect()] == [("cat", 1), ("dog", 2)]
    assert [tuple(r) for r in common_words(frame, most=1).collect()] == [("cat", 1)]
