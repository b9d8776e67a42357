import hashlib
import re

import pytest
from pyspark.sql import functions as F

from dispatchlens.llm.fingerprints import closed_syncmers, compare_edited, fingerprint, word_hashes


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def likeness(a, b):
    a, b = set(a.split()), set(b.split())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_anchors_are_the_closed_runs(spark):
    text = " ".join(re.findall(".", "the quick brown fox jumps over the lazy dog" * 3))
    frame = docs(spark, [(1, text)]).withColumn("h", word_hashes(F.col("text")))
    row = frame.select("h", closed_syncmers("h", 5).alias("a")).first()
    runs = [row.h[i : i + 5] for i in range(len(row.h) - 4)]
    chosen = [r for r in runs if min(r[0], r[-1]) == min(r)]
    hashed = spark.createDataFrame([(i, *r) for i, r in enumerate(chosen)])
    wanted = [
        r[0] >> 32
        for r in hashed.orderBy("_1")
        .select(F.xxhash64("_2", "_3", "_4", "_5", "_6"))
        .collect()
    ]
    assert row.a == wanted


@pytest.mark.parametrize("size", [1, 2, 57, 4500])
def test_next_document_and_edit(spark, size):
    rows = [((i * 7919) % 1_000_003, f"w{i} é{i * i} common words here {i % 5}") for i in range(size)]
    rows[size // 2] = (rows[size // 2][0], None)
    found = {r.doc_id: r for r in compare_edited(docs(spark, rows)).collect()}
    assert len(found) == size
    ordered = sorted((i, t or "") for i, t in rows)
    for (i, text), (j, following) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(text) // 2
        edited = text[: len(text) - cut] + following[:cut]
        row = found[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_next == pytest.approx(likeness(row.fingerprint, found[j].fingerprint))
        assert row.near_edited == pytest.approx(likeness(row.fingerprint, row.edited_fingerprint))


def test_odd_rows(spark):
    rows = [(None, "a b"), (None, None), (3, ""), (3, ""), (3, "x " * 9000), (1, "one two three")]
    found = compare_edited(docs(spark, rows).withColumn("TEXT2", F.lit(1)))
    assert found.count() == 6
    empty = docs(spark, [])
    assert compare_edited(empty).count() == 0
    clash = docs(spark, rows).withColumn("Anchors", F.lit("mine"))
    assert dict(fingerprint(clash).dtypes)["anchors"] == "array<int>"
    prints = {r.text: r.fingerprint for r in fingerprint(clash).collect()}
    assert prints[None] == "" and prints["one two three"]


def test_equal_texts_have_equal_fingerprints(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, " a b\tc d e\nf g h ")]
    assert len({r.fingerprint for r in fingerprint(docs(spark, rows)).collect()}) == 1
