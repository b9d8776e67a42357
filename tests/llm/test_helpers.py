import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import packets, words
from dispatchlens.llm.components import components
from dispatchlens.llm.frames import tidy

TEXTS = ["", None, "a b", "  a\tb ", "Ünï cödé", "a-b_c9 D", "\x00x\x7f", "word " * 50, "x" * 3000, "a b"]


@pytest.mark.parametrize("kind", ["blank", "alphanumeric"])
@pytest.mark.parametrize("sliced", [False, True])
def test_words_are_those_of_the_pattern(kind, sliced, monkeypatch):
    monkeypatch.setattr(words, "_AT_ONCE", 7)
    column = pa.array(["first", *TEXTS])[1:] if sliced else pa.chunked_array([TEXTS[:3], TEXTS[3:]])
    pattern = "[^\x20\x09-\x0D]+" if kind == "blank" else "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    table = words.NOT_BLANK if kind == "blank" else words.ALPHANUMERIC
    found = words.split(column, table, lower=kind != "blank")
    wanted = []
    for t in TEXTS:
        t = t or ""
        wanted.append(re.findall(pattern, t if kind == "blank" else re.sub("[A-Z]", lambda m: m[0].lower(), t)))
    assert np.diff(found.bounds).tolist() == [len(w) for w in wanted]
    flat = [w for ws in wanted for w in ws]
    names = dict(zip(found.hashes.tolist(), flat))
    assert [names[h] for h in found.hashes.tolist()] == flat
    assert len(names) == len(set(flat))
    assert found.room().tolist() == [n - i for n in map(len, wanted) for i in range(n)]
    for n in (1, 2, 5):
        runs = [tuple(flat[i : i + n]) for i in range(len(flat) - n + 1)]
        for variant in (0, 1):
            hashes = found.sequences(n, variant).tolist()
            assert len(hashes) == len(runs) and len(set(hashes)) == len(set(runs))
            assert dict(zip(runs, hashes)) == {r: h for r, h in zip(runs, hashes)}


def test_lowest_places_are_leftmost():
    rng = random.Random(2)
    values = np.array([rng.randrange(4) << 50 for _ in range(200)], np.uint64)
    for width in (1, 2, 3, 7, 64, 200, 201):
        found = words.lowest_places(values, width).tolist()
        runs = [values[i : i + width].tolist() for i in range(len(values) - width + 1)]
        assert found == [i + run.index(min(run)) for i, run in enumerate(runs)]


def test_pieces_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 5, None, "y" * 100, "", "z"] * 7, "i": list(range(35))})
    parts = list(words.pieces(batch, "t", 12))
    assert [i for p in parts for i in p["i"].to_pylist()] == list(range(35))
    assert list(words.pieces(batch.slice(0, 0), "t")) == []


def test_numbers_survive_packing():
    rng = np.random.default_rng(1)
    for kind in (np.uint8, np.uint16, np.uint32, np.uint64):
        values = rng.integers(0, np.iinfo(kind).max, 1000, dtype=kind)
        assert (packets.restore(packets.shrink(values)) == values).all()
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    assert (packets.restore_sorted(packets.shrink_sorted(keys)) == keys).all()


@pytest.mark.parametrize("checked", [False, True])
def test_answers_are_counts_in_other_blocks(checked):
    rng = np.random.default_rng(3)
    asked, rows = {}, []
    for block in range(5):
        keys = np.unique(rng.integers(0, 40, 30).astype(np.uint64)) << np.uint64(58)
        checks = (keys >> np.uint64(58)).astype(np.uint32) % 3 if checked else None
        counts = rng.integers(1, 400, len(keys))
        asked[block] = keys, counts
        rows += packets.ask(block, 1, keys, counts, 4, checks)
        rows += packets.ask(block, 2, keys[:1], counts[:1], 4, None)
    table = packets.packet_table(rows)
    told = [
        packets.answer_others(table.filter(pa.array(np.array(table["bucket"]) == b)))
        for b in np.unique(np.array(table["bucket"]))
    ]
    told = pa.concat_tables(told)
    for block, (keys, _) in asked.items():
        own = told.filter(pa.array(np.array(told["block"]) == block))
        wanted = [
            sum(int(c[k == key].sum()) for b, (k, c) in asked.items() if b != block) for key in keys
        ]
        assert packets.answers(own, 1).tolist() == wanted


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    random.Random(1).shuffle(chain)
    edges = chain + [(100, 100 + i) for i in range(1, 30)] + [(500, 500), (7, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    labels = {r.node: r.label for r in found}
    assert labels == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tidy_columns(spark):
    frame = spark.range(2).select(
        F.lit(1).alias("TEXT"), F.lit("t").alias("text"), F.lit(2).alias("x"), F.lit(3).alias("X"),
        F.lit(4).alias("Made"), F.lit(5).alias("a.b"),
    )
    found = tidy(frame, ["text"], ["made"])
    assert found.columns == ["text", "x", "a.b"]
    assert found.first().asDict() == {"text": "t", "x": 2, "a.b": 5}
    with pytest.raises(ValueError):
        tidy(frame, ["doc_id"])
