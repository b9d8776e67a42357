import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import queries
from dispatchlens.llm.decontamination import find_benchmark_passages
from dispatchlens.llm.lm_scoring import score_documents
from dispatchlens.llm.toxicity import (
    Model, Weights, _without_near_copies, chance, learn, logistic, score, segments,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def passages(rows, items, n=10):
    windows = {}
    for item, text in items:
        ws = WORD.findall(low(text))
        size = min(n, len(ws))
        for i in range(len(ws) - size + 1) if ws else ():
            windows.setdefault(tuple(ws[i : i + size]), set()).add(item)
    out = []
    for i, text in rows:
        ws, hit, found = WORD.findall(low(text)), set(), set()
        for a in range(len(ws)):
            for size in range(1, n + 1):
                ids = windows.get(tuple(ws[a : a + size])) if a + size <= len(ws) else None
                if ids:
                    hit.update(range(a, a + size))
                    found |= {str(x) for x in ids if x is not None}
        out.append((i, len(ws), len(hit), tuple(sorted(found))))
    return Counter(out)


@pytest.mark.parametrize("block_bytes", [60, 1 << 20])
def test_benchmark_passages_by_brute_force(spark, block_bytes):
    rng = random.Random(8)
    word = lambda: rng.choice(["ab", "Cd", "é", "x1", "ZZ"]) + str(rng.randrange(6))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 3, 5, 9, 10, 14, 30])))) for i in range(12)]
    items += [(3, "other text of item three"), (None, "word"), (50, None), (51, "..."), items[0]]
    rows = [(None, None), (1, ""), (1, "word WORD wörd"), (2, "--" * 100), (2, "--" * 100)]
    for i in range(30):
        ws = [word() for _ in range(60)]
        if i % 2:
            ws[30:30] = WORD.findall(rng.choice(items[:12])[1])
        rows.append((100 + i, rng.choice(["-", ", ", "\n"]).join(ws).swapcase()))
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = docs(spark, rows).withColumn("HITS", F.lit(1))
    found = find_benchmark_passages(frame, bench, block_bytes=block_bytes)
    rows_found = found.collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows_found) == passages(rows, items)
    assert all(sum(s.end - s.start for s in r.hits) == r.n_hit for r in rows_found)


def test_empty_benchmark_and_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    found = find_benchmark_passages(docs(spark, [(1, "a b")]), bench).first()
    assert (found.n_words, found.n_hit, found["items"]) == (2, 0, [])
    assert find_benchmark_passages(docs(spark, []), bench).count() == 0


def scores_by_hand(rows, order, backoff=0.4):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    grams = lambda ws, k: Counter(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    total = sum(map(len, texts))
    corpus = [None] + [sum((grams(ws, k) for ws in texts), Counter()) for k in range(1, order + 1)]
    out = []
    for (i, _), ws in zip(rows, texts):
        own = [None] + [grams(ws, k) for k in range(1, order + 1)]
        count = lambda g: corpus[len(g)][g] - own[len(g)][g]
        units = 0
        for j in range(len(ws)):
            for k in range(min(order, j + 1), 0, -1):
                g = tuple(ws[j - k + 1 : j + 1])
                if count(g) > 0:
                    units += round(math.log(count(g) / (count(g[:-1]) if k > 1 else total)) * 1e6)
                    break
                units += round(math.log(backoff) * 1e6) if k > 1 else 0
            else:
                units += round(math.log(0.5 / total) * 1e6)
        out.append((i, len(ws), units))
    return Counter(out)


@pytest.mark.parametrize("order,size", [(1, 100), (3, 400), (3, 1 << 20), (4, 1 << 20)])
def test_backoff_scores_by_hand(spark, order, size):
    rng = random.Random(order)
    rows = [(None, None), (1, ""), (2, "only"), (2, "a a a a a a a"), (3, "the cat sat"), (3, "the cat sat")]
    rows += [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(60)))) for i in range(10, 40)]
    frame = docs(spark, rows).withColumn("PER_WORD", F.lit("x"))
    found = score_documents(frame, order=order, block_bytes=size).collect()
    got = Counter((r.doc_id, r.n_words, round(r.log_score * 1e6)) for r in found)
    assert got == scores_by_hand(rows, order)
    assert all((r.per_word is None) == (r.n_words == 0) for r in found)
    assert all(sum(r.by_order) == r.n_words for r in found)
    assert score_documents(frame.limit(0)).count() == 0


def best_first(weights):
    """Maximal segments by their definition: the best one, then those on either side of it."""

    def inside(a, b):
        sums = [(sum(weights[i:j]), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        top = max(sums, default=(0,))
        if top[0] <= 0:
            return []
        _, _, i, j = top
        return [*inside(a, i), (i, j), *inside(j, b)]

    return inside(0, len(weights))


def test_segments_by_definition():
    rng = random.Random(6)
    for _ in range(200):
        ws = [rng.choice([-1.3, -0.7, 0.9, 1.7, -2.01]) + rng.random() / 100 for _ in range(rng.randrange(14))]
        assert [(a, b) for a, b, _ in segments(np.array(ws))] == best_first(ws)


def test_chance_is_the_root_of_the_moment():
    from collections import Counter as C

    rate, share = chance(C({2.0: 10, 3.0: 5}), 10_000, 0.5, 4.0)
    p = {2.0: 10 / 10_001, 3.0: 5 / 10_001, 4.0: 1 / 10_001}
    rest = 1 - sum(p.values())
    assert rest * math.exp(-rate / 2) + sum(q * math.exp(rate * s) for s, q in p.items()) == pytest.approx(1)
    assert 0 < share < 1


def test_logistic_separates():
    a, b = logistic(np.array([0, 0, 0, 0, 3, 3.0]), np.array([0, 0, 0, 0, 1, 1.0]))
    assert a < -1 and a + 3 * b > 1



def test_scores_find_held_out_toxic_documents(spark):
    tables = "/root/testdata/sf0.1"
    try:
        labels = spark.read.parquet(f"{tables}/labels.parquet")
    except Exception:
        pytest.skip("no larger tables here")
    found = queries.toxicity(spark, tables).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in found)
    toxic = [r for r in found if r.toxic]
    assert right / len(found) > 0.95
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.85
    ordered = sorted(found, key=lambda r: r.score)
    ranks = [i for i, r in enumerate(ordered) if r.toxic]
    area = (sum(ranks) - len(ranks) * (len(ranks) - 1) / 2) / (len(ranks) * (len(found) - len(ranks)))
    assert area > 0.9


def test_toxicity_odd_rows(spark):
    rows = [(i, f"good words {i} and more of them") for i in range(40)]
    rows += [(100 + i, f"you awful {i} person, awful awful") for i in range(20)]
    labels = [(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(20)] + [(None, 1), (3, None)]
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = learn(docs(spark, rows), marked)
    odd = [(None, None), (1, ""), (1, "..."), (2, "awful awful"), (2, "awful awful"), (3, "fine " * 20_000)]
    found = score(docs(spark, odd).withColumn("Score", F.lit("mine")), model).collect()
    by_text = {r.text: r for r in found}
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert by_text["awful awful"].score > 0.5 > by_text[None].score == by_text[""].score
    assert by_text["awful awful"].segments[0].start == 0
    assert score(docs(spark, []), model).count() == 0
    nothing = learn(docs(spark, rows), marked.limit(0))
    assert score(docs(spark, odd), nothing).where("score >= 0.3").count() == 0


def test_model_without_segments_has_the_base_score():
    model = Model(Weights({"bad": 2.0}), 1.0, 0.5, -3.0, 2.0)
    assert model.probability(model.evidence([], 10)) == pytest.approx(1 / (1 + math.exp(3)))


def test_rare_toxic_texts_that_share_a_passage_with_clean_ones_are_learned_from(spark):
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, f"{passage} fine words number {i}") for i in range(3)]
    rows += [(10 + i, f"{passage} vile words number {i}") for i in range(5)]
    texts = spark.createDataFrame([(t, int(i >= 10)) for i, t in rows], "text string, toxic int")
    kept = [r.toxic for r in _without_near_copies(texts).collect()]
    assert sorted(set(kept)) == [0, 1] and len(kept) < 8
