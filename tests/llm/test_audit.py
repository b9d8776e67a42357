import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import queries
from dispatchlens.llm.source_audit import UNIT, divergences, share

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, s, top):
    docs = [
        (lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        for text, lang, source in rows
    ]
    out = []
    for lang in {x for x, _, _ in docs}:
        own = [(source, terms) for x, source, terms in docs if x == lang]
        found = Counter(t for _, terms in own for t in set(terms))
        kept = [t for t, n in found.items() if n >= least]
        counts = {source: Counter() for source, _ in own}
        whole = Counter()
        for source, terms in own:
            counts[source].update(t for t in terms if t in kept)
            whole.update(t for t in terms if t in kept)

        def part(c, t):
            return 1 + UNIT * (c[t] + s) // (c.total() + s * len(kept))

        for source, c in counts.items():
            pairs = [(-sum(abs(part(c, t) - part(d, t)) for t in kept), other.encode(), other)
                     for other, d in counts.items() if other != source]
            terms = [(part(whole, t) - part(c, t), t.encode(), t) for t in kept
                     if c[t] and part(c, t) > part(whole, t)]
            for name, items in (("pair", pairs), ("term", sorted(terms)[:top])):
                out += [(lang, source, name, x, -v, i) for i, (v, _, x) in enumerate(sorted(items), 1)]
    return sorted(out)


@pytest.mark.parametrize("block_groups,block_terms", [(2, 3), (64, 4096), (1, 1000)])
def test_cells_against_brute_force(spark, block_groups, block_terms):
    rng = random.Random(block_groups)
    words = ["The", "the", "été", "b2b", "Z", "ÀB", "x-y", "你好", *(f"w{'abcdefgh'[i]}" for i in range(8))]
    rows = [
        (" ".join(rng.choices(words, range(1, 17), k=rng.randrange(0, 12))),
         rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "a", "b", "c", "D", "é", "", None]))
        for _ in range(120)
    ]
    rows += [(None, "en", "empty"), ("", "fr", "x"), ("one", "fr", "y"), ("", "it", None), (None, None, None)]
    rows += [("the " * 30_000, "en", "a")] * 2 + [("w" * 50_000, "en", "long")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    frame = frame.select("*", F.lit(1).alias("Term"), F.lit(2).alias("value"), F.lit(3).alias("LANG"))
    found = divergences(
        frame, least_docs=4, top=5, block_groups=block_groups, block_terms=block_terms
    )
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, 5, 5)
    assert divergences(frame.limit(0)).count() == 0


def test_whole_table_against_sql_and_brute_force(spark, tables):
    found = [tuple(r) for r in queries.source_divergence(spark, tables).collect()]
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("text", "lang", "source").collect()
    assert sorted(found) == brute([tuple(r) for r in docs], 30, 5, 50)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
    assert sorted(found) == sorted(duck.sql(queries.ORACLES["op12_source_divergence"]).fetchall())


def test_shares_are_exact_for_large_counts():
    for count, of in ((5, 5), (10**13 + 7, 10**14 - 3), (123_456_789_012, 999_999_999_989), (5, 10**14)):
        assert share(np.array([count]), np.array([of]))[0] == 1 + UNIT * count // of
