"""Fingerprints of texts from closed syncmers, with DataFrame functions alone.

A run of ``k`` words is an anchor if the lowest of its words' hashes lies at its first or last word.
Whether a run is chosen depends on nothing outside it, so an edit changes only the anchors that
touch it, and anchors in text order match by place.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispatchlens.llm.frames import tidy

LAST_ID = 2**63 - 1


def word_hashes(text: Column) -> Column:
    """The hashes of a text's words, cut at ASCII white space."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def closed_syncmers(hashes: str, k: int = 5) -> Column:
    """The anchors of a column of word hashes, in text order, as 32-bit numbers.

    A text of one to ``k - 1`` words has one anchor, of all its words; one without words has none.
    """
    h = F.col(hashes)

    def at(i: Column, j: int) -> Column:
        return F.get(h, i + j)

    def closed(i: Column) -> Column:
        inner = reduce(F.least, (at(i, j) for j in range(1, k - 1)))
        return F.least(at(i, 0), at(i, k - 1)) <= inner

    def number(*values: Column) -> Column:
        return F.shiftright(F.xxhash64(*values), 32).cast("int")

    places = F.filter(F.sequence(F.lit(0), F.size(h) - k), closed)
    anchors = F.transform(places, lambda i: number(*(at(i, j) for j in range(k))))
    none = F.array().cast("array<int>")
    return (
        F.when(F.size(h) >= k, anchors)
        .when(F.size(h) > 0, F.array(number(h)))
        .otherwise(none)
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of anchors, 1 for two empty ones."""
    common, both = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(common / both)


def as_text(anchors: Column) -> Column:
    return F.array_join(anchors.cast("array<string>"), " ")


def with_next(df: DataFrame, key: str, made: str, bucket_rows: int = 2000, most: int = 1024):
    """``df`` in buckets by ranges of ``key``; the function returned adds a column ``made`` that
    holds the struct of the given columns of the next row.

    Order: by ``key``, nulls last, then by a hash of the row; after the last row comes the first.
    Each bucket also gets the first row of the bucket after it, as a guest.  Bucket bounds are
    approximate quantiles, at most ``most``.
    """
    id_ = F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID))
    ids = df.select(id_.alias("id"))
    count = ids.count()
    n = max(1, min(most, -(-count // bucket_rows)))
    shares = F.array(*(F.lit(i / n) for i in range(1, n))) if n > 1 else None
    bounds = []
    if shares is not None:
        bounds = sorted(set(ids.agg(F.percentile_approx("id", shares, 10 * n)).first()[0]))
    limits = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")

    def bucket(value: Column) -> Column:
        return F.size(F.filter(limits, lambda b: value > b))

    firsts = ids.groupBy(bucket(F.col("id")).alias("b")).agg(F.min("id").alias("id")).collect()
    firsts = sorted((r.b, r.id) for r in firsts)
    before = {b: firsts[i - 1][0] for i, (b, _) in enumerate(firsts)}
    first = dict(firsts)
    first_of = F.from_json(
        F.lit(json.dumps([first.get(b) for b in range(len(bounds) + 1)])), "array<bigint>"
    )
    before_of = F.from_json(
        F.lit(json.dumps([before.get(b) for b in range(len(bounds) + 1)])), "array<int>"
    )
    mark = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    own = bucket(F.col("next_id"))
    guest = F.when(F.get(first_of, F.col("next_own")) == F.col("next_id"), F.lit(1)).otherwise(0)
    homes = F.when(
        guest == 1,
        F.array(
            F.struct(F.col("next_own").alias("home"), F.lit(0).alias("guest")),
            F.struct(F.get(before_of, F.col("next_own")).alias("home"), F.lit(1).alias("guest")),
        ),
    ).otherwise(F.array(F.struct(F.col("next_own").alias("home"), F.lit(0).alias("guest"))))
    dealt = (
        df.withColumn("next_id", id_)
        .withColumn("next_mark", mark)
        .withColumn("next_own", own)
        .withColumn("next_at", F.explode(homes))
        .withColumn("next_home", F.col("next_at.home"))
        .withColumn("next_guest", F.col("next_at.guest"))
        .drop("next_at", "next_own")
        .repartition("next_home")
    )

    def finish(rows: DataFrame, *columns: str) -> DataFrame:
        window = Window.partitionBy("next_home").orderBy("next_guest", "next_id", "next_mark")
        return (
            rows.withColumn(made, F.lead(F.struct(*columns)).over(window))
            .where(F.col("next_guest") == 0)
            .drop("next_id", "next_mark", "next_home", "next_guest")
        )

    return dealt, finish


def fingerprint(docs: DataFrame, text: str = "text", k: int = 5) -> DataFrame:
    """``docs`` with ``anchors`` (array of int, in text order) and ``fingerprint`` (as text).

    Null and empty texts have no anchors and an empty fingerprint; equal texts have equal ones.
    An empty table gives an empty result.  Columns named like the added ones are replaced.
    """
    docs = tidy(docs, [text], ("anchors", "fingerprint", "word_hashes"))
    hashed = docs.withColumn("word_hashes", word_hashes(F.col(f"`{text}`")))
    return (
        hashed.withColumn("anchors", closed_syncmers("word_hashes", k))
        .drop("word_hashes")
        .withColumn("fingerprint", as_text(F.col("anchors")))
    )


def compare_edited(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5
) -> DataFrame:
    """Fingerprints of texts and of their edited texts, and how alike they are.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many (or
    all) of the next document by ascending id, of the first one after the last.  Documents
    without an id come last; those that share an id are ordered by a hash.  Null texts are empty.
    An empty table gives an empty result.  Returns only the id and the columns made:
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.
    """
    docs = tidy(docs, [doc_id, text])
    docs = docs.select(
        F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("own_text")
    )
    dealt, finish = with_next(docs, doc_id, "following")
    own = fingerprint(dealt, "own_text", k).drop("fingerprint")
    n = F.char_length("own_text")
    cut = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring("own_text", F.lit(1), n - cut),
        F.substring(F.col("following.own_text"), F.lit(1), cut),
    )
    rows = finish(own, "own_text", "anchors").select(
        doc_id,
        n.cast("long").alias("n_chars"),
        "anchors",
        F.col("following.anchors").alias("next_anchors"),
        edited.alias("edited"),
    )
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = rows.withColumn("word_hashes", word_hashes(F.col("edited")))
    rows = rows.withColumn("edited_anchors", closed_syncmers("word_hashes", k))
    return rows.select(
        doc_id,
        "n_chars",
        "edited_sha256",
        as_text(F.col("anchors")).alias("fingerprint"),
        as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
