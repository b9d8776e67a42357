"""Similarity join of documents on word shingles, by a MinHash LSH forest with exact checks.

Equal texts are one node.  Every node has a signature of lowest shingle hashes, cut into labels for
``trees`` prefix tries.  Two nodes meet where they share the first labels of a tree: the matched
prefix is shortened, label by label, until pairs at the threshold are found with the target
recall.  Each run of nodes with one prefix is searched in tiles of bounded size, which keep pairs
whose signatures agree well enough and tell only how these hang together.  The groups that come
of it are few and small; within them, again in tiles, the similarity of every pair is computed from
the whole shingle sets.  Links are counted per node, and no list of pairs is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm import words, worker
from dispatchlens.llm.components import components
from dispatchlens.llm.frames import stored, tidy

U64 = np.uint64
MADE = ("class_key", "class_id", "n_copies", "n_links", "n_similar_texts")
_RANDOM = np.random.Generator(np.random.PCG64(97))
_FACTORS = _RANDOM.integers(0, 2**64, 512, dtype=U64) | U64(1)
_SHIFTS = _RANDOM.integers(0, 2**64, 512, dtype=U64)


def prefix_length(threshold: float, trees: int, recall: float, longest: int) -> int:
    """The longest prefix at which pairs at the threshold share one in some tree with ``recall``."""
    for length in range(longest, 1, -1):
        if (1 - threshold**length) ** trees <= 1 - recall:
            return length
    return 1


def shingles(found: words.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words and the text of each; a shorter text is one shingle."""
    room, of_text = found.room(), found.texts()
    places = np.flatnonzero(room >= n)
    hashes, texts = [found.sequences(n)[places]], [of_text[places]]
    counts = np.diff(found.bounds)
    for length in range(1, n):
        short = np.flatnonzero(counts == length)
        if len(short):
            hashes.append(found.sequences(length)[found.bounds[short]])
            texts.append(short)
    hashes, texts = np.concatenate(hashes), np.concatenate(texts)
    order = np.argsort(texts, kind="stable")
    return hashes[order], texts[order]


def signatures(found: words.Words, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have shingles, and ``size`` lowest 32-bit hashes of each."""
    hashes, texts = shingles(found, n)
    if not len(hashes):
        return texts, np.zeros((0, size), np.uint32)
    at = np.flatnonzero(np.diff(texts, prepend=-1))
    out = np.empty((len(at), size), np.uint32)
    for i in range(size):
        own = ((hashes ^ _SHIFTS[i]) * _FACTORS[i]) >> U64(32)
        out[:, i] = np.minimum.reduceat(own.astype(np.uint32), at)
    return texts[at], out


def _roots(count: int, pairs: np.ndarray) -> np.ndarray:
    """The lowest member of each one's component, for pairs of numbers below ``count``."""
    root = np.arange(count)
    while len(pairs):
        low = np.minimum(root[pairs[0]], root[pairs[1]])
        before = root.copy()
        for side in pairs:
            np.minimum.at(root, root[side], low)
            np.minimum.at(root, side, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _tiles(df: DataFrame, member: str, size: Column, most: int) -> DataFrame:
    """Rows dealt to tiles (``low``, ``high``) of their group of ``size`` rows: the group is cut into
    parts of about ``most`` rows by a hash of ``member``, and a tile has the rows of two parts, or
    of one."""
    parts = F.ceil(size / most).cast("int")
    part = F.pmod(F.xxhash64(member, F.lit("part")), parts).cast("int")
    df = df.withColumn("parts", parts).withColumn("part", part)
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return df.select(
        "*", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    ).drop("parts", "other")


def _tile_pairs(low: int, high: int, part: np.ndarray, linked) -> np.ndarray:
    """Pairs (i, j) of a tile's rows for which ``linked(rows, rows)`` holds, each pair once."""
    a, b = np.flatnonzero(part == low), np.flatnonzero(part == high)
    yes = linked(a, b)
    if low == high:
        yes = np.triu(yes, 1)
    i, j = np.nonzero(yes)
    return np.stack([a[i], b[j]])


def link_similar(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.999999,
    trees: int = 24,
    longest: int = 6,
    tile_rows: int = 512,
) -> DataFrame:
    """Join documents whose sets of ``n``-word shingles have a Jaccard similarity of ``threshold``.

    Words are runs of bytes that are not ASCII white space.  A text of fewer words is one shingle;
    one without words has none and is linked to its equals only.  Returns the input columns and:

    * ``class_key`` string: one for all documents that hang together by links or equal texts
    * ``class_id``: the lowest id in the class
    * ``n_copies`` long: documents with this very text, itself included
    * ``n_links`` long: other documents that are linked, copies of this text included
    * ``n_similar_texts`` long: other texts that are linked

    Null counts as the empty text.  Rows without an id take part; a class of such rows alone has
    class null.  Equal rows are documents of their own.  An empty table gives an empty result.
    Input columns named like the added ones are replaced.

    ``recall``: expected share of pairs exactly at the threshold that meet in the forest; all pairs
    above it meet more surely, and none that meets is missed.  ``tile_rows``: texts compared at once.
    """
    docs = tidy(docs, [doc_id, text], (*MADE, "node"))
    length = prefix_length(threshold, trees, recall, longest)
    size = trees * length
    # six deviations below the threshold: fewer than one in 10**8 linked pairs agree less
    agree = max(0.0, threshold - 6 * (threshold * (1 - threshold) / size) ** 0.5)
    body = F.coalesce(F.col(text), F.lit(""))
    node = F.unhex(F.md5(body))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.give_back()
        for batch in batches:
            for piece in words.pieces(batch, "body"):
                has, found = signatures(words.split(piece["body"]), n, size)
                marks: list[bytes | None] = [None] * len(piece)
                for i, row in zip(has.tolist(), found):
                    marks[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [piece["id"], piece["node"], pa.array(marks, pa.binary())],
                    ["id", "node", "marks"],
                )

    id_type = docs.schema[doc_id].dataType.simpleString()
    signed = docs.select(F.col(doc_id).alias("id"), node.alias("node"), body.alias("body"))
    signed = signed.mapInArrow(sign, f"id {id_type}, node binary, marks binary")
    # marks depend on the node, so that they may stand among the keys
    nodes = stored(
        signed.groupBy("node", "marks").agg(F.min("id").alias("id"), F.count("*").alias("copies")),
        "nodes",
    )

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            marks = np.frombuffer(b"".join(batch["marks"].to_pylist()), np.uint32)
            marks = marks.reshape(len(batch), trees, length)
            keys = np.zeros((len(batch), trees), U64) + np.arange(1, trees + 1, dtype=U64)
            for i in range(length):
                keys = words.mix(keys * _FACTORS[0] + marks[:, :, i].astype(U64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["node"].take(pa.array(np.repeat(np.arange(len(batch)), trees))),
                    pa.array(keys.reshape(-1).astype(np.int64)),
                ],
                ["node", "run"],
            )

    marked = nodes.where(F.col("marks").isNotNull()).select("node", "marks")
    planted = marked.mapInArrow(plant, "node binary, run long")
    runs = planted.groupBy("run").agg(F.count("*").alias("size")).where("size > 1")
    met = planted.join(runs, "run")

    # signatures go along with 16 bits a label, enough to see whether two agree
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            thinned = [
                np.frombuffer(m, np.uint32).astype(np.uint16).tobytes()
                for m in batch["marks"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], pa.array(thinned, pa.binary())], ["node", "thin"]
            )

    met = met.join(marked.mapInArrow(thin, "node binary, thin binary"), "node")
    met = _tiles(met, "node", F.col("size"), tile_rows)

    def meet(rows: pa.Table) -> pa.Table:
        # by node, so that a group has the same root in most of its runs
        rows = rows.take(pa.array(np.argsort(np.array(rows["node"].to_pylist(), object))))
        marks = np.frombuffer(b"".join(rows["thin"].to_pylist()), np.uint16).reshape(-1, size)

        def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            yes = np.zeros((len(a), len(b)), bool)
            for i in range(0, len(a), 32):
                same = marks[a[i : i + 32], None, :] == marks[None, b, :]
                yes[i : i + 32] = same.sum(2) >= agree * size
            return yes

        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        pairs = _tile_pairs(low, high, rows["part"].to_numpy(), linked)
        root = _roots(len(rows), pairs)
        child = np.flatnonzero(root != np.arange(len(rows)))
        return pa.table(
            {"a": rows["node"].take(pa.array(child)), "b": rows["node"].take(pa.array(root[child]))}
        )

    edges = met.groupBy("run", "low", "high").applyInArrow(meet, "a binary, b binary")
    groups = components(edges)
    sizes = groups.groupBy("label").agg(F.count("*").alias("size"))
    members = groups.join(sizes, "label").join(nodes.select("node", "id", "copies"), "node")
    members = members.withColumn("key", F.coalesce(F.col("id").cast("string"), F.lit("")))
    bodies = docs.select(
        node.alias("node"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("key"),
        body.alias("body"),
    )
    whole = bodies.join(members, ["node", "key"])
    whole = _tiles(whole, "node", F.col("size"), tile_rows)
    whole = whole.select("label", "low", "high", "part", "node", "copies", "body")

    def verify(rows: pa.Table) -> pa.Table:
        # equal rows of one document arrive as often as they are in the input
        first = np.unique(np.array(rows["node"].to_pylist(), object), return_index=True)[1]
        rows = rows.take(pa.array(first))
        hashes, texts = shingles(words.split(rows["body"]), n)
        order = np.lexsort((texts, hashes))
        hashes, texts = hashes[order], texts[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
        hashes, texts = hashes[new], texts[new]
        sizes = np.bincount(texts, minlength=len(rows))
        # columns: shingles of two texts or more
        column = np.cumsum(np.diff(hashes, prepend=hashes[:1]) != 0)
        shared = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
        texts = texts[shared]
        column = np.unique(column[shared], return_inverse=True)[1]

        def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            common = np.zeros((len(a), len(b)), np.float32)
            row_a, row_b = np.full(len(rows), -1), np.full(len(rows), -1)
            row_a[a], row_b[b] = np.arange(len(a)), np.arange(len(b))
            count = column[-1] + 1 if len(column) else 0
            edges = np.searchsorted(column, np.arange(0, count, 4096))
            for start, end in zip(edges, [*edges[1:], len(column)]):
                own, at = texts[start:end], column[start:end] - column[start]
                width = int(at[-1]) + 1
                left, right = (np.zeros((len(x), width), np.float32) for x in (a, b))
                for matrix, row in ((left, row_a), (right, row_b)):
                    inside = row[own] >= 0
                    matrix[row[own][inside], at[inside]] = 1
                common += left @ right.T
            union = sizes[a][:, None] + sizes[b][None, :] - common.astype(np.float64)
            return common / np.maximum(union, 1) >= threshold

        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        pairs = _tile_pairs(low, high, rows["part"].to_numpy(), linked)
        copies = rows["copies"].to_numpy()
        links, similar = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for x, y in (pairs, pairs[::-1]):
            np.add.at(links, x, copies[y])
            np.add.at(similar, x, 1)
        root = _roots(len(rows), pairs)
        have = np.flatnonzero(similar)
        return pa.table(
            {
                "node": rows["node"].take(pa.array(have)),
                "root": rows["node"].take(pa.array(root[have])),
                "links": pa.array(links[have]),
                "similar": pa.array(similar[have]),
            }
        )

    links = whole.groupBy("label", "low", "high").applyInArrow(
        verify, "node binary, root binary, links long, similar long"
    )
    links = stored(links, "links")
    classes = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("node").agg(
        F.sum("links").alias("links"), F.sum("similar").alias("similar")
    )
    known = nodes.select("node", "id", "copies").join(counted, "node", "left")
    known = known.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = known.groupBy("label").agg(F.min("id").alias("class_id"))
    known = known.join(lowest, "label").select(
        "node",
        F.hex("label").alias("class_key"),
        "class_id",
        F.col("copies").alias("n_copies"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("similar", F.lit(0)).alias("n_similar_texts"),
    )
    return docs.withColumn("node", node).join(known, "node").drop("node")
