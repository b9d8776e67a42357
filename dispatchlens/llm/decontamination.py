"""Documents that hold passages of benchmark items.

Winnowing: a window of ``n`` words has as its fingerprint the lowest hash of ``k`` consecutive words in
it.  A shared window has the same fingerprint on both sides, so every shared span of ``n`` words
meets at least one common fingerprint; a hit is extended to the windows that the fingerprint
stands for, and these are compared.

The benchmark is the side with a bound: it is read in blocks of at most ``block_bytes`` of text,
and each block's fingerprints and windows are broadcast for one pass over the documents.  A
benchmark below the bound takes one pass.  Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.llm import packets, words, worker
from dispatchlens.llm.frames import text_bytes, tidy

MADE = ("n_words", "n_hit", "hits", "items")
_ADDED = "n_words long, n_hit long, hits array<struct<start:int,end:int>>, items array<string>"
_FILTER_BITS = 20


class _Windows:
    """All windows of one length in a block of items, and the fingerprints that lead to them."""

    def __init__(self, found: words.Words, starts: np.ndarray, length: int, k: int):
        self.length, self.k = length, min(k, length)
        grams = found.sequences(self.k)
        anchors = words.lowest_places(grams, length - self.k + 1)[starts]
        self.seeds = np.unique(grams[anchors])
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._short(self.seeds)] = True
        keys = found.sequences(length)[starts]
        checks = found.sequences(length, variant=1)[starts]
        self.keys, self.checks, place, _ = packets.unique(keys, checks)
        # items of window i: owners[first[i] : first[i + 1]]
        pairs = np.unique(np.stack([place, found.texts()[starts]]), axis=1)
        self.first = np.searchsorted(pairs[0], np.arange(len(self.keys) + 1))
        self.owners = pairs[1]

    @staticmethod
    def _short(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def matches(self, found: words.Words, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows in ``found`` that are one of these, and which one each is."""
        starts = np.flatnonzero(room >= self.length)
        if not len(starts):
            return starts, starts
        grams = found.sequences(self.k)
        at = words.lowest_places(grams, self.length - self.k + 1)[starts]
        maybe = self.filter[self._short(grams)][at]
        starts, at = starts[maybe], at[maybe]
        seeded = np.isin(grams[at], self.seeds)
        starts = starts[seeded]
        keys = found.sequences(self.length)[starts]
        checks = found.sequences(self.length, variant=1)[starts]
        # equal keys with different checks are not expected, but they are told apart
        place = np.searchsorted(self.keys, keys)
        hit, which = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        for step in range(int(np.unique(self.keys, return_counts=True)[1].max())):
            i = np.minimum(place + step, len(self.keys) - 1)
            same = (self.keys[i] == keys) & (self.checks[i] == checks)
            hit |= same
            which[same] = i[same]
        return starts[hit], which[hit]


def _index(rows: list, n: int, k: int) -> tuple[list[str | None], list[_Windows]]:
    """The ids of a block of items and their windows, by length."""
    found = words.split(pa.array([r[1] for r in rows], pa.string()), words.ALPHANUMERIC, True)
    counts, room = np.diff(found.bounds), found.room()
    tables = []
    for length in sorted({min(n, c) for c in counts.tolist()} - {0}):
        whole = (counts >= n) if length == n else (counts == length)
        starts = np.flatnonzero((room >= length) & np.repeat(whole, counts))
        tables.append(_Windows(found, starts, length, k))
    return [r[0] for r in rows], tables


def _scan(batch: pa.RecordBatch, text: str, index, earlier: bool) -> pa.RecordBatch:
    ids, tables = index
    found = words.split(batch[text], words.ALPHANUMERIC, lower=True)
    room, of_text = found.room(), found.texts()
    steps = np.zeros(len(found.hashes) + 1, np.int32)
    pairs = [np.zeros((2, 0), np.int64)]
    for table in tables:
        starts, which = table.matches(found, room)
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + table.length, -1)
        first, many = table.first[which], np.diff(table.first)[which]
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        owners = table.owners[np.repeat(first, many) + inside]
        pairs.append(np.stack([np.repeat(of_text[starts], many), owners]))
    flags = np.cumsum(steps[:-1]) > 0
    owners_of: dict[int, set[str]] = {}
    for doc, item in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
        if ids[item] is not None:
            owners_of.setdefault(doc, set()).add(ids[item])
    hits: list[list[dict]] = [[] for _ in range(len(batch))]
    items = [sorted(owners_of.get(i, ())) for i in range(len(batch))]
    before_items = batch["items"].to_pylist() if earlier else []
    for i, spans in enumerate(batch["hits"].to_pylist() if earlier else []):
        for span in spans:
            flags[found.bounds[i] + span["start"] : found.bounds[i] + span["end"]] = True
        items[i] = sorted({*items[i], *before_items[i]})
    sums = np.concatenate([[0], np.cumsum(flags)])[found.bounds]
    counts = np.diff(sums)
    for i in np.flatnonzero(counts).tolist():
        hits[i] = words.spans(flags[found.bounds[i] : found.bounds[i + 1]])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    made = {
        "n_words": pa.array(np.diff(found.bounds), pa.int64()),
        "n_hit": pa.array(counts, pa.int64()),
        "hits": pa.array(hits, span),
        "items": pa.array(items, pa.list_(pa.string())),
    }
    kept = {c: batch[c] for c in batch.schema.names if c not in MADE}
    return pa.RecordBatch.from_pydict(kept | made)


def find_benchmark_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 10,
    k: int = 6,
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """Mark the words of ``docs`` that lie in a window of ``n`` words of a benchmark item.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count as
    a-z.  An item of fewer words is one window; one without words has none.  Adds:

    * ``n_words`` long, ``n_hit`` long: words, and how many of them lie in a shared window
    * ``hits`` array of (start, end): the runs of such words
    * ``items`` array of string: ids of the items with a window in the document, sorted as strings

    Null texts have no words.  Items without an id mark words but are not listed; items that share
    an id are listed once.  An empty benchmark hits nothing, an empty table gives an empty result.
    Input columns named like the added ones are replaced.

    ``k``: words of a fingerprint; any value gives the same result.  ``block_bytes``: most text of
    the benchmark that is broadcast at once; a single longer item is a block of its own.
    """
    docs = tidy(docs, [text], MADE)
    items = tidy(benchmark, [item_id, item_text]).select(
        F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text")
    )
    items = items.where(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(text_bytes(F.col("text"))).alias("n")).first()["n"] or 0
    count = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(_ADDED).fields)
    context, out = docs.sparkSession.sparkContext, docs
    for i in range(count):
        shared = context.broadcast(_index(items.where(block == i).collect(), n, k))

        def scan(
            batches: Iterator[pa.RecordBatch], shared=shared, earlier=i > 0
        ) -> Iterator[pa.RecordBatch]:
            worker.give_back()
            for batch in batches:
                for piece in words.pieces(batch, text):
                    yield _scan(piece, text, shared.value, earlier)

        out = out.mapInArrow(scan, schema)
    return out
