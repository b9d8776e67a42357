"""Removal of word passages that occur more than once.

Seed and extend.  Every window of ``n`` words has a seed: its lowest hash of ``k`` consecutive words,
the winnowed anchor of the window.  Equal windows have equal seeds in the same place, so only
windows whose seed occurs at two places or more can repeat.  Round one joins the documents'
anchors by hash.  Round two extends each repeated seed both ways, to all windows that it is the
anchor of, and compares those.  Overlapping repeated windows make up the maximal repeats.

Both rounds go through ``packets``: no pair of occurrences is ever made, and a passage that every
document has costs one key per block.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.llm import packets, words
from dispatchlens.llm.frames import text_bytes, tidy

U64 = np.uint64
SEEDS, WINDOWS = 1, 2
MADE = ("n_words", "n_removed", "repeats", "kept_text")


def _windows(column, n: int, k: int):
    """Words, starts of the windows that lie in one text, and the anchor of each."""
    found = words.split(column)
    room = found.room()
    starts = np.flatnonzero(room >= n)
    grams = found.sequences(k)
    anchors = words.lowest_places(grams, n - k + 1)[starts] if len(starts) else starts
    return found, starts, grams, anchors


def _seeds(column, n: int, k: int):
    """Different seeds, the number of places of each, windows and the seed of each."""
    found, starts, grams, anchors = _windows(column, n, k)
    places = np.unique(anchors)
    seeds, _, _, counts = packets.unique(grams[places])
    of_window = np.searchsorted(seeds, grams[anchors]) if len(starts) else starts
    return found, starts, of_window, seeds, counts


def _extended(column, answered: pa.Table, n: int, k: int):
    """The windows around repeated seeds: their keys, sorted, and which key each has."""
    found, starts, of_window, _, counts = _seeds(column, n, k)
    repeated = packets.answers(answered, SEEDS) + counts > 1
    starts = starts[repeated[of_window]] if len(starts) else starts
    keys = found.sequences(n)[starts]
    checks = (found.sequences(n, variant=1)[starts] >> U64(32)).astype(np.uint32)
    keys, checks, place, counts = packets.unique(keys, checks)
    return found, starts, keys, checks, place, counts


def _without(text: bytes, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> bytes:
    """``text`` without the words that are gone, and else as it is; ``starts`` and ``ends`` of its words.

    Of the white space before and after a cut one stays: the one with more line feeds, or the longer
    one.  At the start of a text it is the one before, at its end the one after.
    """
    if gone.all():
        return b""
    out, at, last = [], 0, len(gone)
    for span in words.spans(gone):
        a, b = span["start"], span["end"]
        before = text[ends[a - 1] if a else 0 : starts[a]]
        after = text[ends[b - 1] : starts[b] if b < last else len(text)]
        size = lambda blank: (blank.count(b"\n"), len(blank))
        first = a == 0 or (b < last and size(before) >= size(after))
        out += [text[at : starts[a] - len(before)], before if first else after]
        at = ends[b - 1] + len(after)
    return b"".join([*out, text[at:]])


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    n: int = 35,
    k: int = 12,
    block_bytes: int = 4 << 20,
    bucket_keys: int = 1 << 21,
    joined: bool = True,
) -> DataFrame:
    """Cut every word that lies in a window of ``n`` words found at another place, too.

    Words are runs of bytes that are not ASCII white space.  All copies of a repeat go, the first
    one as well.  Windows are judged on the input.  Adds to the columns of ``docs``:

    * ``n_words`` long, ``n_removed`` long
    * ``repeats`` array of (start, end): the maximal repeats, in words
    * ``kept_text`` string: the words that stay, joined by one blank; unless ``joined``, the text as it
      was but for the removed words and the white space between them

    A null or empty text has no words and an empty ``kept_text``.  Equal rows repeat each other.
    An empty table gives an empty result.  Input columns named like the added ones are replaced,
    other columns stay (see ``frames.tidy``).

    ``k``: words of an anchor; any value below ``n`` gives the same result.  ``block_bytes``: text
    in one task's hands at once.  ``bucket_keys``: about how many keys one bucket compares.
    """
    if not 0 < k < n:
        raise ValueError("k must be from 1 to n - 1")
    docs = tidy(docs, [text], MADE)
    total = docs.agg(F.sum(text_bytes(F.col(text))).alias("n")).first()["n"] or 0
    # a seed every (n - k + 2) / 2 words of about six bytes
    bits = max(7, (total // (3 * (n - k + 2)) // bucket_keys).bit_length())
    dealt = packets.pack(docs, text, block_bytes)
    added = T.StructType.fromDDL(
        "n_words long, n_removed long, repeats array<struct<start:int,end:int>>, kept_text string"
    )
    schema = T.StructType([f for f in docs.schema.fields] + added.fields)

    def seeds(packed: pa.Table) -> pa.Table:
        block, rows = packets.unpack(packed)
        _, _, _, keys, counts = _seeds(rows[text], n, k)
        return packets.packet_table(
            packets.ask(block, SEEDS, keys, np.minimum(counts, 2), bits)
        )

    def extend(packed: pa.Table, answered: pa.Table) -> pa.Table:
        block, rows = packets.unpack(packed)
        _, _, keys, checks, _, counts = _extended(rows[text], answered, n, k)
        return packets.packet_table(
            packets.ask(block, WINDOWS, keys, np.minimum(counts, 2), bits, checks)
        )

    def cut(packed: pa.Table, answered: pa.Table) -> pa.Table:
        _, rows = packets.unpack(packed)
        found, starts, _, _, place, counts = _extended(rows[text], answered, n, k)
        starts = starts[(packets.answers(answered, WINDOWS) + counts)[place] > 1]
        steps = np.zeros(len(found.hashes) + 1, np.int32)
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + n, -1)
        gone = np.cumsum(steps[:-1]) > 0
        counts, kept, spans = np.diff(found.bounds), [], []
        data, offsets = words.column_bytes(rows[text])
        data = data.tobytes()
        for i in range(len(rows)):
            own = gone[found.bounds[i] : found.bounds[i + 1]]
            if not joined:
                own_text, at = data[offsets[i] : offsets[i + 1]], slice(*found.bounds[i : i + 2])
                if own.any():
                    places = found.starts[at] - offsets[i], found.ends[at] - offsets[i]
                    own_text = _without(own_text, *places, own)
                spans.append(words.spans(own))
                kept.append(own_text.decode())
                continue
            parts = data[offsets[i] : offsets[i + 1]].split()
            if own.any():
                parts = [w for w, out in zip(parts, own.tolist()) if not out]
            spans.append(words.spans(own))
            kept.append(b" ".join(parts).decode())
        removed = np.concatenate([[0], np.cumsum(gone)])[found.bounds]
        out = rows.append_column("n_words", pa.array(counts, pa.int64()))
        out = out.append_column("n_removed", pa.array(np.diff(removed), pa.int64()))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        out = out.append_column("repeats", pa.array(spans, span))
        return out.append_column("kept_text", pa.array(kept, pa.string()))

    def known(found: pa.Table) -> pa.Table:
        return packets.answer_others(found, limit=1)

    by_block = lambda df: df.groupBy("block")
    asked = by_block(dealt).applyInArrow(seeds, packets.PACKET)
    repeated = asked.groupBy("bucket").applyInArrow(known, packets.ANSWER)
    asked = by_block(dealt).cogroup(by_block(repeated)).applyInArrow(extend, packets.PACKET)
    windows = asked.groupBy("bucket").applyInArrow(known, packets.ANSWER)
    both = repeated.unionByName(windows)
    return by_block(dealt).cogroup(by_block(both)).applyInArrow(cut, schema)
