"""Stupid-backoff scores of documents under a language model of all other documents.

The n-gram counts of the corpus are a table split by hash.  Blocks of documents send their different
n-grams with counts to it, and the total counts come back joined to the n-grams in the order
they were sent (see ``packets``); then each word is scored and scores are summed per document.
An n-gram travels once per block, so that frequent ones cost no more than others.  From three words
on, an n-gram is asked for only where both of its shorter ones occur in other documents; where one
doesn't, nor does the n-gram, and nobody else asks for it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.llm import packets, words
from dispatchlens.llm.frames import text_bytes, tidy

MADE = ("n_words", "log_score", "per_word", "by_order")
#: scores are summed as whole millionths, so that the sum has one value
UNIT = 1_000_000
CORPUS = 0  # kind of packets that ask for the number of words


class Places:
    """The n-grams of one order in a block, at the places where they could be in others, too."""

    def __init__(self, order: int, found: words.Words, shorter: np.ndarray | None):
        """``shorter``: counts in other documents of the n-grams of one word less, by place."""
        room = found.room()
        fits = room >= order
        if shorter is not None and order > 2:
            fits[:-1] &= (shorter[:-1] > 0) & (shorter[1:] > 0)
        self.places, self.size = np.flatnonzero(fits), len(room)
        self.of_text = found.texts()[self.places]
        grams = found.sequences(order)[self.places]
        self.keys, _, self.which, self.counts = packets.unique(grams)

    def others(self, answers: np.ndarray) -> np.ndarray:
        """For every word of the block, how often the n-gram from it on is in other documents."""
        out = np.zeros(self.size, np.int64)
        if len(self.places):
            own = self.of_text * len(self.keys) + self.which
            _, _, at, counts = packets.unique(own)
            out[self.places] = (answers + self.counts)[self.which] - counts[at]
        return out


def others_by_order(found: words.Words, answered: pa.Table, order: int) -> list[np.ndarray]:
    """By order, from one word on, the counts in other documents at every place."""
    counts: list[np.ndarray] = []
    for k in range(1, order + 1):
        own = Places(k, found, counts[-1] if counts else None)
        counts.append(own.others(packets.answers(answered, k)))
    return counts


def score_block(found: words.Words, counts: list[np.ndarray], backoff: float, total: int):
    """Scores in millionths of every word and the order each was found at, 0 for unseen words."""
    n = len(found.hashes)
    done, units, level = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64)
    within = np.arange(n) - np.repeat(found.bounds[:-1], np.diff(found.bounds))
    penalty = round(math.log(backoff) * UNIT)
    for k in range(len(counts), 0, -1):
        # n-gram of order k that ends with the word, and its context before the word
        first = np.maximum(np.arange(n) - (k - 1), 0)
        fits = within >= k - 1
        seen = np.where(fits, counts[k - 1][first], 0)
        base = counts[k - 2][first] if k > 1 else np.full(n, total)
        new = ~done & (seen > 0)
        units[new] += np.round(np.log(seen[new] / base[new]) * UNIT).astype(np.int64)
        level[new] = k
        done |= new
        if k > 1:  # words that had a context of this length and did not match it back off
            units[~done & fits] += penalty
    units[~done] += round(math.log(0.5 / max(1, total)) * UNIT)
    return units, level


def score_documents(
    docs: DataFrame,
    text: str = "text",
    order: int = 3,
    backoff: float = 0.4,
    block_bytes: int = 6 << 20,
    bucket_keys: int = 1 << 20,
) -> DataFrame:
    """Score each document by the n-grams, up to ``order``, of all other rows of ``docs``.

    Words are runs of bytes that are not ASCII white space.  With c the counts over all other
    documents, a word scores c(context word) / c(context) for the longest context of up to
    ``order - 1`` words of its document with c(context word) > 0, times ``backoff`` for each
    shorter context that was gone to; without context c(word) / N, where N is the number of words
    in ``docs``; a word of no other document scores 1 / 2N.  Adds:

    * ``n_words`` long
    * ``log_score`` double: sum of the natural logarithms, each rounded to a millionth
    * ``per_word`` double: the mean, null for texts without words
    * ``by_order`` array of long: how many words were found at each order, from 0 (unseen) on

    A null or empty text scores 0.  Equal rows are documents of their own and tell of each other.
    An empty table gives an empty result.  Input columns named like the added ones are replaced.
    """
    docs = tidy(docs, [text], MADE)
    total = docs.agg(F.sum(text_bytes(F.col(text))).alias("n")).first()["n"] or 0
    bits = max(7, (total * order // 6 // bucket_keys).bit_length())
    dealt = packets.pack(docs, text, block_bytes)
    added = "n_words long, log_score double, per_word double, by_order array<long>"
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(added).fields)

    def first(packed: pa.Table) -> pa.Table:
        block, rows = packets.unpack(packed)
        found = words.split(rows[text])
        one, size = np.zeros(1, np.uint64), np.array([len(found.hashes)])
        asked = packets.ask(block, CORPUS, one, size, bits)
        for k in range(1, min(2, order) + 1):
            own = Places(k, found, None)
            asked += packets.ask(block, k, own.keys, own.counts, bits)
        return packets.packet_table(asked)

    def longer(k: int):
        def ask(packed: pa.Table, answered: pa.Table) -> pa.Table:
            block, rows = packets.unpack(packed)
            found = words.split(rows[text])
            own = Places(k, found, others_by_order(found, answered, k - 1)[-1])
            return packets.packet_table(packets.ask(block, k, own.keys, own.counts, bits))

        return ask

    def apply(packed: pa.Table, answered: pa.Table) -> pa.Table:
        _, rows = packets.unpack(packed)
        found = words.split(rows[text])
        size = int(packets.answers(answered, CORPUS)[0]) + len(found.hashes)
        counts = others_by_order(found, answered, order)
        units, level = score_block(found, counts, backoff, size)
        per_text = np.diff(found.bounds)
        sums = np.diff(np.concatenate([[0], np.cumsum(units)])[found.bounds])
        levels = np.bincount(
            found.texts() * (order + 1) + level, minlength=len(rows) * (order + 1)
        ).reshape(len(rows), order + 1)
        out = rows.append_column("n_words", pa.array(per_text, pa.int64()))
        out = out.append_column("log_score", pa.array(sums / UNIT, pa.float64()))
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = sums / UNIT / per_text
        out = out.append_column("per_word", pa.array(mean, pa.float64(), mask=per_text == 0))
        return out.append_column(
            "by_order", pa.array(levels.tolist(), pa.list_(pa.int64()))
        )

    def add_up(asked: pa.Table) -> pa.Table:
        return packets.answer_others(asked)

    by_block = lambda df: df.groupBy("block")
    asked = by_block(dealt).applyInArrow(first, packets.PACKET)
    table = asked.groupBy("bucket").applyInArrow(add_up, packets.ANSWER)
    for k in range(3, order + 1):
        asked = by_block(dealt).cogroup(by_block(table)).applyInArrow(longer(k), packets.PACKET)
        table = table.unionByName(asked.groupBy("bucket").applyInArrow(add_up, packets.ANSWER))
    return by_block(dealt).cogroup(by_block(table)).applyInArrow(apply, schema)
