"""Which tokens of one tokenizer stand for which of another, by interval coalescing.

Both tokenizers cut the same bytes.  All tokens A and B of many texts are sorted together by start
(lexsort), and their ends accumulated to a running maximum: a group of tokens ends where the next
start reaches that maximum, which is where tokens of both end.  Within groups, every token A is
expanded to the tokens B that its bytes overlap.

Links are counted over the corpus in two passes.  A block of texts is encoded once; it keeps its
links as places in its sorted list of different id pairs, and tells each pair with one count, so a
pair met everywhere costs a row per block.  The counts are added up and joined back to blocks.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.llm import words, worker
from dispatchlens.llm.frames import stored, tidy
from dispatchlens.llm.packets import restore, restore_sorted, shrink, shrink_sorted, small
from dispatchlens.llm.token_counts import _byte_letters

MADE = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
_ADDED = ", ".join(f"{name} long" for name in MADE[:-1]) + ", groups string"
_BLOCK = "block long, rows binary, links binary, marks binary, pairs binary, counts binary"
_NEW_A, _NEW_B, _NEW_GROUP = 1, 2, 4
_LOW = (1 << 32) - 1
_BLANKS = " \t\n\r\x0b\x0c"
_OTHER_BLANKS = re.compile(r"[^\S \t\n\r\x0b\x0c]")
#: characters of new chunks that are encoded at once, and of all chunks that a worker holds
_RUN, _MOST_HELD = 1 << 17, 1 << 21


class _Places(dict):
    """The place of each chunk in the table, given out at the first question."""

    def __missing__(self, chunk: str) -> int:
        place = self[chunk] = len(self)
        return place


class Encoders:
    """Both tokenizers, and the bytes of their tokens.

    Texts are cut into chunks, a run of white space and what follows up to the next one, where neither
    tokenizer has a token across the cut: A takes words apart there, and B has no piece that holds
    such a white space after another character.  Each different chunk is encoded once, many of them
    in one text.  A text with other white space than that of ASCII is a chunk of its own.
    """

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self._a = tokenizers.Tokenizer.from_str(spec)
        # strings of special tokens inside texts are ordinary text
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = {letter: i for i, letter in enumerate(_byte_letters())}
        parts = json.loads(spec)
        entries = parts["model"]["vocab"] | {x["content"]: x["id"] for x in parts["added_tokens"]}
        bytes_a = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            bytes_a[i] = bytes(byte_of[c] for c in token) if set(token) <= byte_of.keys() else b""
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.bytes = (bytes_a, bytes_b)
        self.sizes = [np.array([len(x) for x in table], np.int32) for table in self.bytes]
        plain = [p.replace("▁", " ") for p in pieces]
        uncut = [c for c in _BLANKS if any(re.search(f"[^{_BLANKS}]{c}", p) for p in plain)]
        other = f"(?:[{''.join(uncut)}][{_BLANKS}]*[^{_BLANKS}]*)*" if uncut else ""
        self._chunks = re.compile(f"[{_BLANKS}]+[^{_BLANKS}]*{other}")
        self._whole = " " in uncut or not _cuts_at_white_space(parts)
        self._forget()

    def _forget(self) -> None:
        self._places, self._held = _Places(), 0
        self._ids = [[np.zeros(0, np.int32)] for _ in self.bytes]
        self._counts = [[np.zeros(0, np.int64)] for _ in self.bytes]
        self._spelled = [np.zeros(0, bool)]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids A and B of a blank and each text, one text after the other, and how many each text has;
        none for a text if either doesn't spell that."""
        if self._held > _MOST_HELD:
            self._forget()
        known, places, rows = len(self._places), self._places, []
        for text in texts:
            if not text:
                found = ()
            elif self._whole or _OTHER_BLANKS.search(text):
                found = (" " + text,)
            else:
                found = self._chunks.findall(" " + text)
            rows.append(np.fromiter(map(places.__getitem__, found), np.int64, len(found)))
        self._learn(list(islice(places, known, None)))
        spelled = np.concatenate(self._spelled)
        rows = [row if spelled[row].all() else row[:0] for row in rows]
        each = np.array([len(row) for row in rows], np.int64)
        flat, edges = np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([[0], np.cumsum(each)])
        ids, counts = [], []
        for side in (0, 1):
            self._ids[side] = [np.concatenate(self._ids[side])]
            self._counts[side] = [np.concatenate(self._counts[side])]
            many = self._counts[side][0]
            first = np.cumsum(many) - many
            own, sums = many[flat], np.concatenate([[0], np.cumsum(many[flat])])
            at = np.arange(sums[-1]) + np.repeat(first[flat] - sums[:-1], own)
            ids.append(self._ids[side][0][at])
            counts.append(np.diff(sums[edges]))
        self._spelled = [spelled]
        return ids, counts

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks into the table, in the order of their places."""
        self._held += sum(map(len, chunks))
        run: list[str] = []
        size = 0
        for chunk in chunks:
            if chunk[-1] in _BLANKS or "▁" in chunk or len(chunk) > _RUN or _OTHER_BLANKS.search(chunk):
                self._learn_run(run)
                self._learn_one(chunk)
                run, size = [], 0
                continue
            run.append(chunk)
            size += len(chunk)
            if size > _RUN:
                self._learn_run(run)
                run, size = [], 0
        self._learn_run(run)

    def _learn_run(self, run: list[str]) -> None:
        """Chunks that may stand one after the other, in one text."""
        if not run:
            return
        text = " x" + "".join(run)  # B writes the blank before the x by itself
        found = (self._a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self._b.encode(text[1:]))
        ends = 2 + np.cumsum([0, *(len(c.encode()) for c in run)])
        spelled, cuts = text.encode(), []
        for ids, table, size in zip(found, self.bytes, self.sizes):
            at = np.cumsum(size[ids], dtype=np.int64)
            cut = np.searchsorted(at, ends)
            if b"".join(map(table.__getitem__, ids)) != spelled or (at[cut] != ends).any():
                for chunk in run:
                    self._learn_one(chunk)
                return
            cuts.append(cut + 1)
        for side, (ids, cut) in enumerate(zip(found, cuts)):
            self._ids[side].append(np.array(ids[cut[0] :], np.int32))
            self._counts[side].append(np.diff(cut))
        self._spelled.append(np.ones(len(run), bool))

    def _learn_one(self, chunk: str) -> None:
        a = self._a.encode(chunk, add_special_tokens=False).ids
        if chunk[0] == " " and len(chunk) > 1:
            b = self._b.encode(chunk[1:])
        else:  # after a word, whose own pieces go
            b = self._b.encode("x" + chunk)[len(self._b.encode("x")) :]
        spelled = all(
            b"".join(map(table.__getitem__, ids)) == chunk.encode() for ids, table in zip((a, b), self.bytes)
        )
        for side, ids in enumerate((a, b)):
            self._ids[side].append(np.array(ids, np.int32))
            self._counts[side].append(np.array([len(ids)], np.int64))
        self._spelled.append(np.array([spelled]))


def _cuts_at_white_space(spec: dict) -> bool:
    """Whether a file's words never go on over white space that follows another character."""
    steps = spec["pre_tokenizer"] or {}
    return (
        spec["normalizer"] is None
        and steps.get("type") == "ByteLevel"
        and steps.get("use_regex", False)
        and not steps.get("add_prefix_space", True)
    )


def encoders(spec: str, model: bytes) -> Encoders:
    """Both tokenizers of files' contents, kept by each Python worker."""
    return worker.table(("align", hash(spec), hash(model)), lambda: Encoders(spec, model))


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every interval the number of its group, from 0 on in the order of places.

    Intervals that overlap, also by way of others, are of one group; touching ones are not.
    """
    order = np.lexsort((ends, starts))
    top = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), bool)
    breaks[1:] = starts[order][1:] >= top[:-1]
    groups = np.empty(len(order), np.int32)
    groups[order] = np.cumsum(breaks, dtype=np.int32)
    return groups


def overlaps(
    a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B of all overlapping intervals, by A; each side is sorted and disjoint."""
    first = np.searchsorted(b_ends, a_starts, "right")
    many = np.searchsorted(b_starts, a_ends, "left") - first
    in_a = np.repeat(np.arange(len(a_starts)), many)
    in_b = np.arange(len(in_a)) + np.repeat(first - (np.cumsum(many) - many), many)
    return in_a, in_b


def align(ids: list[np.ndarray], counts: list[np.ndarray], sizes: list[np.ndarray]):
    """Links of many texts one after the other: pairs of ids, and what each link is the first of.

    ``ids`` A and B, how many of them each text has, and ``sizes`` of tokens in bytes.  Both sides spell
    the same bytes.  Also counts per text: tokens A and B, groups, links.
    """
    ends = [np.cumsum(size[i], dtype=np.int32) for size, i in zip(sizes, ids)]
    starts = [end - size[i] for end, size, i in zip(ends, sizes, ids)]
    group_a = coalesce(np.concatenate(starts), np.concatenate(ends))[: len(ids[0])]
    in_a, in_b = overlaps(starts[0], ends[0], starts[1], ends[1])
    texts = len(counts[0])
    text_of_a = np.repeat(np.arange(texts), counts[0])
    pairs = ids[0][in_a].astype(np.int64) << 32 | ids[1][in_b]
    new_group = np.diff(group_a[in_a], prepend=-1) > 0
    marks = (
        (np.diff(in_a, prepend=-1) > 0) * _NEW_A
        + (np.diff(in_b, prepend=-1) > 0) * _NEW_B
        + new_group * _NEW_GROUP
    ).astype(np.uint8)
    text_of_link = text_of_a[in_a]
    per_text = {
        "n_a": counts[0],
        "n_b": counts[1],
        "n_groups": np.bincount(text_of_link[new_group], minlength=texts),
        "n_links": np.bincount(text_of_link, minlength=texts),
    }
    return pairs, marks, per_text


@lru_cache(maxsize=1)
def _numbers(many: int) -> pa.Array:
    """Each number below ``many`` with each separator: ',', '|', ';' and none."""
    return pa.array([f"{i}{sep}" for i in range(many) for sep in (",", "|", ";", "")])


def write_groups(pairs: np.ndarray, marks: np.ndarray, links: np.ndarray) -> pa.Array:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3``, from all links and the number of links of
    each text."""
    if not len(pairs):
        return pa.array([""] * len(links), pa.string())
    group = np.cumsum((marks & _NEW_GROUP) > 0)
    text = np.repeat(np.arange(len(links)), links)
    sides = [(marks & _NEW_A) > 0, (marks & _NEW_B) > 0]
    ids = np.concatenate([pairs[sides[0]] >> 32, pairs[sides[1]] & _LOW])
    # by group, tokens A before tokens B
    key = np.concatenate([2 * group[first] + i for i, first in enumerate(sides)])
    text = np.concatenate([text[first] for first in sides])
    order = np.argsort(key, kind="stable")
    ids, key, text = ids[order], key[order], text[order]
    step = np.diff(key, append=0)
    separator = np.where(step == 0, 0, np.where(key % 2 == 0, 1, 2))
    separator[np.diff(text, append=-1) != 0] = 3
    table = _numbers(1 << max(16, int(ids.max()).bit_length()))
    ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(links)))])
    written = table.take(pa.array(4 * ids + separator))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), written), "")


def align_tokens(
    docs: DataFrame,
    vocabulary: str,
    model: str,
    text: str = "text",
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """Align the tokens A of ``vocabulary`` (byte-level, a ``tokenizers`` file) with the tokens B of
    ``model`` (a ``sentencepiece`` file), text by text, in place of the column ``text``.

    Both are encoded without special tokens; A reads a blank and the text, as B adds a blank itself.
    A text that is null or empty, or whose tokens A or B don't spell that, counts as without
    tokens: all zero and no groups.  Adds, next to all other columns:

    * ``n_a``, ``n_b`` long: tokens; ``n_groups``: pieces between common ends of both
    * ``n_links`` long: pairs of tokens that share bytes
    * ``count_sum`` long: over the links, how many links of all texts hold the same two ids
    * ``n_best`` long: links whose count is the highest that their id B has, ties included
    * ``groups`` string: ids of each group, ``a1,a2|b1;a3|b2,b3``; empty without tokens

    Equal rows are counted each.  An empty table gives an empty result.  Input columns named like
    the added ones are replaced.  Files are read on the driver and broadcast (a few megabytes).
    """
    docs = tidy(docs, [text], MADE)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((Path(vocabulary).read_text("utf-8"), Path(model).read_bytes()))
    carried = [c for c in docs.columns if c != text]
    schema = T.StructType(
        [f for f in docs.schema.fields if f.name != text] + T.StructType.fromDDL(_ADDED).fields
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoders(*shared.value)
        number = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for batch in batches:
            for piece in words.pieces(batch, text, block_bytes):
                pairs, marks, per_text = align(*own.encode(piece[text].to_pylist()), own.sizes)
                known, at, counts = np.unique(pairs, return_inverse=True, return_counts=True)
                kept = pa.RecordBatch.from_pydict(
                    {c: piece[c] for c in carried} | {c: pa.array(x) for c, x in per_text.items()}
                )
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, kept.schema, options=options) as out:
                    out.write_batch(kept)
                row = {
                    "block": number,
                    "rows": sink.getvalue().to_pybytes(),
                    "links": shrink(small(at)),
                    "marks": shrink(marks),
                    "pairs": shrink_sorted(known.astype(np.uint64)),
                    "counts": shrink(small(counts)),
                }
                yield pa.RecordBatch.from_pylist([row], _arrow(_BLOCK))
                number += 1

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = restore_sorted(row["pairs"]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(pairs), row["block"])),
                        pa.array(pairs),
                        pa.array(restore(row["counts"]).astype(np.int64)),
                    ],
                    ["block", "pair", "n"],
                )

    def apply(block: pa.Table, told: pa.Table) -> pa.Table:
        worker.give_back()
        (row,) = block.to_pylist()
        with pa.ipc.open_stream(row["rows"]) as stream:
            out = stream.read_all()
        pairs = restore_sorted(row["pairs"]).astype(np.int64)
        links, marks = restore(row["links"]).astype(np.int64), restore(row["marks"])
        order = np.argsort(told["pair"].to_numpy())
        if not np.array_equal(told["pair"].to_numpy()[order], pairs):
            raise ValueError(f"block {row['block']}: counts of other pairs than its own")
        count, best = told["count"].to_numpy()[order], told["best"].to_numpy()[order]
        per_text = out["n_links"].to_numpy()
        edges = np.concatenate([[0], np.cumsum(per_text)])
        for name, values in (("n_best", best.astype(np.int64)), ("count_sum", count)):
            sums = np.concatenate([[0], np.cumsum(values[links])])
            out = out.append_column(name, pa.array(np.diff(sums[edges]), pa.int64()))
        return out.append_column("groups", write_groups(pairs[links], marks, per_text))

    blocks = stored(docs.mapInArrow(encode, _BLOCK), "alignment")
    told = blocks.select("block", "pairs", "counts").mapInArrow(tell, "block long, pair long, n long")
    summed = told.groupBy("pair").agg(F.sum("n").alias("count"))
    counted = summed.withColumn("b", F.col("pair").bitwiseAND(F.lit(_LOW)))
    highest = counted.groupBy("b").agg(F.max("count").alias("highest"))
    counted = stored(
        counted.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")),
        "pair-counts",
    )
    answers = told.join(counted, "pair").select("block", "pair", "count", "best")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(","))])
