"""Blocks of rows ask hash buckets about keys, and get answers in the order of asking.

A block (some megabytes of texts) sends each bucket one packet: its different 64-bit keys in that
bucket, sorted, with a small count each.  A bucket adds up the counts of equal keys over all
packets and answers every packet with one number per key.  A key therefore travels once per block,
however often it occurs: frequent keys meet no task with all of their rows.  With blocks too
many for large packets this is, at worst, an ordinary shuffle of one row per key and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from dispatchlens.llm import words, worker

U64 = np.uint64
PACKET = "bucket int, block long, kind int, keys binary, checks binary, counts binary"
ANSWER = "block long, kind int, bucket int, answer binary"
_PACKET_ARROW = pa.schema(
    [
        ("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()),
        ("keys", pa.binary()), ("checks", pa.binary()), ("counts", pa.binary()),
    ]
)
_ANSWER_ARROW = pa.schema(
    [("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("answer", pa.binary())]
)


def pack(df: DataFrame, text: str, size: int) -> DataFrame:
    """``df`` in blocks (``block`` long, ``rows`` binary): runs of input rows with about ``size`` bytes
    of text, compressed as a whole.

    Every user of the blocks must group them by ``block`` first, so that all read one shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.give_back()
        number = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for batch in batches:
            for piece in words.pieces(batch, text, size):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, piece.schema, options=options) as out:
                    out.write_batch(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    ["block", "rows"],
                )
                number += 1

    return df.mapInArrow(run, "block long, rows binary")


def unpack(block: pa.Table) -> tuple[int, pa.Table]:
    """Number and rows of a block."""
    worker.give_back()
    with pa.ipc.open_stream(block["rows"][0].as_buffer()) as rows:
        return block["block"][0].as_py(), rows.read_all()


def shrink(values: np.ndarray) -> bytes:
    """Numbers as bytes: byte planes one after the other, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(values.dtype.char.encode() + planes.tobytes())


def restore(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    kind = np.dtype(raw[:1].decode())
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def shrink_sorted(keys: np.ndarray) -> bytes:
    return shrink(np.diff(keys, prepend=U64(0)))


def restore_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(restore(data), dtype=U64)


def small(counts: np.ndarray) -> np.ndarray:
    """The counts in the narrowest type that holds them."""
    top = int(counts.max()) if len(counts) else 0
    for kind in (np.uint8, np.uint16, np.uint32):
        if top <= np.iinfo(kind).max:
            return counts.astype(kind)
    return counts.astype(np.uint64)


def unique(keys: np.ndarray, checks: np.ndarray | None = None):
    """Different keys (with their checks), sorted; the place of each input among them; counts."""
    order = np.argsort(keys, kind="stable") if checks is None else np.lexsort((checks, keys))
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    c = None
    if checks is not None:
        c = checks[order]
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    place = np.empty(len(k), np.int64)
    place[order] = np.cumsum(new) - 1
    return k[at], None if c is None else c[at], place, np.diff(at, append=len(k))


def bucket_edges(keys: np.ndarray, bucket_bits: int) -> np.ndarray:
    """Where the sorted keys of each of 2**bucket_bits buckets begin; the last entry is the end."""
    tops = np.arange(1, 1 << bucket_bits, dtype=U64) << U64(64 - bucket_bits)
    return np.concatenate([[0], np.searchsorted(keys, tops), [len(keys)]])


def ask(
    block: int,
    kind: int,
    keys: np.ndarray,
    counts: np.ndarray,
    bucket_bits: int,
    checks: np.ndarray | None = None,
) -> list[dict]:
    """Packets of sorted different keys, one for each bucket that has any."""
    edges, rows = bucket_edges(keys, bucket_bits), []
    for bucket in np.flatnonzero(np.diff(edges)):
        a, b = edges[bucket], edges[bucket + 1]
        rows.append(
            {
                "bucket": int(bucket),
                "block": block,
                "kind": kind,
                "keys": shrink_sorted(keys[a:b]),
                "checks": None if checks is None else shrink(checks[a:b]),
                "counts": shrink(small(counts[a:b])),
            }
        )
    return rows


def packet_table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _PACKET_ARROW)


def answer_others(packets: pa.Table, limit: int | None = None) -> pa.Table:
    """Every packet's keys answered with their count in all other packets of the kind.

    ``limit``: larger counts are told as this, where the asker only compares.
    """
    worker.give_back()
    rows = []
    kinds = packets["kind"].to_numpy()
    for kind in np.unique(kinds):
        group = packets.filter(pa.array(kinds == kind))
        keys = [restore_sorted(x) for x in group["keys"].to_pylist()]
        checks = [x and restore(x) for x in group["checks"].to_pylist()]
        counts = [restore(x).astype(np.int64) for x in group["counts"].to_pylist()]
        _, _, place, _ = unique(
            np.concatenate(keys), np.concatenate(checks) if checks[0] is not None else None
        )
        own = np.concatenate(counts)
        told, at = np.bincount(place, own).astype(np.int64)[place] - own, 0
        if limit is not None:
            told = np.minimum(told, limit)
        for i, k in enumerate(keys):
            rows.append(
                {
                    "block": group["block"][i].as_py(),
                    "kind": int(kind),
                    "bucket": group["bucket"][i].as_py(),
                    "answer": shrink(small(told[at : at + len(k)])),
                }
            )
            at += len(k)
    return pa.Table.from_pylist(rows, _ANSWER_ARROW)


def answers(table: pa.Table, kind: int) -> np.ndarray:
    """One block's answers of a kind, in the order of its sorted keys."""
    rows = sorted(
        (b, a)
        for k, b, a in zip(
            table["kind"].to_pylist(), table["bucket"].to_pylist(), table["answer"].to_pylist()
        )
        if k == kind
    )
    parts = [restore(a) for _, a in rows]
    return np.concatenate([p.astype(np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
