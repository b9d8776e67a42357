"""A uniform shuffle of rows into shards of exact sizes, with DataFrame functions alone.

The communication matrix says how many rows of each source partition go to each target cell.  Over
all uniform shuffles its law is the multivariate hypergeometric one with the partition sizes as
row sums and the cell sizes as column sums, so it is drawn from that law first.  Then each partition
permutes its rows and cuts them into runs of the drawn lengths, rows are exchanged to their
cells, and each cell permutes again.  Every shard is a row of cells, so that no task holds a shard.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dispatchlens.llm.frames import stored, tidy

MADE = ("shard", "slot", "row_mark", "source_part", "cell")


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows taken without return from ``good + bad`` are good ones.

    By inversion, from the most likely value outwards in the order of likelihood.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    top = log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws)
    left = rng.random() - math.exp(top)
    down, p_down, up, p_up = mode, math.exp(top), mode, math.exp(top)
    while left > 0 and (down > low or up < high):
        next_down = next_up = -1.0
        if down > low:
            next_down = p_down * down * (bad - draws + down)
            next_down /= (good - down + 1) * (draws - down + 1)
        if up < high:
            next_up = p_up * (good - up) * (draws - up)
            next_up /= (up + 1) * (bad - draws + up + 1)
        if next_down >= next_up:
            down, p_down, left = down - 1, next_down, left - next_down
            last = down
        else:
            up, p_up, left = up + 1, next_up, left - next_up
            last = up
        if left <= 0 or max(next_down, next_up) <= 0:
            return last
    return mode


def communication_matrix(sizes: list[int], cells: list[int], seed: int) -> list[list[int]]:
    """Rows of each partition for each cell, drawn; row sums ``sizes``, column sums ``cells``."""
    rng, room, matrix = random.Random(seed), list(cells), []
    for size in sizes:
        row, rest = [], sum(room)
        for i, free in enumerate(room):
            rest -= free
            row.append(hypergeometric(rng, free, rest, size))
            size -= row[-1]
            room[i] -= row[-1]
        matrix.append(row)
    return matrix


def shuffle_into_shards(
    df: DataFrame, shards: int = 24, seed: int = 1, task_rows: int = 50_000, most_parts: int = 1024
) -> DataFrame:
    """Deal the rows of ``df`` into ``shards`` shards in uniformly random order.

    Adds ``shard`` int from 0, and ``slot`` long: the row's place in its shard, without gaps from 0.
    Shard sizes differ by one row at most.  Equal rows are rows of their own; null values do no
    harm, since rows are told apart by their place in the input, and texts are not looked at.  An
    empty table gives an empty result.  Input columns named like the added ones are replaced.

    The input is written once to the shared folder, so that places stay what they are when a
    task runs again: give it narrow rows and join wide ones later.  ``task_rows``: rows that one
    task permutes, more only when that would need over ``most_parts`` partitions or cells.
    The driver sees the partition sizes and the matrix, ``most_parts`` squared numbers at most.
    """
    if shards < 1 or most_parts < shards:
        raise ValueError("there must be a shard, and room for a cell per shard")
    df = tidy(df, [], MADE)
    columns = [F.col(f"`{c}`") for c in df.columns]
    rows = stored(df.withColumn("row_mark", F.monotonically_increasing_id()), "shards")
    total = rows.count()
    parts = max(1, min(most_parts, -(-total // task_rows)))
    rows = rows.withColumn(
        "source_part", F.pmod(F.xxhash64("row_mark", F.lit(seed)), F.lit(parts)).cast("int")
    )
    sizes = [0] * parts
    for part, count in rows.groupBy("source_part").count().collect():
        sizes[part] = count

    per_shard = min(most_parts // shards, max(1, -(-total // (shards * task_rows))))
    lengths = [total // shards + (s < total % shards) for s in range(shards)]
    cells = [n // per_shard + (c < n % per_shard) for n in lengths for c in range(per_shard)]
    matrix = communication_matrix(sizes, cells, seed)

    def constant(values: list, kind: str):
        return F.from_json(F.lit(json.dumps(values)), kind)

    def running(values: list[int]) -> list[int]:
        out, at = [], 0
        for n in values:
            out.append(at)
            at += n
        return out

    order = F.xxhash64("row_mark", F.lit(seed + 1)), F.col("row_mark")
    place = F.row_number().over(Window.partitionBy("source_part").orderBy(*order))
    # a row's cell is the last one that begins before it
    begins = F.get(constant([running(r) for r in matrix], "array<array<int>>"), "source_part")
    again = F.xxhash64("row_mark", F.lit(seed + 2)), F.col("row_mark")
    within = F.row_number().over(Window.partitionBy("cell").orderBy(*again))
    firsts = [
        at for s in range(shards) for at in running(cells[s * per_shard : (s + 1) * per_shard])
    ]
    return (
        rows.withColumn("place", place)
        .withColumn("cell", F.size(F.filter(begins, lambda b: b < F.col("place"))) - 1)
        .withColumn("within", within)
        .select(
            *columns,
            F.floor(F.col("cell") / per_shard).cast("int").alias("shard"),
            (F.get(constant(firsts, "array<bigint>"), "cell") + F.col("within") - 1).alias("slot"),
        )
    )
