"""How far the sources of a language are apart in the terms they use, by three-dimensional cells.

The work is a cube: sources times sources times terms, for each language.  It is cut into cells of
one block of sources, another block of sources and one block of terms.  A source block's counts
in a term block are a slice, and a slice is sent to each cell that it is part of.  A cell computes
what its terms add to the divergence of each of its pairs, and these parts are summed along the
terms.  Cells are of bounded size, however many terms a language has or rows a source.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispatchlens.llm.frames import stored, tidy

#: letters of ASCII in lower case and all bytes beyond ASCII stay, everything else is a gap
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: what a task holds before it passes its counts on
_MOST_TERMS, _MOST_BYTES = 300_000, 32 << 20
#: shares are told in parts of this; it is multiplied in two steps, so that counts may reach 10**14
UNIT = 1_000_000_000
_STEPS = (31_250, 32_000)


def terms(text: str | None) -> list[bytes]:
    """Terms of a text: runs of letters and of characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode().translate(FOLD).split()


def count_terms(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` of each term by ``keys`` (strings), as parts to add up.

    Every combination of keys has a part without term, whether its texts hold terms or not.
    """
    names = [*keys, "term", "n", "docs"]

    def told(held: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for key, (counts, found) in held.items():
            own = [None, *counts]
            values = [[k] * len(own) for k in key]
            term = pa.array(own, pa.binary()).cast(pa.string())
            n, docs = ([0, *c.values()] for c in (counts, {t: found[t] for t in counts}))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(v, pa.string()) for v in values), term, pa.array(n, pa.int64()),
                 pa.array(docs, pa.int64())], names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(lambda: (Counter(), Counter()))
        size = room = 0
        for batch in batches:
            for *key, body in zip(*(batch[c].to_pylist() for c in (*keys, text))):
                counts, found = held[tuple(key)]
                own = terms(body)
                before = len(counts)
                counts.update(own)
                different = set(own)
                found.update(different)
                size += len(counts) - before
                room += sum(map(len, different)) if len(counts) > before else 0
                if size > _MOST_TERMS or room > _MOST_BYTES:
                    yield from told(held)
                    held.clear()
                    size = room = 0
        yield from told(held)

    ddl = ", ".join(f"{k} string" for k in keys)
    return docs.select(*keys, text).mapInArrow(run, f"{ddl}{', ' if keys else ''}term string, n long, docs long")


def share(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * count / of), in 64 bits."""
    whole, rest = np.divmod(count * _STEPS[0], of)
    return 1 + whole * _STEPS[1] + rest * _STEPS[1] // of


def _share(count: Column, of: Column) -> Column:
    first = count * F.lit(_STEPS[0]).cast("long")
    rest = (first % of) * F.lit(_STEPS[1]).cast("long")
    div = lambda a, b: F.call_function("div", a, b)
    return 1 + div(first, of) * F.lit(_STEPS[1]).cast("long") + div(rest, of)


def cell_parts(groups: pa.Table, entries: pa.Table, smoothing: int) -> tuple[np.ndarray, ...]:
    """What one cell adds to the divergence of its pairs: places of both groups, and the part.

    ``groups``: ``place``, ``block`` and ``n`` of each group, with ``size``, the terms kept in the
    language, and ``here``, those in the cell.  ``entries``: ``place``, ``term`` and ``n``.
    """
    order = np.argsort(groups["place"].to_numpy())
    place, block, n = (groups[c].to_numpy()[order] for c in ("place", "block", "n"))
    size, here = groups["size"][0].as_py(), groups["here"][0].as_py()
    codes = pc.dictionary_encode(entries["term"].combine_chunks())
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    counts = np.zeros((len(place), len(codes.dictionary)), np.int64)
    counts[np.searchsorted(place, entries["place"].to_numpy()), codes.indices.to_numpy()] = entries["n"]
    left, right, parts = [], [], []
    of = n + smoothing * size
    if size:
        shares = share(counts + smoothing, of[:, None])
        absent = share(np.full(len(of), smoothing), of)
    low, high = block.min(), block.max()
    for i in np.flatnonzero(block == low):
        others = np.flatnonzero((block == high) & (place > place[i]))
        if not len(others):
            continue
        part = np.zeros(len(others), np.int64)
        if size:  # terms that neither block holds differ by what smoothing gives them
            part += np.abs(shares[others] - shares[i]).sum(1)
            part += np.abs(absent[others] - absent[i]) * (here - counts.shape[1])
        left.append(np.full(len(others), place[i]))
        right.append(place[others])
        parts.append(part)
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (left, right, parts))


def divergences(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = 30,
    smoothing: int = 5,
    top: int = 50,
    block_groups: int = 64,
    block_terms: int = 4096,
) -> DataFrame:
    """Divergences between the sources of each language, and the terms that set a source apart.

    A term is a run of letters A-Z, a-z (told in lower case) and characters beyond ASCII.  A language
    keeps the terms of at least ``least_docs`` of its documents.  A group is a language and source, or a
    language as a whole, and gives each kept term 1 + floor(10**9 (count + s) / (N + s V)), with s
    the ``smoothing``, N the group's occurrences of kept terms and V their number.  Returns rows of
    ``lang``, ``source``, ``part``, ``item``, ``value`` long, ``rank`` int:

    * part ``pair``: for each other source of the language the sum of differences over all kept terms
    * part ``term``: up to ``top`` terms that the source has and favours most against its language

    Ranks start at 1 for each group and part, by falling value, then by the item's bytes.  All numbers
    are exact while a group has less than 10**14 occurrences.  Null text, language and source count
    as ''; a group without kept terms gives each the same share; without any kept term in the
    language all differences are 0.  Equal rows count each.  An empty table gives an empty result;
    other columns are not looked at.
    """
    docs = tidy(docs, [text, lang, source])
    named = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.col(text).alias("text"),
    )
    # one shuffle by language and term serves both the sums and the choice of terms
    by_term = Window.partitionBy("lang", "term")
    counted = (
        count_terms(named, ["lang", "source"])
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    kept = stored(
        counted.withColumns(
            {
                "docs": F.sum("docs").over(by_term),
                "total": F.sum("n").over(by_term),
                "first": F.row_number().over(by_term.orderBy("source")) == 1,
            }
        )
        .where(F.col("term").isNull() | (F.col("docs") >= least_docs))
        .drop("docs"),
        "terms",
    )
    held = kept.where("term IS NOT NULL")
    once = F.count_if(F.col("first") & F.col("term").isNotNull())
    langs = kept.groupBy("lang").agg(once.alias("size"), F.sum("n").alias("lang_n"))
    of_lang = Window.partitionBy("lang")
    groups = stored(
        kept.groupBy("lang", "source")
        .agg(F.sum("n").alias("of"))
        .withColumn("place", F.row_number().over(of_lang.orderBy("source")).cast("long") - 1)
        .withColumn("blocks", F.ceil(F.count("*").over(of_lang) / block_groups))
        .join(langs, "lang")
        .withColumn("block", F.call_function("div", "place", F.lit(block_groups)))
        .withColumn("slabs", F.greatest(F.ceil(F.col("size") / block_terms), F.lit(1))),
        "groups",
    )
    entries = held.join(groups, ["lang", "source"])
    slab = F.expr("pmod(xxhash64(term), slabs)").alias("slab")

    def to_cells(rows: DataFrame, *columns: str | Column) -> DataFrame:
        """Rows sent to every cell that their source block is part of."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
        return rows.select("*", other).select(
            F.col("lang").alias("lang"),
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            *(F.col(c).alias(c) if isinstance(c, str) else c for c in columns),
        )

    here = held.where("first").join(groups.select("lang", "slabs").distinct(), "lang")
    here = here.groupBy("lang", slab).agg(F.count("*").alias("here"))
    every = groups.withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slabs") - 1)))
    frames = to_cells(
        every.join(here, ["lang", "slab"], "left").withColumn("here", F.coalesce("here", F.lit(0))),
        "slab", "place", "block", F.col("of").alias("n"), "size", "here",
    )
    slices = to_cells(entries, slab, "place", "term", "n")

    def cell(key, own: pa.Table, held: pa.Table) -> pa.Table:
        names = ["lang", "left", "right", "part"]
        if not len(own):
            raise ValueError(f"cell {key} without groups")
        left, right, parts = cell_parts(own, held, smoothing)
        lang = pa.array([key[0].as_py()] * len(left), pa.string())
        return pa.Table.from_arrays([lang, pa.array(left), pa.array(right), pa.array(parts)], names)

    cube = ["lang", "low", "high", "slab"]
    parts = frames.groupBy(*cube).cogroup(slices.groupBy(*cube)).applyInArrow(
        cell, "lang string, left long, right long, part long"
    )
    sums = parts.groupBy("lang", "left", "right").agg(F.sum("part").alias("value"))
    both = F.explode(
        F.array(
            F.struct(F.col("left").alias("place"), F.col("right").alias("to")),
            F.struct(F.col("right").alias("place"), F.col("left").alias("to")),
        )
    ).alias("way")
    name = groups.select("lang", "place", "source")
    pairs = (
        sums.select("lang", both, "value")
        .select("lang", "way.*", "value")
        .join(name, ["lang", "place"])
        .join(name.select("lang", F.col("place").alias("to"), F.col("source").alias("item")), ["lang", "to"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    own = _share(F.col("n") + smoothing, F.col("of") + smoothing * F.col("size"))
    whole = _share(F.col("total") + smoothing, F.col("lang_n") + smoothing * F.col("size"))
    favoured = entries.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (own - whole).alias("value")
    ).where("value > 0")
    rank = F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    )
    return (
        pairs.withColumn("rank", rank)
        .unionByName(favoured.withColumn("rank", rank).where(F.col("rank") <= top))
        .select("lang", "source", "part", "item", "value", "rank")
    )
