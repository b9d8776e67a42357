"""A corpus pipeline: each stage takes documents and gives the documents it keeps."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dispatchlens.llm.decontamination import find_benchmark_passages
from dispatchlens.llm.frames import read, stored, tidy
from dispatchlens.llm.near_duplicates import link_similar
from dispatchlens.llm.queries import held_out
from dispatchlens.llm.sentence_pieces import encode_pieces
from dispatchlens.llm.substring_dedup import remove_repeats
from dispatchlens.llm.toxicity import learn, score

#: documents that score as much are rejected
TOXIC = 0.3


def _carried(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but id and text in one, out of the operators' way, and the names
    of all; of names that differ in case only, the first counts."""
    docs = tidy(docs, ["doc_id", "text"])
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    carried = [F.struct(*others).alias("carried")] if others else []
    return docs.select("doc_id", "text", *carried), docs.columns


def _documents(found: DataFrame, names: list[str], **new: Column) -> DataFrame:
    """``found`` with the columns ``names``, those in ``new`` by their new values."""
    own = {c: F.col(c) if c in ("doc_id", "text") else F.col(f"carried.`{c}`") for c in names}
    return found.select(*(new.get(c, column).alias(c) for c, column in own.items()))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't score as toxic; the scores are learned from labelled ones."""
    docs, names = _carried(docs)
    model = learn(docs, read(spark, sf_dir, "labels"), ~held_out())
    return _documents(score(docs, model).where(F.col("score") < TOXIC), names)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of lowest id of each class of similar documents; one, if rows are equal."""
    docs, names = _carried(docs)
    order = F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    place = F.row_number().over(Window.partitionBy("class_key").orderBy(*order))
    return _documents(link_similar(docs).withColumn("place", place).where("place = 1"), names)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without repeated passages and else as they were; one that was nothing
    else is empty."""
    docs, names = _carried(docs)
    text = F.col("kept_text")
    return _documents(
        remove_repeats(docs, joined=False), names, text=text, n_chars=F.char_length(text).cast("long")
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    docs, names = _carried(docs)
    found = find_benchmark_passages(docs, read(spark, sf_dir, "benchmark"))
    return _documents(found.where(F.col("n_hit") == 0), names)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as piece ids."""
    encoded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.drop("text")


STAGES = [
    ("toxicity", toxicity),
    ("jaccard join", jaccard_join),
    ("substring dedup", substring_dedup),
    ("decontamination", decontamination),
    ("sentence pieces", sentence_pieces),
]
#: SQL can't learn and scan segments, so the pipeline is tested stage by stage instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written out and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
