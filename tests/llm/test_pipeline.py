import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from test_dedup import similar_by_pairs, without_repeats
from test_scores import passages


def rows_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_every_stage_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == [
        "toxicity", "jaccard join", "substring dedup", "decontamination", "sentence pieces",
    ]

    kept = pipeline.stored(stages["toxicity"](spark, docs, tables), "t")
    assert kept.columns == docs.columns
    # this scale has too few labels to reject much; the operator's tests look at the scores
    before = rows_of(kept)
    assert len(before) <= docs.count()

    one = pipeline.stored(stages["jaccard join"](spark, kept, tables), "j")
    assert one.columns == docs.columns
    classes = {c for _, c, *_ in similar_by_pairs(before)}
    after = rows_of(one)
    assert sorted(i for i, _ in after) == sorted(classes)
    assert set(after) <= set(before)

    cut = pipeline.stored(stages["substring dedup"](spark, one, tables), "s")
    assert cut.columns == docs.columns
    wanted = dict(rows_of(cut))
    assert wanted.keys() == dict(after).keys()
    for (i, text), (_, removed, joined) in zip(after, without_repeats(after, 35)):
        # the words that stay, and the layout where nothing goes
        assert b" ".join(wanted[i].encode().split()).decode() == joined
        assert removed or wanted[i] == (text or "")
    assert cut.where(F.col("n_chars") != F.char_length("text")).count() == 0

    clean = pipeline.stored(stages["decontamination"](spark, cut, tables), "d")
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    hits = {i for i, _, n, _ in passages(list(wanted.items()), items) if n}
    assert {i for i, _ in rows_of(clean)} == set(wanted) - hits

    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    last = stages["sentence pieces"](spark, clean, tables).collect()
    texts = dict(rows_of(clean))
    assert {r.doc_id: r.piece_ids for r in last} == {i: library.encode(t) for i, t in texts.items()}

    # the registered query runs the same stages
    whole = {r.doc_id: r.piece_ids for r in entry.queries()["pipeline"](spark, tables).collect()}
    assert whole == {r.doc_id: r.piece_ids for r in last}


def test_rows_that_are_odd(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0),
        (2, "a b", None, "s", 3), (2, "a b", None, "s", 3), (None, "a b", "en", "t", 3),
        (5, "x " * 30_000, "en", "s", 60_000),
    ]
    docs = spark.createDataFrame(rows, schema)
    one = pipeline.jaccard_join(spark, docs, "")
    # null and "" are one text, the three "a b" are one, the long text stays
    assert sorted((r.doc_id, (r.text or "")[:3]) for r in one.collect()) == [(1, ""), (2, "a b"), (5, "x x")]
    cut = pipeline.substring_dedup(spark, one, "").collect()
    assert {r.doc_id: r.text for r in cut} == {1: "", 2: "a b", 5: ""}
    more = docs.withColumn("Text", F.col("text")).withColumn("a.b", F.lit(1))
    more = more.select("doc_id", F.col("Text").alias("text"), "`a.b`", F.lit(2).alias("repeats"))
    assert pipeline.substring_dedup(spark, more, "").columns == ["doc_id", "text", "a.b", "repeats"]
    assert {r.repeats for r in pipeline.substring_dedup(spark, more, "").collect()} == {2}
    assert pipeline.jaccard_join(spark, more, "").columns == ["doc_id", "text", "a.b", "repeats"]
    empty = docs.limit(0)
    for stage in (pipeline.jaccard_join, pipeline.substring_dedup, pipeline.sentence_pieces):
        assert stage(spark, empty, "").count() == 0


def test_substring_dedup_keeps_the_layout_of_texts(spark, tables):
    passage = "\t".join(f"p{i}" for i in range(40))
    rows = [
        (1, "def f(x):\n\treturn  x\r\n\n# end \n"), (2, f"One  é, two.\n\n{passage}  \nThree,\tfour.\n"),
        (3, f"a  b {passage}\n\n  c"), (4, f"  {passage}\n\nText\n"), (5, f"Text \u00a0é\n\n{passage}\n"),
        (6, f" {passage} \n"), (7, f"x {passage} y\n{passage}"), (8, ""), (9, " \n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = dict(rows_of(pipeline.substring_dedup(spark, docs, "")))
    assert cut == {
        1: rows[0][1], 2: "One  é, two.\n\nThree,\tfour.\n", 3: "a  b\n\n  c", 4: "  Text\n",
        5: "Text \u00a0é\n", 6: "", 7: "x y", 8: "", 9: " \n",
    }

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    before = rows_of(docs)
    found = pipeline.substring_dedup(spark, docs, "")
    assert found.where(F.col("n_chars") != F.char_length("text")).count() == 0
    after, unchanged = dict(rows_of(found)), 0
    for (i, text), (_, removed, joined, *_) in zip(before, without_repeats(before, 35)):
        assert b" ".join(after[i].encode().split()).decode() == joined
        if not removed:
            assert after[i] == (text or "")
            unchanged += (text or "") != joined
    assert unchanged > 0
