import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from dispatchlens.llm import queries, token_alignment
from dispatchlens.llm.token_alignment import Encoders, align_tokens, coalesce, overlaps

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "\n\n a\n", "a  b   c    d ", "▁", "a▁b", "été ́x", "a\x1cb\x85c　d\xa0e", "\x00\x1f",
    "你好 世界 🙂👍🏽 12345 x1y2", "don't I'M you'Re!!!...###", "a" * 300, "<|endoftext|>a<s></s><unk><0x41>",
    "x;\r\ny {\r z\t\tq", "the " * 50, "the " * 50, "İstanbul ǅ ß",
]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def byte_letters():
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokens(libraries, text):
    """Ids and byte ranges of both sides by the libraries' own strings; none if bytes differ."""
    a, b = libraries
    letters, wanted, found = byte_letters(), (" " + (text or "")).encode(), []
    if not text:
        return [], []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    found.append([(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids])
    found.append(
        [
            (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
            for i in b.encode(text)
        ]
    )
    if any(b"".join(x for _, x in side) != wanted for side in found):
        return [], []
    out = []
    for side in found:
        at, rows = 0, []
        for i, x in side:
            rows.append((i, at, at + len(x)))
            at += len(x)
        out.append(rows)
    return out


def brute(libraries, texts):
    both, linked, result = [tokens(libraries, t) for t in texts], [], []
    counts = Counter()
    for a, b in both:
        links, first = [], 0
        for x in a:
            while first < len(b) and b[first][2] <= x[1]:
                first += 1
            j = first
            while j < len(b) and b[j][1] < x[2]:
                links.append((x[0], b[j][0]))
                j += 1
        counts.update(links)
        linked.append(links)
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    for (a, b), links in zip(both, linked):
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, i, j = [], 0, 0
        for cut in cuts:
            left, right = [], []
            while i < len(a) and a[i][2] <= cut:
                left.append(str(a[i][0]))
                i += 1
            while j < len(b) and b[j][2] <= cut:
                right.append(str(b[j][0]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        result.append(
            (len(a), len(b), len(groups), len(links), sum(counts[x] == top[x[1]] for x in links),
             sum(counts[x] for x in links), ";".join(groups))
        )
    return result


def test_whole_table_against_brute_force(spark, tables, libraries):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    wanted = {
        r.doc_id: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")
        for r, w in zip(docs, brute(libraries, [r.text for r in docs]))
    }
    found = queries.token_alignment(spark, tables).collect()
    assert len(found) == len(docs)
    assert {r.doc_id: tuple(r)[1:] for r in found} == wanted


def test_odd_rows(spark, libraries):
    rows = [*enumerate(ODD), (None, "null id"), (3, "again"), (3, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.select("*", F.lit("mine").alias("N_Links"), F.lit(1).alias("kept_one"))
    found = align_tokens(frame, VOCABULARY, MODEL, block_bytes=64)
    assert found.columns == ["doc_id", "kept_one", *token_alignment.MADE[:4], "n_best", "count_sum", "groups"]
    order = lambda r: (r[0] is None, r)
    wanted = [(i, 1, *w) for (i, _), w in zip(rows, brute(libraries, [t for _, t in rows]))]
    assert sorted(map(tuple, found.collect()), key=order) == sorted(wanted, key=order)
    assert align_tokens(frame.limit(0), VOCABULARY, MODEL).count() == 0


def test_encodings_by_chunks_are_those_of_whole_texts(libraries, monkeypatch):
    own = Encoders(open(VOCABULARY, encoding="utf-8").read(), open(MODEL, "rb").read())
    rng = random.Random(1)
    bits = [
        " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c", "\x1c", "\xa0", "\u3000", "\u2028", "\u200b", ";", "{", "don't",
        "'s", "it", "é", "你好", "12", "▁", "The", "e\u0301", "🙂", "<|endoftext|>", "<s>", "!!", "\x00", "-x-", "\r", "\ufeff",
    ]
    texts = ["word  and\n more; don't \t stop été 你好 x\r\n y" * 20, "z" * 500, "a b" * 400, None, "▁ " * 99, *ODD]
    texts += ["".join(rng.choices(bits, k=rng.randrange(1, 14))) for _ in range(4000)]
    for run, held in ((token_alignment._RUN, token_alignment._MOST_HELD), (40, 500)):
        monkeypatch.setattr(token_alignment, "_RUN", run)
        monkeypatch.setattr(token_alignment, "_MOST_HELD", held)
        for at in range(0, len(texts), 50):
            some = texts[at : at + 50]
            ids, counts = own.encode(some)
            for side in (0, 1):
                split = np.split(ids[side], np.cumsum(counts[side])[:-1])
                for text, found in zip(some, split):
                    assert found.tolist() == [i for i, *_ in tokens(libraries, text)[side]], repr(text)


def test_groups_and_overlaps_of_intervals():
    a = np.array([[0, 2], [2, 5], [5, 6], [6, 9]])
    b = np.array([[0, 1], [1, 2], [2, 3], [3, 7], [7, 9]])
    every = np.concatenate([a, b])
    assert coalesce(every[:, 0], every[:, 1]).tolist() == [0, 1, 1, 1, 0, 0, 1, 1, 1]
    in_a, in_b = overlaps(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
    assert list(zip(in_a.tolist(), in_b.tolist())) == [
        (i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] < y[1] and y[0] < x[1]
    ]
