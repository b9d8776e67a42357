"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

Token files of the ``tokenizers`` library with byte-pair encoding, word ends, and words cut at white
space.  A text's pieces between ASCII white space are encoded apart, so the count of a text is the
sum over its pieces, and running sums are the counts of all prefixes that end with a piece.  Within
a word, the last token of each prefix follows from the last tokens of shorter prefixes (see
``merges``): one pass gives the counts of all prefixes, nothing is encoded again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dispatchlens.llm import words, worker
from dispatchlens.llm.frames import tidy
from dispatchlens.llm.merges import Memo, Merges

MADE = ("n_bytes", "n_tokens", "over_limit", "fitting_chars", "prefix_tokens")
_ADDED = "n_bytes long, n_tokens long, over_limit boolean, fitting_chars long"
_BLANKS = " \t\n\r\x0b\x0c"
#: what str.split() takes for white space beyond _BLANKS
_OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: counts of longer pieces and words are not kept, so that a worker's memory is bounded
_KEPT = 64
_PIECES = re.compile(f"[^{_BLANKS}]+")
#: a character and those after it that may be composed or put in order with it
_CLUSTERS = regex.compile("(?s).[\\p{M}\u1160-\u11ff\ud7b0-\ud7ff]*")
#: up to here lower case and composition are the same in every version of Unicode
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = [""] * 256, 0x100
    for byte in range(256):
        if byte in shown:
            letters[byte] = chr(byte)
        else:
            letters[byte], spare = chr(spare), spare + 1
    return letters


class PrefixCounter:
    """Counts tokens as the library does, for a ``tokenizers`` file given as text."""

    def __init__(self, spec: str):
        import tokenizers

        parts = json.loads(spec)
        model, steps = parts["model"], parts["pre_tokenizer"].get("pretokenizers", [])
        normal = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
        if (
            model["type"] != "BPE"
            or not model["end_of_word_suffix"]
            or model["unk_token"] or model["byte_fallback"] or model["ignore_merges"]
            or normal != ["NFC", "Replace", "Lowercase"]
            or [x["type"] for x in steps] != ["Split", "ByteLevel"]
            or steps[1]["use_regex"] or steps[1]["add_prefix_space"]
            or any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"]
                   for x in parts["added_tokens"])
        ):
            raise ValueError("not a lower-casing byte-pair vocabulary with word ends")
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.vocabulary = model["vocab"]
        # tokens that close a word, by their letters
        self.closing = {t.removesuffix(self.end): t for t in self.vocabulary if t.endswith(self.end)}
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocabulary)
        self.merges = Merges(_lookup(pairs), self._symbols, self.vocabulary, self.longest)
        self.letters = _byte_letters()
        self.table = {i: letter for i, letter in enumerate(self.letters)}
        self.word = regex.compile(steps[0]["pattern"]["Regex"])
        special = [re.escape(x["content"]) for x in parts["added_tokens"]]
        self.special = re.compile("(" + "|".join(special) + ")") if special else None
        self.marks = [x["content"] for x in parts["added_tokens"]]
        self.marks_apart = not any(a != b and a in b for a in self.marks for b in self.marks)
        library = tokenizers.Tokenizer.from_str(spec)
        self._normal, self._cut = library.normalizer, library.pre_tokenizer
        # counts of pieces as they stand in texts, and of the words in them
        self.pieces = Memo(self.piece_count)
        self.words = Memo(self._word_count)
        # counts of the prefixes of pieces
        self.tables = Memo(self._table)
        self.word_prefixes = Memo(self._word_prefixes)
        self.forms = Memo(self._normal.normalize_str)

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end):
            row = list(token[: -len(self.end)])
            row[-1] += self.end
            return row
        return list(token)

    def _words(self, piece: str) -> list[str]:
        """The words of a piece between special tokens, as letters for bytes."""
        if _BEYOND_LATIN.search(piece):
            return [w for w, _ in self._cut.pre_tokenize_str(self._normal.normalize_str(piece))]
        low = unicodedata.normalize("NFC", piece).lower()
        found = [low] if low.isalpha() else self.word.findall(low)
        return [self._letters(w) for w in found]

    def _letters(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return word.encode().decode("latin1").translate(self.table)

    def _prefixes(
        self, word: str, lasts: Sequence[str] = ("",), counts: Sequence[int] = (0,)
    ) -> tuple[list[str], list[int]]:
        """Last token and token count of each open prefix of a word; those of the first ones may be known."""
        lasts, counts = self.merges.tails(word, lasts), [*counts]
        for i in range(len(counts), len(lasts)):
            counts.append(counts[i - len(lasts[i])] + 1)
        return lasts, counts

    def _closed(self, word: str, lasts: list[str], counts: list[int], i: int) -> int:
        """Tokens of the first ``i`` letters of a word as a word of their own."""
        vocabulary, beside, made = self.vocabulary, self.merges.beside, self.merges.made
        for j in range(i - 1, max(-1, i - 1 - self.longest), -1):
            token = word[j:i] + self.end
            if token in vocabulary and made(token) and (not lasts[j] or beside(lasts[j], token)):
                return counts[j] + 1
        raise ValueError(f"no encoding of {word!r}")

    def _word_prefixes(self, word: str) -> tuple[int, ...]:
        """Tokens of each prefix of a word as a word of its own, by number of letters from 1 on."""
        return tuple(self._extended(word, [""], [0], []))

    def _extended(self, word: str, lasts: list[str], counts: list[int], own: list[int]) -> list[int]:
        """``own``: tokens of each prefix of a word as a word of its own; the lists, which hold the first of them
        and the last token and count of those open prefixes, are made longer."""
        tokens, closing, known = self.merges.tokens, self.closing, self.merges.pairs
        made, beside, longest = self.merges.made, self.merges.beside, self.longest
        for i in range(len(lasts), len(word) + 1):
            last = closed = None
            # one token fits as the last of an open word and one of a closed word, short ones most of the time
            for j in range(i - 1, max(-1, i - 1 - longest), -1):
                part, left = word[j:i], lasts[j]
                beyond = known.get(left)
                if last is None:
                    token = tokens.get(part)
                    if token is None and i - j == 1:
                        token = part
                    if token is not None:
                        fits = beyond.get(token) if beyond is not None else None
                        if fits is None:
                            fits = made(token) and (not left or beside(left, token))
                        if fits:
                            last, n = token, counts[j] + 1
                            if closed is not None:
                                break
                if closed is None:
                    token = closing.get(part)
                    if token is not None:
                        fits = beyond.get(token) if beyond is not None else None
                        if fits is None:
                            fits = made(token) and (not left or beside(left, token))
                        if fits:
                            closed = counts[j] + 1
                            if last is not None:
                                break
            else:
                raise ValueError(f"no encoding of {word!r}")
            lasts.append(last)
            counts.append(n)
            own.append(closed)
        return own

    def _learn(self, pieces: Iterable[str]) -> None:
        """Keep the prefix counts of the words of pieces; in the order of words, what two begin with is counted once."""
        known, letters, found = self.word_prefixes, self._letters, set()
        for piece in pieces:
            if len(piece) > _KEPT:
                continue
            if piece.isascii():
                low = piece.lower()
            elif _BEYOND_LATIN.search(piece):
                continue
            else:
                low = unicodedata.normalize("NFC", piece).lower()
            if low.isalpha():
                found.add(low)
            else:
                found.update(self.word.findall(low))
        before, lasts, counts, own = "", [""], [0], []
        for word in sorted({letters(w) for w in found} - known.keys()):
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            del lasts[same + 1 :], counts[same + 1 :], own[same:]
            known[word] = tuple(self._extended(word, lasts, counts, own))
            before = word

    def _word_count(self, word: str) -> int:
        merges, end, n = self.merges, self.end, len(word)
        if word + end in self.vocabulary and merges.made(word + end):
            return 1
        # the last token closes the word; before it stands the encoding of a prefix
        for j in range(n - 1, max(0, n - 1 - self.longest), -1):
            token = word[j:] + end
            if token in self.vocabulary and merges.made(token):
                before = merges.encode(word[:j])
                if merges.beside(before[-1], token):
                    return len(before) + 1
        raise ValueError(f"no encoding of {word!r}")

    def piece_count(self, piece: str) -> int:
        """Tokens of a text without ASCII white space."""
        if self.special and any(m in piece for m in self.marks):
            parts = self.special.split(piece)
            return len(parts) // 2 + sum(self.piece_count(p) for p in parts[::2] if p)
        known, count = self.words, self._word_count
        return sum(count(w) if len(w) > _KEPT else known[w] for w in self._words(piece))

    def piece_prefixes(self, piece: str) -> list[int]:
        """Tokens of every prefix of a piece, by number of code points from 0 on."""
        if not self.special or not any(m in piece for m in self.marks):
            return self._plain_prefixes(piece)
        if not self.marks_apart:
            return self._each_prefix(piece)
        # a special token cut short is text like that before it
        out, parts = [0], self.special.split(piece)
        for text, mark in zip(parts[::2], [*parts[1::2], ""]):
            before, table = out[-1], self._plain_prefixes(text + mark[:-1])
            out += [before + n for n in table[1:]]
            if mark:
                out.append(before + table[len(text)] + 1)
        return out

    def _each_prefix(self, piece: str) -> list[int]:
        return [0, *(self.piece_count(piece[: i + 1]) for i in range(len(piece)))]

    def _plain_prefixes(self, piece: str) -> list[int]:
        """Tokens of every prefix of a piece without special tokens."""
        latin = piece.isascii() or not _BEYOND_LATIN.search(piece)
        out = self._latin_prefixes(piece) if latin else None
        if out is None:
            out = self._aligned_prefixes(piece)
        return out or self._each_prefix(piece)

    def _latin_prefixes(self, piece: str) -> list[int] | None:
        """Tokens of every prefix of a piece whose characters keep their places; None for other pieces."""
        low = piece.lower() if piece.isascii() else unicodedata.normalize("NFC", piece).lower()
        if len(low) != len(piece):
            return None
        out = [0]
        for found in (low,) if low.isalpha() else self.word.findall(low):
            if found[0] == "'" and found[1:].isalpha():  # cut short, this is two words
                cuts = [self.word.findall(found[: i + 1]) for i in range(len(found))]
                own = [sum(map(self._word_count, cut)) for cut in cuts]
            else:
                word = self._letters(found)
                own = self._word_prefixes(word) if len(word) > _KEPT else self.word_prefixes[word]
                if len(word) > len(found):
                    own = [own[i - 1] for i in accumulate(len(c.encode()) for c in found)]
            before = out[-1]
            out += [before + n for n in own] if before else own
        # white space beyond ASCII costs nothing, but takes a place
        return out if len(out) == len(piece) + 1 else None

    def _aligned_prefixes(self, piece: str) -> list[int] | None:
        """Tokens of every prefix of a piece whose clusters are normalised each by itself, from one
        pass over each of its words; None for other pieces."""
        normal, forms = self._normal.normalize_str(piece), self.forms.room()
        clusters = _CLUSTERS.findall(piece)
        made = [forms[c] if len(c) <= _KEPT else self._normal.normalize_str(c) for c in clusters]
        if "".join(made) != normal:
            return None
        # tokens of every prefix of the normal form; white space costs nothing
        counts, words = [0], []
        for letters, (start, end) in self._cut.pre_tokenize_str(normal):
            before = counts[-1]
            counts += [before] * (start + 1 - len(counts))
            if letters[0] == "'" and normal[start + 1 : end].isalpha():  # cut short, this may be two words
                counts += [before + self.piece_count(normal[start:i]) for i in range(start + 1, end + 1)]
                words.append((start, before, letters, None, None))
                continue
            lasts, own = self._prefixes(letters)
            sizes = [0, *accumulate(len(c.encode()) for c in normal[start:end])]
            counts += [before + self._closed(letters, lasts, own, i) for i in sizes[1:]]
            words.append((start, before, letters, sizes, (lasts, own)))
        counts += [counts[-1]] * (len(normal) + 1 - len(counts))
        out, at, word = [0], 0, -1
        for cluster, form in zip(clusters, made):
            while word + 1 < len(words) and words[word + 1][0] < at:
                word += 1
            for i in range(1, len(cluster)):
                part = self._normal.normalize_str(cluster[:i])
                if form.startswith(part):
                    out.append(counts[at + len(part)])
                else:
                    out.append(self._other_end(normal, at, part, words[max(0, word - 1) : word + 1]))
            at += len(form)
            out.append(counts[at])
        return out

    def _other_end(self, normal: str, at: int, part: str, words: list[tuple]) -> int:
        """Tokens of the first ``at`` characters of a normal form and others after them.  ``words``: the last
        two to begin before, each with its place, the tokens before it, and its prefixes."""
        if not words:
            return self.piece_count(part)
        start, before, letters, sizes, prefixes = words[-1]
        if words[0][2] == "'" and words[0][0] == start - 1 and at - start <= _KEPT:
            # other letters may make one word with the sign
            start, before = words[0][:2]
        if sizes is None or at - start <= _KEPT or at - start >= len(sizes):
            return before + self.piece_count(normal[start:at] + part)
        # words of so many characters are of one kind, whichever their last one is
        last = "!" if normal[at - 1] == "'" else normal[at - 1]
        cut = [w for w, _ in self._cut.pre_tokenize_str(last + part)]
        own = "".join(self.letters[b] for b in last.encode())
        size, (lasts, counts) = sizes[at - start], prefixes
        first = max(0, size - 2 * self.longest)
        if not cut or not cut[0].startswith(own):
            return before + self._closed(letters, lasts, counts, size) + sum(map(self._word_count, cut))
        longer = letters[first:size] + cut[0][len(own) :]
        more = self._prefixes(longer, lasts[first : size + 1], counts[first : size + 1])
        return before + self._closed(longer, *more, len(longer)) + sum(map(self._word_count, cut[1:]))

    def _table(self, piece: str) -> bytes:
        """Tokens of every prefix of a piece but the empty one, four bytes each."""
        if piece.isalpha() and piece.isascii() and len(piece) <= _KEPT:
            return array("i", self.word_prefixes[piece.lower()]).tobytes()
        return array("i", self.piece_prefixes(piece)[1:]).tobytes()

    def _enough(self, piece: str, limit: int) -> int:
        """A number of code points from which on every prefix of the piece has more than ``limit`` tokens.

        A longer prefix may have fewer tokens than a shorter one, as the last token that closes a word
        may replace those of its letters, and composed characters take the place of others.  That is
        less than ``slack``: before the closing token stands the encoding of a prefix that ends at most
        one longest token earlier, which has at most as many fewer tokens.
        """
        slack = 2 * self.longest + 64
        high = 256
        while high < len(piece) and self.piece_count(piece[:high]) <= limit + slack:
            high *= 2
        low = high // 2 if high > 256 else 0
        if high >= len(piece):
            return len(piece)
        while high - low > 1:
            middle = (low + high) // 2
            if self.piece_count(piece[:middle]) <= limit + slack:
                low = middle
            else:
                high = middle
        return high

    def _fitting_chars(self, piece: str, limit: int) -> int:
        """Code points of the longest prefix of at most ``limit`` tokens of a piece that has more."""
        piece = piece[: self._enough(piece, limit)]
        table = self.piece_prefixes(piece)
        return max(i for i, n in enumerate(table) if n <= limit)

    def _counts(self, text: str) -> Iterator[int]:
        parts = _PIECES.findall(text) if _OTHER_BLANKS.search(text) else text.split()
        self.words.room()
        known, count = self.pieces.room(), self.piece_count
        return (count(p) if len(p) > _KEPT else known[p] for p in parts)

    def count(self, text: str) -> int:
        return sum(self._counts(text))

    def fitting(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of at most ``limit`` tokens."""
        at, best = 0, 0
        for piece, total in zip(_PIECES.finditer(text), accumulate(self._counts(text))):
            if total > limit:
                # white space before the piece costs nothing
                return piece.start() + self._fitting_chars(piece[0], limit - at)
            at, best = total, piece.end()
        return len(text) if best or not text.strip(_BLANKS) else 0

    def prefixes(self, text: str) -> list[int]:
        """Tokens of every prefix of a text, by number of code points from 0 on."""
        return self.prefix_table([text])[1].tolist()

    def prefix_table(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of every prefix of several texts, from the empty one to the text, one text after the other;
        and where each text begins and ends there."""
        ends = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=ends[1:])
        # a blank before each text stands for its empty prefix, and keeps texts apart
        joined = "".join(f" {t}" for t in texts)
        parts = _PIECES.findall(joined)
        self.words.room()
        self.word_prefixes.room()
        known, table = self.tables.room(), self._table
        self._learn(set(parts) - known.keys())
        tables = [table(p) if len(p) > _KEPT else known[p] for p in parts]
        at = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = (at != 0x20) & ((at < 0x09) | (at > 0x0D))
        counts = np.zeros(len(at), np.int64)
        if tables:
            sizes, own = np.array([len(p) for p in parts]), np.frombuffer(b"".join(tables), np.int32)
            totals = np.cumsum(own[np.cumsum(sizes) - 1], dtype=np.int64)
            counts[inside] = own + np.repeat(np.concatenate([[0], totals[:-1]]), sizes)
            # white space costs nothing: the count is that at the last character before it
            counts = counts[np.maximum.accumulate(np.where(inside, np.arange(len(at)), 0))]
        counts -= np.repeat(counts[ends[:-1]], np.diff(ends))
        return ends, counts.astype(np.int32)


def _lookup(pairs: list[tuple[str, str]]):
    ranks: dict[tuple[str, str], int] = {}
    for i, pair in enumerate(pairs):
        ranks.setdefault(pair, i)
    return lambda a, b: ranks.get((a, b))


def counter(spec: str) -> PrefixCounter:
    """The counter of a file's text, kept by each Python worker."""
    return worker.table(("tokens", hash(spec)), lambda: PrefixCounter(spec))


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    limit: int = 2048,
    keep_prefixes: bool = False,
) -> DataFrame:
    """Token counts of whole texts, without begin, end or added special tokens.

    ``vocabulary``: path of the token file, read on the driver and broadcast (a few megabytes).
    Strings of special tokens inside texts count as the library counts them.  Adds:

    * ``n_bytes`` long: UTF-8 bytes, ``n_tokens`` long, ``over_limit``: more than ``limit`` tokens
    * ``fitting_chars`` long: code points of the longest prefix of at most ``limit`` tokens
    * with ``keep_prefixes``, ``prefix_tokens`` array of int: tokens of every prefix, from the empty
      one to the text, so that any later question of budget or truncation is a look-up

    Null counts as empty: no bytes, no tokens.  Equal rows are counted each.  An empty table gives
    an empty result.  Input columns named like the added ones are replaced.
    """
    docs = tidy(docs, [text], MADE)
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text("utf-8"))
    added = _ADDED + (", prefix_tokens array<int>" if keep_prefixes else "")
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(added).fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(shared.value)
        for batch in batches:
            for piece in words.pieces(batch, text):
                texts = [t or "" for t in piece[text].to_pylist()]
                made = {"n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64())}
                if keep_prefixes:
                    # all else is told by the counts of the prefixes
                    ends, counts = own.prefix_table(texts)
                    tokens = counts[ends[1:] - 1].tolist()
                    fitting = [
                        len(t) if n <= limit else int(np.flatnonzero(counts[a:b] <= limit)[-1])
                        for t, n, a, b in zip(texts, tokens, ends, ends[1:])
                    ]
                else:
                    tokens = [own.count(t) for t in texts]
                    fitting = [len(t) if n <= limit else own.fitting(t, limit) for t, n in zip(texts, tokens)]
                made["n_tokens"] = pa.array(tokens, pa.int64())
                made["over_limit"] = pa.array([n > limit for n in tokens], pa.bool_())
                made["fitting_chars"] = pa.array(fitting, pa.int64())
                if keep_prefixes:
                    made["prefix_tokens"] = pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(counts, pa.int32())
                    )
                yield pa.RecordBatch.from_pydict(
                    {c: piece[c] for c in piece.schema.names} | made
                )

    return docs.mapInArrow(count, schema)
