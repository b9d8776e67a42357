"""Which two tokens may stand side by side in a byte-pair encoding.

A byte-pair encoding is decided by its neighbours alone: a row of tokens is the encoding of what it
spells if and only if each token encodes to itself and each pair of neighbours encodes to that
pair.  Encodings can therefore be found from left to right, prefix by prefix, without merging.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import cached_property

Rank = Callable[[str, str], "float | None"]


class Memo(dict):
    """Values of a function, kept; ``room`` lets go of all of them when there are too many."""

    def __init__(self, function: Callable, limit: int = 500_000):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        value = self[key] = self.function(key)
        return value

    def room(self) -> "Memo":
        if len(self) > self.limit:
            self.clear()
        return self


class Merges:
    """``rank(a, b)`` is the order of merging two neighbours, lowest first, None for never;
    of equal ranks the leftmost pair goes first.  ``symbols`` gives what a token is made of."""

    def __init__(
        self,
        rank: Rank,
        symbols: Callable[[str], Sequence[str]],
        vocabulary: Iterable[str],
        longest: int,
        limit: int = 500_000,
    ):
        self.rank, self.symbols, self.limit = rank, symbols, limit
        # each token as one string object, however many tables hold it
        self.tokens, self.longest = {t: t for t in vocabulary}, longest
        self._made: dict[str, tuple | None] = {}
        # by left token, whether a right one stays apart from it
        self.pairs: dict[str, dict[str, bool]] = {}
        self._pair_count = 0

    def merge(self, symbols: Sequence[str]) -> tuple[list[str], list[tuple]]:
        """The encoding of the symbols by merging, and the merges in their order."""
        row, done, rank = list(symbols), [], self.rank
        while len(row) > 1:
            best, at = None, -1
            for i in range(len(row) - 1):
                r = rank(row[i], row[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            done.append((best, row[at], row[at + 1]))
            row[at : at + 2] = [row[at] + row[at + 1]]
        return row, done

    def made(self, token: str) -> tuple | None:
        """(rank, left, right) of a token's last merge, rank -1 for a single symbol; whether merging
        went by rising rank all the time; None if the token doesn't encode to itself."""
        if token not in self._made:
            row, done = self.merge(self.symbols(token))
            if row != [token]:
                self._made[token] = None
            elif not done:
                self._made[token] = (-1, "", "", True)
            else:
                ranks = [r for r, *_ in done]
                plain = all(a < b or done[i][1:] == done[i + 1][1:] for i, (a, b) in
                            enumerate(zip(ranks, ranks[1:])))
                self._made[token] = (*done[-1], plain)
        return self._made[token]

    def tails(self, word: str, lasts: Sequence[str] = ("",)) -> list[str]:
        """The last token of each prefix of a word; the empty one has "".

        A letter that is no token may stand for itself.  ``lasts``: those of the first prefixes, if known; where
        the word goes on to the left of what is given, the first one is not empty.
        """
        lasts = [*lasts]
        tokens, made, known = self.tokens, self.made, self.pairs
        for i in range(len(lasts), len(word) + 1):
            # exactly one token fits, and it is a short one most of the time
            for j in range(i - 1, max(-1, i - 1 - self.longest), -1):
                token = tokens.get(word[j:i])
                if token is None:
                    if i - j > 1:
                        continue
                    token = word[j:i]
                if lasts[j]:
                    fits = known[lasts[j]].get(token) if lasts[j] in known else None
                    if fits is None:
                        fits = made(token) and self.beside(lasts[j], token)
                else:
                    fits = made(token)
                if fits:
                    lasts.append(token)
                    break
            else:
                raise ValueError(f"no encoding of {word!r}")
        return lasts

    @cached_property
    def starts(self) -> dict[str, str]:
        """Every beginning of a token, and the longest token it begins with.

        A first letter that is no token stands for itself.
        """
        found: dict[str, str] = {}
        for token in sorted(self.tokens, key=len):
            for i in range(1, len(token)):
                if token[:i] not in found:
                    found[token[:i]] = found[token[: i - 1]] if i > 1 else token[0]
            found[token] = token
        return found

    def encode(self, word: str) -> list[str]:
        """The tokens of a word, the longest that begins at a place first.

        The tokens up to a place are its encoding if all of them stay apart, so there is one such row for a
        place: from where it could not go on, none can, and no place is left twice.
        """
        starts, known, made, beside = self.starts, self.pairs, self.made, self.beside
        found: list[str] = []
        dead: set[int] = set()
        left, at, size = "", 0, len(word)
        while at < size:
            token, end = word[at], at + 1
            longest = starts.get(token, token)
            while longest is not None:
                token, end = longest, end + 1
                if end > size:
                    break
                longest = starts.get(word[at:end])
            while True:
                if at + len(token) not in dead:
                    if left:
                        fits = known[left].get(token) if left in known else None
                        if fits is None:
                            fits = made(token) and beside(left, token)
                    else:
                        fits = made(token)
                    if fits:
                        found.append(token)
                        left = token
                        at += len(token)
                        break
                if len(token) > 1:
                    token = starts[token[:-1]]
                elif left:
                    dead.add(at)
                    token = found.pop()
                    at -= len(token)
                    left = found[-1] if found else ""
                else:
                    raise ValueError(f"no encoding of {word!r}")
        return found

    def beside(self, left: str, right: str) -> bool:
        """Whether both tokens, each encoding to itself, stay apart when written together."""
        if self._pair_count > self.limit:
            self.pairs.clear()
            self._pair_count = 0
        own = self.pairs.setdefault(left, {})
        found = own.get(right)
        if found is None:
            found = own[right] = self._apart(left, right)
            self._pair_count += 1
        return found

    def _apart(self, left: str, right: str) -> bool:
        a, b = self.made(left), self.made(right)
        if not (a[3] and b[3]):
            return self.merge([*self.symbols(left), *self.symbols(right)])[0] == [left, right]
        # back in time: undo the later merge, and ask whether the halves that then touch would
        # have merged before it; at the same rank a merge further left comes first
        left_limit = right_limit = float("inf")
        while True:
            r = self.rank(left, right)
            if r is not None and r < left_limit and r <= right_limit:
                return False
            a, b = self.made(left), self.made(right)
            if a[0] < 0 and b[0] < 0:
                return True
            if a[0] > b[0]:
                left_limit, left = a[0], a[2]
            else:
                right_limit, right = b[0], b[1]
