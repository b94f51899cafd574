"""Byte-level BPE by monoid tree reduction.

A text is cut in halves down to leaves. Neighbouring halves are joined twice over, on matches of the pattern and on the
tokens inside a match, and each join redoes no more than a window around the border.

*Matches.* The pattern looks at most LOOK characters past the end of a match and never back. A match of the left half
that ends so far before the border is settled. The text is matched again from the end of the last settled one until a
match starts where one of the right half does; from there on both see the same text.

*Tokens.* A row of tokens is the encoding of its bytes if and only if every two neighbours are the encoding of theirs.
(Up to the first merge over a token border, the merges inside two neighbours are those of encoding just the two, as the
lowest rank of all is also the lowest of theirs. So that first merge would also happen in the two alone.) A join
re-encodes a growing window of tokens at the border until both its ends fit the token outside; everything outside is
then proven to stay, whatever the ranks are. Decoding concatenates bytes up a tree.

Null is the empty text: no ids. Equal rows are encoded each, null ids are kept. Only `doc_id` and `text` are read, so
other columns cannot clash. Long texts take a logarithm more, not a square: a window merges by a heap. An empty table
gives no rows.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

LOOK = 2
LEAF_CHARS, LEAF_BYTES, LEAF_IDS = 1024, 8, 4096
ROWS = 256
MEMORY, LONG, SHORT = 500_000, 64, 16
BYTES = [bytes([b]) for b in range(256)]


class TreeCoder:
    """Encodes and decodes with the ranks of a file (base64 of the bytes, rank) and the pattern that splits texts."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.highest = max(self.tokens, default=0)
        #: Tokens by rank, to look up whole arrays of ids.
        self.row = np.full(self.highest + 1, None, object)
        self.row[list(self.tokens)] = np.fromiter(self.tokens.values(), object, len(self.tokens))
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.short: dict[bytes, list[int]] = {}

    def remembered(self, data: bytes) -> list[int]:
        """merged(), of short data looked up."""
        if len(data) > SHORT:
            return self.merged(data)
        if (found := self.short.get(data)) is None:
            if len(self.short) > MEMORY:
                self.short.clear()
            found = self.short[data] = self.scanned(data)
        return found

    def scanned(self, data: bytes) -> list[int]:
        """As merged(), looking at all pairs before each merge; for short data."""
        ranks, rank, none = self.ranks, self.ranks.get, self.highest + 1
        if len(data) <= 2 and (whole := rank(data)) is not None:
            return [whole]
        parts = [BYTES[b] for b in data]
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (least := min(pairs)) != none:
            i = pairs.index(least)
            del pairs[i]
            own = parts[i] = parts[i] + parts.pop(i + 1)
            if i < len(pairs):
                pairs[i] = rank(own + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + own, none)
        return [ranks[part] for part in parts]

    def merged(self, data: bytes) -> list[int]:
        """Ids of `data`: the pair of lowest rank is merged, the leftmost of equal ones, as long as there is one."""
        n, ranks = len(data), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[data[i : i + 2]], i, i + 2) for i in range(n - 1) if data[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, start, end = heapq.heappop(heap)
            middle = after[start]
            if middle < 0 or middle >= n or after[middle] != end:
                continue
            after[start], after[middle] = end, -1
            if end < n:
                before[end] = start
                if (rank := ranks.get(data[start : after[end]])) is not None:
                    heapq.heappush(heap, (rank, start, after[end]))
            if start and (rank := ranks.get(data[before[start] : end])) is not None:
                heapq.heappush(heap, (rank, before[start], end))
        ids, at = [], 0
        while at < n:
            ids.append(ranks[data[at : after[at]]])
            at = after[at]
        return ids

    def fit(self, left: int, right: int) -> bool:
        """Whether these two tokens are the encoding of their bytes."""
        if (found := self.fits.get((left, right))) is None:
            if len(self.fits) > MEMORY:
                self.fits.clear()
            found = self.remembered(self.tokens[left] + self.tokens[right]) == [left, right]
            self.fits[left, right] = found
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours' bytes from the encodings of each."""
        if left and right and self.fit(left[-1], right[0]):
            return left + right
        low, high, middle = len(left), 0, []
        from_left = from_right = 1
        while True:
            before, behind = left[low - 1 : low] if low else [], right[high : high + 1]
            row = before + middle + behind
            open_left = bool(before) and len(row) > 1 and not self.fit(row[0], row[1])
            open_right = bool(behind) and len(row) > 1 and not self.fit(row[-2], row[-1])
            if not open_left and not open_right:
                return left[:low] + middle + right[high:]
            if open_left:
                low, from_left = max(0, low - from_left), 2 * from_left
            if open_right:
                high, from_right = min(len(right), high + from_right), 2 * from_right
            middle = self.remembered(b"".join(self.tokens[i] for i in left[low:] + right[:high]))

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one match: its halves' ids joined. Leaves are a few bytes."""
        if len(data) <= LEAF_BYTES:
            return self.remembered(data)
        middle = len(data) // 2
        return self.join(self.encode_bytes(data[:middle]), self.encode_bytes(data[middle:]))

    def encode_match(self, match: str) -> bytes:
        data = match.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        return array("i", self.encode_bytes(data) if whole is None else [whole]).tobytes()

    def matches(self, text: str, low: int = 0, high: int | None = None) -> list[str]:
        """Matches of the pattern in text[low:high]: those of the halves joined."""
        high = len(text) if high is None else high
        if high - low <= LEAF_CHARS:
            return self.pattern.findall(text, low, high)
        middle = (low + high) // 2
        left, right = self.matches(text, low, middle), self.matches(text, middle, high)
        at = middle
        while left and at + LOOK > middle:
            at -= len(left.pop())
        start, first = middle, 0
        while at != start:
            if at > start:
                start += len(right[first])
                first += 1
            else:
                left.append(self.pattern.match(text, at, high)[0])
                at += len(left[-1])
        left += right[first:]
        return left

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if len(self.known) > MEMORY:
            self.known.clear()
        matches, known = self.matches(text), self.known
        fresh = set(matches).difference(known)
        for match in fresh:
            known[match] = self.encode_match(match)
        data = b"".join(map(known.__getitem__, matches))
        for match in fresh:
            if len(match) > LONG:
                del known[match]
        return np.frombuffer(data, np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of `ids`, concatenated up a tree."""
        if len(ids) <= LEAF_IDS:
            return b"".join(self.row[ids].tolist())
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


_coders: dict[tuple[str, str], TreeCoder] = {}


def _coder(path: str, pattern: str) -> TreeCoder:
    if (path, pattern) not in _coders:
        _coders[path, pattern] = TreeCoder(path, pattern)
    return _coders[path, pattern]


def encode_texts(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id` and the `ids` of every whole text."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                ids = [coder.encode(text) for text in some.column("text").to_pylist()]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), lists], ["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows of encode_texts() with the bytes (`decoded`) that their ids stand for."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                lists = some.column("ids")
                ids, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
                if len(ids) and ids.min() < 0:
                    raise KeyError(int(ids.min()))
                decoded = [coder.decode(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("ids"), pa.array(decoded, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
