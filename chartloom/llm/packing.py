"""Hierarchical packing of tokenized documents into windows of several context sizes.

A document longer than the largest window fills whole windows of its own. What is left of it, and every shorter
document, is routed to the smallest tier that holds it. Tiers are packed from long to short: each window opens with the
longest piece of its tier and its gap is filled from shorter tiers, best fit first; when nothing fits, one piece is cut
to close the gap. Windows of a tier are dealt to step groups of equal tokens. At the end of a partition the few pieces
left over are laid end to end and cut at powers of two, so nothing is padded.

Each partition packs its own documents in bounded pools, without a shuffle. Nulls and empty texts are the end token
alone; a null id is kept. Only `doc_id` and `text` are read, so other columns cannot clash. Equal rows are packed once
each. An empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

END = 1
TIERS = (2048, 1024, 512, 256)
STEP_TOKENS = 64 * 2048
POOL = 4096
MEMORY = 300_000
MASK = 0xFFFFFFFF

LETTERS, NUMBERS, SPACES = (
    re.escape(bytes(c for c in range(256) if regex.match(kind, chr(c)))) for kind in (r"\p{L}", r"\p{N}", r"\s")
)
# Fixed value: the pre-tokenizer pattern of the vocabulary file, for Latin-1.
PRETOKEN = re.compile(b"[%s]+|[%s]|'(?:s|t|re|ve|m|ll|d)|[^%s]+" % (LETTERS, NUMBERS, LETTERS + NUMBERS + SPACES))


def _recalled(fresh: set, old: dict, new: dict) -> set:
    """Those of `fresh` that are not in `old`; the others move from `old` to `new`."""
    met = fresh.intersection(old)
    new.update((x, old.pop(x)) for x in met)
    return fresh - met


class WordEncoder:
    """Token ids of texts, as bytes of unsigned 32-bit little-endian numbers, from a word-level tokenizer.

    Pre-tokens never cross white space, so ids of a text are those of its words in turn, and ids of a word those of its
    pre-tokens. ASCII texts are cut into pre-tokens at once, without a look at their words. Up to `MEMORY` words are
    remembered, and pre-tokens: when half of them are new, those not met since the last time are forgotten. Texts in which
    the tokenizer sees more than single words go to it whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.old_parts: dict[bytes, bytes] = {}

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_parts(self, parts: list[bytes]) -> None:
        for i in range(0, len(parts), 1000):
            some = parts[i : i + 1000]
            ids = np.array(self.tokenizer.encode(b" ".join(some).decode("latin-1"), add_special_tokens=False).ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                data, at = ids.tobytes(), (4 * stops).tolist()
                self.parts.update(zip(some, map(data.__getitem__, map(slice, [0, *at], at)), strict=True))
            else:
                self.parts.update((p, self.plain(p.decode("latin-1"))) for p in some)

    def learn_parts(self, parts: set[bytes]) -> None:
        fresh = parts.difference(self.parts)
        self.encode_parts(list(_recalled(fresh, self.old_parts, self.parts)))

    def learn(self, words: set[bytes]) -> None:
        # Letters alone are one pre-token; other words are split.
        letters, split = {w for w in words if w.isalpha()}, {}
        for word in words - letters:
            try:
                latin = word if word.isascii() else word.decode("utf-8", "surrogatepass").encode("latin-1")
                split[word] = PRETOKEN.findall(latin)
            except UnicodeEncodeError:
                self.words[word] = self.plain(word.decode("utf-8", "surrogatepass"))
        self.learn_parts(letters.union(*split.values()))
        known = self.parts.__getitem__
        self.words.update(zip(letters, map(known, letters), strict=True))
        self.words.update((w, b"".join(map(known, found))) for w, found in split.items())

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if 2 * len(self.words) > MEMORY:
            self.old_words, self.words = self.words, {}
        if 2 * len(self.parts) > MEMORY:
            self.old_parts, self.parts = self.parts, {}
        out: list = []
        for text in texts:
            text = text or ""
            if text.isascii() and "<|" not in text:
                out.append((self.parts, PRETOKEN.findall(text.lower().encode())))
            elif "<|" in text or "Σ" in text:
                out.append((None, self.plain(text)))
            else:
                lowered = unicodedata.normalize("NFC", text).lower()
                out.append((self.words, lowered.encode("utf-8", "surrogatepass").split()))
        self.learn_parts(set().union(*[x for known, x in out if known is self.parts]))
        fresh = set().union(*[x for known, x in out if known is self.words]).difference(self.words)
        self.learn(_recalled(fresh, self.old_words, self.words))
        return [x if known is None else b"".join(map(known.__getitem__, x)) for known, x in out]


class Packer:
    """Packs pieces (doc_id, start, ids, tokens of the document) and returns rows of finished sequences."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, first: int):
        self.tiers, self.step_tokens, self.next = tiers, step_tokens, first << 33
        self.pool: list[tuple] = []
        self.counts = dict.fromkeys(tiers, 0)
        self.first = first
        self.rows: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        """Number a finished sequence of pieces (length, doc_id, start, ids, tokens)."""
        size = sum(p[0] for p in pieces)
        group = None
        if size in self.counts:
            step = self.counts[size] // max(1, self.step_tokens // size)
            group = (self.first << 40) + (size << 28) + step
            self.counts[size] += 1
        offset = 0
        for length, doc_id, start, ids, tokens in pieces:
            self.rows.append((doc_id, start, length, ids, tokens, self.next, offset, size, group))
            offset += length
        self.next += 1

    def add(self, doc_id, ids: bytes) -> None:
        tokens, window = len(ids) // 4, self.tiers[0]
        for start in range(0, tokens - window + 1, window):
            self.close([(window, doc_id, start, ids[4 * start : 4 * (start + window)], tokens)])
        if rest := tokens % window:
            self.pool.append((rest, doc_id, tokens - rest, ids[4 * (tokens - rest) :], tokens))

    @staticmethod
    def split(piece: tuple, at: int) -> tuple[tuple, tuple]:
        length, doc_id, start, ids, tokens = piece
        return (at, doc_id, start, ids[: 4 * at], tokens), (length - at, doc_id, start + at, ids[4 * at :], tokens)

    def pack(self) -> None:
        """Fill windows of every tier; pieces of windows that stay open return to the pool."""
        order = sorted(range(len(self.pool)), key=lambda i: self.pool[i][0])
        items = [(self.pool[i][0], n, self.pool[i]) for n, i in enumerate(order)]
        number, open_ = len(items), []
        for tier, lower in zip(self.tiers, [*self.tiers[1:], 0], strict=True):
            while items and items[-1][0] > lower:
                pieces = [items.pop()[2]]
                gap = tier - pieces[0][0]
                while gap and items:
                    at = bisect_right(items, gap, key=lambda x: x[0]) - 1
                    piece = items.pop(max(0, at))[2]
                    if at < 0:
                        piece, rest = self.split(piece, gap)
                        insort(items, (rest[0], number, rest))
                        number += 1
                    pieces.append(piece)
                    gap -= piece[0]
                if gap:
                    open_ += pieces
                else:
                    self.close(pieces)
        self.pool = open_

    def finish(self) -> None:
        """Lay what is left end to end and cut it at powers of two."""
        self.pack()
        pieces, left = self.pool[::-1], sum(p[0] for p in self.pool)
        while left:
            room = min(self.tiers[0], 1 << (left.bit_length() - 1))
            left -= room
            taken = []
            while room:
                piece = pieces.pop()
                if piece[0] > room:
                    piece, rest = self.split(piece, room)
                    pieces.append(rest)
                taken.append(piece)
                room -= piece[0]
            self.close(taken)
        self.pool = []


_encoders: dict[str, WordEncoder] = {}

FIELDS = (
    ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("window", pa.int64()), ("step_group", pa.int64()),
)


def pack_documents(
    documents: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS
) -> DataFrame:
    """Pieces of all documents: `ids` (32-bit little-endian), where they come from and where they lie."""
    end = np.array([END], "<u4").tobytes()
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = WordEncoder(tokenizer)
        encoder, packer = _encoders[tokenizer], Packer(tiers, step_tokens, TaskContext.get().partitionId())
        schema = None

        def rows() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) or [()] * len(schema)
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), *FIELDS])
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                texts = some.column("text").to_pylist()
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encoder(texts), strict=True):
                    packer.add(doc_id, ids + end)
                if len(packer.pool) >= POOL:
                    packer.pack()
                yield rows()
        if schema is not None:
            packer.finish()
            yield rows()

    return documents.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long, window long, step_group long",
    )
