"""The whole corpus as token ids of a public byte-level BPE tokenizer.

Method: forced-boundary splitting.  A byte pair that occurs inside no vocabulary token can never be
inside a merged token, so a text may be cut there; the fragments are encoded independently and their
ids concatenated.  Most fragments are short and repeat, so each worker keeps a bounded memo.

A cut must also leave the tokenizer's pre-tokenisation as it is.  With the pattern of the byte-level
tokenizers (contractions, ` ?letters`, ` ?digits`, ` ?others`, white space with a look-ahead) it does if
(1) the character before the cut isn't white space, so no look-ahead and no leading space is touched;
(2) the character after it isn't an apostrophe, and the one before isn't an apostrophe followed by
ASCII, so no contraction is made or broken; (3) it lies between characters, not inside one.

Scale: narrow, one pass, no shuffle; bytes are scanned with numpy over whole Arrow buffers.  The
vocabulary (under 1 MB) is loaded once per Python worker from a path that is a parameter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import spread

#: Fragments kept per worker, and the longest that is.
MEMO_ENTRIES, MEMO_BYTES = 400_000, 48


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def forced_pairs(tokens) -> np.ndarray:
    """Boolean table over 65,536 byte pairs: True where the pair is inside no token and a cut keeps the pre-tokenisation.

    White space beyond ASCII is left to ``cut_positions``: its last byte says nothing by itself.
    """
    inside = np.zeros(65_536, dtype=bool)
    for token in tokens:
        if len(token) > 1:
            b = np.frombuffer(token, dtype=np.uint8).astype(np.int32)
            inside[b[:-1] * 256 + b[1:]] = True
    left, right = np.divmod(np.arange(65_536), 256)
    white = np.isin(left, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
    middle = (right >= 0x80) & (right < 0xC0)
    apostrophe = (right == 39) | ((left == 39) & (right < 0x80))
    return ~(inside | white | middle | apostrophe)


def cut_positions(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Positions p of UTF-8 bytes such that a cut before data[p] is certain."""
    if len(data) < 2:
        return np.empty(0, dtype=np.int64)
    allowed = table[(data[:-1].astype(np.int32) << 8) | data[1:]]
    # white space beyond ASCII (C2 85, C2 A0, E1 9A 80, E1 A0 8E, E2 80 80-AF, E2 81 9F-A0, E3 80 80): never cut after it
    wide = (data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0)) if len(data) > 2 else np.empty(0, dtype=bool)
    if len(data) > 2:
        allowed[1:][wide] = False
    if len(data) > 3:
        a, b, c = data[:-3], data[1:-2], data[2:-1]
        space = ((a == 0xE2) & ((b == 0x80) | (b == 0x81))) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xE1) & ((b == 0x9A) | (b == 0xA0)))
        allowed[2:][space] = False
    return np.flatnonzero(allowed) + 1


class ForcedEncoder:
    """Encodes UTF-8 bytes by certain cuts; the same ids as encoding the whole text."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        ranks = load_ranks(path)
        self.table = forced_pairs(ranks)
        self.whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.memo: dict[bytes, list[int]] = {}

    def fragment(self, piece: bytes) -> list[int]:
        ids = self.memo.get(piece)
        if ids is None:
            ids = self.whole(piece.decode())
            if len(piece) <= MEMO_BYTES:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[piece] = ids
        return ids

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of a string column: row i has ids[offsets[i]:offsets[i+1]]; null is like empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        starts = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        lo, hi = (int(starts[0]), int(starts[-1])) if len(texts) else (0, 0)
        if hi == lo:
            return np.zeros(len(texts) + 1, dtype=np.int32), np.empty(0, dtype=np.int32)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[lo:hi]
        bounds = starts - lo
        edges = np.union1d(cut_positions(data, self.table), bounds)
        blob, fragment, ids = data.tobytes(), self.fragment, []
        ends_row = np.searchsorted(edges, bounds)  # index of each row's start among the edges
        counts = np.zeros(len(texts), dtype=np.int64)
        points = edges.tolist()
        for row in range(len(texts)):
            before = len(ids)
            for k in range(ends_row[row], ends_row[row + 1]):
                ids += fragment(blob[points[k] : points[k + 1]])
            counts[row] = len(ids) - before
        return np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), np.array(ids, dtype=np.int32)


@lru_cache(maxsize=2)
def encoder(path: str) -> ForcedEncoder:
    """One encoder for each Python worker and vocabulary."""
    return ForcedEncoder(path)


def _mapped(path: str, count_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            # rows are taken in slices so that the ids of very long texts don't pile up
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                offsets, ids = enc.column(part.column(1))
                if count_only:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets), pa.int32())], names=["doc_id", "n_tokens"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))], names=["doc_id", "ids"])

    return run


def encode_corpus(documents: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every document without special tokens.

    A null text and an empty one give an empty list; strings of special tokens are ordinary text.
    Repeated keys and texts stay separate rows; null keys stay; an empty table gives no rows; further
    columns are ignored.
    """
    slim = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return spread(slim).mapInArrow(_mapped(path or default_path(), False), "doc_id bigint, ids array<int>")


def count_tokens(documents: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens): the same, only counted."""
    slim = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return spread(slim).mapInArrow(_mapped(path or default_path(), True), "doc_id bigint, n_tokens int")
