"""Byte-level BPE encoding and decoding as a tree reduction over halves of a text.

``encode`` cuts a text in halves down to leaves, encodes the leaves, and joins neighbours up the tree. The halves
were cut anywhere, so ids near the cut may be wrong. A join therefore re-encodes a window around the cut and lets
it grow until ids outside provably are what the whole text has:

* A match of the split pattern never holds white space behind another character, so a place between a character
  that is not white space and white space is a boundary of the whole text's matches whatever surrounds it. Matches
  on either side of such a place, and so their ids, do not depend on the other side. The window ends there.
* A long stretch without such a place is one or a few matches. Inside a single run of letters, digits or signs the
  window works on ids: a sequence of ids is the encoding of its bytes exactly when each neighbouring pair is the
  encoding of that pair's bytes, so a window is wide enough once the pairs at both its edges are.

The operation is associative and the empty text is its identity: any tree over the same text gives the same ids.
``decode`` concatenates the bytes of leaves up a tree of the same shape.

Defined cases: a null text is the empty text, with no ids; any other text, of any length, is encoded whole;
repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table, texts_of

LEAF = 64  # characters that are encoded in one piece
FIRST_WINDOW = 32  # characters or ids on either side of a cut that a join looks at first
DECODE_LEAF = 64  # ids

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

# White space by any reading of the split pattern; a match always ends before it if what precedes is none.
_WHITE = frozenset(" \t\n\r\x0b\x0c")


class Codec:
    """Encoder and decoder for a rank file and a split pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.plain = self.tokens.encode_ordinary
        # One whole run of letters, digits or signs, the only matches that can be long besides white space.
        self.run = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        if len(text) <= leaf:
            return self.plain(text)
        return self._encode(text, 0, len(text), leaf)

    def _encode(self, text: str, lo: int, hi: int, leaf: int) -> list[int]:
        if hi - lo <= leaf:
            return self.plain(text[lo:hi])
        cut = (lo + hi) // 2
        return self.join(text, lo, cut, hi, self._encode(text, lo, cut, leaf), self._encode(text, cut, hi, leaf))

    def join(self, text: str, lo: int, cut: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of ``text[lo:hi]`` from those of ``text[lo:cut]`` and ``text[cut:hi]``."""
        if not left or not right:
            return left or right
        width = FIRST_WINDOW
        start = end = None
        while start is None or end is None:
            if start is None:
                start = self._edge_before(text, lo, cut, width)
            if end is None:
                end = self._edge_after(text, cut, hi, width)
            if (start is None or end is None) and width >= 16 * FIRST_WINDOW:
                joined = self._join_run(text, lo, cut, hi, left, right)
                if joined is not None:
                    return joined
            width *= 4
        n_left = self._ids_of(left, len(text[start:cut].encode()), reverse=True)
        n_right = self._ids_of(right, len(text[cut:end].encode()), reverse=False)
        return left[:len(left) - n_left] + self.plain(text[start:end]) + right[n_right:]

    @staticmethod
    def _edge_before(text: str, lo: int, cut: int, width: int) -> int | None:
        """A sure boundary within ``width`` before the cut; ``lo`` when the window reaches it."""
        at = text.rfind(" ", max(lo, cut - width) + 1, cut)
        if at > 0 and not text[at - 1].isspace():  # nearly always
            return at
        for at in range(cut - 1, max(lo, cut - width), -1):
            if text[at] in _WHITE and not text[at - 1].isspace():
                return at
        return lo if cut - width <= lo else None

    @staticmethod
    def _edge_after(text: str, cut: int, hi: int, width: int) -> int | None:
        at = text.find(" ", cut + 1, min(hi, cut + width))
        if at > 0 and not text[at - 1].isspace():
            return at
        for at in range(cut + 1, min(hi, cut + width)):
            if text[at] in _WHITE and not text[at - 1].isspace():
                return at
        return hi if cut + width >= hi else None

    def _ids_of(self, ids: list[int], n_bytes: int, reverse: bool) -> int:
        """How many ids at one end have exactly these bytes."""
        count = 0
        while n_bytes > 0:
            count += 1
            n_bytes -= len(self.bytes_of[ids[-count if reverse else count - 1]])
        if n_bytes:
            raise AssertionError("a boundary of matches is inside a token")
        return count

    def _pair_stands(self, a: int, b: int) -> bool:
        """Whether two neighbouring ids are the encoding of their bytes."""
        return self._merged(self.bytes_of[a] + self.bytes_of[b]) == (a, b)

    @lru_cache(maxsize=65536)  # noqa: B019  a codec lives as long as its worker
    def _merged(self, piece: bytes) -> tuple[int, ...]:
        return tuple(self.tokens._core_bpe.encode_single_piece(piece))

    def _join_run(self, text: str, lo: int, cut: int, hi: int, left: list[int], right: list[int]) -> list[int] | None:
        """Join inside one run of letters, digits or signs that goes on far to both sides of the cut; None elsewhere.

        Within the run ids follow from bytes alone, without the split pattern, so the window is one of ids.
        """
        span = FIRST_WINDOW * 16
        if cut - span < lo or cut + span > hi:
            return None
        if not self.run.fullmatch(text, cut - span, cut + span):
            return None
        room, left_room = 0, 0
        # ids that lie wholly inside the run on each side
        while left_room < len(left) and room + len(self.bytes_of[left[-1 - left_room]]) < span:
            room += len(self.bytes_of[left[-1 - left_room]])
            left_room += 1
        room, right_room = 0, 0
        while right_room < len(right) and room + len(self.bytes_of[right[right_room]]) < span:
            room += len(self.bytes_of[right[right_room]])
            right_room += 1
        width = 2
        while width < min(left_room, right_room) - 1:
            window = b"".join(self.bytes_of[i] for i in left[-width:] + right[:width])
            ids = list(self.tokens._core_bpe.encode_single_piece(window))
            if self._pair_stands(left[-width - 1], ids[0]) and self._pair_stands(ids[-1], right[width]):
                return left[:-width] + ids + right[width:]
            width *= 2
        return None

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=2)
def _codec(ranks_path: str | None, pattern: str | None) -> Codec:
    import public_tokenizers

    return Codec(ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                 pattern or public_tokenizers.PATTERN)


def encode_documents(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None,
                     id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` (array) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                ids = pa.array([codec.encode(t) for t in texts_of(part.column(1))], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string"))
    return narrow.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """``doc_id, data`` (the bytes) of every row of ids; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, None)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                data = pa.array([codec.decode(ids or []) for ids in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), data], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode every text, decode the ids, and return digests of both; ids and bytes stay in their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for lo in range(0, batch.num_rows, 64):
                for text in texts_of(batch.column(1).slice(lo, 64)):
                    ids = codec.encode(text)
                    counts.append(len(ids))
                    id_digests.append(sha(",".join(map(str, ids)).encode()))
                    text_digests.append(sha(codec.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
                 pa.array(text_digests, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, ENCODED)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return round_trip(table(spark, sf_dir, "documents"))


QUERIES = {"op3_byte_bpe": op3_byte_bpe}
SQL: dict[str, str] = {}
