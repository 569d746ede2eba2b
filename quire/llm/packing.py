"""Best-fit packing with certified sequence counts.

Every document becomes token ids (a closing id included), is cut into pieces no longer than a sequence, and
the pieces are packed into as few sequences as possible:

1. The pieces are dealt over slots of bounded size. Each slot runs best-fit decreasing.
2. Dual feasible functions give each slot a lower bound. A slot that meets it is certified: no packing of its
   pieces needs fewer sequences.
3. Slots with a gap give up the pieces of their unfilled sequences, certified slots those of their emptiest
   one (the rounding of the bound). These are dealt anew, so slots exchange pieces, and are packed again. A
   round that does not save a sequence is not taken, and rounds end there and nowhere before.

Rows are few bytes, one for each piece; no slot, and nothing on the driver, grows with the corpus.

Ids are those of the tokenizer file as it stands: an added token written out in a text (``<|endoftext|>``) is its
one id.

Defined cases: a null or empty text is its closing id alone, a null id stays null; a text of any length is cut into
full pieces and a rest; pieces of equal length are taken in the order in which they are stored; repeated rows and
repeated ids are packed row by row; an empty table gives an empty result; other columns of the input are not looked
at.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import slots, table, texts_of, written

CAPACITY = 4096
CLOSING_ID = 1
SLOT_ROWS = 100_000  # pieces in a slot: what one task packs
CACHED_WORDS = 350_000  # parts whose ids a worker remembers at once; a limit on memory only

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", round int, slot int, bin int, offset long, bound int, bins int, pooled boolean"


# The tokenizer lower-cases, drops white space and parts the rest into these matches, which it encodes one by one.
# Written out for texts of Latin letters (to U+024F), where the classes are these ranges; fixed values.
_LATIN = re.compile(r"[^\x00-\u024f]")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                    r"|[^ \t-\r\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f0-9\xb2\xb3\xb9\xbc-\xbe]+")
# The characters that stand for bytes in the vocabulary: printable ones for themselves, the others from U+0100 on.
_SELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_NAMES = {b: 0x100 + n for n, b in enumerate(sorted(set(range(0x100)) - set(_SELF)))}


class WordIds:
    """Ids of the parts of texts, remembered.

    The tokenizer never joins characters across its parts, so a text's ids are its parts' ids in a row. A text with
    letters beyond the Latin ones is parted at white space only, which is as right but repeats less.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Added tokens stand for themselves, looked for in the text as it is and before anything else.
        self.added = {token.content: struct.pack("<I", number)
                      for number, token in self.tokenizer.get_added_tokens_decoder().items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.between = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.known: dict[str, bytes] = {}

    @staticmethod
    def parts(text: str) -> list[str] | None:
        """Matches of a text of Latin letters; None for other texts."""
        lower = text.lower()
        return None if _LATIN.search(lower) else _PARTS.findall(lower)

    def _ids(self, part: str) -> bytes:
        """Ids of one match: the merges alone, on the characters that stand for its bytes. An added token is its id."""
        if part in self.added:
            return self.added[part]
        if not (part.isascii() and part.isprintable()):
            part = part.encode().decode("latin-1").translate(_BYTE_NAMES)
        ids = [token.id for token in self.tokenizer.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without a closing id."""
        split: list[list[str]] = []
        others = set()  # words that the tokenizer itself has to part
        for text in texts:
            marked = any(token in text for token in self.added)
            own: list[str] = []
            for piece in self.between.split(text) if marked else [text]:
                parts = [piece] if piece in self.added else self.parts(piece)
                if parts is None:
                    parts = piece.replace("\n", " ").split(" ")
                    others.update(parts)
                own += parts
            split.append(own)
        if len(self.known) > CACHED_WORDS:  # short parts are those that come again
            self.known = {word: ids for word, ids in self.known.items() if len(word) <= 6}
        known = self.known
        if others:
            words = list(others.difference(known))
            for word, found in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
                known[word] = struct.pack(f"<{len(found.ids)}I", *found.ids)
        for part in set().union(*split).difference(known):
            known[part] = self._ids(part)
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    """One for each worker process: later tasks find what earlier ones remembered."""
    return WordIds(path)


def _path(tokenizer: str | None) -> str:
    if tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document, and ``ids`` (array) if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, closing = _word_ids(_path(tokenizer)), np.uint32(CLOSING_ID).tobytes()
        step = 4 * capacity
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
                for key, ids in zip(part.column(0).to_pylist(), encode(texts_of(part.column(1)))):
                    ids += closing
                    for n, at in enumerate(range(0, len(ids), step)):
                        own = ids[at:at + step]
                        out["doc_id"].append(key)
                        out["piece"].append(n)
                        out["start"].append(at // 4)
                        out["length"].append(len(own) // 4)
                        out["ids_crc32"].append(zlib.crc32(own))
                        if with_ids:
                            out["ids"].append(np.frombuffer(own, dtype="<u4").astype("i4"))
                arrays = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
                          "ids_crc32": pa.int64()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})
                yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in arrays.items()], list(arrays))

    narrow = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return narrow.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the fill of each bin.

    Bins with the same room form a stack; one integer has a bit for each room that has bins, so the best fit is
    the lowest bit from the length up.
    """
    bins, offsets = np.zeros(len(lengths), np.int32), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, own = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = own, fills[own]
        fills[own] += size
        left = room - size
        if left:
            if not stacks[left]:
                rooms |= 1 << left
            stacks[left].append(own)
    return bins, offsets, np.array(fills, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of the volume bound and two families of dual feasible functions.

    A dual feasible function maps sizes so that whatever fits a bin still fits after mapping; the mapped volume
    over the capacity then bounds the bins of every packing. Thresholds: sizes above ``capacity - t`` count as a
    whole bin and sizes below ``t`` as nothing. Steps: ``x`` becomes ``floor((k + 1) x / capacity) / k``, and stays
    where ``(k + 1) x / capacity`` is whole.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    number, volume = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - t]
    middle = volume[capacity - t] - volume[t - 1]
    best = max(best, int((whole + -(-middle // capacity)).max(initial=0)))
    for k in range(1, 65):
        times = (k + 1) * size
        # in units of 1 / (k * capacity)
        mapped = np.where(times % capacity == 0, size * k, times // capacity * capacity)
        best = max(best, -(-int((count * mapped).sum()) // (k * capacity)))
    return best


def _pack_slot(round_: int, capacity: int):
    def pack(rows: pa.Table) -> pa.Table:
        lengths = rows.column("length").to_numpy().astype(np.int64)
        bins, offsets, fills = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        give = fills < capacity
        if len(fills) == bound:  # certified: only the rounding of the bound is left
            keep = int(np.argmin(fills))
            give = give & (np.arange(len(fills)) == keep)
        n = rows.num_rows
        whole = lambda value: pa.array(np.full(n, value, np.int32))
        return pa.table({
            **{k: rows.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")},
            "round": whole(round_), "slot": rows.column("slot"), "bin": pa.array(bins), "offset": pa.array(offsets),
            "bound": whole(bound), "bins": whole(len(fills)), "pooled": pa.array(give[bins]),
        })

    return pack


def pack(cut: DataFrame, capacity: int = CAPACITY, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Pack stored pieces. Adds ``sequence_id``, ``offset`` and the certificate: ``bound`` and ``bins`` of the slot
    that placed the piece, and ``certified`` where they agree."""
    kept: list[DataFrame] = []
    pool = cut.select(*[c.split()[0] for c in PIECES.split(", ")])
    before = None  # the last round's rows, and the sequences it has for the pieces now pooled
    for round_ in count():  # ends: every round but the last saves a sequence
        rows = pool.count()
        dealt = slots(pool, max(1, -(-rows // slot_rows)))
        packed = written(dealt.groupBy("slot").applyInArrow(_pack_slot(round_, capacity), PACKED), "packed")
        used = packed.select("slot", "bin", "pooled").distinct().groupBy("pooled").count()
        found = {r["pooled"]: r["count"] for r in used.collect()}  # two rows
        if before is not None and sum(found.values()) >= before[1]:
            break
        if before is not None:
            kept.append(before[0].filter(~F.col("pooled")))
        before = (packed, found.get(True, 0))
        if found.get(True, 0) < 2:
            break
        pool = packed.filter("pooled").select(*pool.columns)
    kept.append(before[0])
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    number = F.shiftleft(F.col("round").cast("long"), 48) + F.shiftleft(F.col("slot").cast("long"), 24) + F.col("bin")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", number.alias("sequence_id"), "offset",
                      "round", "bound", "bins", (F.col("bound") == F.col("bins")).alias("certified"))


def sequences(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` (array), of at most ``capacity`` ids each.

    For documents whose ``doc_id`` is unique; a sequence gathers at most ``capacity`` ids, so a group is bounded.
    """
    cut = written(pieces(docs, capacity, tokenizer, with_ids=True), "pieces")
    placed = pack(cut, capacity)
    joined = cut.select("doc_id", "piece", "ids").join(placed, ["doc_id", "piece"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
                   slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Cut and pack documents; one row for each piece."""
    return pack(written(pieces(docs, capacity, tokenizer), "pieces"), capacity, slot_rows)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids."""
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op1_best_fit_packing": op1_best_fit_packing}
SQL: dict[str, str] = {}
