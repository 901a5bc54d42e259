"""Packing into training sequences by vector bin packing.

Every piece has a demand vector: tokens, one segment, and loss-bearing tokens. A sequence is filled by
the dot-product heuristic: of the pieces that fit under all limits, take the one whose demand has the
largest product with what is left. When none fits, the largest is cut to close the gap (texts may be cut
anywhere). A sequence that a limit other than tokens closes early, and what is left at the end, end at
powers of two, which need no padding.

Documents are tokenized and packed where they lie, block after block of bounded size, in one pass and
without a shuffle. A lost task is repeated from its input alone.

Null and empty texts hold only the end id. Repeated rows are packed as often as they occur. Null ids are
kept. An empty table gives no pieces. Columns besides ``id`` and ``text`` are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .tokens import WordTokens

CAPACITY = 4096
MAX_SEGMENTS = 128
END_ID = (2).to_bytes(4, "little")
BLOCK_DOCS = 2048
BLOCK_TOKENS = 4_000_000
LIMITS = (CAPACITY, MAX_SEGMENTS, CAPACITY)
Piece = tuple[int, int, int]  # item, start, length


def text_loss(length: int) -> int:
    """Loss-bearing ids of a piece of running text: all but the first, which has no context."""
    return length - 1


def choose(demand: np.ndarray, left: np.ndarray, limits: np.ndarray) -> int:
    """Index of the item that fits and has the largest dot product with what is left; -1 if none fits."""
    fits = (demand <= left).all(axis=1)
    if not fits.any():
        return -1
    product = (demand / limits) @ (left / limits)
    product[~fits] = -1.0
    return int(product.argmax())


def pack_whole(demand: np.ndarray, limits=LIMITS) -> list[list[int]]:
    """Sequences of uncut examples. An example beyond a limit of its own gets a sequence to itself."""
    limits = np.asarray(limits, dtype=np.int64)
    alive, out = np.arange(len(demand)), []
    while len(alive):
        left, items = limits.copy(), []
        while len(alive) and (i := choose(demand[alive], left, limits)) >= 0:
            items.append(int(alive[i]))
            left -= demand[alive[i]]
            alive = np.delete(alive, i)
        if not items:
            items, alive = [int(alive[0])], alive[1:]
        out.append(items)
    return out


def _split(pieces: list[Piece], tokens: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``tokens`` ids, and the rest."""
    head, rest = [], []
    for item, start, length in pieces:
        take = min(tokens, length)
        tokens -= take
        if take:
            head.append((item, start, take))
        if take < length:
            rest.append((item, start + take, length - take))
    return head, rest


def pack_texts(sizes: list[int], limits=LIMITS) -> list[list[Piece]]:
    """Sequences of pieces that hold each id of each text once; texts may be cut."""
    capacity = limits[0]
    limits = np.asarray(limits, dtype=np.int64)
    out: list[list[Piece]] = []
    pool: list[Piece] = []
    for item, n in enumerate(sizes):
        start = 0
        if limits[2] >= capacity - 1:
            for start in range(0, n - capacity + 1, capacity):
                out.append([(item, start, capacity)])
            start = n - n % capacity
        if start < n:
            pool.append((item, start, n - start))
    demand = np.array([(p[2], 1, text_loss(p[2])) for p in pool], dtype=np.int64).reshape(-1, 3)
    alive = np.ones(len(pool), dtype=bool)

    def put_back(piece: Piece) -> None:
        nonlocal demand, alive
        free = np.flatnonzero(~alive)
        i = int(free[0]) if len(free) else len(pool)
        row = (piece[2], 1, text_loss(piece[2]))
        if len(free):
            pool[i], demand[i], alive[i] = piece, row, True
        else:
            pool.append(piece)
            demand, alive = np.vstack([demand, row]), np.append(alive, True)

    while alive.any():
        left, held = limits.copy(), []
        while left[0] and alive.any():
            live = np.flatnonzero(alive)
            i = choose(demand[live], left, limits)
            if i >= 0:
                i = int(live[i])
                held.append(pool[i])
                left -= demand[i]
                alive[i] = False
                continue
            gap = int(min(left[0], left[2] + 1))
            if gap < 1 or left[1] < 1:
                break
            i = int(live[demand[live, 0].argmax()])
            item, start, length = pool[i]
            gap = min(gap, length)
            held.append((item, start, gap))
            left -= (gap, 1, text_loss(gap))
            alive[i] = False
            if gap < length:
                put_back((item, start + gap, length - gap))
        filled = int(limits[0] - left[0])
        if filled < capacity and alive.any():  # another limit closed it: end at a power of two
            held, back = _split(held, 1 << (filled.bit_length() - 1))
            for piece in back:
                put_back(piece)
            out.append(held)
        elif filled < capacity:  # the last: powers of two, largest first
            while held:
                head, held = _split(held, 1 << (sum(p[2] for p in held).bit_length() - 1))
                out.append(head)
        else:
            out.append(held)
    return out


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", limits=LIMITS) -> DataFrame:
    """One row per piece: where its ids lie in the document and in which sequence they go.

    ``sequence_id`` is unique: the partition's number in the high bits, a count in the low ones."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 36
        doc_ids, ids, tokens = [], [], 0

        def emit() -> pa.RecordBatch:
            nonlocal sequence, doc_ids, ids, tokens
            rows = []
            for held in pack_texts([len(x) // 4 for x in ids], limits):
                offset = 0
                for item, start, length in held:
                    rows.append((item, start, length, zlib.crc32(ids[item][4 * start:4 * (start + length)]),
                                 len(ids[item]) // 4, sequence, offset))
                    offset += length
                sequence += 1
            item, *rest = (np.array(c, dtype=np.int64) for c in zip(*rows))
            arrays = [pa.concat_arrays(doc_ids).take(pa.array(item)), *[pa.array(c) for c in rest]]
            doc_ids, ids, tokens = [], [], 0
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            for at in range(b.num_rows):
                doc_ids.append(b.column(0).slice(at, 1))
                ids.append(encoder.ids(b.column(1)[at].as_py() or "") + END_ID)
                tokens += len(ids[-1]) // 4
                if len(ids) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                    yield emit()
        if ids:
            yield emit()

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(given, of, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:]))


_encoders: dict[str, WordTokens] = {}


def _encoder(path: str) -> WordTokens:
    """One per Python worker, so its cache outlives a task."""
    if path not in _encoders:
        _encoders[path] = WordTokens(path)
    return _encoders[path]
