"""Packing of token ids into windows, by minimum bin slack.

A document longer than a window fills whole windows; what remains of it is one item. Items of a chunk of
documents are a multiset of lengths. For each window the longest remaining item is set, and a subset-sum
over the other lengths finds the multiset of items that comes closest to the window's end: the sums that
can be reached are the bits of one integer, a length with a count is a few shifts of it (1, 2, 4, ... items),
and walking the shifts back tells how often each length is used. A found multiset fills as many windows as
the counts allow, so many equal lengths cost one search.

Tasks pack what they read, chunk by chunk, and keep the windows that are filled exactly; nothing is
shuffled for them. The few items left over are dealt into groups of bounded size and packed again. There
an item is cut where no multiset fits exactly, so at most one window of a group is padded.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.byte_pairs import Encoder
from fleetlens.llm.tables import bounded_batches, read
from fleetlens.llm.words import pieces
from fleetlens.session import new_path

WINDOW = 2048
END_ID = 1
#: Items packed together, in a task and in a group of items left over.
CHUNK_ITEMS = 4096
_PIECE = 4 << 20

_ROW = ("doc_id", "start", "length", "ids", "doc_tokens")
_ITEM = "doc_id long, start long, length long, ids binary, doc_tokens long"
_PLACED = f"{_ITEM}, sequence_id long, offset long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def fullest(counts: Iterable[tuple[int, int]], room: int) -> Counter[int]:
    """How often each length is used in a sum of lengths that is nearest to ``room``, not beyond it.

    ``counts`` are (length, count), the longest first; the search ends as soon as the room is filled.
    """
    within, goal = (1 << (room + 1)) - 1, 1 << room
    sums, steps = 1, []
    for length, count in counts:
        left, times = min(count, room // length), 1
        while left:
            times = min(times, left)
            steps.append((length, times, sums))
            sums |= (sums << (length * times)) & within
            left -= times
            times *= 2
        if sums & goal:
            break
    best, used = sums.bit_length() - 1, Counter()
    for length, times, before in reversed(steps):
        if not before >> best & 1:
            best -= length * times
            used[length] += times
    return used


def windows(counts: dict[int, int], window: int, cut: bool) -> Iterator[tuple[Counter[int], tuple[int, int] | None, int]]:
    """Multisets of lengths that use up ``counts``, with (length, first part) of an item to cut, and how many windows each fills.

    Of a cut item the first part ends the window; the rest is an item from then on.
    """
    left = {length: n for length, n in counts.items() if n}
    order = sorted(left)
    while order:
        longest = order[-1]
        left[longest] -= 1
        room = window - longest
        fitting = range(bisect_right(order, room) - 1, -1, -1)
        used = fullest(((order[k], left[order[k]]) for k in fitting), room)
        left[longest] += 1
        used[longest] += 1
        slack = window - sum(length * n for length, n in used.items())
        split = None
        if cut and slack:
            split = next(((length, slack) for length in reversed(order) if left[length] > used[length]), None)
        need = used + Counter({split[0]: 1}) if split else used
        times = min(left[length] // n for length, n in need.items())
        yield used, split, times
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length], order[bisect_left(order, length)]
        if split:
            rest = split[0] - split[1]
            if rest not in left:
                insort(order, rest)
            left[rest] = left.get(rest, 0) + times


class Filler:
    """Places pieces (doc_id, start, length, ids, doc_tokens) into windows and hands out sequence ids."""

    def __init__(self, window: int, first_id: int):
        self.window, self.next_id = window, first_id
        self.items: list[tuple] = []
        self.rows: list[tuple] = []

    def sequence(self, items: list[tuple]) -> None:
        offset = 0
        for item in items:
            self.rows.append((*item, self.next_id, offset))
            offset += item[2]
        self.next_id += 1

    def fill(self, cut: bool) -> None:
        """Place items: with ``cut`` all of them, else those that fill a window exactly. The others stay."""
        by_length: dict[int, list[tuple]] = {}
        for item in self.items:
            by_length.setdefault(item[2], []).append(item)
        self.items = []
        for used, split, times in windows({k: len(v) for k, v in by_length.items()}, self.window, cut):
            whole = cut or sum(k * n for k, n in used.items()) == self.window
            for _ in range(times):
                chosen = [by_length[length].pop() for length, n in used.items() for _ in range(n)]
                if split:
                    length, size = split
                    doc_id, start, _, ids, doc_tokens = by_length[length].pop()
                    chosen.append((doc_id, start, size, ids[: 4 * size], doc_tokens))
                    by_length.setdefault(length - size, []).append((doc_id, start + size, length - size, ids[4 * size :], doc_tokens))
                if whole:
                    self.sequence(chosen)
                else:
                    self.items += chosen

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(_ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process, with what it remembers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack_rows(path: str, window: int, end_id: int, chunk_items: int):
    """Pieces of the documents of a task; those left over have neither sequence nor offset."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, filler = encoder(path), Filler(window, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for part, data, offsets in pieces(batch, size=_PIECE):
                ids, bounds = tokens.encode(data, offsets)
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                whole = ids.tobytes()
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    for at in range(a, b, window):
                        stop = min(at + window, b)
                        item = (doc_id, at - a, stop - at, whole[4 * at : 4 * stop], b - a)
                        if stop - at == window:
                            filler.sequence([item])
                        else:
                            filler.items.append(item)
                if len(filler.items) >= chunk_items:
                    filler.fill(cut=False)
                    if 2 * len(filler.items) > chunk_items:  # these lengths don't fit one another
                        filler.rows += [(*item, None, None) for item in filler.items]
                        filler.items = []
                yield filler.batch()
        filler.fill(cut=False)
        filler.rows += [(*item, None, None) for item in filler.items]
        yield filler.batch()

    return rows


def pack_left(window: int):
    """Pieces of the items of a group, all of them placed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler = Filler(window, (1 << 62) | (TaskContext.get().partitionId() << 33))
        for batch in batches:
            filler.items += [tuple(row.values()) for row in batch.to_pylist()]
        filler.fill(cut=True)
        yield filler.batch()

    return rows


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, chunk_items: int = CHUNK_ITEMS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text by the byte-level pair vocabulary in the file ``tokenizer``
    (the same path on all executors), and then ``end_id``; a null or empty text is ``end_id`` alone. ``ids``
    are little-endian unsigned 32-bit numbers. A sequence's pieces lie side by side from offset 0 and hold
    at most ``window`` ids. Each id is in one piece. Repeated rows are packed each; rows without an id are
    packed like others. Which documents share a sequence depends on how the input is partitioned; reading
    the same files again gives the same sequences. A very long text is encoded as one piece of a batch,
    with some 60 bytes per byte of text. An empty table gives no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    path = new_path(spark, "pieces")  # ids have many zero bytes, so they are written densely
    rows.mapInArrow(pack_rows(tokenizer, window, end_id, chunk_items), _PLACED).write.option("compression", "zstd").parquet(path)
    pieces_ = spark.read.schema(_PLACED).parquet(path)
    left = pieces_.filter("sequence_id IS NULL").select(*_ROW)
    groups = max(1, -(-left.count() // chunk_items))
    placed = left.repartition(groups).mapInArrow(pack_left(window), _PLACED)
    return pieces_.filter("sequence_id IS NOT NULL").unionByName(placed)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces_ = pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces_.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
