"""Documents as token sequences of a fixed length, packed online with bounded space.

Each partition keeps a fixed number of open windows. What is left of a document after whole windows
goes into the open window where it fits best. If none fits, the fullest one is filled up with the head
of the document and emitted, and the tail is placed again. A partition thus holds ``open_windows`` rows
of bookkeeping whatever its size, and only its leftover windows are not full; their pieces (with their
ids, at most ``open_windows`` sequences a partition) are merged afterwards through a single open window,
in groups of bounded size. Other token ids never move between tasks.

Defined results: a null text is an empty one, and an empty one is just the end token; rows that repeat
an id are packed one by one; a null id stays null; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import as_table
from tidemark.llm.token_ids import word_ids
from tidemark.sources.scratch import stored

CAPACITY = 2048
OPEN_WINDOWS = 32
END_ID = 1
#: Partitions whose leftovers are merged in one task.
MERGED_PARTITIONS = 32
_BATCH_CHARS = 1_000_000

_PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("open_ids", T.BinaryType()),
])
_NAMES = _PIECES.names[:-1]


class Windows:
    """The open windows of one partition; pieces come out with their sequence and place."""

    def __init__(self, capacity: int, most: int, first_id: int):
        self.capacity, self.most, self.next_id = capacity, most, first_id
        self.gaps: list[tuple[int, int]] = []  # (gap, sequence), smallest gap first

    def place(self, length: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of each piece of a document."""
        pieces, start = [], 0

        def put(n: int, gap: int, sequence: int) -> int:
            pieces.append((start, n, sequence, self.capacity - gap))
            if gap > n:
                insort(self.gaps, (gap - n, sequence))
            return start + n

        while start < length:
            rest = length - start
            if rest < self.capacity:
                at = bisect_left(self.gaps, (rest, -1))
                if at < len(self.gaps):  # best fit
                    start = put(rest, *self.gaps.pop(at))
                    continue
                if len(self.gaps) == self.most:  # none fits: the fullest takes what it can and goes
                    gap, sequence = self.gaps.pop(0)
                    start = put(gap, gap, sequence)
                    continue
            start = put(min(rest, self.capacity), self.capacity, self.next_id)
            self.next_id += 1
        return pieces


def _batches(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts in portions of bounded size."""
    for frame in frames:
        ids, texts, size = [], [], 0
        for key, text in zip(frame.column("id").to_pylist(), frame.column("text")):
            text = text.as_py() or ""
            ids.append(key)
            texts.append(text)
            size += len(text)
            if size > _BATCH_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
        yield ids, texts


def _pack_partition(tokenizer: str, capacity: int, most: int):
    schema = pa.schema([
        (f.name, pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.int64()) for f in _PIECES
    ])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        windows = Windows(capacity, most, TaskContext.get().partitionId() << 32)
        pending: dict[int, list[tuple]] = {}  # pieces in windows that are still open, and their ids
        end = END_ID.to_bytes(4, "little")

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = [*zip(*rows)] if rows else [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for keys, texts in _batches(frames):
            done = []
            for key, ids in zip(keys, encoder.encode(texts)):
                ids += end
                total = len(ids) // 4
                for start, n, sequence, offset in windows.place(total):
                    own = ids[4 * start : 4 * (start + n)]
                    row = (key, start, n, zlib.crc32(own), total, sequence, offset)
                    if offset + n == capacity:
                        done.extend((*r, None) for r, _ in pending.pop(sequence, ()))
                        done.append((*row, None))
                    else:
                        pending.setdefault(sequence, []).append((row, own))
            yield batch(done)
        yield batch([(*row, own) for rows in pending.values() for row, own in rows])

    return run


def _merged(capacity: int):
    """Pieces of leftover windows, largest first, through one open window; it is cut full each time."""

    schema = pa.schema([(name, pa.int64()) for name in _NAMES])

    def run(key: tuple, pieces: pa.Table) -> pa.Table:
        windows = Windows(capacity, 1, (1 << 62) + (key[0].as_py() << 32))
        moved = []
        for p in sorted(pieces.to_pylist(), key=lambda p: (-p["length"], p["sequence_id"], p["offset"])):
            for start, n, sequence, offset in windows.place(p["length"]):
                crc = zlib.crc32(p["open_ids"][4 * start : 4 * (start + n)])
                moved.append((p["doc_id"], p["start"] + start, n, crc, p["doc_tokens"], sequence, offset))
        return pa.table([pa.array(c, pa.int64()) for c in zip(*moved)], schema=schema)

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """The pieces of all documents: where each run of ids lies and the checksum of its ids.

    ``tokenizer`` is the path of a word-end vocabulary file on the executors. Columns: doc_id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    rows = as_table(docs, id=id_col, text=text_col)
    packed = rows.mapInArrow(_pack_partition(tokenizer, capacity, open_windows), _PIECES)
    packed = stored(packed, "pieces")
    group = F.floor(F.shiftright("sequence_id", 32) / MERGED_PARTITIONS)
    left = packed.filter("open_ids is not null").groupBy(group.alias("merge_group"))
    merged = left.applyInArrow(_merged(capacity), T.StructType(_PIECES[:-1]))
    return packed.filter("open_ids is null").select(_NAMES).unionByName(merged)
