"""Best-fit packing with bounded space.

Documents become pieces of at most LENGTH ids, an end id included; only longer ones are cut, and only
the first piece may then be shorter than LENGTH. Pieces go to bins online: into the open bin with the
least room that is enough, found in a bitset of free spaces; else into a new one. At most OPEN bins
are open; one more closes the fullest. The pieces are dealt out in turn, so that a packing task has
a bounded number of them however many there are.

Cases: a null text is an empty one, and an empty text is its end id alone. Repeated rows are packed
each. Null ids are kept. Of bins with the same room the one that came to it last is taken or closed. Very long texts give many pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailsight.llm.common import freeing, written
from trailsight.llm.token_ids import encoder

LENGTH, END = 2048, 0
OPEN = 1024
#: Pieces of a packing task, about.
TASK_PIECES = 100_000


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    first = n % length or min(n, length)
    return [(0, first), *((s, length) for s in range(first, n, length))]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids of every piece."""

    @freeing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, True)
        for b in batches:
            rows: list[tuple] = []
            for doc, got in zip(b["doc_id"].to_pylist(), code.bulk(x.as_py() for x in b["text"]), strict=True):
                whole = np.append(got, code.type(end)).astype("<u4")
                for i, (s, n) in enumerate(cuts(len(whole), length)):
                    part = whole[s : s + n]
                    rows.append((doc, i, s, n, zlib.crc32(part.tobytes()), part.astype(np.int32) if ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")[: 5 + ids]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds[: 5 + ids], strict=False)], names=list(names))
        code.forget()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


class Bins:
    """Open bins by free space. A bin is a number; the bitset says which free spaces have bins."""

    def __init__(self, size: int, most: int, first: int = 0) -> None:
        self.size, self.most, self.next, self.open, self.bits = size, most, first, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        bin_id = self.by_free[free].pop()
        self.open -= 1
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        return bin_id

    def put(self, n: int) -> tuple[int, int]:
        """(bin, offset) for a piece of n ids."""
        fit = self.bits >> n
        if fit:
            free = n + (fit & -fit).bit_length() - 1
            bin_id = self._take(free)
        else:
            free, bin_id = self.size, self.next
            self.next += 1
        left = free - n
        if left:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[left].append(bin_id)
            self.bits |= 1 << left
            self.open += 1
        return bin_id, self.size - free


def packed(rows: DataFrame, length: int = LENGTH, most: int = OPEN) -> DataFrame:
    """The pieces (a written table) with sequence_id and offset."""
    tasks = max(1, -(-rows.count() // TASK_PIECES))
    # Dealt out in turn, not by a key: repeated ids, and rows without one, go to all tasks alike.
    dealt = rows.repartition(tasks).sortWithinPartitions(F.xxhash64("doc_id", "piece", F.lit(5)), "ids_crc32")
    names = rows.columns

    @freeing
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = None
        for b in batches:
            if bins is None and b.num_rows:
                bins = Bins(length, most, b["_part"][0].as_py() << 36)
            got = [bins.put(n) for n in b["length"].to_pylist()]
            columns = [b[c] for c in names]
            yield pa.record_batch([*columns, pa.array([x for x, _ in got], pa.int64()), pa.array([y for _, y in got], pa.int64())], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long"
    return dealt.withColumn("_part", F.spark_partition_id().cast("long")).mapInArrow(place, schema)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, most: int = OPEN, ids: bool = False) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packed(written(pieces(docs, tokenizer, length, end, ids)), length, most)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from pieces packed with their ids; `length` ids a group at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
