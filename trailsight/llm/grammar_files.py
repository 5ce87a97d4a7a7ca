"""Token-id files with Re-Pair grammar compression.

Documents are encoded in order of their ids and cut into shards. In each shard frequent pairs of ids
are replaced by nonterminals, in rounds: the most frequent pairs of a round get rules, and of two
overlapping places the one of the more frequent pair is replaced. Rounds end when no pair stands in
LEAST places; symbols past 16 bits take 32. No pair crosses the end of a
document, so each document is a run of symbols of its own. A shard holds its rules, the length that
each rule expands to, the symbols, and for each document the first symbol and the first id: any
document, or any range of one, is decoded without the rest.

The files are one row a shard, with binary columns of little-endian numbers, in a folder of Parquet
parts in ascending order of the ids; so any store that Spark reaches can hold them.

Cases: a null text is an empty one, and an empty text is its end id alone. Null ids come first; rows
of equal ids are in order of their texts' hashes. Very long texts are encoded whole, and are a shard
of their own if need be. No documents give no shards. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailsight.llm.common import small, written
from trailsight.llm.token_ids import encoder

END = 1
#: Documents of a range of ids, about, and ids of a shard after which the next one begins.
RANGE_DOCS, SHARD_IDS = 2500, 4_000_000
RULES_A_ROUND, LEAST = 4000, 24
#: Characters of the texts that are encoded together.
GROUP = 8_000_000
_NONE = np.int32(2**31 - 1)
_SLOTS = 18
SCHEMA = "part long, shard int, n_docs long, n_ids long, base int, doc_ids binary, null_ids binary, first_ids binary, first_symbols binary, rules binary, lengths binary, symbols binary"


def places(rank: np.ndarray) -> np.ndarray:
    """Places of smaller rank than those that overlap them; of a run of equal ranks every other one."""
    near = np.full(len(rank) + 2, _NONE)
    near[1:-1] = rank
    low = (rank < near[:-2]) & (rank <= near[2:])
    again = np.flatnonzero((rank == near[:-2]) & (rank < _NONE))
    if len(again):
        start = np.flatnonzero(np.r_[True, again[1:] != again[:-1] + 1])
        n = np.diff(np.r_[start, len(again)])
        nth = np.arange(1, len(again) + 1) - np.repeat(start, n)
        head = again[start] - 1
        odd = rank[head] > near[head]  # the first place of the run goes to the pair before it
        low[again] = (rank[again] <= near[again + 2]) & (nth % 2 == np.repeat(odd, n))
    return np.flatnonzero(low)


def compress(ids: np.ndarray, ends: np.ndarray, base: int, a_round: int = RULES_A_ROUND, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, the first symbol of each document, rules (left, right), and what each rule expands to in length.

    `ends`: one past the last id of each document. `base`: symbols below it are ids. Rounds go on until no
    pair has `least` places. A pair without a new symbol gains no places, so only the pairs that were
    frequent and those with a new symbol (`live`) are counted again.
    """
    x = ids.astype(np.uint32)
    last = np.zeros(len(x), dtype=bool)
    last[ends - 1] = True
    live = ~last
    rules, lengths = np.zeros((0, 2), dtype=np.uint32), np.zeros(0, dtype=np.uint32)
    while True:
        # Two symbols make one number; of 32 bits while all symbols have 16.
        narrow = base + len(rules) <= 1 << 16
        wide, half = (np.uint32, np.uint32(16)) if narrow else (np.uint64, np.uint64(32))
        mix, shift = (np.uint32(0x9E3779B1), np.uint32(32 - _SLOTS)) if narrow else (np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - _SLOTS))
        at = np.flatnonzero(live)
        if not len(at):
            break
        code = (x[at].astype(wide) << half) | x[at + 1]
        s = np.sort(code)
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        n = np.diff(np.r_[first, len(s)])
        often = np.flatnonzero(n >= least)
        if not len(often):
            break
        often = often[np.argsort(-n[often], kind="stable")]
        pairs = s[first[often]]
        slot, slots = (pairs * mix) >> shift, (code * mix) >> shift
        held = np.zeros(1 << _SLOTS, dtype=bool)
        held[slot] = True
        live[at] = held[slots]
        # Of pairs in one slot the most frequent; the others, and those past a_round, are still live in the next round.
        mine = np.sort(np.unique(slot, return_index=True)[1])[:a_round]
        pairs, slot = pairs[mine], slot[mine]
        table = np.full(1 << _SLOTS, _NONE)
        table[slot] = np.arange(len(pairs), dtype=np.int32)
        rank = table[slots]
        rank[np.append(pairs, pairs[:1])[np.minimum(rank, len(pairs))] != code] = _NONE
        ranks = np.full(len(x), _NONE)
        ranks[at] = rank
        while len(where := places(ranks)):
            x[where] = base + len(rules) + ranks[where].astype(np.uint32)
            last[where] = last[where + 1]
            for changed in (where, np.maximum(where - 1, 0)):
                live[changed], ranks[changed] = ~last[changed], _NONE
            stay = np.ones(len(x), dtype=bool)
            stay[where + 1] = False
            stay = np.flatnonzero(stay)
            x, last, live, ranks = x.take(stay), last.take(stay), live.take(stay), ranks.take(stay)
        new = np.stack([pairs >> half, pairs & wide((1 << int(half)) - 1)], axis=1).astype(np.uint32)
        size = lambda v: np.where(v < base, 1, np.append(lengths, 1)[np.minimum(np.maximum(v.astype(np.int64) - base, 0), len(lengths))])  # noqa: B023, E731
        lengths = np.concatenate([lengths, (size(new[:, 0]) + size(new[:, 1])).astype(np.uint32)])
        rules = np.concatenate([rules, new])
    return x, np.r_[0, np.flatnonzero(last)[:-1] + 1], rules, lengths


class Shard:
    """One row of the files, opened."""

    def __init__(self, row: dict) -> None:
        self.base = row["base"]
        self.rules = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(row["lengths"], dtype="<u4")
        wide = self.base + len(self.rules) > 1 << 16
        self.symbols = np.frombuffer(row["symbols"], dtype="<u4" if wide else "<u2")
        self.first_ids = np.frombuffer(row["first_ids"], dtype="<u8").astype(np.int64)
        self.first_symbols = np.frombuffer(row["first_symbols"], dtype="<u4").astype(np.int64)
        nulls = np.frombuffer(row["null_ids"], dtype=np.uint8).astype(bool)
        self.doc_ids = [None if z else int(d) for d, z in zip(np.frombuffer(row["doc_ids"], dtype="<i8"), nulls, strict=True)]
        self.size = np.concatenate([np.ones(self.base, dtype=np.int64), self.lengths.astype(np.int64)])
        self.at = np.concatenate([np.arange(self.base), self.base + np.cumsum(self.lengths, dtype=np.int64) - self.lengths])
        flat = [np.arange(self.base, dtype=np.uint32)]
        grown: list[np.ndarray] = []
        for left, right in self.rules.tolist():
            part = [grown[v - self.base] if v >= self.base else np.array([v], dtype=np.uint32) for v in (left, right)]
            grown.append(np.concatenate(part))
        self.flat = np.concatenate(flat + grown)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.size.take(symbols)
        total = np.cumsum(n)
        kind = np.int32 if not len(total) or max(total[-1], len(self.flat)) < 1 << 31 else np.int64
        place = np.repeat((self.at.take(symbols) - total + n).astype(kind), n)
        place += np.arange(len(place), dtype=kind)
        return self.flat.take(place)

    def ids(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop of the document at this place; only symbols that overlap are expanded."""
        a, b = self.first_symbols[doc], self.first_symbols[doc + 1] if doc + 1 < len(self.first_symbols) else len(self.symbols)
        symbols = self.symbols[a:b]
        upto = np.cumsum(self.size[symbols])
        stop = int(upto[-1]) if stop is None else min(stop, int(upto[-1]))
        i, j = np.searchsorted(upto, start, side="right"), np.searchsorted(upto, stop, side="left") + 1
        skipped = int(upto[i - 1]) if i else 0
        return self.expand(symbols[i:j])[start - skipped : stop - skipped]


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, shard_ids: int = SHARD_IDS, least: int = LEAST) -> None:
    """Encodes the documents and writes their shards, in ascending order of doc_id, to the folder.

    Pairs of fewer than `least` places get no rule: a rule takes room too, and rare ones take most of the time.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    # By the text as well, as rows of one id, or without one, may be too many for a range.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(max(1, -(-rows.count() // RANGE_DOCS)), *order).sortWithinPartitions(*order)
    rows = rows.withColumn("part", F.spark_partition_id().cast("long"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, False)
        base = code.tokenizer.get_vocab_size()
        held: list[np.ndarray] = []
        docs_held: list[int | None] = []
        count, shard, part = 0, 0, 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(h) for h in held])
            x, first, rules, lengths = compress(np.concatenate(held), ends, base, least=least)
            x = x.astype("<u4" if base + len(rules) > 1 << 16 else "<u2")
            doc_ids = np.array([d or 0 for d in docs_held], dtype="<i8")
            nulls = np.array([d is None for d in docs_held], dtype=np.uint8)
            blobs = (doc_ids, nulls, np.r_[0, ends[:-1]].astype("<u8"), first.astype("<u4"), rules.astype("<u4"), lengths.astype("<u4"), x)
            values = [pa.array([part], pa.int64()), pa.array([shard], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([int(ends[-1])], pa.int64()), pa.array([base], pa.int32())]
            return pa.record_batch(values + [pa.array([v.tobytes()], pa.binary()) for v in blobs], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for b in batches:
            part = b["part"][0].as_py() if b.num_rows else part
            for doc, got in zip(b["doc_id"].to_pylist(), code.bulk((x.as_py() for x in b["text"]), GROUP), strict=True):
                held.append(np.append(got, code.type(end)))
                docs_held.append(doc)
                count += len(held[-1])
                if count >= shard_ids:
                    yield flush()
                    held, docs_held, count, shard = [], [], 0, shard + 1
        if held:
            yield flush()

    rows.mapInArrow(shards, SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def documents(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of every document, decoded from the files."""
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("part", "shard", "n_ids").withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0))).drop("n_ids")
    rows = files.join(small(written(before), 32), ["part", "shard"])
    names = ["before", *(c.split()[0] for c in SCHEMA.split(", ") if "binary" in c or c.startswith("base"))]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b[c][i].as_py() for c in names}
                s = Shard(row)
                ids = s.expand(s.symbols).astype("<u4")
                stops = np.append(s.first_ids[1:], len(ids))
                crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(s.first_ids, stops, strict=True)]
                yield pa.record_batch(
                    [pa.array(s.doc_ids, pa.int64()), pa.array(s.first_ids + row["before"]), pa.array(stops - s.first_ids), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return rows.select(*names).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
