"""Importance resampling towards a target distribution, over hashed word n-grams.

The features of a text are its runs of 1 to GRAMS words, joined by one blank; a feature's bucket is its
CRC-32 modulo BUCKETS. A document is scanned once, with its words lower-cased and one blank between
them, and the running CRC at the end of each word is stored. The CRC of any n-gram follows from two of
these prefixes: moving the one before it over the n-gram's length (a multiplication by a power of x
over GF(2)) and adding the one at its end cancels all that comes before.

Buckets are counted over all documents and all target texts. Each has a gain, the log ratio of the
two smoothed shares; a document's weight is its mean gain. Gumbel noise from a hash of the id is added
to it, and the highest scores are drawn, which samples without replacement in proportion to the weights.
Ranks come from ranges of the score and the counts of the ranges before.

Cases: null and empty texts, and texts without a word, have no features and weight 0. Fewer than LEAST
words are never drawn. A null id hashes as an empty one. Ties of the score go to the smaller id, null
ids last; repeated rows are rows of their own with ranks of their own. An empty target has equal
shares; no documents give no rows. Very long texts are scanned whole. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailsight.llm.common import small, written

GRAMS, BUCKETS = 2, 10_000
LEAST, PERCENT, SEED = 20, 25, "7"
#: Rows of a range that is sorted, about, and words that are hashed at a time, about.
RANGE_ROWS, HELD = 200_000, 200_000
_POLY = 0xEDB88320
#: Bytes as they are compared: A-Z lower, all ASCII but letters and digits a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the CRC's, highest power in the lowest bit."""
    out = 0
    while a:
        if a & 1 << 31:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (_POLY if b & 1 else 0)
    return out


def _tables() -> list[np.ndarray]:
    """For each k, what each byte of a CRC (four rows of 256) becomes when it moves over 2**k bytes."""
    power, out = 1 << 31 - 8, []
    for _ in range(32):
        bits = [_times(1 << i, power) for i in range(32)]
        table = np.zeros((4, 256), dtype=np.uint32)
        for row in range(4):
            for i in range(8):
                table[row, 1 << i : 2 << i] = table[row, : 1 << i] ^ np.uint32(bits[8 * row + i])
        out.append(table)
        power = _times(power, power)
    return out


_MOVES = _tables()


def moved(crc: np.ndarray, over: np.ndarray) -> np.ndarray:
    """Each CRC moved over so many bytes."""
    crc = crc.copy()
    for k in range(int(over.max()).bit_length() if len(over) else 0):
        at = np.flatnonzero(over >> k & 1)
        x, t = crc[at], _MOVES[k]
        crc[at] = t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]
    return crc


def scan(text: str | None) -> tuple[list[int], list[int]]:
    """Running CRCs of a text at the ends of its words, each word after a blank, and the bytes of the words."""
    words, crc = (text or "").encode().translate(_FOLD).split(), 0
    return [crc := zlib.crc32(w, zlib.crc32(b" ", crc)) for w in words], [len(w) for w in words]


def gram_crcs(ends: np.ndarray, sizes: np.ndarray, first: np.ndarray, most: int = GRAMS) -> list[np.ndarray]:
    """CRC-32 of the n-grams that begin at each word, for n of 1 to `most`, from the prefixes of all texts.

    `first` says at which words a text begins. An n-gram past the end of its text is left in; see `gram_ends`.
    """
    before = np.r_[np.uint32(0), ends[:-1]]
    before[first] = 0
    start = moved(before, np.ones(len(ends), dtype=np.int64)) ^ np.uint32(zlib.crc32(b" "))  # past the blank
    size, out = sizes.copy(), []
    for n in range(1, most + 1):
        k = len(ends) - n + 1
        if k <= 0:
            break
        if n > 1:
            size = size[:k] + 1 + sizes[n - 1 :]
        out.append(moved(start[:k], size) ^ ends[n - 1 :])
    return out


def buckets_of(texts: list[str | None], most: int = GRAMS, buckets: int = BUCKETS) -> list[tuple[int, np.ndarray]]:
    """(words, buckets of all features) of each text."""
    scanned = [scan(t) for t in texts]
    counts = np.array([len(s) for _, s in scanned], dtype=np.int64)
    ends = np.array([x for e, _ in scanned for x in e], dtype=np.uint32)
    sizes = np.array([x for _, s in scanned for x in s], dtype=np.int64)
    stop = np.cumsum(counts)
    first = (stop - counts)[counts > 0]
    grams = [(c % buckets).astype(np.uint32) for c in gram_crcs(ends, sizes, first, most)]
    out = []
    for n, z in zip(counts.tolist(), stop.tolist(), strict=True):
        mine = [g[z - n : z - k] for k, g in enumerate(grams) if n > k]
        out.append((n, np.concatenate(mine) if mine else np.zeros(0, dtype=np.uint32)))
    return out


def featured(rows: DataFrame, key: str, most: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """The key, n_words, n_features and features (their buckets, little-endian) of each row's text."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
        block, size = [], 0
        for t in texts:
            block.append(t)
            size += len(t or "")
            if size >= 6 * HELD:
                yield block
                block, size = [], 0
        if block:
            yield block

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for block in blocks(b["_text"].to_pylist()):
                found = buckets_of(block, most, buckets)
                ids = b[key].slice(at, len(block))
                at += len(block)
                columns = [pa.array([n for n, _ in found], pa.int64()), pa.array([len(f) for _, f in found], pa.int64()), pa.array([f.astype(kind).tobytes() for _, f in found], pa.binary())]
                yield pa.record_batch([ids, *columns], names=[key, "n_words", "n_features", "features"])

    return rows.select(F.col(key).cast("long").alias(key), F.col("text").alias("_text")).mapInArrow(find, f"{key} long, n_words long, n_features long, features binary")


def counted(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows; the driver gets one number a bucket."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for f in b["features"]:
                total += np.bincount(np.frombuffer(f.as_buffer(), dtype=kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in features.select("features").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio of the smoothed shares) of each bucket."""
    n, m = len(source) + float(source.sum()), len(source) + float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * n / ((s + 1.0) * m))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight (the floored mean gain of the features)."""
    known = features.sparkSession.sparkContext.broadcast(gain)
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.frombuffer(f.as_buffer(), dtype=kind) for f in b["features"]]
            weight = pa.array([int(known.value[f].sum()) // len(f) if len(f) else 0 for f in found], pa.int64())
            yield pa.record_batch([b["doc_id"], b["n_words"], b["n_features"], weight], names=["doc_id", "n_words", "n_features", "weight"])

    return features.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """With rank, 1 for the highest score, of the first `drawn` rows that `may` be drawn; null for the others."""
    keys = [F.col("may").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features"]
    dealt = rows.repartitionByRange(max(1, -(-rows.count() // RANGE_ROWS)), *keys).sortWithinPartitions(*keys)
    dealt, names = dealt.withColumn("part", F.spark_partition_id().cast("long")), rows.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            yield pa.record_batch([*b.columns, pa.array(np.arange(n, n + b.num_rows, dtype=np.int64))], names=[*names, "part", "nth"])
            n += b.num_rows

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    numbered = written(dealt.mapInArrow(number, schema + ", nth long"))
    # One row a range.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = numbered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("nth") + 1
    return numbered.join(small(written(ranges), 24), "part").withColumn("rank", F.when(F.col("may") & (rank <= drawn), rank))


def resampled(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, least: int = LEAST, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of each document; `target` has the texts to be like."""
    features = written(featured(docs.select("doc_id", "text"), "doc_id", grams, buckets))
    wanted = featured(target.select(F.lit(0).alias("item_id"), "text"), "item_id", grams, buckets)
    gain = gains(counted(features, buckets), counted(wanted, buckets))
    rows = weighted(features, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = written(rows.withColumn("may", F.col("n_words") >= least).drop("n_words"))
    drawn = percent * rows.where("may").count() // 100
    return ranked(rows, drawn).select("doc_id", "n_features", "weight", "score", "rank")
