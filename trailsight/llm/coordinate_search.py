"""Hard negatives by inner product, with pruning by coordinates.

Vectors are filed in buckets of one label and about one length; a bucket holds at most some ROWS of
them, its largest and smallest length, and for each coordinate a list of its vectors sorted by their
values at unit length. A search for inner products of at least `floor` asks a bucket for cosines of at
least floor / (length of the anchor * length of the bucket). A bucket that can't hold them is skipped.
Else each focus coordinate (those where the anchor is largest) must have a value in a range that the
cosine allows: the sorted lists give the ranges' ends, the shortest list's part is taken and cut
with the ranges of the other focus coordinates, then with the bound that all of them give together.
What is left is verified by its exact integer product. Ranges and bounds are widened by SLACK, so
rounding loses nothing.

Floors come from SCOUTS vectors of each label that are searched first: the k-th best of some is never
above the k-th best of all. Then all vectors are searched: once for an anchor's positives in its own label, then
for the negatives of each of them in all other labels. Anchors go to buckets in blocks; a task holds one bucket and one
block. What a bucket finds is at most k vectors an anchor and window.

Cases: rows without an id, a label or a vector, with an empty vector, or with a component that is null,
not finite or of 2^26 and more after scaling take no part. Only vectors of one length are compared.
Fully equal rows count once; other rows of one id are rows of their own, told apart by a hash of their
vector, and rows of an anchor's own id are never its positives. Ties go to the smaller id, then that
hash. No rows, and no anchors, give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailsight.llm.common import small, written

SCALE, EVERY = 256, 100
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
ROWS, ANCHORS, SCOUTS = 2048, 256, 512
FOCUS, SLACK = 6, 1e-6
#: Lengths of a bucket differ by this factor at most.
BAND = 1.1
#: Buckets that one copy of a block of anchors meets, about.
PER_COPY = 32
_LEAST = -(1 << 62)
FOUND = "anchor long, akey long, win int, id long, key long, score long"


def vectors(rows: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """id, key (hash of the vector), label, dim, vec (little-endian 64-bit integers) and len of the rows that take part."""
    good = rows.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), "embedding")
    good = good.where("id is not null and label is not null and embedding is not null and size(embedding) > 0")
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float(1 << 26)))
    good = good.where(fine).select("id", "label", scaled.alias("v"))
    good = good.withColumn("key", F.xxhash64("v")).dropDuplicates(["id", "label", "key"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = [np.array(v, dtype="<i8") for v in b["v"].to_pylist()]
            dims = pa.array([len(v) for v in vecs], pa.int32())
            lens = pa.array([float(np.sqrt(float(v @ v))) for v in vecs], pa.float64())
            yield pa.record_batch([b["id"], b["key"], b["label"], dims, pa.array([v.tobytes() for v in vecs], pa.binary()), lens], names=["id", "key", "label", "dim", "vec", "len"])

    return good.mapInArrow(pack, "id long, key long, label long, dim int, vec binary, len double")


def bucketed(rows: DataFrame, size: int = ROWS) -> DataFrame:
    """The vectors as buckets, a written table: bucket (number), dim, label, and ids, keys and vecs as binary."""
    band = F.when(F.col("len") > 0, F.floor(F.log("len") / float(np.log(BAND)))).otherwise(F.lit(-(1 << 31)))
    rows = rows.withColumn("band", band)
    parts = rows.groupBy("dim", "label", "band").agg(F.ceil(F.count("*") / size).alias("parts"))
    rows = rows.join(small(written(parts), 40), ["dim", "label", "band"])
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("id", "key", F.lit(1)), F.col("parts")))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        one = block.iloc[0]
        raw = lambda c: block[c].to_numpy(dtype="<i8").tobytes()
        return pd.DataFrame({"dim": [one["dim"]], "label": [one["label"]], "band": [one["band"]], "sub": [one["sub"]], "ids": [raw("id")], "keys": [raw("key")], "vecs": [b"".join(block["vec"])]})

    packed = rows.groupBy("dim", "label", "band", "sub").applyInPandas(pack, "dim int, label long, band long, sub long, ids binary, keys binary, vecs binary")
    return written(packed.withColumn("bucket", F.xxhash64("dim", "label", "band", "sub")), "none")


class Bucket:
    """Vectors of one label and about one length, with a sorted list for each coordinate."""

    def __init__(self, dim: int, ids: bytes, keys: bytes, vecs: bytes) -> None:
        self.ids, self.keys = np.frombuffer(ids, dtype="<i8"), np.frombuffer(keys, dtype="<i8")
        self.vecs = np.frombuffer(vecs, dtype="<i8").reshape(-1, dim)
        x = self.vecs.astype(np.float64)
        lens = np.sqrt((x * x).sum(axis=1))
        self.longest, self.shortest = float(lens.max()), float(lens.min())
        self.unit = x / np.where(lens > 0, lens, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable").T.copy()
        self.lists = np.take_along_axis(self.unit, self.order.T, axis=0).T.copy()

    def candidates(self, q: np.ndarray, floor: float) -> np.ndarray:
        """Places of all vectors whose product with q may be `floor` or more, and of few others."""
        length = float(np.sqrt(q @ q))
        # For a floor above 0 the longest vectors need the least cosine, else the shortest do.
        reach = length * (self.longest if floor > 0 else self.shortest)
        everything = np.arange(len(self.ids))
        if reach == 0 or floor / reach <= -1:
            return everything[:0] if floor > 0 else everything
        cosine = floor / reach - SLACK
        if cosine > 1:
            return everything[:0]
        q = q / length
        focus = np.argsort(-np.abs(q), kind="stable")[:FOCUS]
        at = q[focus]
        middle, half = at * cosine, np.sqrt(np.maximum(0, 1 - cosine * cosine) * np.maximum(0, 1 - at * at)) + SLACK
        # Angles from the axis may differ by the angle of the cosine; past an end of the axis the range is open.
        low = np.where(at < -cosine, -1.0, middle - half) - SLACK
        high = np.where(at > cosine, 1.0, middle + half) + SLACK
        ends = [(np.searchsorted(self.lists[f], a, side="left"), np.searchsorted(self.lists[f], z, side="right")) for f, a, z in zip(focus, low, high, strict=True)]
        least = int(np.argmin([z - a for a, z in ends]))
        a, z = ends[least]
        if z - a < len(everything):
            everything = self.order[focus[least], a:z]
        values = self.unit[everything][:, focus]
        inside = ((values >= low) & (values <= high)).all(axis=1)
        rest = np.sqrt(np.maximum(0, 1 - (at * at).sum()) * np.maximum(0, 1 - (values * values).sum(axis=1)))
        return everything[inside & (values @ at + rest >= cosine - SLACK)]


def best(ids: np.ndarray, keys: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` highest scores, ties by id and key, in order."""
    if len(scores) > 4 * most:  # cut off below the most-th score, ties kept
        keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((keys[keep], ids[keep], -scores[keep]))[:most]]


def searched(buckets: DataFrame, asked: DataFrame, most: int, same_label: bool) -> DataFrame:
    """The first `most` vectors of each window of each anchor: anchor, akey, win, id, key, score.

    `asked`: id, key, label, dim, vec, and wins, an array of (win, lo, hi): scores from lo to hi are looked for
    among vectors of the anchor's label, or of all others.
    """
    by = ["dim", "label"] if same_label else ["dim"]
    counts = written(asked.groupBy(*by).agg(F.ceil(F.count("*") / ANCHORS).alias("blocks")))
    asked = asked.join(small(counts, 32), by).withColumn("block", F.pmod(F.xxhash64("id", "key", F.lit(2)), F.col("blocks")))
    blocks = asked.groupBy(*by, "block").agg(F.collect_list(F.struct("id", "key", "label", "vec", "wins")).alias("anchors"))
    blocks = written(blocks, "none")
    # Which bucket meets which block, as numbers; each block is copied so that no task meets it with all buckets.
    pairs = buckets.select("bucket", *by).join(small(counts, 32), by).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    meets = written(pairs.groupBy(*by, "block").agg(F.ceil(F.count("*") / PER_COPY).alias("copies")))
    pairs = pairs.join(small(meets, 40), [*by, "block"]).withColumn("copy", F.pmod(F.xxhash64("bucket", F.lit(3)), F.col("copies"))).drop("copies")
    copied = blocks.join(small(meets, 40), [*by, "block"]).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    met = pairs.join(copied, [*by, "block", "copy"]).select("bucket", "anchors")
    met = met.join(buckets.select("bucket", F.col("dim").alias("d"), F.col("label").alias("of"), "ids", "keys", "vecs"), "bucket")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for b in batches:
            for i in range(b.num_rows):
                of = b["of"][i].as_py()
                bucket = Bucket(b["d"][i].as_py(), *(b[c][i].as_py() for c in ("ids", "keys", "vecs")))
                out: list[list[np.ndarray]] = []
                for anchor in b["anchors"][i].as_py():
                    if (anchor["label"] == of) != same_label or not anchor["wins"]:
                        continue
                    q = np.frombuffer(anchor["vec"], dtype="<i8")
                    at = bucket.candidates(q.astype(np.float64), float(min(w["lo"] for w in anchor["wins"])))
                    if same_label:
                        at = at[bucket.ids[at] != anchor["id"]]
                    scores = bucket.vecs[at] @ q
                    for w in anchor["wins"]:
                        inside = np.flatnonzero((scores >= w["lo"]) & (scores <= w["hi"]))
                        ids, keys, found = bucket.ids[at[inside]], bucket.keys[at[inside]], scores[inside]
                        top = best(ids, keys, found, most)
                        if len(top):
                            full = lambda v: np.full(len(top), v)  # noqa: B023, E731
                            out.append([full(anchor["id"]), full(anchor["key"]), full(w["win"]), ids[top], keys[top], found[top]])
                if out:
                    cols = [pa.array(np.concatenate(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.record_batch(cols, names=[c.split()[0] for c in FOUND.split(", ")])

    found = met.select("d", "of", "ids", "keys", "vecs", "anchors").mapInArrow(search, FOUND)
    order = Window.partitionBy("anchor", "akey", "win").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def with_floors(asked: DataFrame, scouts: DataFrame, most: int, same_label: bool) -> DataFrame:
    """The asked anchors with windows that begin at the `most`-th best of the scouts, where so many are found."""
    seen = searched(scouts, asked, most, same_label).where(F.col("rank") == most).select("anchor", "akey", F.struct("win", "score").alias("x"))
    seen = written(seen.groupBy("anchor", "akey").agg(F.map_from_entries(F.collect_list("x")).alias("seen")))
    rows = asked.join(seen, (F.col("id") == F.col("anchor")) & (F.col("key") == F.col("akey")), "left")
    raised = F.transform("wins", lambda w: F.struct(w["win"].alias("win"), F.greatest(w["lo"], F.try_element_at("seen", w["win"])).alias("lo"), w["hi"].alias("hi")))
    return written(rows.select(*(raised.alias(c) if c == "wins" else c for c in asked.columns)), "none")


def mined(rows: DataFrame, label: Column, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (an id
    divisible by `every`) and each of its first `positives` vectors of its label, the first `negatives` vectors
    of other labels whose score is `low` to `high` per cent of the positive's."""
    rows = written(vectors(rows, label), "none")
    buckets = bucketed(rows)
    order = Window.partitionBy("dim", "label").orderBy(F.xxhash64("id", "key", F.lit(4)), "id", "key")
    ranked = rows.select("dim", "label", "id", "key").withColumn("n", F.row_number().over(order)).where(F.col("n") <= SCOUTS)
    scouts = bucketed(rows.join(small(written(ranked.select("label", "id", "key")), 32), ["label", "id", "key"], "left_semi").select(*rows.columns))
    anchors = written(rows.where(F.col("id") % every == 0).select("id", "key", "label", "dim", "vec"), "none")
    window = lambda win, lo, hi: F.struct(win.cast("int").alias("win"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    asked = anchors.withColumn("wins", F.array(window(F.lit(0), F.lit(_LEAST), F.lit(-_LEAST))))
    found = searched(buckets, with_floors(asked, scouts, positives, True), positives, True)
    found = written(found.select("anchor", "akey", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # The window of a positive, in whole numbers: low * score <= 100 * negative <= high * score.
    lo, hi = f"{low} * positive_score", f"{high} * positive_score"
    lo, hi = F.expr(f"({lo} + pmod(-({lo}), 100)) div 100"), F.expr(f"({hi} - pmod({hi}, 100)) div 100")
    wins = found.withColumn("lo", lo).withColumn("hi", hi).where("lo <= hi").groupBy("anchor", "akey").agg(F.sort_array(F.collect_list(window(F.col("rank"), F.col("lo"), F.col("hi")))).alias("wins"))
    asked = written(anchors.join(wins, (F.col("id") == F.col("anchor")) & (F.col("key") == F.col("akey"))).drop("anchor", "akey"), "none")
    hard = searched(buckets, with_floors(asked, scouts, negatives, False), negatives, False)
    hard = hard.select("anchor", "akey", F.col("win").alias("of"), F.col("rank").cast("int").alias("nth"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    both = hard.join(found.withColumnRenamed("rank", "of"), ["anchor", "akey", "of"])
    return both.select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("nth").alias("rank"), "negative_id", "positive_score", "negative_score")


#: The same over the table embeddings, for a second engine: all products.
SQL = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor AS anchor_id, p.id AS positive_id, (row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id))::INTEGER AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same WHERE {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) <= {NEGATIVES}
"""
