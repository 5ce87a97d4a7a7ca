"""Near-duplicate embeddings by NN-descent.

Each vector has a list of its nearest vectors of the same label. First lists come from blocks of
vectors with equal signs under random hyperplanes; a large block is compared part by part, each with
each. Then lists are refined: the neighbours of a vector, and those that have it as neighbour, are
compared with each other, until no list changes. A list holds its OPEN best neighbours whatever their
cosine, so that every vector is reached, and others of cosine FLOOR or more, as far ones don't lead to
links. A list that is full of links is saturated: it is enlarged to the vector's whole component, whose
vectors are then compared in blocks. Recall is audited against all vectors: of a sample of AUDIT it is
the mean, over the vectors that have links, of the share that was found, so that a pair counts as much
as a member of a family. While it is under RECALL, more hyperplane tables are added; after MOST_TABLES
the vectors of a label are all compared, in blocks. Links are exact cosines in double precision.

Cases: null, empty and zero vectors, vectors with null or non-finite components, rows without a label
or id link with nothing; so do vectors of different lengths. Equal vectors of a label are one node
with a weight, so copies cost nothing; repeated rows are vectors of their own. A row without an id has
no component and is not kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailsight.llm.common import small, written
from trailsight.llm.components import components

THRESHOLD, FLOOR, OPEN = 0.98, 0.85, 2
NEIGHBOURS, FIRST, ROUNDS = 16, 8, 6
TABLES, BLOCK, MOST_TABLES = 8, 64, 32
SPLIT = 256
AUDIT, RECALL = 400, 0.98


def unit(vecs: list[bytes] | pd.Series) -> np.ndarray:
    """Unit rows in double precision."""
    x = np.stack([np.frombuffer(v, dtype="<f8") for v in vecs])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def best_pairs(ids: np.ndarray, x: np.ndarray, most: int, floor: float, sides: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, cosine) of up to `most` nearest others of each row, the first OPEN of any cosine, the rest of
    `floor` or more; with `sides` of other sides only."""
    s = x @ x.T
    s[ids[:, None] == ids[None, :]] = -2
    if sides is not None:
        s[sides[:, None] == sides[None, :]] = -2
    k = min(most, len(ids) - 1)
    if k < 1:
        return ids[:0], ids[:0], np.zeros(0)
    at = np.argpartition(-s, k - 1, axis=1)[:, :k]
    sims = np.take_along_axis(s, at, axis=1)
    open_ = np.partition(sims, k - min(OPEN, k), axis=1)[:, k - min(OPEN, k)]
    keep = (sims >= np.minimum(floor, open_)[:, None]) & (sims > -1.5)
    return np.repeat(ids, keep.sum(axis=1)), ids[at[keep]], sims[keep]


def nodes_of(rows: DataFrame) -> DataFrame:
    """grp, embedding, node (smallest id of equal vectors), weight, vec (little-endian doubles)."""
    good = rows.where("vec_id is not null and label is not null and embedding is not null")
    fine = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v)) & F.exists("embedding", lambda v: v != 0)
    good = good.where(fine).withColumn("grp", F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string")))
    one = good.groupBy("grp", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = pa.array([np.array(v, dtype="<f8").tobytes() for v in b["embedding"].to_pylist()], pa.binary())
            yield pa.record_batch([b["grp"], b["embedding"], b["node"], b["weight"], vec], names=["grp", "embedding", "node", "weight", "vec"])

    kind = one.schema["embedding"].dataType.simpleString()
    return one.mapInArrow(pack, f"grp string, embedding {kind}, node long, weight long, vec binary")


def first_lists(nodes: DataFrame, tables: range) -> DataFrame:
    """Edges (a, b, sim) within blocks of equal hyperplane signs."""
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n"))
    sized = nodes.select("grp", "node", "vec").join(sizes, "grp")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            width = np.array([len(v) // 8 for v in b["vec"].to_pylist()])
            bits = np.clip(np.ceil(np.log2(np.maximum(1, b["n"].to_numpy() / BLOCK))), 0, 40).astype(int)
            for t in tables:
                codes = np.zeros(b.num_rows, dtype=np.int64)
                for w in np.unique(width):
                    mine = np.flatnonzero(width == w)
                    planes = np.random.default_rng([t, int(w)]).standard_normal((40, w))
                    x = unit([b["vec"][int(i)].as_py() for i in mine])
                    signs = (x @ planes.T > 0) & (np.arange(40) < bits[mine][:, None])
                    codes[mine] = signs @ (1 << np.arange(40))
                yield pa.record_batch([pa.array([t] * b.num_rows, pa.int32()), b["grp"], pa.array(codes), b["node"], b["vec"]], names=["t", "grp", "code", "node", "vec"])

    coded = written(sized.mapInArrow(code, "t int, grp string, code long, node long, vec binary"), "none")
    blocks = written(coded.groupBy("t", "grp", "code").agg(F.ceil(F.count("*") / SPLIT).alias("parts")))
    return compared(coded.join(blocks, ["t", "grp", "code"]), ["t", "grp", "code"], FIRST, FLOOR)


def compared(rows: DataFrame, keys: list[str], most: int, floor: float) -> DataFrame:
    """Edges between the nodes of a block, of which `parts` are compared two at a time; a node goes to all of them."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts")))
    sent = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    sent = sent.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        if block["i"].iloc[0] == block["j"].iloc[0]:
            block = block.drop_duplicates("node")
            sides = None
        else:
            sides = block["own"].to_numpy()
        a, b, sim = best_pairs(block["node"].to_numpy(), unit(block["vec"]), most, floor, sides)
        return pd.DataFrame({"a": a, "b": b, "sim": sim})

    return nearest(sent.groupBy(*keys, "i", "j").applyInPandas(compare, "a long, b long, sim double"))


def exact_lists(nodes: DataFrame) -> DataFrame:
    """The lists of all nodes by comparing all vectors of a label, in blocks."""
    sizes = nodes.groupBy("grp").agg(F.ceil(F.count("*") / (4 * SPLIT)).alias("parts"))
    return compared(nodes.join(small(written(sizes), 64), "grp"), ["grp"], NEIGHBOURS, FLOOR)


def nearest(edges: DataFrame, most: int = NEIGHBOURS) -> DataFrame:
    by = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    one = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    return one.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= most).drop("_n")


def refined(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """Lists after one round: members of a list, and those that list its owner, compared with each other."""
    back = nearest(lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    members = lists.unionByName(back).select("a", "b").unionByName(lists.select("a", F.col("a").alias("b"))).distinct()
    vecs = nodes.select(F.col("node").alias("b"), "vec")
    groups = members.join(vecs, "b").groupBy("a").agg(F.collect_list(F.struct("b", "vec")).alias("m"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):  # one list at a time as Python objects
                m = batch["m"][row].as_py()
                out.append(best_pairs(np.array([x["b"] for x in m], dtype=np.int64), unit([x["vec"] for x in m]), NEIGHBOURS, FLOOR))
            if out:
                a, b, sim = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.record_batch([pa.array(a), pa.array(b), pa.array(sim)], names=["a", "b", "sim"])

    return nearest(lists.unionByName(groups.select("m").mapInArrow(compare, "a long, b long, sim double")))


def _mark(lists: DataFrame) -> tuple:
    return tuple(lists.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def block_links(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links): weights of the others that a node links with in its component, compared in blocks.

    `members`: component, size, node, weight, vec. A node is sent to each block of its component.
    """
    parts = F.ceil(F.col("size") / SPLIT)
    own = members.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
    sent = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    sent = sent.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def count(block: pd.DataFrame) -> pd.DataFrame:
        i, j = int(block["i"].iloc[0]), int(block["j"].iloc[0])
        if i == j:
            block = block.drop_duplicates("node")
        x, ids, w, own = unit(block["vec"]), block["node"].to_numpy(), block["weight"].to_numpy(), block["own"].to_numpy()
        hit = x @ x.T >= threshold
        hit &= (own[:, None] != own[None, :]) if i != j else (ids[:, None] != ids[None, :])
        return pd.DataFrame({"node": ids, "links": hit @ w})

    return sent.groupBy("component", "i", "j").applyInPandas(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def recall(nodes: DataFrame, found: DataFrame, threshold: float, sample: int = AUDIT) -> float:
    """Mean share of the true links that are found (node, links), over the nodes of a sample that have some."""
    asked = nodes.orderBy(F.xxhash64("node", F.lit(9)), "node").limit(sample).select("node", "grp", "vec").toPandas()
    if not len(asked):
        return 1.0
    queries = nodes.sparkSession.sparkContext.broadcast([(g, d["node"].to_numpy(), unit(d["vec"])) for g, d in asked.groupby("grp")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grp, ids, w = np.array(b["grp"].to_pylist()), b["node"].to_numpy(), b["weight"].to_numpy()
            for g, q, x in queries.value:
                mine = np.flatnonzero(grp == g)
                if len(mine):
                    y = unit([b["vec"][int(i)].as_py() for i in mine])
                    hit = (x @ y.T >= threshold) & (q[:, None] != ids[mine][None, :])
                    yield pa.record_batch([pa.array(q), pa.array(hit @ w[mine])], names=["node", "truth"])

    truth = nodes.select("grp", "node", "weight", "vec").mapInArrow(count, "node long, truth long").groupBy("node").agg(F.sum("truth").alias("truth"))
    share = F.least("truth", F.coalesce("links", F.lit(0))) / F.col("truth")
    mean = truth.where("truth > 0").join(found, "node", "left").agg(F.avg(share)).first()[0]
    return 1.0 if mean is None else mean


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of (vec_id, embedding, label)."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    nodes = written(nodes_of(rows), "none")
    lists, done = None, 0
    tables = TABLES
    while True:
        more = first_lists(nodes, range(done, tables)) if done < MOST_TABLES else exact_lists(nodes)
        lists = written(nearest(more if lists is None else lists.unionByName(more)))
        mark = _mark(lists)
        for _ in range(ROUNDS):
            lists = written(refined(lists, nodes))
            before, mark = mark, _mark(lists)
            if mark == before:
                break
        links = written(lists.where(F.col("sim") >= threshold).select("a", "b"))
        of = written(components(links))
        full = links.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") >= NEIGHBOURS).select(F.col("a").alias("node"))
        wide = of.join(full, "node", "left_semi").select("component").distinct()
        sizes = of.groupBy("component").agg(F.count("*").alias("size")).join(wide, "component", "left_semi")
        members = of.join(written(sizes), "component").join(nodes.select("node", "weight", "vec"), "node")
        counted = written(block_links(members, threshold))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        weights = nodes.select(F.col("node").alias("b"), "weight")
        listed = both.join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("links"))
        found = written(listed.join(counted, "node", "left_anti").unionByName(counted))
        if done >= MOST_TABLES or recall(nodes, found, threshold) >= RECALL:
            break
        done, tables = tables, 2 * tables
    named = nodes.join(found, "node", "left").join(of, "node", "left")
    named = named.select("grp", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    named = written(named.withColumnRenamed("embedding", "_vec").withColumnRenamed("grp", "_grp"))
    grp = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string"))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    out = rows.join(named, known & (grp == F.col("_grp")) & (F.col("embedding") == F.col("_vec")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
