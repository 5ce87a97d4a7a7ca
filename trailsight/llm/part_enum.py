"""Exact n-gram Jaccard join by PartEnum signatures.

A document's set holds the hashes of its distinct five-word shingles. Sets are filed in size bands; of
two similar sets the smaller is in the band of the larger or the one before, so each set joins in its
own band and the next. Within a band, similar sets differ in at most k shingles. The domain of hashes
is cut into n1 parts, each part into three cells: by the pigeonhole principle similar sets differ in
at most one shingle in at least one part, so they agree on two of its three cells. The signatures are
the contents of all pairs of cells of all parts.

Two refinements keep this exact and keep signatures from being shared for nothing:

* Empty contents give no signature. `spare` parts more than needed are cut; a set with more bad parts
  (some pair of cells is empty) than that is odd. Similar sets that are both odd are found by their
  prefixes instead: the shingles that the larger of two similar sets cannot all lack in the other.
* Shingles that very many documents share (estimated on a sample) are left out of the domain, which
  can't raise the difference of two sets, and come last in a prefix.

Sets that share a signature are candidates. Near copies share most of their signatures, so of signatures
with the same sets one is taken. In some rounds one set of each signature is held against
the others, and components are formed of the true links. Then only pairs of a signature that are still
in different components are left; they are compared in blocks. Before two sets are fetched, sketches
of them must allow for the similarity: a bit for each range of hashes holds the parity of its count,
so the bits that differ are no more than the shingles that differ. Equal sets are one node, so copies
cost nothing.

Cases: null and empty texts, and texts without a word, have an empty set and link with nothing. Fewer
than five words are one shingle. Rows without an id have their count, but link with nothing and have
no component. Repeated rows and equal sets are one component. Very long texts are read whole. Other
columns pass through `one_of_each`, and are not read elsewhere. An id with several texts stands for each of them: it is in the component of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailsight.llm.common import freeing, small, written
from trailsight.llm.components import components

WORDS, PERCENT = 5, 80
#: Documents that the common shingles are estimated on: at least so many, and one of so many. How many of them must share one.
SAMPLE, SAMPLE_OF, COMMON, COMMON_MOST = 4000, 16, 4, 200_000
#: Signatures that a task holds at a time, and of a bucket, about.
HELD, BUCKET = 400_000, 1_000_000
#: Rounds of one set against the others of a signature, and sets of a block that are compared at once.
STARS, BLOCK = 3, 256
#: Smallest signatures of a set that go with it, so that a pair of many common signatures is given once.
FIRSTS = 48
_U = np.uint64
_BASE, _A, _B = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: list[np.ndarray] = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _A
    h = (h ^ (h >> _U(27))) * _B
    return h ^ (h >> _U(31))


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for i, base in enumerate((_BASE, _INVERSE)):
            _powers[i] = np.multiply.accumulate(np.r_[_U(1), np.full(size - 1, base)])
    return _powers


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    raw = _LOWER[np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)]
    space = np.r_[True, _SPACE[raw], True]
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, dtype=_U)
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum((raw.astype(_U) + _U(1)) * up[: len(raw)], out=sums[1:])
    w = mix((sums[ends] - sums[starts]) * down[starts] + _U(1))
    n = min(words, len(w))
    h = np.zeros(len(w) - n + 1, dtype=_U)
    for i in range(n):
        h = h * _A + w[i : len(w) - n + 1 + i]
    h = np.sort(mix(h ^ _U(n)))
    return h[np.r_[True, h[1:] != h[:-1]]]


def node_of(s: np.ndarray) -> int:
    """A number for the whole set."""
    return int(mix(np.array([mix(s * _B).sum() + _U(len(s))], dtype=_U)).view(np.int64)[0])


@lru_cache(maxsize=None)
def band(size: int) -> tuple[int, int]:
    """(smallest, largest) size of the band of a size; the largest is at most 100 / PERCENT times the smallest."""
    low = 1
    while True:
        high = max(low, 100 * low // PERCENT)
        if size <= high:
            return low, high
        low = high + 1


@lru_cache(maxsize=None)
def shape(high: int) -> tuple[int, int]:
    """(n1, spare) of the band with this largest size; n1 is 0 if only equal sets are similar."""
    k = 2 * high * (100 - PERCENT) // (100 + PERCENT)
    if k == 0:
        return 0, 0
    need, spare = k // 2 + 1, 0
    least = PERCENT * band(high)[0] / 100
    if k >= 8:
        for _ in range(6):  # as many spare parts as a small set of the band will hardly exceed
            bad = min(1.0, 3 * np.exp(-least / (need + spare) * 2 / 3)) * (need + spare)
            spare = min(int(np.ceil(bad + 3 * np.sqrt(bad))), need // 2)
    return need + spare, spare


def signatures(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The signatures of a set, in its band and the next, with its prefix if it is odd."""
    if not len(s):
        return s
    at = np.searchsorted(common, s)
    usual = np.append(common, _U(0))[at] == s if len(common) else np.zeros(len(s), dtype=bool)
    rare, out, odd = s[~usual], [], False
    low, high = band(len(s))
    following = band(high + 1)
    for top in [high] + ([following[1]] if 100 * len(s) // PERCENT >= following[0] else []):
        n1, spare = shape(top)
        if not n1:
            continue
        # Cells are equal ranges of the hash, so a sorted set lies in them one after another.
        cells = 3 * n1
        edge = np.searchsorted(rare, (np.arange(cells + 1) * (2.0**64 / cells)).clip(max=2.0**64 - 2049).astype(_U))
        edge[-1] = len(rare)
        sums = np.zeros(len(rare) + 1, dtype=_U)
        np.cumsum(mix(rare * _A + _U(top)), out=sums[1:])
        content = (sums[edge[1:]] - sums[edge[:-1]]).reshape(n1, 3)
        count = np.diff(edge).reshape(n1, 3)
        pairs = np.stack([content[:, i] * _A + content[:, j] * _B + _U(17 * i + j) for i, j in ((0, 1), (0, 2), (1, 2))], axis=1)
        held = np.stack([count[:, i] + count[:, j] for i, j in ((0, 1), (0, 2), (1, 2))], axis=1) > 0
        place = (np.arange(n1, dtype=_U) * _BASE + _U(top))[:, None]
        out.append(mix(pairs + place)[held])
        odd |= int((~held.all(axis=1)).sum()) > spare
    if odd:
        most = len(s) - -(-PERCENT * len(s) // 100) + 1
        out.append(mix(np.concatenate([rare, s[usual]])[:most] ^ _B))
    return np.concatenate(out) if out else np.zeros(0, dtype=_U)


def counted(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, node (a number for the set, null for an empty one) and text_hash."""

    @freeing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = (shingles(t.as_py(), words) for t in b["text"])  # one at a time
            sizes, nodes = zip(*((len(s), node_of(s) if len(s) else None) for s in sets), strict=True) if b.num_rows else ((), ())
            yield pa.record_batch([b["doc_id"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), b["text_hash"]], names=["doc_id", "n_shingles", "node", "text_hash"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(count, "doc_id long, n_shingles long, node long, text_hash long")


def common_shingles(docs: DataFrame, rows: int, words: int = WORDS) -> np.ndarray:
    """Shingles that many documents of a sample share; they steer the cost, not the result.

    The sample is a share of the table, so that as many documents make a shingle common however large it is.
    """
    one_of = min(SAMPLE_OF, max(1, rows // SAMPLE))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(one_of)) == 0).select("text")

    @freeing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, n = np.unique(np.concatenate([shingles(t, words) for t in b["text"].to_pylist()]), return_counts=True)
            yield pa.record_batch({"h": h.view(np.int64), "n": n.astype(np.int64)})

    often = sample.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    top = often.orderBy(F.desc("n"), "h").limit(COMMON_MOST).select("h").toPandas()
    return np.sort(top["h"].to_numpy(dtype=np.int64).view(_U))


def shared(docs: DataFrame, common: np.ndarray, total: int, words: int = WORDS) -> DataFrame:
    """(sig, node) of every signature that two different sets have.

    Tasks send signatures in blocks, one for each bucket. What a task itself finds shared is sent as
    found, with one set of it to look for more elsewhere, so a bucket gets each signature from a task
    at most once and a very common one makes no large bucket. A signature becomes its bucket and its lower
    half, of which only the half is sent; different ones that become equal give candidates that fail.
    """
    known = docs.sparkSession.sparkContext.broadcast(common)
    buckets = max(1, -(-total // BUCKET))

    @freeing
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        count = 0

        def blocks(s: np.ndarray, n: np.ndarray, kind: int, deal: np.ndarray) -> pa.RecordBatch:
            """One row for each bucket; sets that follow each other in a bucket are sent as runs."""
            order = np.argsort(deal.astype(np.uint16) if buckets < 1 << 16 else deal, kind="stable")
            s, n, deal = s[order], n[order], deal[order]
            at = np.flatnonzero(np.r_[True, deal[1:] != deal[:-1]])
            cut = list(zip(at, np.r_[at[1:], len(deal)], strict=True))
            run = np.flatnonzero(np.r_[True, (n[1:] != n[:-1]) | (deal[1:] != deal[:-1])])
            nodes, counts = n[run], np.diff(np.r_[run, len(n)]).astype(np.uint32)
            runs = list(zip(np.searchsorted(run, at), np.r_[np.searchsorted(run, at[1:]), len(run)], strict=True))
            raw = lambda v, ranges: pa.array([v[a:z].tobytes() for a, z in ranges], pa.binary())
            sent = s if kind == 2 else s.astype(np.uint32)
            values = [pa.array(deal[at].astype(np.int32)), pa.array([kind] * len(cut), pa.int32()), raw(sent, cut), raw(nodes, runs), raw(counts, runs)]
            return pa.record_batch(values, names=["bucket", "kind", "sigs", "nodes", "counts"])

        def flush() -> Iterator[pa.RecordBatch]:
            s, n = np.concatenate(sigs), np.concatenate(nodes)
            deal = (s >> _U(32)) * _U(buckets) >> _U(32)
            s = deal << _U(32) | s & _U(0xFFFFFFFF)
            deal = deal.astype(np.int64)
            order = np.argsort(s)
            same = s[order][1:] == s[order][:-1]
            again = order[np.r_[False, same] | np.r_[same, False]]  # signatures seen more than once, few
            single = np.ones(len(s), dtype=bool)
            single[again] = False
            if single.any():
                yield blocks(s[single], n[single], 0, deal[single])
            again = again[np.lexsort((n[again], s[again]))]
            first = np.r_[True, s[again][1:] != s[again][:-1]] if len(again) else np.zeros(0, dtype=bool)
            new = first.copy()
            new[1:] |= n[again][1:] != n[again][:-1]
            again, first = again[new], first[new]
            many = np.repeat(np.diff(np.r_[np.flatnonzero(first), len(first)]) > 1, np.diff(np.r_[np.flatnonzero(first), len(first)]))
            for pick, kind in ((~many, 0), (many & first, 1)):
                if pick.any():
                    yield blocks(s[again[pick]], n[again[pick]], kind, deal[again[pick]])
            rest = again[many & ~first]
            if len(rest):
                yield blocks(s[rest], n[rest], 2, np.arange(len(rest)) * buckets // len(rest))

        for b in batches:
            for text in b["text"]:
                s = shingles(text.as_py(), words)
                sig = signatures(s, known.value)
                if len(sig):
                    sigs.append(sig)
                    nodes.append(np.full(len(sig), node_of(s)))
                    count += len(sig)
                if count >= HELD:
                    yield from flush()
                    sigs, nodes, count = [], [], 0
        if count:
            yield from flush()

    def match(block: pd.DataFrame) -> pd.DataFrame:
        part = lambda rows, c, t: np.concatenate([np.zeros(0, dtype=t), *(np.frombuffer(x, dtype=t) for x in rows[c])])
        named = lambda rows: np.repeat(part(rows, "nodes", np.int64), part(rows, "counts", np.uint32))
        found, rest = block[block["kind"] == 2], block[block["kind"] != 2]
        s, n = part(rest, "sigs", np.uint32), named(rest)
        sure = np.concatenate([np.zeros(0, dtype=bool), *(np.full(len(x) // 4, k == 1) for x, k in zip(rest["sigs"], rest["kind"], strict=True))])
        order = np.argsort(s)
        s, n, sure = s[order], n[order], sure[order]
        at = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, dtype=np.int64)
        size = np.diff(np.r_[at, len(s)])
        if len(at):
            keep = np.repeat(np.logical_or.reduceat(sure, at) | (np.minimum.reduceat(n, at) < np.maximum.reduceat(n, at)), size)
            s, n = s[keep], n[keep]
        s = s.astype(_U) | _U(block["bucket"].iloc[0]) << _U(32)
        s, n = np.concatenate([s, part(found, "sigs", _U)]), np.concatenate([n, named(found)])
        return pd.DataFrame({"sig": s.view(np.int64), "node": n})

    sent = docs.where("doc_id is not null").select("text").mapInArrow(send, "bucket int, kind int, sigs binary, nodes binary, counts binary")
    return sent.groupBy("bucket").applyInPandas(match, "sig long, node long").distinct()


def one_of_each_group(sigs: DataFrame) -> DataFrame:
    """The rows (sig, node) of one signature for each group of nodes that have a signature in common.

    Signatures of equal groups give the same pairs. Groups are told apart by their size and two hashes.
    """
    hashes = (F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in range(2))
    groups = sigs.groupBy("sig").agg(F.count("*").alias("n"), *hashes)
    one = groups.groupBy("n", "h0", "h1").agg(F.min("sig").alias("sig"))
    return sigs.join(one.select("sig"), "sig", "left_semi")


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the numbers of hashes in equal ranges, at least as many ranges as hashes, in 64-bit words."""
    bits = max(9, int(len(s) - 1).bit_length())
    odd = np.bincount((mix(s ^ _A) >> _U(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(_U)


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """A sketch (or rows of sketches) in fewer ranges: neighbouring parities are added up until so many words are left."""
    while x.shape[-1] > words:
        bits = np.unpackbits(x.view(np.uint8), axis=-1, bitorder="little")
        x = np.packbits(bits[..., ::2] ^ bits[..., 1::2], axis=-1, bitorder="little").view(_U)
    return x


def stacked(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows, all of as many words as the shortest one."""
    size = np.array([len(x) for x in sketches])
    out = np.empty((len(size), size.min() // 8), dtype=_U)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        out[at] = folded(np.frombuffer(b"".join([sketches[x] for x in at]), dtype=_U).reshape(len(at), -1), out.shape[1])
    return out


def may_differ(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Shingles that similar sets of these sizes can differ in at most; -1 if the sizes rule it out."""
    most = (n + m) * (100 - PERCENT) // (100 + PERCENT)
    return np.where(100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m), most, -1)


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sketches allow for similarity."""

    @freeing
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = may_differ(batch["na"].to_numpy(), batch["nb"].to_numpy())
            ok = []
            for x, y, k in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), most.tolist(), strict=True):
                x, y = np.frombuffer(x, dtype=_U), np.frombuffer(y, dtype=_U)
                words = min(len(x), len(y))
                ok.append(k >= 0 and int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()) <= k)
            keep = pa.array(ok, pa.bool_())
            yield pa.record_batch([batch["a"].filter(keep), batch["b"].filter(keep)], names=["a", "b"])

    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y")), "b")
    return both.select("a", "b", "na", "nb", "x", "y").mapInArrow(check, "a long, b long")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes, a written table, whose sets are similar."""

    @freeing
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=_U), np.frombuffer(y, dtype=_U)
                both = np.sort(np.concatenate([x, y]))
                inside = int((both[1:] == both[:-1]).sum())
                ok.append(100 * inside >= PERCENT * (len(both) - inside))
            keep = pa.array(ok, pa.bool_())
            yield pa.record_batch([b["a"].filter(keep), b["b"].filter(keep)], names=["a", "b"])

    pairs = small(pairs, 24)
    mine, theirs = sets.select(F.col("node").alias("a"), F.col("set").alias("x")), sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    # Only sets that are asked for are sent on.
    theirs = theirs.join(small(written(pairs.select("b").distinct()), 16), "b", "left_semi")
    both = mine.join(pairs, "a").join(theirs, "b")
    return both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def block_pairs(tagged: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of a signature in different components whose sketches allow for similarity.

    `tagged`: sig, node, c (component), n (sets of the signature). A set is sent to each block of its signature,
    with those of its FIRSTS smallest signatures that are smaller: a pair that has one of them in common is left to it.
    """
    firsts = tagged.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("sig")), 1, FIRSTS).alias("firsts"))
    own = tagged.join(sets.select("node", F.col("n").alias("size"), "sketch"), "node").join(firsts, "node")
    place = F.array_position("firsts", F.col("sig"))
    own = own.withColumn("firsts", F.when(place > 0, F.slice("firsts", F.lit(1), (place - 1).cast("int"))).otherwise(F.col("firsts")))
    own = own.withColumn("parts", F.ceil(F.col("n") / BLOCK))
    own = own.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
    sent = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    sent = sent.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    blocks = sent.groupBy("sig", "i", "j").agg(F.collect_list(F.struct("node", "c", "size", "sketch", "own", "firsts")).alias("m"))

    @freeing
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # one block at a time
                (i, j), m = (batch[c][row].as_py() for c in ("i", "j")), batch["m"][row].values
                node, c, size, own = (m.field(f).to_numpy() for f in ("node", "c", "size", "own"))
                sketches, firsts = stacked(m.field("sketch").to_pylist()), m.field("firsts")
                step = max(1, (1 << 18) // sketches.size)
                for k in range(0, len(node), step):
                    mine = slice(k, k + step)
                    near = (node[None] < node[mine, None]) & (c[None] != c[mine, None])
                    if i != j:
                        near &= own[None] != own[mine, None]
                    if not near.any():
                        continue
                    differ = np.bitwise_count(sketches[None] ^ sketches[mine, None]).sum(axis=2, dtype=np.int64)
                    near &= differ <= may_differ(size[None], size[mine, None])
                    pairs = [(a + k, b) for a, b in np.argwhere(near).tolist() if not len(np.intersect1d(firsts[a + k].values, firsts[b].values))]
                    if pairs:
                        a, b = np.array(pairs).T
                        yield pa.record_batch([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    return blocks.mapInArrow(compare, "a long, b long").distinct()


def node_sets(docs: DataFrame, reps: DataFrame, words: int = WORDS) -> DataFrame:
    """node, n, sketch and set (sorted hashes) of the documents that stand for the nodes of reps (doc_id, node)."""

    @freeing
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, text in zip(b["node"].to_pylist(), b["text"].to_pylist(), strict=True):
                s = shingles(text, words)
                if len(s) and node_of(s) == node:
                    values = [pa.array([node], pa.int64()), pa.array([len(s)], pa.int64()), pa.array([sketch(s).tobytes()], pa.binary()), pa.array([s.tobytes()], pa.binary())]
                    yield pa.record_batch(values, names=["node", "n", "sketch", "set"])

    rows = docs.select("doc_id", "text").join(reps.select("node", "doc_id"), "doc_id")
    return rows.select("node", "text").mapInArrow(build, "node long, n long, sketch binary, set binary")


def grouped(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, component (a node of it, null without a word) and text_hash of each document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(counted(docs, words))
    n, total = rows.agg(F.count("*"), F.sum("n_shingles")).first()
    common = common_shingles(docs, n, words)
    sigs = written(one_of_each_group(written(shared(docs, common, total or 0, words))))
    nodes = sigs.select("node").distinct()
    ids = rows.where("doc_id is not null").join(nodes, "node", "left_semi").groupBy("node", "doc_id").agg(F.count("*").alias("rows"))
    reps = written(ids.groupBy("node").agg(F.min(F.struct("doc_id", "rows")).alias("r")).select("node", "r.doc_id", "r.rows"))
    # Only rows that are repeated give a set twice; the sets of the others need no shuffle.
    sets = node_sets(docs, small(reps.where("rows = 1"), 16), words)
    again = reps.where("rows > 1")
    if not again.isEmpty():
        sets = sets.unionByName(node_sets(docs, small(again, 16), words).dropDuplicates(["node"]))
    sets = written(sets, "none")
    tagged, links, of = sigs.withColumn("c", F.col("node")), None, None
    for turn in range(STARS + 1):
        # Signatures whose sets are not all in one component so far.
        open_sigs = tagged.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n"), F.min(F.xxhash64("node", F.lit(turn))).alias("lead"))
        # The only pair of a signature of two is settled by the first round.
        open_sigs = open_sigs.where("lo < hi" if turn == 0 else "lo < hi and n > 2")
        tagged = written(tagged.join(open_sigs.drop("lo", "hi"), "sig"))
        if turn < STARS:
            lead = tagged.where(F.xxhash64("node", F.lit(turn)) == F.col("lead")).select("sig", F.col("node").alias("b"), F.col("c").alias("d"))
            pairs = tagged.select("sig", F.col("node").alias("a"), "c").join(lead, "sig").where("c <> d").select("a", "b").distinct()
            pairs = possible(pairs, sets)
        else:
            pairs = block_pairs(tagged, sets)
        new = written(linked(written(pairs), sets))
        tagged = tagged.drop("n", "lead")
        if new.isEmpty():
            continue
        links = new if links is None else links.unionByName(new)
        of = written(components(links))
        tagged = tagged.drop("c").join(of, "node", "left").select("sig", "node", F.coalesce("component", "node").alias("c"))
    if of is None:
        of = rows.where("false").select("node", F.col("node").alias("component"))
    firsts = rows.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    firsts = firsts.join(of, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    smallest = firsts.groupBy("component").agg(F.min("first").alias("component_id"))
    named = written(firsts.join(smallest, "component").select(F.col("node").alias("_node"), "component", "component_id"))
    out = rows.join(named, F.col("node") == F.col("_node"), "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), own).alias("component_id")
    return out.select("doc_id", "n_shingles", component, "component", "text_hash")


def joined(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id of each document."""
    return grouped(docs, words).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of each component, and all rows without an id or without a word.

    The row has the component's smallest id; of several texts with that id, one by their hashes, and of
    fully equal rows (id and text) one. A text that is linked with nothing stays, whatever ids it shares.
    """
    rows = grouped(docs, words).where("doc_id is not null and component is not null")
    texts = written(rows.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("n")))
    # An id can be the smallest of several components, by different texts; so they are told apart by nodes.
    first = texts.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    texts = texts.join(first, "component").withColumn("stays", F.struct("doc_id", "text_hash") == F.col("first"))
    texts = written(texts.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "stays", "n"))
    goes, again = texts.where("not stays"), texts.where("stays and n > 1")
    keyed = docs.withColumn("_of", F.xxhash64("text"))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_of") == F.col("_hash"))
    if again.isEmpty():
        return keyed.join(small(goes, 24, goes.count()), same, "left_anti").drop("_of")
    # Rows that are repeated go out with the others, and one of each comes back.
    rest = texts.where("not stays or n > 1")
    one = keyed.join(small(again, 24), same, "left_semi").dropDuplicates(["doc_id", "_of"])
    return keyed.join(small(rest, 24), same, "left_anti").unionByName(one).drop("_of")
