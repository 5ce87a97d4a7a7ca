"""The Jaccard join and NN-descent against brute force; components against union-find."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixture import SCHEMA, rows, text
from tests.llm.test_native import clashing
from trailsight.llm import nn_descent, part_enum
from trailsight.llm.components import components
from trailsight.llm.queries import QUERIES


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 430)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == roots(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_join(data):
    sets = {d: shingle_set(t) for d, t in data if d is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = roots(ids, links)
    return sorted((d is None, d or 0, len(shingle_set(t)), root.get(d)) for d, t in data)


def join_rows(frame):
    return sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in part_enum.joined(frame).collect())


def test_jaccard_join(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    want = brute_join([(r[0], r[1]) for r in rows()])
    assert join_rows(clashing(docs)) == want
    kept = part_enum.one_of_each(clashing(docs))
    assert kept.columns == clashing(docs).columns
    ids = {d for _, d, _, c in want if d is not None and d == c}
    assert sorted(r[0] for r in kept.where("doc_id is not null").collect()) == sorted(ids)


def test_one_of_each_by_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    data = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, c.upper()), (4, None), (4, None), (5, ""), (None, c), (None, c), (2, a), (6, b + " z")]
    frame = spark.createDataFrame(data, "doc_id long, text string").withColumn("_n", F.lit(1))
    kept = sorted(((r[0] is None, r[0] or 0, (r[1] or "").lower()) for r in part_enum.one_of_each(frame).collect()))
    assert kept == sorted([(False, 1, a), (False, 2, b), (False, 3, c), (False, 4, ""), (False, 4, ""), (False, 5, ""), (True, 0, c), (True, 0, c)])


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_join_at_the_bound(spark, seed):
    """Families at every size whose members lie just above and below the bound."""
    rng = random.Random(seed)
    data = []
    for size in [*range(5, 40), 47, 60, 75, 99, 140, 260, 520]:
        words = text(rng, size).split()
        data.append(" ".join(words))
        for share in (0.03, 0.06, 0.1, 0.11, 0.12, 0.2, 0.22):
            cut = max(1, round(share * size))
            kind = rng.randint(0, 2)
            other = words[cut:] if kind == 0 else words + text(rng, cut).split() if kind == 1 else words[cut // 2 :] + text(rng, cut - cut // 2).split()
            data.append(" ".join(other))
    data = list(enumerate(data))
    assert join_rows(spark.createDataFrame(data, "doc_id long, text string")) == brute_join(data)


def test_signatures_lose_no_similar_sets():
    """Similar sets share a signature, with and without common shingles taken out."""
    rng = np.random.default_rng(5)
    for size in [*range(4, 60), 100, 200, 400, 1000]:
        x = rng.integers(0, 1 << 64, size, dtype=np.uint64)
        for _ in range(4):
            low = -(-80 * size // 100)
            both = rng.integers(low, size + 1)
            extra = int(rng.integers(0, 100 * both // 80 - size + 1)) if 100 * both // 80 >= size else 0
            y = np.sort(np.concatenate([rng.permutation(x)[:both], rng.integers(0, 1 << 64, extra, dtype=np.uint64)]))
            assert 100 * both >= 80 * (size + extra)
            common = np.sort(x[rng.random(size) < rng.choice([0.0, 0.3, 1.0])])
            a, b = part_enum.signatures(np.sort(x), common), part_enum.signatures(y, common)
            assert len(np.intersect1d(a, b)) or (len(x) == len(y) == both)


def test_one_signature_of_each_group(spark):
    """Signatures of the same sets are one; each group of sets that had a signature has one still."""
    groups = [(1, 2), (1, 2), (2, 3), (1, 2, 3), (3, 2, 1), (1, 3), (2, 3)]
    sigs = spark.createDataFrame([(100 + i, n) for i, g in enumerate(groups) for n in g], "sig long, node long")
    left = {}
    for r in part_enum.one_of_each_group(sigs).collect():
        left.setdefault(r["sig"], set()).add(r["node"])
    assert sorted(map(sorted, left.values())) == [[1, 2], [1, 2, 3], [1, 3], [2, 3]]


def test_near_copies_have_few_signature_rows(spark, monkeypatch):
    """Two near copies share some hundred signatures; the rounds see one of them."""
    words = [f"word{i * i}" for i in range(600)]
    rows, real = [], part_enum.written
    monkeypatch.setattr(part_enum, "written", lambda df, *rest: (out := real(df, *rest), rows.append(out.count()) if "lead" in out.columns else None)[0])
    frame = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:-1], "other"]))], "doc_id long, text string")
    assert [r["component_id"] for r in part_enum.joined(frame).collect()] == [1, 1]
    assert rows[0] == 2


def test_common_shingles_follow_the_table(spark, monkeypatch):
    """A shingle of 40 of 400 documents is common, however much larger the table is than SAMPLE."""
    monkeypatch.setattr(part_enum, "SAMPLE", 10)
    monkeypatch.setattr(part_enum, "SAMPLE_OF", 2, raising=False)
    docs = spark.createDataFrame([(i, "all of these five words " * (i % 10 == 0) + f"a{i} b{i} c{i} d{i} e{i}") for i in range(400)], "doc_id long, text string")
    assert part_enum.shingles("all of these five words")[0] in part_enum.common_shingles(docs, 400)


def test_signatures_are_a_bucket_and_a_half(spark):
    """Only half a signature is sent, beside its bucket; and no pair of documents that share one is lost."""
    docs = [(i, " ".join(f"{'xy'[j == i]}{i % 6} w{j}" for j in range(40))) for i in range(24)]
    none = np.zeros(0, dtype=np.uint64)
    of = {part_enum.node_of(s): {int(x) for x in part_enum.signatures(s, none)} for s in (part_enum.shingles(t) for _, t in docs)}
    found = {}
    for r in part_enum.shared(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), none, 5 * part_enum.BUCKET).collect():
        assert 0 <= r["sig"] >> 32 < 5
        found.setdefault(r["sig"], set()).add(r["node"])
    pairs = {(a, b) for g in found.values() for a in g for b in g if a < b}
    assert pairs and pairs == {(a, b) for a in of for b in of if a < b and of[a] & of[b]}


@pytest.mark.parametrize("again", [False, True])
def test_sets_are_shuffled_only_if_rows_repeat(spark, monkeypatch, again):
    plans, plain = [], part_enum.written

    def seen(df, *rest):
        if "sketch" in df.columns:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, *rest)

    monkeypatch.setattr(part_enum, "written", seen)
    words = " ".join(f"w{j}" for j in range(60))
    data = [(1, words), (2, words + " end"), (3, "something else"), (1, words), (1, words)][: 5 if again else 3]
    got = join_rows(spark.createDataFrame(data, "doc_id long, text string"))
    assert got == brute_join(data)
    assert len(plans) == 1 and ("Aggregate" in plans[0]) == again


def test_stacked_sketches_are_folded():
    sets = [np.sort(np.unique(part_enum.mix(np.arange(n, dtype=np.uint64)))) for n in (500, 700, 90, 512, 2000)]
    sketches = [part_enum.sketch(s) for s in sets]
    words = min(map(len, sketches))
    want = np.stack([part_enum.folded(x, words) for x in sketches])
    assert (part_enum.stacked([x.tobytes() for x in sketches]) == want).all()
    plain = [np.bitwise_xor.reduce(np.unpackbits(x.view(np.uint8), bitorder="little").reshape(64 * words, -1), axis=1) for x in sketches]
    assert (np.unpackbits(want.view(np.uint8), axis=1, bitorder="little") == np.stack(plain)).all()


def test_shingles_follow_words():
    sets = [part_enum.shingles(t) for t in ("a b c d e", "A  b\tC\nd e", "a b c d", "", None, " \n", "a b c d f", "ab c d e f", "É a b c d", "é a b c d")]
    assert (sets[0] == sets[1]).all() and len(sets[2]) == 1 and not len(sets[3]) and not len(sets[4]) and not len(sets[5])
    assert len({s.tobytes() for s in sets}) == 7


def brute_links(data):
    out = {}
    for label in {x[2] for x in data if x[2] is not None}:
        part = [(i, x[0], np.array(x[1], dtype=float)) for i, x in enumerate(data) if x[2] == label and x[0] is not None and x[1] and None not in x[1] and np.isfinite(x[1]).all() and any(x[1])]
        ok = lambda a, b: len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98
        links = [(a[0], b[0]) for k, a in enumerate(part) for b in part[:k] if ok(a[2], b[2])]
        root = roots([p[0] for p in part], links)
        by = {}
        for i, vec_id, _ in part:
            by[root[i]] = min(by.get(root[i], vec_id), vec_id)
        for i, *_ in part:
            out[i] = (sum(i in x for x in links), by[root[i]])
    return sorted((x[0] is None, x[0] or 0, out.get(i, (0, x[0]))[0], out.get(i, (0, x[0]))[1], x[0] is not None and out.get(i, (0, x[0]))[1] == x[0]) for i, x in enumerate(data))


def vectors():
    rng = np.random.default_rng(8)
    data, n = [], 0
    for label in (0, 1, 2, None):
        for _ in range(60):
            data.append((n := n + 1, rng.standard_normal(16).tolist(), label))
        centre = rng.standard_normal(16)
        for spread in (0.03, 0.1, 0.2):
            data += [(n := n + 1, (centre + spread * rng.standard_normal(16)).tolist(), label) for _ in range(40)]
            centre = rng.standard_normal(16)
        data += [(n := n + 1, centre.tolist(), label) for _ in range(30)] + [(n := n + 1, (2 * centre).tolist(), label)]
    good = data[0][1]
    data += [(9001, None, 0), (9002, [], 0), (9003, [0.0] * 16, 0), (9004, [None, *good[1:]], 0), (9005, [float("nan"), *good[1:]], 0), (9006, [float("inf"), *good[1:]], 0)]
    data += [(9007, good, None), (None, good, 0), (9008, good[:8], 0), (9009, good, 0), (9009, good, 0), (9010, [-v for v in good], 0)]
    return data


@pytest.mark.parametrize("kind", ["double", "float"])
def test_near_duplicates(spark, kind):
    data = vectors()
    if kind == "float":
        data = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in data]
    frame = spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>, label int").withColumn("node", F.lit(1)).withColumn("grp", F.lit("x"))
    got = sorted((r[0] is None, r[0] or 0, r[1], r[2], r[3]) for r in nn_descent.near_duplicates(frame).collect())
    assert got == brute_links(data)


def family_and_pairs(seed=2, family=3000, pairs=150):
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = rng.standard_normal(64)
    out = list(unit(centre + 0.1 * rng.standard_normal((family, 64))))
    for x in unit(rng.standard_normal((pairs, 64))):
        out += [x, unit(x + 0.015 * rng.standard_normal(64))]
    return [(i, v.tolist(), 0) for i, v in enumerate(out)], family


def test_lone_pairs_beside_a_family(spark):
    data, family = family_and_pairs()
    x = np.array([v for _, v, _ in data])
    links = (x @ x.T >= 0.98).sum(axis=1) - 1
    got = {r[0]: r for r in nn_descent.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")).collect()}
    assert [got[i]["n_links"] for i, *_ in data] == links.tolist()
    assert all(got[i]["component_id"] == i - (i - family) % 2 for i in range(family, len(data)) if links[i])


@pytest.mark.parametrize("tables", [0, 1])
def test_exact_lists_stand_behind_the_tables(spark, monkeypatch, tables):
    monkeypatch.setattr(nn_descent, "MOST_TABLES", tables)
    monkeypatch.setattr(nn_descent, "TABLES", 1)
    monkeypatch.setattr(nn_descent, "RECALL", 1.1)
    monkeypatch.setattr(nn_descent, "SPLIT", 7)
    data = vectors()
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = sorted((r[0] is None, r[0] or 0, r[1], r[2], r[3]) for r in nn_descent.near_duplicates(frame).collect())
    assert got == brute_links(data)


def test_empty_tables(spark):
    assert part_enum.joined(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nn_descent.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_query_of_embeddings(spark):
    sf = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted((False, *r) for r in QUERIES["op8_embedding_near_dedup"](spark, sf).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == brute_links(data)
