"""The pipeline, stage by stage, against plain loops over all documents."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.fixture import SCHEMA, rows
from tests.llm.test_links import brute_join
from tests.llm.test_native import clashing, plain_dropped
from tests.llm.test_tokens import BYTES, plain_ids
from trailsight.llm import mixing, rank_profiles
from trailsight.llm.common import freeing, table, written

SF = "/root/testdata/sf0.001"
NAMES = ("doc_id", "text", "lang", "source", "n_chars")


def grams(text):
    padded, n = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " ", Counter()
    for k in (1, 2, 3):
        for i in range(len(padded) - k + 1):
            g = padded[i : i + k]
            if g not in (" ", "  ") and not (k == 3 and g[1] == " "):
                n[g] += 1
    return n


def ordered(n, most):
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return sorted(n, key=lambda g: (-n[g], code(g)))[:most]


def plain_language(docs):
    counts = {}
    for d in docs:
        if None not in (d["doc_id"], d["text"], d["lang"]) and zlib.crc32(str(d["doc_id"]).encode()) % 5:
            counts.setdefault(d["lang"], Counter()).update(grams(d["text"]))
    profiles = {k: {g: i for i, g in enumerate(ordered(n, rank_profiles.PROFILE))} for k, n in counts.items()}
    out = []
    for d in docs:
        top = ordered(grams(d["text"] or ""), rank_profiles.DOC_GRAMS)
        size = rank_profiles.PROFILE
        far = [sum(min(abs(p[g] - i), size) if g in p else size for i, g in enumerate(top)) for p in profiles.values()]
        if top and far and 1 - min(far) / (size * len(top)) >= rank_profiles.LEAST_SCORE:
            out.append(d)
    return out


def plain_lines(docs):
    gone, out = plain_dropped([(d["doc_id"], d["text"]) for d in docs]), []
    for d in docs:
        lines = (d["text"] or "").split("\n")
        kept = [x for i, x in enumerate(lines) if (d["doc_id"], d["text"], i) not in gone]
        if len(kept) < len(lines):
            d = d | {"text": "\n".join(kept), "n_chars": len("\n".join(kept))}
            if not re.search(r"[^\x20\x09-\x0D]", d["text"]):
                continue
        out.append(d)
    return out


def plain_join(docs):
    goes = {(i,) for null, i, _, c in brute_join([(d["doc_id"], d["text"]) for d in docs]) if not null and c != i}
    out, seen = [], set()
    for d in docs:  # the fixture has no id with two texts, but equal rows, of which one stays
        row = (d["doc_id"], d["text"])
        if (d["doc_id"],) not in goes and (d["doc_id"] is None or not (d["text"] or "").encode().split() or row not in seen):
            out.append(d)
        seen.add(row)
    return out


def plain_mix(docs):
    size = lambda d: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
    sources = sorted({d["source"] for d in docs}, key=lambda s: (s is None, s))
    sizes = {s: sum(size(d) for d in docs if d["source"] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    full, target = set(), {}
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        heavy = sum(weight[s] for s in sources if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / heavy for s in sources}
        above = {s for s in sources if s not in full and target[s] > 2 * sizes[s]}
        if not above:
            break
        full |= above

    def key(d):
        u = (int(hashlib.md5(f"{mixing.SEED}:{'' if d['doc_id'] is None else d['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        text = d["text"]
        marks = len(re.sub("[^#*$%&|<>!]", "", text)) if text is not None else 0
        return -math.log(u) / (max(0.1, 1 - 8 * marks / max(1, len(text))) if text is not None else 1.0)

    out = []
    for s in sources:
        mine = sorted((d for d in docs if d["source"] == s), key=lambda d: (key(d), d["doc_id"] is not None, d["doc_id"], size(d)))
        epochs = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, before = target[s] - epochs * sizes[s], 0
        for d in mine:
            times = epochs + (2 * before + size(d) <= 2 * rest)
            out += [d] * times if size(d) else []
            before += size(d)
    return out


PLAIN = (plain_language, plain_lines, plain_join, plain_mix)


def as_rows(docs):
    return sorted((tuple(d[c] for c in NAMES) for d in docs), key=lambda r: tuple((v is None, str(v)) for v in r))


def resident_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_tasks_give_freed_memory_back():
    """What a task has freed goes back to the system, also if something kept lies behind it."""
    kept = []

    @freeing
    def task(batches):
        parts = [bytes(2000) for _ in range(100_000)]
        kept.append(parts[-1])
        yield resident_mb()

    before = resident_mb()
    during = next(run := task([]))
    assert during > before + 150
    assert list(run) == [] and resident_mb() < before + 50


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]


@pytest.mark.parametrize("which", ["table", "fixture"])
def test_stages(spark, which):
    docs = table(spark, SF, "documents") if which == "table" else clashing(spark.createDataFrame([r for r in rows() if r[1] is None or len(r[1]) < 20_000], SCHEMA))
    columns = docs.columns
    plain = [r.asDict() for r in docs.collect()]
    for (_, stage), by_hand in zip(corpus_pipeline.STAGES[:4], PLAIN, strict=True):
        docs, plain = written(stage(spark, docs, SF)), by_hand(plain)
        assert docs.columns == columns
        assert as_rows(r.asDict() for r in docs.collect()) == as_rows(plain)
        assert plain
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    want = Counter((d["doc_id"], len(plain_ids(BYTES, d["text"], 0))) for d in plain)
    ids = Counter()
    for doc, n in want:
        ids[doc] += n * want[doc, n]
    got = Counter()
    for r in packed:
        got[r["doc_id"]] += r["length"]
    assert got == ids
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:], strict=False)) and sum(n for _, n in parts) <= 2048


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 100


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA).withColumn("extra", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = written(stage(spark, docs, SF))
        assert docs.count() == 0 and docs.columns == [*NAMES, "extra"]
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() == 0
