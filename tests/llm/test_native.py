"""Line frequency, line dedup and mixing against their SQL on a second engine, and against plain loops."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tests.conftest import SF
from tests.llm.fixture import SCHEMA, rows
from trailsight.llm import line_frequency, mixing, near_lines
from trailsight.llm.queries import QUERIES, statements

CLASHES = ("key", "h", "pos", "norm", "gone", "target", "size", "lines", "host", "epochs", "edge", "last", "fold", "node", "score", "lang_pred", "_text")


def clashing(frame):
    return frame.select("*", *(F.lit(7).alias(c) for c in CLASHES))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def sql_over(frame):
    con = duckdb.connect()
    con.register("documents_", pd.DataFrame([r.asDict() for r in frame.collect()], columns=frame.columns))
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, lang::VARCHAR AS lang, source::VARCHAR AS source FROM documents_")
    return con


@pytest.mark.parametrize("name", ["op1_line_frequency", "op9_line_dedup", "op10_mixing"])
def test_query(spark, name):
    frame = QUERIES[name](spark, SF)
    assert difference(frame, connect(SF), statements()[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "Arrow"))


@pytest.mark.parametrize(("limit", "share", "rest"), [(25, 0.001, 0.5), (2, 0.0, 0.5), (1, 0.2, 0.9)])
def test_line_frequency(docs, limit, share, rest):
    got = line_frequency.judged(clashing(docs), limit, share, rest)
    assert difference(got, sql_over(docs), line_frequency.sql(limit, share, rest)) is None


def test_line_frequency_rejects_depleted_documents(docs):
    got = {r["doc_id"]: r for r in line_frequency.judged(docs, 2, 0.0).collect()}
    lost = [r for r in got.values() if r["boilerplate_words"]]
    assert lost and any(not r["kept"] and not r["base_failed"] for r in line_frequency.judged(docs, 2, 0.0, 0.7).collect())
    assert any(r["kept"] for r in lost)


def test_line_frequency_takes_lines_out(docs):
    squeeze = lambda x: " ".join(x.lower().split())
    data, holders = [r.asDict() for r in docs.collect()], {}
    for r in data:
        for x in (r["text"] or "").split("\n"):
            holders.setdefault((r["source"], squeeze(x)), set()).add((r["doc_id"], r["text"]))
    frequent = {k for k, v in holders.items() if k[1] and len(v) > 2}
    want = []
    for r in data:
        kept = None if r["text"] is None else "\n".join(x for x in r["text"].split("\n") if (r["source"], squeeze(x)) not in frequent)
        want.append((r["doc_id"], r["source"], kept, r["n_chars"] if kept == r["text"] else len(kept)))
    got = line_frequency.cleaned(clashing(docs), 2, 0.0)
    assert got.columns == clashing(docs).columns + [f"_lf_{c}" for c in line_frequency.JUDGED]
    assert sorted(map(str, ((r["doc_id"], r["source"], r["text"], r["n_chars"]) for r in got.collect()))) == sorted(map(str, want))
    assert sum(w[2] != r["text"] for w, r in zip(want, data, strict=True)) > 5
    assert all(r["key"] == 7 and r["host"] == 7 and r["_lf_n_words"] - r["_lf_boilerplate_words"] == len((r["text"] or "").encode().split()) for r in got.collect())


def test_repeat_words_by_hand(spark):
    texts = ["a b c d e f g h " * 3, "a b c d e f g h x a b c d e f g h", "a b c d e f g", "", "a b c d e f g h i a b c d e f g h i"]
    frame = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    assert [r[0] for r in line_frequency.measured(frame).orderBy("doc_id").select("n_repeat_words").collect()] == [24, 16, 0, 0, 18]


def plain_dropped(data):
    """Places of lines that an earlier line equals or is one edit away from, by the definition."""

    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < near_lines.MIN_CHARS:
            return False
        if abs(len(a) - len(b)) > 1:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]

    lines = []
    for doc, text in data:
        for pos, x in enumerate((text or "").split("\n")):
            norm = x.lower().strip(" ")
            if text is not None and norm.encode().split():
                lines.append(((doc is None, doc or 0, pos), norm, (doc, text, pos)))
    return {m for at, x, m in lines if any(other < at and near(x, y) for other, y, _ in lines)}


def test_line_dedup(docs):
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    gone = plain_dropped(data)
    want = []
    for doc, text in data:
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, text, i) not in gone)
        want.append((doc, kept))
    got = near_lines.deduped(clashing(docs))
    assert got.columns[:5] == docs.columns and set(CLASHES) < set(got.columns)
    order = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=order) == sorted(want, key=order)
    assert len(gone) > 20


def test_short_lines_go_too(spark):
    texts = ["short line\n\nof its own", "short line", "SHORT LINE\n \t\n\nyes", "yes\nyes\nyet\n\n", "short line", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in near_lines.deduped(frame).collect()}
    assert [out[i]["text"] for i in range(6)] == [texts[0], "", " \t\n\nyes", "yet\n\n", "", None]
    assert {r["doc_id"] for r in near_lines.cleaned(frame).collect()} == {0, 2, 3, 5}


@pytest.mark.parametrize("size", [20, 31, 32, 33, 63, 64, 65, 511, 512, 513, 768, 1025])
def test_line_dedup_at_every_place(spark, size):
    base = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(size))
    edited = [base]
    for i in {0, 1, size // 3, size // 2, size - 2, size - 1}:
        edited += [base[:i] + "é" + base[i + 1 :], base[:i] + "Z" + base[i:], base[:i] + base[i + 1 :]]
    frame = spark.createDataFrame([(1, base)] + [(2 + i, x) for i, x in enumerate(edited)], "doc_id long, text string")
    left = {r["doc_id"] for r in near_lines.deduped(frame).where("_ll_gone = 0").collect()}
    short = {x.lower(): 2 + i for i, x in reversed(list(enumerate(edited))) if len(x) < near_lines.MIN_CHARS}
    assert left == {1} | set(short.values())


@pytest.mark.parametrize("size", [127, 128, 129, 255, 256, 257, 4097])
def test_line_dedup_at_every_place_of_narrow_stretches(spark, size):
    test_line_dedup_at_every_place(spark, size)


def test_few_variants_of_lines_that_share_a_half(spark, monkeypatch):
    """Lines that agree on a long stretch, but differ in several places, get no variants; near ones get few."""
    base = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    texts = [base[:300] + chr(65 + i) * 50 + base[350:370] + chr(65 + i) * 30 for i in range(20)] + [base, base[:111] + "é" + base[112:]]
    counts, real = {}, near_lines.written

    def written(df, *rest):
        out = real(df, *rest)
        if "kind" in out.columns:
            counts["variants"] = out.count()
        return out

    monkeypatch.setattr(near_lines, "written", written)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in near_lines.deduped(frame).where("_ll_gone > 0").collect()} == {21}
    assert counts["variants"] < 500


def test_mixing(docs):
    keyed = mixing.narrow(mixing.keyed(clashing(docs)))
    got = mixing.mixed(keyed, mixing.plan(keyed)).select("doc_id", *(F.col(f"_mix_{c}").alias(c) for c in ("size", "source_size", "target", "taken")))
    assert difference(got, sql_over(docs), mixing.SQL) is None
    out = got.toPandas()
    assert (out["taken"] <= 2 * out["size"]).all()
    copies = mixing.copies(clashing(docs))
    assert copies.columns == clashing(docs).columns
    assert copies.count() == int((out["taken"] / out["size"].where(out["size"] > 0)).fillna(0).sum())


@pytest.mark.parametrize("most", [1, 3, 40])
def test_mixing_splits_a_large_edge(spark, docs, monkeypatch, most):
    """All rows in one bucket, of marks mostly; the part that is sorted gets small."""
    monkeypatch.setattr(mixing, "EDGE_ROWS", most)
    frame = docs
    keyed = mixing.keyed(frame).withColumn("_mix_bucket", F.lit(mixing.BUCKETS - 1))
    got = mixing.mixed(mixing.narrow(keyed), mixing.plan(mixing.narrow(keyed)))
    got = got.select("doc_id", *(F.col(f"_mix_{c}").alias(c) for c in ("size", "source_size", "target", "taken")))
    assert difference(got, sql_over(frame), mixing.SQL) is None


@pytest.mark.parametrize("which", ["lines", "frequency"])
def test_places_beyond_the_broadcast_bound(docs, monkeypatch, which):
    """Nothing may be sent: the joins shuffle, with the same result."""
    run = (lambda: near_lines.deduped(docs)) if which == "lines" else (lambda: line_frequency.cleaned(docs, 2, 0.0))
    whole = sorted(map(str, run().collect()))
    monkeypatch.setattr("trailsight.llm.common.BROADCAST_BYTES", -1)
    assert sorted(map(str, run().collect())) == whole


@pytest.mark.parametrize("sizes", [[100], [100, 1, 1], [1, 1, 1, 1000], [5, 50, 500, 7, 70], [0, 10], [0, 0]])
def test_mixing_targets(spark, sizes):
    frame = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = [r["target"] for r in mixing.targets(frame).orderBy("source").collect()]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    want, fixed = [0.0] * len(sizes), set()
    while len(fixed) < len(sizes):  # share out, stop what is above, share out the rest anew
        rest = 1.5 * sum(sizes) - sum(2 * sizes[i] for i in fixed)
        heavy = sum(w for i, w in enumerate(weights) if i not in fixed)
        want = [2 * sizes[i] if i in fixed else rest * weights[i] / heavy for i in range(len(sizes))]
        above = {i for i in range(len(sizes)) if i not in fixed and want[i] > 2 * sizes[i]}
        if not above:
            break
        fixed |= above
    assert got == pytest.approx(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert line_frequency.judged(none).count() == 0
    assert near_lines.cleaned(none).count() == 0
    assert mixing.copies(none).count() == 0
    lost = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    assert mixing.copies(lost).count() == 0 and near_lines.cleaned(lost).count() == 1 and line_frequency.judged(lost).count() == 1
