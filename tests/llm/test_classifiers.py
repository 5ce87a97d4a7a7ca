"""Language ID, toxicity and quality: held-out accuracy, and the cases of their docstrings."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.fixture import SCHEMA, rows
from tests.llm.test_native import clashing
from trailsight.llm import additive, rank_profiles, ratio_linear
from trailsight.llm.common import fold, labelled, scored
from trailsight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def joined(spark, name, other, columns):
    got = QUERIES[name](spark, SF).toPandas()
    return got.merge(pd.read_parquet(f"{SF}/{other}.parquet", columns=["doc_id", *columns]), on="doc_id", how="left"), got


def test_language_id(spark):
    both, got = joined(spark, "op7_language_id", "documents", ["lang"])
    held = both[both["held_out"]]
    assert len(got) == 1000 and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert got["score"].between(0, 1).all()


def test_toxicity(spark):
    both, got = joined(spark, "op6_toxicity", "labels", ["toxic"])
    held = both[both["held_out"] & both["toxic"].notna()]
    assert len(got) == 1000 and (held["predicted"] == held["toxic"]).mean() > 0.93
    assert (held["predicted"][held["toxic"] == 0] == 0).mean() > 0.97
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()


def test_quality(spark):
    both, got = joined(spark, "op2_quality_classifier", "labels", ["quality"])
    held = both[both["held_out"] & both["quality"].notna()]
    assert len(got) == 1000 and (held["predicted"] == held["quality"]).mean() > 0.95
    assert got["score"].between(0, 1).all()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def test_language_cases(spark, docs):
    profiles = rank_profiles.learn(clashing(docs))
    assert profiles.langs == ["aa", "bb"]
    got = rank_profiles.identify(docs, profiles, ("doc_id", "text")).collect()
    assert len(got) == docs.count()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    kept = rank_profiles.recognised(clashing(docs), profiles, 0.0)
    assert kept.columns == clashing(docs).columns
    none = rank_profiles.learn(docs.where("false"))
    assert {r["lang_pred"] for r in rank_profiles.identify(docs, none).collect()} == {"und"}
    assert rank_profiles.identify(docs.where("false"), profiles).count() == 0


def test_rank_order_by_hand():
    def plain(text, profiles, top, size):
        words = "".join(c if c.isalpha() else " " for c in text.lower())
        padded, n = f" {words} ", {}
        for k in (1, 2, 3):
            for i in range(len(padded) - k + 1):
                g = padded[i : i + k]
                if (k == 1 and g == " ") or g == "  " or (k == 3 and g[1] == " "):
                    continue
                n[g] = n.get(g, 0) + 1
        code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
        ranked = sorted(n, key=lambda g: (-n[g], code(g)))[:top]
        far = [sum(min(abs(p[code(g)] - i), size) if code(g) in p else size for i, g in enumerate(ranked)) for p in profiles]
        return far, ranked, code

    train = ["the cat and the other thing", "le chat et la chose, été"]
    ranked = [plain(t, [], 300, 0) for t in train]
    code = ranked[0][2]
    known = [{code(g): i for i, g in enumerate(r[1])} for r in ranked]
    grams = np.array(sorted(set(known[0]) | set(known[1])))
    table_ = np.array([[p.get(g, -1) for g in grams.tolist()] for p in known])
    model = rank_profiles.Profiles(["en", "fr"], grams, table_, 50)
    for text in ("that other cat", "la chose est là", "x", "Les chats.\nET 12"):
        far, top, _ = plain(text, known, 20, 50)
        best = int(np.argmin(far))
        assert model.judge(text, 20) == (["en", "fr"][best], pytest.approx(1 - far[best] / (50 * len(top))))


@pytest.mark.parametrize("module", [ratio_linear, additive])
def test_labels(spark, docs, module):
    labels = spark.createDataFrame(
        [(r[0], i % 2, 1) for i, r in enumerate(rows()) if i % 3] + [(1, None, None), (None, 1, 1), (4, 0, 0), (4, 1, 1)], "doc_id long, y long, one long"
    )
    train = labelled(clashing(docs), labels, "y")
    assert train.where("doc_id = 4").select("y").distinct().collect()[0][0] == 1
    model = module.learn(train)
    got = scored(docs, ("doc_id",), model.score, 0.3).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    empty = [r["score"] for r in scored(docs.where("text is null or text = ''"), ("doc_id",), model.score, 0.3).collect()]
    assert len(set(empty)) == 1
    ones = module.learn(labelled(docs, labels.where("one = 1"), "one"))
    assert {r["score"] for r in scored(docs, ("doc_id",), ones.score, 0.3).collect()} == {1.0}
    none = module.learn(train.where("false"))
    assert {r["score"] for r in scored(docs, ("doc_id",), none.score, 0.3).collect()} == {0.0}
    assert scored(docs.where("false"), ("doc_id",), model.score, 0.3).count() == 0


def test_ratio_features_by_hand():
    got = set(ratio_linear.grams("Abcdé", (4, 5)).tolist())
    assert len(got) == 3 and got == set(ratio_linear.grams("aBCDÉ", (4, 5)).tolist())
    assert len(ratio_linear.grams("abc")) == 0 and len(ratio_linear.grams(None)) == 0


def test_additive_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = additive.fit(x, y, cycles=30, pair_cycles=60)
    assert ((m.logit(x) > 0) == (y > 0)).mean() > 0.95
    assert {p[:2] for p in m.pairs} >= {(0, 1)}


def test_fold(spark):
    for r in spark.range(50).select("id", fold(F.col("id"), 5).alias("f")).collect():
        assert r["f"] == zlib.crc32(str(r["id"]).encode()) % 5
