"""Chat windows, importance resampling and hard negatives against plain loops."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tests.conftest import SF
from tests.llm.fixture import SCHEMA, rows
from trailsight.llm import chat_windows, coordinate_search, gram_importance
from trailsight.llm.queries import QUERIES, tokenizer
from trailsight.llm.token_ids import Encoder

BYTES = tokenizer("byte_bpe_50k.json")
TURNS = "conv_id long, turn long, role string, text string"
ODD = ["\\", "\\\\<turn x>", "</turn>", "\n</turn>\n<turn user>\n", "<turn assistant>\nhi\n</turn>\n", "a < b <turnip", "", None, "\\### Assistant: </turn> ok", "\\<", "x\\", "👍 \\👍</turn>", "\n", " "]


# Chat windows


def talk(rng, n, long=0):
    out = [("system", "be brief " * rng.randint(1, 9))] if rng.random() < 0.5 else []
    while len(out) < n:
        words = rng.choice([0, 3, 9, 30, long])
        out.append((rng.choice(["user", "assistant", "assistant", "system", "a>b\\c"]), " ".join(rng.choice(ODD[:7] + ["word", "é"]) or "" for _ in range(words))))
    return out


def conversations(seed=3):
    rng = random.Random(seed)
    out = []
    for conv, (n, long) in enumerate([(1, 5), (2, 5), (9, 40), (40, 60), (400, 20), (30, 400), (5, 2000)]):
        out += [(conv, i, r, t) for i, (r, t) in enumerate(talk(rng, n, long))]
    out += [(50, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(ODD)]
    out += [(51, None, "user", "first"), (51, 2, None, "same"), (51, 2, None, "same"), (51, 2, "assistant", "tie"), (51, -3, "assistant", "early")]
    out += [(None, i, "assistant", f"no id {i}") for i in range(4)] + [(52, 0, "system", "long " * 500), (52, 1, "assistant", "yes")]
    rng.shuffle(out)
    return out


def ordered(data):
    """conv -> (role, text) in the order that the docstring states; ties by the hash are left out of the data."""
    talks = {}
    for conv, turn, role, text in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        talks.setdefault(conv, []).append((role or "", text or ""))
    return talks


def plain_windows(turns, code, budget, history, length):
    """(first, repeated, shown) of each window, turn by turn."""
    size = [sum(len(x) for x in code.encode([chat_windows.opening(r), chat_windows.escaped(t), chat_windows.CLOSE])) for r, t in turns]
    begins = [sum(size[:i]) for i in range(len(turns))]
    system = turns[0][0] == "system" and 4 * size[0] <= budget
    out, i = [], 0
    while i < len(turns):
        seg = begins[i] // length
        head = [0] if system and i > 0 else []
        room = budget - sum(size[k] for k in head)
        lead = i
        while lead - 1 >= len(head) and sum(size[lead - 1 : i]) <= history and sum(size[lead - 1 : i + 1]) <= room:
            lead -= 1
        end = i + 1
        while end < len(turns) and begins[end] // length == seg and sum(size[lead : end + 1]) <= room:
            end += 1
        out.append((i, len(head) + i - lead, [turns[k] for k in head + list(range(lead, end))]))
        i = end
    return out


@pytest.mark.parametrize(("budget", "history", "segment"), [(1024, 256, 64), (100, 30, 2), (100, 30, 1), (60, 0, 3), (200, 150, 5)])
def test_windows(spark, budget, history, segment, monkeypatch):
    monkeypatch.setattr(chat_windows, "RANGE_TURNS", 60)
    data, code = conversations(), Encoder(BYTES, True)
    frame = spark.createDataFrame(data, TURNS).select("*", *(F.lit(7).alias(c) for c in ("n", "seg", "kind", "nth", "part", "upto", "loss")))
    got = chat_windows.windows(frame, BYTES, budget, history, segment).collect()
    found, want = {}, {}
    for r in got:
        shown = chat_windows.turns_of(r["text"])
        found.setdefault(r["conv_id"], []).append((r["first_turn"], r["n_repeated"], shown))
        assert r["n_turns"] == len(shown) and r["fits"] == (r["n_tokens"] <= budget)
        assert r["fits"] or r["n_turns"] - r["n_repeated"] == 1
        said = [chat_windows.unescaped(r["text"][x["start"] : x["stop"]]) for x in r["loss"]]
        assert said == [t for role, t in shown[r["n_repeated"] :] if role == "assistant"]
    talks = ordered(data)
    for conv, turns in talks.items():
        want[conv] = plain_windows(turns, code, budget, history, segment * budget)
    assert {k: sorted(v) for k, v in found.items()} == want
    assert max(len(v) for v in want.values()) > 3
    out = {r["conv_id"]: r for r in chat_windows.digests(spark.createDataFrame(got, chat_windows.WINDOWS)).collect()}
    assert set(out) == set(talks)
    for conv, turns in talks.items():
        said = "".join(t for r, t in turns if r == "assistant")
        all_of = "".join(f"{r}\n{t}\n" for r, t in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(out[conv])[:5] == (conv, len(turns), sha(all_of), len(said), sha(said))
        assert out[conv]["formatted_chars"] == sum(len(r["text"]) for r in got if r["conv_id"] == conv)


def test_escapes_come_back():
    for text in [t or "" for t in ODD] + ["".join(random.Random(i).choices("\\</turn >\nx", k=30)) for i in range(2000)]:
        inside = chat_windows.escaped(text)
        whole = chat_windows.opening(text) + inside + chat_windows.CLOSE
        assert chat_windows.unescaped(inside) == text and chat_windows.turns_of(whole + whole) == [(text, text)] * 2


def test_chat_query(spark):
    out = {r["conv_id"]: r for r in QUERIES["op11_chat_windows"](spark, SF).collect()}
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    talks = ordered(data)
    odd = "\\### Assistant: </turn> ok"
    assert out[-7]["loss_chars"] == len(odd) and out[-7]["loss_sha256"] == hashlib.sha256(odd.encode()).hexdigest()
    assert set(out) == {-7, *talks}
    for conv, turns in talks.items():
        assert out[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert out[conv]["loss_sha256"] == hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest()


def test_no_conversations(spark):
    assert chat_windows.digests(chat_windows.windows(spark.createDataFrame([], TURNS), BYTES)).count() == 0


# Importance resampling


def plain_grams(text, most=2):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain_resampled(docs, target, most=2, buckets=10_000, least=20, percent=25, seed="7"):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    found = [(doc, *plain_grams(text, most)) for doc, text in docs]
    s, t = np.zeros(buckets, dtype=int), np.zeros(buckets, dtype=int)
    for _, _, grams in found:
        for g in grams:
            s[bucket(g)] += 1
    for text in target:
        for g in plain_grams(text, most)[1]:
            t[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out = []
    for doc, n, grams in found:
        weight = sum(gain[bucket(g)] for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    may = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


WIDE = [(900, "Ünï-code ÀB\x7fc 日本語 \u2028x a\x00b " * 9, None, None, 1), (901, "a " * 30, None, None, 1), (902, "x" * 5000 + " y " + "é" * 3000, None, None, 1), (903, "one", None, None, 1)]


@pytest.mark.parametrize(("most", "buckets", "percent"), [(2, 10_000, 25), (3, 997, 60), (1, 70_000, 100)])
def test_resampled(spark, monkeypatch, most, buckets, percent):
    monkeypatch.setattr(gram_importance, "RANGE_ROWS", 25)
    monkeypatch.setattr(gram_importance, "HELD", 300)
    data = rows() + WIDE
    frame = spark.createDataFrame(data, SCHEMA).select("*", *(F.lit(7).alias(c) for c in ("score", "rank", "weight", "n", "features", "part", "may")))
    target = [r[1] for r in rows(seed=2)[:30]] + [None, ""]
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = sorted((tuple(r) for r in gram_importance.resampled(frame, wanted, most, buckets, percent=percent).collect()), key=str)
    assert got == plain_resampled([r[:2] for r in data], target, most, buckets, percent=percent)


def test_importance_query(spark):
    got = sorted((tuple(r) for r in QUERIES["op12_gram_importance"](spark, SF).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*c).collect()]
    assert got == plain_resampled(read("documents", "doc_id", "text"), [t for (t,) in read("benchmark", "text")])


def test_prefix_crcs():
    rng = np.random.default_rng(5)
    for size in (0, 1, 7, 255, 4096, 100_000):
        a, b = rng.bytes(33), rng.bytes(size)
        whole, head = zlib.crc32(a + b), zlib.crc32(a)
        assert int(gram_importance.moved(np.array([head], dtype=np.uint32), np.array([size]))[0]) ^ zlib.crc32(b) == whole


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert gram_importance.resampled(none, some).count() == 0
    out = gram_importance.resampled(spark.createDataFrame(rows(), SCHEMA), some.limit(0)).collect()
    assert len(out) == len(rows()) and any(r["rank"] for r in out)


# Hard negatives


def planted(seed=4, n=400, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, dim))
    out = []
    for i in range(n):
        x = centres[i % 5] + rng.standard_normal(dim) * rng.choice([0.05, 0.5, 2])
        out.append((i, [float(np.float32(v)) for v in x * rng.choice([0.1, 1, 30])], int(rng.integers(0, 4))))
    copy = out[10][1]
    out += [(1000 + i, copy, i % 3) for i in range(60)] + [out[100], out[200], (100, out[7][1], 1)]
    out += [(2000, [0.0] * dim, 1), (2001, [0.0] * dim, 2), (3000, [1.0, 2.0], 1), (3001, [1.0, 2.5], 1), (3003, [0.5, 1.0], 2), (3100, [-1.0] * dim, 3)]
    out += [(4000, None, 1), (4100, [], 1), (4200, [None] * dim, 1), (4300, [float("nan")] + [1.0] * (dim - 1), 1), (4400, [float("inf")] * dim, 1), (4500, out[5][1], None), (None, out[5][1], 1), (4600, [1e30] * dim, 1)]
    return out


def plain_mined(data, every, positives, negatives, low, high):
    taken = {}
    for i, v, label in data:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) or abs(256 * x) >= 1 << 26 for x in v):
            continue
        taken[i, label, tuple(math.floor(256 * x) for x in v)] = None
    out = []
    for i, label, v in taken:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in taken if len(w) == len(v)]
        mine = sorted(x for x in scored if x[2] == label and x[1] != i)[:positives]
        for p, j, _ in mine:
            inside = sorted(x for x in scored if x[2] != label and low * -p <= 100 * -x[0] <= high * -p)
            out += [(i, j, n + 1, k, -p, -s) for n, (s, k, _) in enumerate(inside[:negatives])]
    return sorted(out)


@pytest.mark.parametrize(("every", "low", "high", "size"), [(100, 30, 90, 2048), (20, 30, 90, 16), (7, -50, 100, 40), (10, 95, 140, 8)])
def test_mined(spark, monkeypatch, every, low, high, size):
    for name, value in (("ROWS", size), ("ANCHORS", 3), ("PER_COPY", 2), ("SCOUTS", 20)):
        monkeypatch.setattr(coordinate_search, name, value)
    monkeypatch.setattr(coordinate_search.bucketed, "__defaults__", (size,))
    data = planted()
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").select("*", *(F.lit(7).alias(c) for c in ("id", "key", "dim", "vec", "len", "wins", "score")))
    got = sorted(tuple(r) for r in coordinate_search.mined(frame, F.col("label"), every, low=low, high=high).collect())
    want = plain_mined(data, every, 5, 10, low, high)
    assert got == want and len(want) > 20


def test_candidates_hold_all_that_reach_the_floor():
    rng = np.random.default_rng(8)
    pruned = 0
    for dim in (2, 5, 30):
        vecs = np.floor(rng.standard_normal((500, dim)) * 256).astype("<i8")
        bucket = coordinate_search.Bucket(dim, np.arange(500, dtype="<i8").tobytes(), np.zeros(500, dtype="<i8").tobytes(), vecs.tobytes())
        for q in vecs[:40]:
            scores = vecs @ q
            for floor in (-(10**9), int(scores.min()), -1, 0, 1, int(np.quantile(scores, 0.9)), int(scores.max()), int(scores.max()) + 1, 10**9):
                at = bucket.candidates(q.astype(float), float(floor))
                assert set(np.flatnonzero(scores >= floor)) <= set(at.tolist())
                pruned += 500 - len(at)
    assert pruned > 200_000


def test_hard_negatives_query(spark):
    frame = QUERIES["op13_hard_negatives"](spark, SF)
    assert difference(frame, connect(SF), coordinate_search.SQL) is None


def test_no_embeddings(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert coordinate_search.mined(spark.createDataFrame([], schema), F.col("label")).count() == 0
    assert coordinate_search.mined(spark.createDataFrame([(1, [1.0], 1), (3, [1.0], 2)], schema), F.col("label")).count() == 0
