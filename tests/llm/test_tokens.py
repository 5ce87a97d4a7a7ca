"""Packing and token files: ids equal the library's, placements hold, files come back exactly."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.fixture import SCHEMA, rows
from tests.llm.test_native import clashing
from trailsight.llm import grammar_files, packing, token_ids
from trailsight.llm.queries import QUERIES, tokenizer
from trailsight.llm.token_ids import Encoder

BYTES, WORDS = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")
ODD = [
    "", " ", "\n", "a  b", " x", "x ", "a\n\nb", "a\tb c", "it's <|endoftext|> x", "Ａ é café\n b", "x\x1cy z", "don't 'S 12 345\nfoo-bar",
    "a b", "a \nb", "étÉ ÀÿŒ.", "ﬁ x×÷ a", "naïve! (x) 's don't a' B.", "ABC!! d|e\nÉa, ñ", "é äb", "x y", "́a b", "日本語 テスト", "a'll 'LL we'Ve", "Σας ΟΔΟΣ",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.mark.parametrize(("path", "keeps"), [(BYTES, True), (WORDS, False)])
def test_ids(path, keeps):
    plain, code = Tokenizer.from_file(path), Encoder(path, keeps)
    texts = ODD + [r[1] for r in rows()] + ODD
    for text, got in zip(texts, code.encode(texts), strict=True):
        assert got.tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("kept", [0, 500_000])
@pytest.mark.parametrize(("path", "keeps"), [(BYTES, True), (WORDS, False)])
def test_ids_in_bulk(path, keeps, kept, monkeypatch):
    """Groups of any size give the library's ids, and words are known from one group to the next or not."""
    monkeypatch.setattr(token_ids, "KEPT", kept)
    plain, code = Tokenizer.from_file(path), Encoder(path, keeps)
    texts = [None, *ODD, *(r[1] for r in rows()), *ODD, "\n", "x"]
    want = [plain.encode(text or "", add_special_tokens=False).ids for text in texts]
    for group in (1000, 1 << 20):
        assert [x.tolist() for x in code.bulk(texts, group)] == want
    assert not list(code.bulk([]))


def test_few_calls_and_little_memory():
    """New words take no call each, and what is kept of them are no Python objects."""
    code = Encoder(BYTES, True)
    calls, words = [], code.words

    class Counted:
        def encode_batch_fast(self, texts, **more):
            calls.append(texts)
            return words.encode_batch_fast(texts, **more)

    code.words = Counted()
    letters = np.array(list("abcdefghij"))
    texts = [" ".join("".join(letters[[int(d) for d in str(n)]]) for n in range(i, i + 5000)) for i in range(0, 50_000, 5000)]
    assert sum(len(x) for x in code.bulk(texts + texts, 50_000)) > 100_000
    assert len(calls) < 200 and not code and not code.before
    code.forget()
    assert not len(code.known[0])


def plain_ids(path, text, end):
    return np.array(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def sorted_rows(found):
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("length", [2048, 64])
def test_packing(spark, docs, length):
    got = packing.pack(clashing(docs), BYTES, length, ids=True).collect()
    want = []
    for doc, text, *_ in rows():
        ids = plain_ids(BYTES, text, 0)
        first = len(ids) % length or min(len(ids), length)
        for i, start in enumerate([0, *range(first, len(ids), length)]):
            part = ids[start : first if i == 0 else start + length]
            want.append((doc, i, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted_rows(tuple(r[:5]) for r in got) == sorted_rows(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(r["ids"]) == r["length"]
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    least = -(-sum(r["length"] for r in got) // length)
    assert len(bins) <= 1.12 * least + 2
    whole = packing.sequences(spark.createDataFrame(got)).collect()
    assert {r["sequence_id"]: len(r["ids"]) for r in whole} == {k: sum(n for _, n in v) for k, v in bins.items()}


def test_bins_by_hand():
    bins = packing.Bins(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]  # the tightest fit each time
    assert [bins.put(n) for n in (5, 6, 8)] == [(2, 0), (3, 0), (4, 0)]  # the third bin closes the fullest, that of 6
    assert bins.put(2) == (4, 8) and bins.put(4) == (2, 5)
    assert bins.put(10) == (5, 0) and bins.open == 1


def test_token_files(spark, docs, tmp_path):
    path = str(tmp_path / "files")
    grammar_files.write(clashing(docs), path, WORDS, shard_ids=3000)
    files = grammar_files.read(spark, path)
    got = [tuple(r) for r in grammar_files.documents(files).collect()]
    order = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in order] == sorted((r[0] for r in rows()), key=lambda d: (d is not None, d or 0))
    at = 0
    for doc, start, n, crc in order:
        assert start == at
        at += n
        assert (n, crc) in {(len(i), zlib.crc32(i.tobytes())) for i in (plain_ids(WORDS, t, 1) for d, t, *_ in rows() if d == doc)}
    raw = files.collect()
    assert len(raw) > 1 and any(len(r["rules"]) for r in raw)
    for r in raw:  # random access, without the rest of the shard
        shard = grammar_files.Shard(r.asDict())
        whole = shard.expand(shard.symbols)
        stops = np.append(shard.first_ids[1:], len(whole))
        for i in range(0, len(shard.doc_ids), 7):
            ids = whole[shard.first_ids[i] : stops[i]]
            assert (shard.ids(i) == ids).all()
            a, z = len(ids) // 3, len(ids) // 2 + 1
            assert (shard.ids(i, a, z) == ids[a:z]).all()


@pytest.mark.parametrize("base", [4, 60_000, 70_000])
def test_grammar_round_trip(base):
    rng = np.random.default_rng(base)
    for n, most in ((1, 1), (2, 2), (5000, 3), (5000, min(base, 200)), (999, 1)):
        ids = rng.integers(0, most, n).astype(np.uint32)
        ends = np.unique(np.append(rng.integers(1, n + 1, 5), n))
        x, first, rules, lengths = grammar_files.compress(ids, ends, base, least=2)
        wide = "<u4" if base + len(rules) > 1 << 16 else "<u2"
        shard = grammar_files.Shard({
            "base": base, "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(), "symbols": x.astype(wide).tobytes(),
            "first_ids": np.r_[0, ends[:-1]].astype("<u8").tobytes(), "first_symbols": first.astype("<u4").tobytes(),
            "doc_ids": np.arange(len(ends)).astype("<i8").tobytes(), "null_ids": bytes(len(ends)),
        })
        assert (shard.expand(shard.symbols) == ids).all()
        assert len(x) < n or n < 3
        for i, (a, z) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
            assert (shard.ids(i) == ids[a:z]).all()


def passages(kind):
    rng = np.random.default_rng(3)
    if kind == "run":
        return [np.full(5000, 7, dtype=np.uint32)] * 2
    if kind == "passage":  # hundreds of ids that all documents share
        shared = rng.integers(0, 60_000, 700)
        return [np.r_[rng.integers(0, 60_000, 5), shared].astype(np.uint32) for _ in range(200)]
    zipf = rng.zipf(1.3, 400_000) if kind == "many" else rng.zipf(1.3, 30_000)
    return np.array_split((zipf % 60_000).astype(np.uint32), 50)


@pytest.mark.parametrize("kind", ["run", "passage", "mixed", "many"])
@pytest.mark.parametrize("base", [60_000, 70_000])
def test_no_frequent_pair_remains(kind, base):
    docs, least = passages(kind), 2 if kind == "many" else grammar_files.LEAST
    x, first, rules, lengths = grammar_files.compress(np.concatenate(docs), np.cumsum([len(d) for d in docs]), base, least=least)
    last = np.zeros(len(x), dtype=bool)
    last[np.r_[first[1:], len(x)] - 1] = True
    pairs, n = np.unique(np.stack([x[:-1], x[1:]])[:, ~last[:-1]], axis=1, return_counts=True)
    assert not len(n) or n.max() < least
    assert len(np.unique(rules, axis=0)) == len(rules)
    if kind == "many":
        assert base + len(rules) > 1 << 16
    if kind == "passage":
        assert lengths.max() >= 350 and len(x) <= 200 * 9
    if kind == "run":
        assert len(x) < 2 * 24 + 10


def test_places_of_runs():
    none = int(grammar_files._NONE)
    for ranks, want in (([0] * 6, [0, 2, 4]), ([1, 2, 2, 2, 2], [0, 2, 4]), ([2, 2, 2, 1], [0, 3]), ([none, 3, 3, none, 3], [1, 4]), ([1, 1, 0, 2, 2, 2], [0, 2, 4])):
        assert grammar_files.places(np.array(ranks, dtype=np.int32)).tolist() == want


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.pack(none, BYTES).count() == 0
    grammar_files.write(none, str(tmp_path / "none"), WORDS)
    assert grammar_files.documents(grammar_files.read(spark, str(tmp_path / "none"))).count() == 0


def test_queries(spark):
    sf = "/root/testdata/sf0.001"
    for name, end in (("op3_packing", 0), ("op4_grammar_files", 1)):
        path = BYTES if end == 0 else WORDS
        got = QUERIES[name](spark, sf).toPandas()
        texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
        sums = got.groupby("doc_id")["length" if end == 0 else "n_tokens"].sum()
        assert sums.to_dict() == {d: len(plain_ids(path, t, end)) for d, t in texts.items()}
