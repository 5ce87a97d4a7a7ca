"""Language ID by rank-order profiles.

The most frequent character n-grams of a document, in order, are held against the ordered profile of
each language; the distance adds up how far each n-gram is out of place, and an n-gram that a profile
lacks costs the most. The nearest language wins.

Cases: null text and texts without a letter are `und` with score 0; so is everything if there is
nothing to learn from. Equal distances go to the first language by name. Rows are judged one by one,
so repeated rows give repeated results; a row with a null id is judged and never learned from.
Very long texts are counted whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailsight.llm.common import bounded_sample

#: Training documents for each language at most.
PER_LANG = 3000
#: n-grams of a language profile, and of a document that are compared.
PROFILE, DOC_GRAMS = 1200, 400
#: Score under which a text is in none of the languages; texts in one of them are far above it.
LEAST_SCORE = 0.3
BLANK = 32

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def gram_codes(text: str) -> np.ndarray:
    """Every 1-, 2- and 3-gram of the words of letters, blank-padded, each packed into 63 bits."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    is_letter = letters()[c]
    c = np.where(is_letter, c, BLANK).astype(np.int64)
    two = (c[:-1] << 21) | c[1:]
    return np.concatenate(
        [c[is_letter], two[is_letter[:-1] | is_letter[1:]], ((two[:-1] << 21) | c[2:])[is_letter[1:-1]]]
    )


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, dtype=np.int64)
    return codes[starts], np.diff(np.r_[starts, len(codes)])


@dataclass
class Profiles:
    """Known n-grams in order of their codes, and the rank of each in each language (or -1)."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int = PROFILE

    def judge(self, text: str | None, top: int = DOC_GRAMS) -> tuple[str, float]:
        grams, n = counted(gram_codes(text or ""))
        if not len(grams) or not self.langs:
            return "und", 0.0
        if len(grams) > top:
            grams = grams[np.argsort(-n, kind="stable")[:top]]
        else:
            grams = grams[np.argsort(-n, kind="stable")]
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        known = self.grams[at] == grams
        ranks = self.ranks[:, at]
        place = np.arange(len(grams))
        far = np.where(known & (ranks >= 0), np.minimum(np.abs(ranks - place), self.size), self.size).sum(axis=1)
        best = int(far.argmin())
        return self.langs[best], 1.0 - float(far[best]) / (self.size * len(grams))


def learn(docs: DataFrame, per_lang: int = PER_LANG, profile: int = PROFILE) -> Profiles:
    """Profiles of the languages in (doc_id, text, lang), from at most `per_lang` documents of each."""
    rows = docs.where("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(b["text"].to_pylist(), b["lang"].to_pylist(), strict=True):
                by.setdefault(lang, []).append(gram_codes(text))
            for lang, codes in by.items():
                grams, n = counted(np.concatenate(codes))
                yield pa.record_batch({"lang": pa.array([lang] * len(grams), pa.string()), "gram": grams, "n": n.astype(np.int64)})

    counts = bounded_sample(rows, "doc_id", per_lang, "lang").mapInArrow(count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("at", F.row_number().over(by) - 1).where(F.col("at") < profile).select("lang", "gram", "at").toPandas()
    langs = sorted(top["lang"].unique())
    grams = np.sort(top["gram"].unique()).astype(np.int64)
    ranks = np.full((len(langs), len(grams)), -1, dtype=np.int64)
    ranks[[langs.index(x) for x in top["lang"]], np.searchsorted(grams, top["gram"].to_numpy(dtype=np.int64))] = top["at"]
    return Profiles(langs, grams, ranks, profile)


def identify(docs: DataFrame, profiles: Profiles, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The `keep` columns, the predicted language and the score of each row; needs a column text."""
    known = docs.sparkSession.sparkContext.broadcast(profiles)
    kept = docs.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", {names[0]} string, {names[1]} double"
    text = keep.index("text") if "text" in keep else len(keep)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [known.value.judge(t) for t in b.column(text).to_pylist()]
            columns = [b.column(i) for i in range(len(keep))]
            yield pa.record_batch(
                [*columns, pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], names=[*keep, *names]
            )

    rows = docs.select(*keep) if "text" in keep else docs.select(*keep, F.col("text").alias("_text"))
    return rows.mapInArrow(judge, schema)


def recognised(docs: DataFrame, profiles: Profiles, least: float = LEAST_SCORE) -> DataFrame:
    """The documents in a language that the profiles know: not `und`, and of a score of at least `least`."""
    rows = identify(docs, profiles, tuple(docs.columns), ("_rp_lang", "_rp_score"))
    return rows.where((F.col("_rp_lang") != "und") & (F.col("_rp_score") >= least)).select(*docs.columns)
