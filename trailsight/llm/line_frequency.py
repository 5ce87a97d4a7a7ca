"""Quality rules: cross-document line frequency.

Lines are normalised and hashed; a line that more than LIMIT documents of one host hold, and more
than SHARE of the host's documents, is boilerplate there and is taken out of them. Both must hold, so
above LIMIT / SHARE documents (25,000) the limit grows with the host: in a host of 3 million a line of
3,000 documents or fewer stays. A document that loses so many words with its boilerplate lines that
less than REST of them are left is rejected. Before that stand rules on the text alone: too few words,
and too many words inside repeated windows of eight words.

Cases: null and empty texts have no words and fail the base rules. A null source is a host of its
own. A document is an (id, text): repeated rows count once for a host and get equal results; rows of
several hosts lose the lines of their own. Lines without a word stay. Very long texts are read whole.
Other columns pass through `cleaned`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailsight.llm.common import let, n_words, small, small_sized, squeezed, words_of, written

WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
LIMIT, SHARE, REST = 25, 0.001, 0.5
SYMBOLS = "[^#*$%&|<>]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
JUDGED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "boilerplate_words", "base_failed", "kept")
#: Bytes of a row of the frequent lines, and of a document besides its places, when it is sent to executors.
LINE_BYTES, GONE_BYTES = 64, 128


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of so many words that the text has twice or more."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.xxhash64(F.slice(words, i + 1, window)))

    def covered(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda x, k: (F.get(pairs, k - 1)["h"] == x["h"]) | (F.get(pairs, k + 1)["h"] == x["h"]))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
        step = lambda a, d: F.struct(d.alias("last"), (a["n"] + F.least(F.lit(window), d - a["last"])).alias("n"))
        return F.aggregate(starts, zero, step, lambda a: a["n"])

    def of(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(pairs, covered))

    return F.when(n < window, 0).otherwise(let(hashes, of))


def measured(docs: DataFrame) -> DataFrame:
    """doc (the row), doc_id, key, host, the base columns, and `lines`: hash and place of each line with a word."""
    text = F.coalesce("text", F.lit(""))
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    rows = docs.select(doc, "doc_id", F.col("source").alias("host"), F.xxhash64("doc_id", "text").alias("key"), text.alias("text"))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("pos"))), lambda x: x["line"].rlike(HAS_WORD))
    stats = let(
        words_of(F.col("text")),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words")),
    )
    by_line = let(
        lines,
        lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x["line"]))).cast("long").alias("n_dup_lines"),
            F.transform(x, lambda y: F.struct(F.xxhash64(squeezed(y["line"])).alias("h"), y["pos"].alias("pos"))).alias("lines"),
        ),
    )
    spaces = F.length(F.regexp_replace("text", r"[^\x20\x09-\x0D]+", ""))
    rows = rows.select(
        "doc", "doc_id", "key", "host", stats.alias("a"), by_line.alias("b"),
        (F.length("text") - spaces).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
    )
    return rows.select("doc", "doc_id", "key", "host", "a.n_words", "word_chars", "n_symbols", "b.n_dup_lines", "a.n_repeat_words", "b.lines")


def cleaned(docs: DataFrame, limit: int = LIMIT, share: float = SHARE, rest: float = REST) -> DataFrame:
    """Documents with their boilerplate lines taken out of text (n_chars follows); the other columns of `judged` as _lf_*."""
    base = written(measured(docs))
    lines = base.select("doc_id", "key", "host", F.explode("lines").alias("line")).select("doc_id", "key", "host", "line.h", "line.pos")
    many = lines.groupBy("host", "h").agg(F.countDistinct("key").alias("docs")).where(F.col("docs") > limit)
    hosts = base.groupBy("host").agg(F.countDistinct("key").alias("all_docs"))
    many, hosts = many.alias("m"), hosts.alias("s")
    frequent = many.join(hosts, F.col("m.host").eqNullSafe(F.col("s.host"))).where(F.col("docs") > share * F.col("all_docs"))
    frequent = small(written(frequent.select("m.host", "m.h")), LINE_BYTES).alias("f")
    found = lines.alias("l").join(frequent, F.col("l.host").eqNullSafe(F.col("f.host")) & (F.col("l.h") == F.col("f.h")))
    gone = found.groupBy("l.doc_id", "l.key", "l.host").agg(F.collect_set("l.pos").alias("at"))
    gone = small_sized(written(gone), GONE_BYTES + 4 * F.size("at")).alias("x")
    same = F.col("b.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("b.key") == F.col("x.key")) & F.col("b.host").eqNullSafe(F.col("x.host"))
    rows = base.drop("lines").alias("b").join(gone, same, "left")
    left = let(F.split("b.doc.text", "\n"), lambda x: F.array_join(F.filter(x, lambda _, i: ~F.array_contains("x.at", i)), "\n"))
    rows = rows.select("b.*", F.col("x.at").isNotNull().alias("loses"), F.when(F.col("x.at").isNotNull(), left).otherwise(F.col("b.doc.text")).alias("text"))
    lost = F.when(F.col("loses"), F.col("n_words") - n_words(F.col("text"))).otherwise(F.lit(0)).cast("long")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("boilerplate_words", lost).withColumn("base_failed", failed)
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("boilerplate_words") >= rest * F.col("n_words")))
    passed = {c: F.col("doc").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        passed["n_chars"] = F.when(F.col("loses"), F.length("text")).otherwise(passed["n_chars"])
    return rows.select(*(v.alias(c) for c, v in passed.items()), *(F.col(c).alias(f"_lf_{c}") for c in JUDGED))


def judged(docs: DataFrame, limit: int = LIMIT, share: float = SHARE, rest: float = REST) -> DataFrame:
    """The base columns with boilerplate_words, base_failed and kept for each row of documents; the words are those that `cleaned` took out."""
    rows = cleaned(docs.select("doc_id", "source", "text"), limit, share, rest)
    return rows.select("doc_id", *(F.col(f"_lf_{c}").alias(c) for c in JUDGED))


def sql(limit: int = LIMIT, share: float = SHARE, rest: float = REST) -> str:
    """The same rules over the table documents, for a second engine."""
    return rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, md5(coalesce(text, 'null' || chr(1))) AS k FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
one AS (SELECT DISTINCT doc_id, k, source, ws, ls FROM w),
win AS (SELECT doc_id, k, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
        FROM (SELECT doc_id, k, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM one)),
twice AS (SELECT doc_id, k, i, count(*) OVER (PARTITION BY doc_id, k, g) AS n FROM win),
rep AS (SELECT doc_id, k, sum(least({WINDOW}, i - before)) AS n_repeat_words FROM (
        SELECT doc_id, k, i, coalesce(lag(i) OVER (PARTITION BY doc_id, k ORDER BY i), i - {WINDOW}) AS before FROM twice WHERE n > 1) GROUP BY ALL),
l AS (SELECT doc_id, k, source, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM (SELECT doc_id, k, source, unnest(ls) AS x FROM one)),
hosts AS (SELECT source, count(DISTINCT (doc_id, k)) AS all_docs FROM one GROUP BY source),
f AS (SELECT l.source, line FROM l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
      GROUP BY l.source, line, all_docs HAVING count(DISTINCT (doc_id, k)) > {limit} AND count(DISTINCT (doc_id, k)) > {share} * all_docs),
lost AS (SELECT doc_id, k, sum(len(string_split(l.line, ' '))) AS lost FROM l JOIN f ON l.line = f.line AND l.source IS NOT DISTINCT FROM f.source GROUP BY ALL),
r AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, (length(t) - length(regexp_replace(t, '[^\x20\x09-\x0D]+', '', 'g')))::BIGINT AS word_chars,
      length(regexp_replace(t, '{SYMBOLS}', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
      coalesce(rep.n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS boilerplate_words
      FROM w LEFT JOIN rep ON w.doc_id IS NOT DISTINCT FROM rep.doc_id AND w.k = rep.k
      LEFT JOIN lost ON w.doc_id IS NOT DISTINCT FROM lost.doc_id AND w.k = lost.k),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM r)
SELECT *, NOT base_failed AND n_words - boilerplate_words >= {rest} * n_words AS kept FROM b
"""
