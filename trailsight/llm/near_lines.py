"""Line dedup by a deletion-neighbourhood join, edit bound 1.

Two lines are alike if, in lower case and trimmed, they are equal or one edit (a character put in,
taken out or changed) apart. Of alike lines the earliest, by document id and place, stays: a line goes if an
earlier line is alike. Lines of under MIN_CHARS characters are alike only if they are equal, as one edit
makes another word of a short one.

Variants are emitted in steps, so that long lines don't cost the square of their length. First a
stretch of a line is deleted: lines one edit apart agree on what is before some stretch, counted from
the start, and on what is after it, counted from the end. Stretches are long ones for all lines, then short
ones for the lines that share a key with a different line. Where such lines share a key of a short stretch,
each character of the stretch is deleted in turn, and the hash of what is left is the key. A key holds
the place of the deletion (or says that one line is longer by one), so all lines of a key are one edit
apart; each needs only the earliest, no pairs are made. The edit distance of a line and its earliest
partner is then verified.

Cases: null and empty texts have no lines and stay. Rows without an id come after all others. Rows of
equal (id, place) are no earlier than each other, so repeated rows keep their lines alike. Blank lines
stay. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailsight.llm.common import WORD, let, small, small_sized, written

#: Characters of a line that may be one edit away from another.
MIN_CHARS = 20
HAS_WORD = r"[^\x20\x09-\x0D]"
BLOCK = 256
#: Blocks of a line at least, if they have eight characters: of all lines, and of those that share a key.
WIDE, NARROW = 2, 16
_LAST_ID = str(1 << 63)


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, key, pos, norm of every line that may go."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("pos"), F.trim(F.lower(x)).alias("norm")))
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.explode(F.filter(lines, lambda x: x["norm"].rlike(HAS_WORD))).alias("x"))
    return rows.select("doc_id", "key", "x.pos", "x.norm")


def rank(doc_id: Column, pos: Column) -> Column:
    """Order of a line among all lines, as one number."""
    return (F.coalesce(doc_id.cast("decimal(20,0)"), F.lit(_LAST_ID).cast("decimal(20,0)")) * F.lit(1 << 31).cast("decimal(12,0)") + pos).cast("decimal(38,0)")


def shape(size: Column, least: int) -> Column:
    """(block, count): a line is taken as so many blocks, counted from either end; the last may be longer."""
    block, power = F.lit(BLOCK), BLOCK // 2  # the largest power of two that the size holds `least` times, from 8 to BLOCK
    while power >= 8:
        block, power = F.when(size < 2 * least * power, power).otherwise(block), power // 2
    return let(block, lambda b: F.struct(b.alias("block"), F.floor(size / b).cast("int").alias("count")))


def stretch_keys(norm: Column, parts: bool, least: int = WIDE) -> Column:
    """A key for each stretch of the line that may be deleted; with `parts` a struct (key, part, longer).

    A line stands for its own length, and (`longer`) for one less, to meet lines of that length; a key
    holds the length. The shape follows the length stood for, mostly the same for both.
    """

    def of(shape_: Column, size: Column, bases: Column) -> Column:
        b, n = shape_["block"], shape_["count"]
        places = F.sequence(F.lit(0), n - 2)
        head = F.transform(places, lambda j: F.xxhash64(F.substring(norm, j * b + 1, b)))
        tail = F.transform(places, lambda j: F.xxhash64(F.substring(norm, size - (j + 1) * b + 1, b)))

        def keys(sides: Column) -> Column:
            def one(base: Column, q: Column) -> Column:
                key = F.xxhash64(base["size"], b, n, q, F.slice(sides["head"], 1, q), F.slice(sides["tail"], 1, n - 1 - q))
                if not parts:
                    return key
                return F.struct(key.alias("key"), F.substring(norm, q * b + 1, size - (n - 1) * b).alias("part"), base["longer"].alias("longer"))

            mine = F.filter(bases, lambda y: y["shape"] == shape_)
            return F.flatten(F.transform(mine, lambda base: F.transform(F.sequence(F.lit(0), n - 1), lambda q: one(base, q))))

        return let(F.struct(head.alias("head"), tail.alias("tail")), keys)

    def all_of(size: Column) -> Column:
        stands = lambda s, longer: F.struct(s.alias("size"), shape(s, least).alias("shape"), F.lit(longer).alias("longer"))
        each = lambda bases: F.transform(F.array_distinct(F.transform(bases, lambda y: y["shape"])), lambda x: of(x, size, bases))
        return let(F.array(stands(size, False), stands(size - 1, True)), lambda bases: F.flatten(each(bases)))

    return let(F.length(norm), all_of)


def variant_keys(key: Column, part: Column, longer: Column) -> Column:
    """A struct (key, kind) for each deletion inside a stretch; kind 0 changed, 1 shorter, 2 longer."""
    one = lambda i: F.concat(F.substring(part, F.lit(1), i), F.substring(part, i + 2, F.length(part)))
    places = F.sequence(F.lit(0), F.length(part) - 1)
    entry = lambda k, kind: F.struct(k.alias("key"), F.lit(kind).alias("kind"))
    halves = lambda i: (F.substring(part, F.lit(1), i), F.substring(part, i + 2, F.length(part)))
    same = F.transform(places, lambda i: entry(F.xxhash64(key, i, *halves(i)), 0))
    short = F.array(entry(F.xxhash64(key, F.lit(-1), part), 1))
    long = F.transform(places, lambda i: entry(F.xxhash64(key, F.lit(-1), one(i)), 2))
    return F.when(longer, long).otherwise(F.concat(same, short))


def dropped(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of id and text) and the sorted places of the lines that go."""
    lines = numbered(docs)
    keys = F.when(F.length("norm") >= MIN_CHARS, stretch_keys(F.col("norm"), parts=False))
    lines = written(lines.select("doc_id", "key", "pos", F.xxhash64("norm").alias("h"), keys.alias("blocks")))
    coarse = lines.select("h", F.explode("blocks").alias("block"))
    shared = coarse.groupBy("block").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a < b").select("block")
    shared = small(written(shared), 16)
    maybe = small(written(coarse.join(shared, "block").select("h").distinct()), 16)
    first = lines.join(maybe, "h", "left_semi").groupBy("h").agg(F.min(rank(F.col("doc_id"), F.col("pos"))).alias("at"))
    texts = numbered(docs).select(F.xxhash64("norm").alias("h"), "norm").join(maybe, "h", "left_semi")
    lone = written(texts.groupBy("h").agg(F.first("norm").alias("norm")).join(first, "h"))
    parts = lone.select("h", "at", F.explode(stretch_keys(F.col("norm"), parts=True, least=NARROW)).alias("x")).select("h", "at", "x.key", "x.part", "x.longer")
    parts = written(parts)
    narrow = parts.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a < b").select("key")
    parts = parts.join(small(written(narrow), 16), "key", "left_semi")
    fine = parts.select("h", "at", F.explode(variant_keys(F.col("key"), F.col("part"), F.col("longer"))).alias("v")).select("h", "at", "v.key", "v.kind")
    fine = written(fine)
    least = [F.min(F.when(F.col("kind") == k, F.col("at"))).alias(f"at{k}") for k in range(3)]
    groups = fine.groupBy("key").agg(*least, F.min("h").alias("a"), F.max("h").alias("b")).where("a < b").drop("a", "b")
    partner = F.when(F.col("kind") == 0, F.col("at0")).when(F.col("kind") == 1, F.col("at2")).otherwise(F.col("at1"))
    pairs = fine.join(groups, "key").where(partner < F.col("at")).select("h", partner.alias("other")).distinct()
    mine, theirs = lone.select("h", "norm"), lone.select(F.col("at").alias("other"), F.col("norm").alias("earlier"))
    near = pairs.join(mine, "h").join(theirs, "other").where(F.levenshtein("norm", "earlier", 1) >= 0).select("h").distinct()
    many = lines.groupBy("h").agg(F.count("*").alias("n"), F.min(rank(F.col("doc_id"), F.col("pos"))).alias("stays")).where("n > 1")
    gone = many.select("h", "stays").join(near.withColumn("all", F.lit(True)), "h", "full").select("h", "stays", F.coalesce("all", F.lit(False)).alias("all"))
    gone = small(written(gone), 48)
    out = lines.select("doc_id", "key", "pos", "h").join(gone, "h").where(F.col("all") | (rank(F.col("doc_id"), F.col("pos")) > F.col("stays")))
    return written(out.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("pos")).alias("gone")))


def deduped(docs: DataFrame) -> DataFrame:
    """Documents with the lines that go taken out of text (n_chars follows); _ll_lines and _ll_gone count lines."""
    gone = small_sized(dropped(docs), 96 + 4 * F.size("gone")).select(F.col("doc_id").alias("_ll_id"), F.col("key").alias("_ll_of"), F.col("gone").alias("_ll_at"))
    rows = docs.withColumn("_ll_key", F.xxhash64("doc_id", "text"))
    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_ll_id")) & (F.col("_ll_key") == F.col("_ll_of")), "left")
    left = let(F.split("text", "\n"), lambda x: F.array_join(F.filter(x, lambda _, i: ~F.array_contains("_ll_at", i)), "\n"))
    text = F.when(F.col("_ll_at").isNull(), F.col("text")).otherwise(left)
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    count = F.when(F.col("_ll_at").isNull(), 0).otherwise(F.size("_ll_at"))
    rows = rows.withColumn("_ll_lines", lines.cast("long")).withColumn("_ll_gone", count.cast("long")).withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("_ll_at").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return rows.select(*docs.columns, "_ll_lines", "_ll_gone")


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go; those that lost lines and have no word left go too."""
    rows = deduped(docs).where((F.col("_ll_gone") == 0) | F.col("text").rlike(WORD))
    return rows.select(*docs.columns)


#: The same lines over the table documents, for a second engine: lines one edit apart share a half.
LINES_SQL = rf"""
l AS (SELECT doc_id, pos, line, trim(lower(line)) AS norm
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM {{docs}} WHERE text IS NOT NULL)),
e AS (SELECT norm, min((coalesce(doc_id::HUGEINT, {_LAST_ID}::HUGEINT) * {1 << 31} + pos)) AS at, length(norm) AS n FROM l WHERE regexp_matches(norm, '{HAS_WORD}') GROUP BY norm),
b AS (SELECT * FROM e WHERE n >= {MIN_CHARS}),
c AS (SELECT a.norm AS x, b.norm AS y, a.at AS xa, b.at AS ya FROM b a JOIN b b ON b.n = a.n AND left(a.norm, a.n // 2) = left(b.norm, a.n // 2) AND a.norm <> b.norm
  UNION SELECT a.norm, b.norm, a.at, b.at FROM b a JOIN b b ON b.n = a.n AND substr(a.norm, a.n // 2 + 1) = substr(b.norm, a.n // 2 + 1) AND a.norm <> b.norm
  UNION SELECT a.norm, b.norm, a.at, b.at FROM b a JOIN b b ON b.n = a.n + 1 AND left(a.norm, a.n // 2) = left(b.norm, a.n // 2)
  UNION SELECT a.norm, b.norm, a.at, b.at FROM b a JOIN b b ON b.n = a.n + 1 AND substr(a.norm, a.n // 2 + 1) = substr(b.norm, a.n // 2 + 2)),
near AS (SELECT DISTINCT CASE WHEN xa > ya THEN x ELSE y END AS norm FROM c WHERE xa <> ya AND levenshtein(x, y) <= 1),
m AS (SELECT l.doc_id, l.pos, l.line, e.norm IS NOT NULL AND (near.norm IS NOT NULL OR (coalesce(l.doc_id::HUGEINT, {_LAST_ID}::HUGEINT) * {1 << 31} + l.pos) > e.at) AS gone
      FROM l LEFT JOIN e ON l.norm = e.norm LEFT JOIN near ON l.norm = near.norm),
r AS (SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
      coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS new_text FROM m GROUP BY doc_id)
"""
SQL = f"""WITH {LINES_SQL.format(docs="documents")}
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, md5(new_text) AS text_md5
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id"""
