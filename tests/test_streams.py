"""The stateful stream and the run that retries: late records, replays, broken batches, compaction."""

import os
import shutil
import time
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from trailsight.operators import ingest, upsert
from trailsight.plans import catalog, views
from trailsight.sources import tables
from trailsight.streaming import newest, retry
from trailsight.streaming import visits as incremental

ORDER = views.REPEATED_ORDER


def rows_of(frame):
    return Counter(map(str, frame.select(*sorted(frame.columns)).collect()))


def land(frame, folder, n):
    frame.coalesce(1).write.parquet(f"{folder}/{n}")


def test_newest_gives_out_changed_keys_only(spark, tmp_path):
    rows = views.view(spark, SF, "repeated")
    root = str(tmp_path)
    phases = ("s1 % 3 = 0", "s1 % 3 = 1", "s1 % 97 = 2")
    seen = None
    for n, cond in enumerate(phases):
        part = rows.filter(cond)
        seen = part if seen is None else seen.unionByName(part)
        land(part, f"{root}/landed", n)
        newest.run_available(spark, f"{root}/landed", rows.schema, root, ORDER, parts=4).awaitTermination()
        whole = ingest.dedup_visits(seen, ORDER)
        assert rows_of(newest.read_newest(spark, root)) == rows_of(whole)
        key = F.struct("gc_code", ingest.visit_key().alias("k"))
        out = newest.changes(spark, root).filter(F.col("batch_id") == n)
        given = {str(r[0]) for r in out.select(key).collect()}
        landed = {str(r[0]) for r in part.filter(ingest.visit_key().isNotNull()).select(key).collect()}
        assert given == landed and out.count() == len(given)
        assert rows_of(out.drop("batch_id")) == rows_of(whole.withColumn("k", key).filter(F.col("k").isNotNull()).join(part.select(key.alias("k")).distinct(), "k", "left_semi").drop("k"))
    assert newest.changes(spark, root).filter("batch_id = 2").count() < newest.read_newest(spark, root).count() / 10
    # a replayed batch, and a start without news
    held = rows_of(newest.read_newest(spark, root))
    again = newest.changes(spark, root).filter("batch_id = 2").drop("batch_id")
    newest.put_batch(spark.createDataFrame(again.collect(), again.schema), 2, root, 4)
    newest.run_available(spark, f"{root}/landed", rows.schema, root, ORDER, parts=4).awaitTermination()
    assert rows_of(newest.read_newest(spark, root)) == held


RESULTS = [
    ("done", 1, None, ["a", "b"]), ("quiet", 1, None, []), ("none", 1, None, None), ("bad", 1, "timeout", None), ("bad", 2, "status 500", None),
    ("late", 1, "timeout", None), (None, 1, None, ["x"]), ("twice", 1, None, ["a"]), ("twice", 1, None, ["a"]),
]
MORE = [("bad", 3, "reset", None), ("late", 2, None, ["c"]), ("done", 2, "timeout", ["z"]), ("new", 1, "timeout", None)]


def results(spark, rows):
    visit = lambda name: (name, None, date(2001, 1, 1), False, False, "Found it", 1)
    return spark.createDataFrame([(c, a, e, None if v is None else [visit(x) for x in v]) for c, a, e, v in rows], retry.RESULT)


def states(spark, root):
    return {r["code"]: (r["attempts"], r["failures"], r["state"], r["last_error"] and r["last_error"]["error"]) for r in retry.ledger(spark, root).collect()}


def test_a_run_that_retries(spark, tmp_path):
    root = str(tmp_path)
    land(results(spark, RESULTS), f"{root}/landed", 0)
    retry.run_available(spark, f"{root}/landed", root).awaitTermination()
    first = {"done": (1, 0, "done", None), "quiet": (1, 0, "done", None), "none": (1, 0, "done", None), "bad": (2, 2, "failing", "status 500"), "late": (1, 1, "failing", "timeout"), "twice": (2, 0, "done", None)}
    assert states(spark, root) == first
    items = spark.createDataFrame([(c, None) for c in (*first, "unseen")], "code string, logs_crawled_at date")
    marked = {r[0] for r in retry.mark_done(items, retry.ledger(spark, root), date(2001, 2, 3)).filter("logs_crawled_at = DATE '2001-02-03'").collect()}
    assert marked == {"done", "quiet", "none", "twice"}  # what was fetched without visits is marked as well
    assert {r["code"]: r["failures"] for r in retry.to_fetch(items, retry.ledger(spark, root)).collect()} == {"bad": 2, "late": 1, "unseen": 0}
    retry.compact(spark, root)
    shutil.rmtree(f"{root}/ledger/log/batch_id=0")  # the ledger survives what compaction lets go
    assert states(spark, root) == first
    land(results(spark, MORE), f"{root}/landed", 1)
    retry.run_available(spark, f"{root}/landed", root).awaitTermination()
    second = first | {"bad": (3, 3, "dead", "reset"), "late": (2, 1, "done", "timeout"), "new": (1, 1, "failing", "timeout")}
    assert states(spark, root) == second
    retry.take_batch(results(spark, MORE), 1, root)  # replayed
    assert states(spark, root) == second
    names = {(r.gc_code, r.user_name) for r in incremental.read_visits(spark, root, retry.VISIT_ORDER).collect()}
    assert names == {("done", "a"), ("done", "b"), ("twice", "a"), ("late", "c")}  # a closed item takes nothing more
    for _ in range(2):
        retry.write_dead_letters(retry.ledger(spark, root), f"{root}/dead")
    dead = spark.read.json(f"{root}/dead").distinct().collect()
    assert [(r["code"], r["attempts"], r["error"]) for r in dead] == [("bad", 3, "reset")]
    assert {r["code"] for r in retry.to_fetch(items, retry.ledger(spark, root)).collect()} == {"unseen"}


def test_no_results_yet(spark, tmp_path):
    assert retry.ledger(spark, str(tmp_path)).count() == 0
    retry.compact(spark, str(tmp_path))
    assert retry.ledger(spark, str(tmp_path)).count() == 0


def test_progress_survives_compaction(spark, tmp_path):
    rows, root = views.view(spark, SF, "repeated"), str(tmp_path)
    incremental.append_batch(rows.filter("s1 % 2 = 0"), 0, root, ORDER)
    incremental.append_batch(rows.filter("s1 % 4 = 1"), 1, root, ORDER)
    before, table = rows_of(incremental.progress(spark, root)), rows_of(incremental.read_visits(spark, root, ORDER))
    incremental.compact(spark, root, ORDER)
    shutil.rmtree(f"{root}/log")
    assert rows_of(incremental.progress(spark, root)) == before
    assert rows_of(incremental.read_visits(spark, root, ORDER)) == table
    incremental.append_batch(rows.filter("s1 % 4 = 3"), 2, root, ORDER)
    whole = incremental.progress(spark, root)
    assert {r["code"] for r in whole.filter("last_batch = 2").collect()} == {r[0] for r in rows.filter("s1 % 4 = 3").filter(ingest.visit_key().isNotNull()).select("gc_code").collect()}
    assert rows_of(incremental.read_visits(spark, root, ORDER)) == rows_of(ingest.dedup_visits(rows, ORDER))


def test_broken_batches_are_not_read(spark, tmp_path):
    rows, root = views.view(spark, SF, "repeated"), str(tmp_path)
    with pytest.raises(ValueError, match="no batch"):
        incremental.read_visits(spark, root, ORDER)
    assert incremental.read_visits(spark, root, ORDER, rows.schema).count() == 0
    incremental.append_batch(rows.filter("s1 % 2 = 0"), 0, root, ORDER)
    table = rows_of(incremental.read_visits(spark, root, ORDER))
    incremental.append_batch(rows, 1, root, ORDER)
    os.remove(f"{root}/log/batch_id=1/_SUCCESS")  # as if the write had broken off
    assert rows_of(incremental.read_visits(spark, root, ORDER)) == table
    incremental.append_batch(rows, 1, root, ORDER)
    assert rows_of(incremental.read_visits(spark, root, ORDER)) == rows_of(ingest.dedup_visits(rows, ORDER))


def test_changes_are_folded_when_they_hold_as_much_as_the_table(spark, tmp_path, monkeypatch):
    """Equal batches in turn: rewriting the table with each would rewrite 36 times a batch's rows."""
    root, folds = str(tmp_path), []
    put = newest.put
    monkeypatch.setattr(newest, "put", lambda rows, *a: (folds.append(rows.count()), put(rows, *a)))
    schema = "gc_code string, user_name string, user_guid string, visited date, n int"
    want = {}
    for n in range(9):
        rows = [(f"GC{i}", "u", f"g{n // 2}", date(2001, 1, 1 + n), n) for i in range(40)] + [(f"GC{n}", "again", None, date(2001, 1, 1), n)]
        newest.put_batch(spark.createDataFrame(rows, schema), n, root, 4)
        want |= {(r[0], r[2]): r for r in rows}
        got = [tuple(r) for r in newest.read_newest(spark, root).select("gc_code", "user_name", "user_guid", "visited", "n").collect()]
        assert sorted(map(str, got)) == sorted(map(str, want.values()))
    assert 2 <= len(folds) <= 5 and sum(folds) <= 9 * 41
    newest.put_batch(spark.createDataFrame(rows, schema), 8, root, 4)  # replayed
    again = [tuple(r) for r in newest.read_newest(spark, root).select("gc_code", "user_name", "user_guid", "visited", "n").collect()]
    assert sorted(map(str, again)) == sorted(map(str, want.values()))


def test_landed_files_do_not_grow_with_the_tasks(spark, tmp_path):
    rows = views.view(spark, SF, "repeated")
    catalog._land(rows.repartition(16), str(tmp_path / "landed"))
    months = [d for d in os.listdir(tmp_path / "landed") if d.startswith("month=")]
    files = [f for d in months for f in os.listdir(tmp_path / "landed" / d) if f.endswith(".parquet")]
    assert len(months) > 50 and len(files) == len(months)
    assert rows_of(spark.read.parquet(str(tmp_path / "landed")).drop("month").select(*rows.columns)) == rows_of(rows)


VISIT = "gc_code string, user_name string, user_guid string, visited date, favorite_point_used boolean, is_ftf boolean, log_type string, seq int"


def visit_rows(spark, numbers):
    rows = [(f"GC{n % 50}", f"u{n % 7}", f"g{n % 3}" if n % 2 else None, date(2001, 1, 1 + n % 28), n % 5 == 0, n % 4 == 0, "", n) for n in numbers]
    return spark.createDataFrame(rows, VISIT)


def shuffle_files(spark):
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in tops for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}


def test_a_stream_leaves_no_shuffle_files_and_no_copies(spark, tmp_path, monkeypatch):
    """With the state in its own partitions, a file of 4 MB set aside by each would be most of the disk."""
    root, manifests = str(tmp_path), []
    put_batch, spark_dirs = newest.put_batch, spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    tops = {os.path.dirname(d) for d in spark_dirs}

    def watched(df, n, *rest):
        put_batch(df, n, *rest)
        manifests.extend(os.stat(f"{d}/{f}").st_blocks * 512 for top in tops for d, _, files in os.walk(top) if "StateStore" in d for f in files if f.startswith("MANIFEST"))

    monkeypatch.setattr(newest, "put_batch", watched)
    monkeypatch.setattr(tables, "new_folder", lambda *_: pytest.fail("a copy was made"))
    keys, before = [*newest.STATE, *newest.LEAN], shuffle_files(spark)
    was = [spark.conf.get(k, None) for k in keys]
    for n in range(3):
        catalog._land(visit_rows(spark, range(200 * n, 200 * n + 300)), f"{root}/landed")
        newest.run_available(spark, f"{root}/landed", visit_rows(spark, [0]).schema, root, ["seq"], parts=4).awaitTermination()
    newest.compact(spark, root, 4)
    assert manifests and max(manifests) < 1_000_000
    assert [spark.conf.get(k, None) for k in keys] == was
    for _ in range(50):  # they are removed beside the jobs
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert rows_of(newest.read_newest(spark, root)) == rows_of(ingest.dedup_visits(visit_rows(spark, range(700)), ["seq"]))


def test_folds_go_by_folders_and_may_break_off(spark, tmp_path, monkeypatch):
    root, written = str(tmp_path), []
    monkeypatch.setattr(upsert, "ROUND_ROWS", 1)
    whole = lambda to: rows_of(ingest.dedup_visits(visit_rows(spark, range(to)), ["seq"]))
    folders = lambda: [n for n, _ in upsert.put_folders(spark, f"{root}/newest")]
    on_disk = lambda: [d for top, names, _ in os.walk(f"{root}/newest") for d in names if d.startswith("_part=")]
    newest.put_batch(ingest.dedup_visits(visit_rows(spark, range(150)), ["seq"]), 0, root, 4)
    assert folders() == [0, 1, 2, 3] == sorted(int(d[6:]) for d in on_disk()) and rows_of(newest.read_newest(spark, root)) == whole(150)
    clear = upsert._clear

    def broken(*a):
        written.append(a)
        if len(written) == 2:
            raise OSError("stopped")
        clear(*a)

    monkeypatch.setattr(upsert, "_clear", broken)
    later = ingest.dedup_visits(visit_rows(spark, range(400)), ["seq"])
    with pytest.raises(OSError):
        newest.put_batch(later, 1, root, 4)
    assert rows_of(newest.read_newest(spark, root)) == whole(400) and len(on_disk()) == 5  # one folder is doubled, none is lost
    newest.put_batch(later, 1, root, 4)
    newest.compact(spark, root, 4)
    assert rows_of(newest.read_newest(spark, root)) == whole(400) and len(on_disk()) == 4 and len(written) > 4


def test_a_table_of_the_old_layout_is_read_and_folded(spark, tmp_path):
    root = str(tmp_path)
    old = ingest.dedup_visits(visit_rows(spark, range(150)), ["seq"]).withColumn("_key", ingest.visit_key())
    old.withColumn("_part", upsert.part_of(newest._keys(), 4)).write.partitionBy("_part").parquet(f"{root}/newest")
    old.write.parquet(f"{root}/changes/batch_id=0")
    spark.range(1).selectExpr("0L AS upto").write.parquet(f"{root}/folded/v00000001")
    whole = lambda to: rows_of(ingest.dedup_visits(visit_rows(spark, range(to)), ["seq"]))
    assert rows_of(newest.read_newest(spark, root)) == whole(150)
    few = ingest.dedup_visits(visit_rows(spark, range(170)), ["seq"]).filter("seq >= 150")
    newest.put_batch(few, 1, root, 4)
    assert rows_of(newest.read_newest(spark, root)) == whole(170)
    newest.compact(spark, root, 4)
    newest.compact(spark, root, 4)  # nothing is waiting
    assert rows_of(newest.read_newest(spark, root)) == whole(170)
