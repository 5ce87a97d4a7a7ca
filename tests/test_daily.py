"""Distinct people from daily bitmap states."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from trailsight.operators import daily
from trailsight.plans import catalog, views

DAY = date(2001, 6, 1)
REGIONS = {"x": "X", "y": "Y"}


def items(spark):
    rows = [("a", "X", 0, 2), ("b", "Y", 0, 2), ("c", "Z", 0, 2), ("d", None, 0, 2), ("e", "X", 404, 2), ("f", "X", 0, 6)]
    return spark.createDataFrame(rows, "code string, country string, cache_status int, geocache_type int")


def visits(spark, rows):
    return spark.createDataFrame(rows, "gc_code string, user_name string, visited date, log_type string")


def some(seed, n=400):
    rng = random.Random(seed)
    days = [DAY + timedelta(k) for k in range(-70, 12)] + [None]
    names = [None, "", "Ann", "ann", *[f"u{k}" for k in range(60)]]
    return [(rng.choice("abcdefz"), rng.choice(names), rng.choice(days), rng.choice(["Found it", "Found it", "deleted", None])) for _ in range(n)]


def plain(rows):
    """region -> (active, before, finders, visits), by sets."""
    country = {"a": "x", "b": "y", "c": None, "d": None}
    out = {}
    for region in ("all", "x", "y"):
        mine = [r for r in rows if r[0] in country and region in ("all", country[r[0]]) and r[3] == "Found it"]
        span = lambda lo, hi: len({r[1] for r in mine if r[1] is not None and r[2] and lo <= r[2] < hi})  # noqa: B023, E731
        active, before = span(DAY - timedelta(30), date.max), span(DAY - timedelta(60), DAY - timedelta(30))
        out[region] = (active, before, len({r[1] for r in mine if r[1]}), len(mine))
    return out


def counts(spark, root):
    got = daily.community(daily.states(spark, root), DAY, REGIONS).collect()
    return {r["region"]: (r["active_players"], r["active_before"], r["total_finders"], r["total_logs"]) for r in got}


def test_days_one_by_one_equal_all_at_once(spark, tmp_path):
    rows, root = some(1), str(tmp_path / "t")
    first = DAY - timedelta(2)
    old = [r for r in rows if r[2] is None or r[2] < first]
    daily.refresh(spark, root, visits(spark, old), items(spark), regions=REGIONS)
    assert counts(spark, root) == plain(old)
    for k in range(3):
        low = first + timedelta(k)
        for _ in range(2):  # a day done again changes nothing
            daily.refresh(spark, root, visits(spark, rows), items(spark), low, low + timedelta(1), REGIONS)
        assert counts(spark, root) == plain([r for r in rows if r[2] is None or r[2] <= low])
    daily.refresh(spark, root, visits(spark, rows), items(spark), first, None, REGIONS)
    assert counts(spark, root) == plain(rows)


def test_late_visits_and_days_that_lose_theirs(spark, tmp_path):
    rows, root = some(2), str(tmp_path / "t")
    daily.refresh(spark, root, visits(spark, rows), items(spark), regions=REGIONS)
    gone = [r for r in rows if r[2] is None or r[2] != DAY]
    daily.refresh(spark, root, visits(spark, gone), items(spark), DAY, DAY + timedelta(1), REGIONS)
    assert counts(spark, root) == plain(gone)
    gone = [r for r in rows if r[2] is None or r[2] < DAY - timedelta(5)]  # the last months empty out
    daily.refresh(spark, root, visits(spark, gone), items(spark), DAY - timedelta(5), None, REGIONS)
    assert counts(spark, root) == plain(gone)
    late = rows + [("b", "late", DAY - timedelta(40), "Found it")]
    daily.refresh(spark, root, visits(spark, late), items(spark), DAY - timedelta(40), None, REGIONS)
    assert counts(spark, root) == plain(late)


def test_changed_items_name_their_days(spark, tmp_path):
    rows = some(3)
    changed = items(spark).filter("code = 'a'")
    got = {r[0] for r in daily.days_of_items(visits(spark, rows), changed).collect()}
    assert got == {r[2] for r in rows if r[0] == "a"}


def test_numbers_are_dense_and_kept(spark, monkeypatch):
    monkeypatch.setattr(daily, "PARTS", 5)
    names = lambda n: spark.range(n).select(F.concat(F.lit("p"), "id").alias("name")).unionByName(spark.createDataFrame([(None,), ("",), ("p1",)], "name string"))
    known = daily.numbered(names(100), spark.createDataFrame([], daily.PEOPLE)).collect()
    assert sorted(r["person_id"] for r in known) == list(range(1, 101)) and len({r["name"] for r in known}) == 100
    more = daily.numbered(names(140), spark.createDataFrame(known, daily.PEOPLE)).collect()
    assert sorted(r["person_id"] for r in more) == list(range(101, 141))


def test_many_people_span_bitmaps(spark, tmp_path):
    n, root = 70_000, str(tmp_path / "t")
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit("b")).alias("gc_code"),
        F.concat(F.lit("p"), "id").alias("user_name"), F.lit(DAY).alias("visited"), F.lit("Found it").alias("log_type"),
    )
    daily.refresh(spark, root, rows, items(spark), regions=REGIONS)
    third = -(-n // 3)
    assert counts(spark, root) == {"all": (n, 0, n, n), "x": (third, 0, third, third), "y": (n - third, 0, n - third, n - third)}
    assert daily.states(spark, root).select("bucket").distinct().count() == 3


def test_a_day_reads_its_own_visits_only(spark, tmp_path):
    """The files of all other days are spoiled before the day is taken in."""
    d, root, facts = catalog.inputs(spark, SF), str(tmp_path / "t"), str(tmp_path / "visits")
    d.visits.filter("visited >= DATE '2001-01-01'").write.partitionBy("visited").parquet(facts)
    stored = spark.read.parquet(facts)
    daily.refresh(spark, root, stored.filter("visited < DATE '2001-06-01'"), d.items, regions=views.REGIONS)
    want = daily.community(daily.states(spark, root), DAY, views.REGIONS).collect()
    for day in os.listdir(facts):
        if day.startswith("visited=") and day != "visited=2001-06-01":
            for name in os.listdir(f"{facts}/{day}"):
                if name.endswith(".parquet"):
                    with open(f"{facts}/{day}/{name}", "wb") as f:
                        f.write(b"spoiled")
                    crc = f"{facts}/{day}/.{name}.crc"
                    if os.path.exists(crc):
                        os.remove(crc)
    with pytest.raises(Exception, match="(?i)parquet|spoiled"):
        spark.read.schema(stored.schema).parquet(facts).agg(F.max("user_name")).collect()
    daily.refresh(spark, root, spark.read.schema(stored.schema).parquet(facts), d.items, DAY, DAY + timedelta(1), views.REGIONS)
    got = daily.community(daily.states(spark, root), DAY, views.REGIONS).collect()
    whole = {r["region"]: r["total_logs"] for r in got}
    before = {r["region"]: r["total_logs"] for r in want}
    new = d.visits.filter("visited = DATE '2001-06-01' AND log_type <> 'deleted'").join(
        d.items.filter("coalesce(cache_status, 0) <> 404 AND geocache_type <> 6").select(F.col("code").alias("gc_code")), "gc_code"
    )
    assert whole["all"] - before["all"] == new.count() > 0
