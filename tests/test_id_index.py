"""The id index, erasure beside a load, and runs asked for again after new files."""

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import RUN_TS, event, file_events, plan
from eventlake.operators import quality
from eventlake.plans import jobs
from eventlake.sinks import id_index, publish, workarea
from eventlake.sources import bronze as bronze_source
from eventlake.sources.folders import sizes
from eventlake.sources.silver import read_rejected, read_silver

JUNE = date(2026, 6, 1), date(2026, 6, 30)


def daily(spark, lake, day):
    return jobs.run_daily(spark, lake, date.fromisoformat(day), RUN_TS)


def held(spark, lake):
    return sorted((r.event_id, str(r.event_date)) for r in read_silver(spark, lake.silver).collect())


def named(spark, lake, *ids):
    """(date, type) pairs that the index names for some ids."""
    keys = spark.createDataFrame([(i,) for i in ids], "event_id string").select(id_index.hashed())
    return {(str(r.event_date), r.event_type) for r in id_index.hints(spark, lake.silver, keys).collect()}


def write_days(spark, lake, days, rows=200):
    """Silver of some days, as another hand may write it."""
    ids = spark.range(days * rows).select(F.col("id").cast("string").alias("event_id"), (F.col("id") % days).cast("int").alias("d"))
    known = {"event_id", "event_date", "event_type"}
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in read_schema() if f.name not in known]
    rows = ids.select("event_id", *empty, F.date_add(F.lit("2026-01-01").cast("date"), F.col("d")).alias("event_date"), F.lit("login").alias("event_type"))
    rows.write.mode("overwrite").partitionBy("event_date", "event_type").parquet(lake.silver)


def read_schema():
    from eventlake.contract import SILVER_SCHEMA

    return SILVER_SCHEMA.fields


def test_a_lookup_reads_as_much_when_silver_has_ten_times_the_dates(spark, lake, monkeypatch):
    monkeypatch.setattr(id_index, "TARGET", 100)
    ids = spark.createDataFrame([("17",), ("204",), ("999",)], "event_id string").select(id_index.hashed())
    read = {}
    for days in (4, 40):
        write_days(spark, lake, days)
        assert jobs.reindex(spark, lake) == days * 200
        paths = [p for paths in id_index.looked_up(spark, lake.silver, ids) for p in paths]
        read[days] = sum(sum(sizes(spark, p)) for p in paths)
        assert len(paths) <= 3
        assert {str(r.event_date) for r in id_index.hints(spark, lake.silver, ids).collect()} <= {
            str(r.event_date) for r in read_silver(spark, lake.silver).select("event_date").distinct().collect()
        }
    assert read[40] < 1.5 * read[4]


def test_entries_of_all_rows_and_few_generations(spark, lake, monkeypatch):
    monkeypatch.setattr(id_index, "TARGET", 8)
    rng, days = random.Random(1), [f"2026-06-{d:02}" for d in range(1, 10)]
    for day in days:
        file_events(lake, day, *(event(f"{day}-{i}", f"{day}T10:00:00Z", event_type=rng.choice(["login", "search"])) for i in range(12)))
        daily(spark, lake, day)
    rows = read_silver(spark, lake.silver).collect()
    for row in rng.sample(rows, 10):
        assert named(spark, lake, row.event_id) == {(str(row.event_date), row.event_type)}
    found = id_index.state(spark, lake.silver)
    assert len(found["generations"]) < 6 and sum(g["entries"] for g in found["generations"]) == len(rows) == 108
    live = {f"gen={g['number']}" for g in found["generations"]}
    assert {p.name for p in Path(id_index.root(lake.silver)).glob("gen=*")} == live
    assert id_index.current(spark, lake.silver)


def test_a_load_finds_copies_whoever_wrote_them(spark, lake):
    """Silver from another hand, changed beside the index, compacted and erased from: an upsert
    through the index is that of the full pass."""
    write_days(spark, lake, 3, rows=10)
    file_events(lake, "2026-06-01", event("1"), event("29"), event("new"), event("4", user_id=None))
    daily(spark, lake, "2026-06-01")
    left = [i for i in range(30) if i not in (1, 29, 4)]
    want = sorted([(str(i), f"2026-01-0{i % 3 + 1}") for i in left] + [(i, "2026-06-01") for i in ("1", "29", "new")])
    assert held(spark, lake) == want
    one = read_silver(spark, lake.silver).where("event_id = 'new'").withColumn("event_date", F.lit("2026-02-02").cast("date"))
    one.write.mode("append").partitionBy("event_date", "event_type").parquet(lake.silver)
    assert not id_index.current(spark, lake.silver)
    jobs.compact(spark, lake)
    jobs.erase_users(spark, lake, spark.createDataFrame([("nobody",)], "user_id string"))
    daily(spark, lake, "2026-06-01")
    assert held(spark, lake) == want and id_index.current(spark, lake.silver)


def test_dated_checks_read_only_dates_the_index_names(spark, lake):
    for day in ("2026-06-01", "2026-06-02", "2026-06-03"):
        file_events(lake, day, event(f"a{day}", f"{day}T01:00:00Z"), event(f"b{day}", f"{day}T01:00:00Z"))
        daily(spark, lake, day)
    rows = read_silver(spark, lake.silver).where("event_id = 'a2026-06-02'")
    rows.withColumn("event_date", F.lit("2026-06-03").cast("date")).write.mode("append").partitionBy(
        "event_date", "event_type"
    ).parquet(lake.silver)
    for _ in range(2):
        # without the index, then through it
        failed = {r.column: r.failures for r in jobs.source_report(spark, lake, ["2026-06-02"]).collect() if r.check == quality.UNIQUE}
        assert failed == {"event_id": 1}
        jobs.reindex(spark, lake)
    report = jobs.source_report(spark, lake, ["2026-06-01"])
    files = {Path(f).parent.parent.name for f in report.inputFiles()}
    assert all(r.failures == 0 for r in report.collect()) and files


def broken(monkeypatch, step):
    """The next call of a step raises."""
    module, name = step
    whole = getattr(module, name)

    def fail(*args, **named):
        monkeypatch.setattr(module, name, whole)
        raise RuntimeError("broken off")

    monkeypatch.setattr(module, name, fail)


@pytest.mark.parametrize("step", [(id_index, "add"), (id_index, "_write"), (id_index, "settled"), (publish, "write_partitions")])
def test_a_load_broken_off_around_the_index(spark, lake, monkeypatch, step):
    file_events(lake, "2026-06-01", event("a"), event("b"))
    daily(spark, lake, "2026-06-01")
    file_events(lake, "2026-06-01", event("a", "2026-06-02T10:00:00Z"), event("b"))
    broken(monkeypatch, step)
    with pytest.raises(RuntimeError):
        daily(spark, lake, "2026-06-01")
    daily(spark, lake, "2026-06-01")
    assert held(spark, lake) == [("a", "2026-06-02"), ("b", "2026-06-01")]
    file_events(lake, "2026-06-01", event("a"), event("b"))
    daily(spark, lake, "2026-06-01")
    assert held(spark, lake) == [("a", "2026-06-01"), ("b", "2026-06-01")]


def staged_then(monkeypatch, work):
    whole = workarea.mark_staged

    def marked(*args):
        whole(*args)
        monkeypatch.setattr(workarea, "mark_staged", whole)
        work()

    monkeypatch.setattr(workarea, "mark_staged", marked)


def users(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "user_id string")


def test_users_erased_beside_a_load_stay_away(spark, lake, monkeypatch):
    """Erased to the end while a load lies between its steps, twice; also when it is broken off
    and finished by another job."""
    jobs.erase_users(spark, lake, users(spark, "early"))
    rows = [event(f"e{n}", user_id=f"u{n}") for n in range(5)] + [event("e9", user_id="early")]
    bad = [event(f"b{n}", "soon", user_id=f"u{n}") for n in range(5)]
    file_events(lake, "2026-06-01", *rows, *bad, '{"event_id": "x", "user_id": "u1", "eve')

    def both():
        jobs.erase_users(spark, lake, users(spark, "u1"))
        jobs.erase_users(spark, lake, users(spark, "u2"))

    staged_then(monkeypatch, both)
    done = daily(spark, lake, "2026-06-01")
    assert (done.bronze_rows, done.good_rows, done.bad_rows) == (6, 3, 3)
    assert [i for i, _ in held(spark, lake)] == ["e0", "e3", "e4"]

    def again():
        jobs.erase_users(spark, lake, users(spark, "u3"))
        raise RuntimeError("broken off")

    staged_then(monkeypatch, again)
    with pytest.raises(RuntimeError):
        daily(spark, lake, "2026-06-01")
    file_events(lake, "2026-06-02", event("f", "2026-06-02T00:00:00Z"))
    daily(spark, lake, "2026-06-02")
    assert [i for i, _ in held(spark, lake)] == ["e0", "e4", "f"]
    assert sorted(r.user_id for r in read_rejected(spark, lake.rejected).collect()) == ["u0", "u4"]


def test_a_run_asked_for_again_reads_new_files(spark, lake, monkeypatch):
    def stop():
        raise RuntimeError("broken off")

    file_events(lake, "2026-06-01", event("a"))
    staged_then(monkeypatch, stop)
    with pytest.raises(RuntimeError):
        daily(spark, lake, "2026-06-01")
    file_events(lake, "2026-06-01", event("b"), name="second.json")
    done = daily(spark, lake, "2026-06-01")
    assert (done.bronze_rows, held(spark, lake)) == (2, [("a", "2026-06-01"), ("b", "2026-06-01")])


def test_a_backfill_asked_for_again_reads_the_folders_that_changed(spark, lake, monkeypatch):
    def stop():
        raise RuntimeError("broken off")

    for day in ("2026-06-01", "2026-06-02"):
        file_events(lake, day, event(f"a{day}", f"{day}T01:00:00Z"), event(f"x{day}", "soon"))
    stray = Path(lake.bronze) / "export.json"
    stray.write_text("{}\n")
    staged_then(monkeypatch, stop)
    with pytest.raises(RuntimeError):
        jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS)
    file_events(lake, "2026-06-02", event("b", "2026-06-02T01:00:00Z"), event("y", "soon"), name="second.json")
    read, scan = [], bronze_source.scan_in_parts
    monkeypatch.setattr(bronze_source, "scan_in_parts", lambda s, r, tree: read.append(tree) or scan(s, r, tree))
    done = jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS)
    assert [[str(d) for _, d in days] for days, _ in read] == [["2026-06-02"]] and not read[0][1]
    assert done.bronze_rows == 5 + 4
    assert held(spark, lake) == [("a2026-06-01", "2026-06-01"), ("a2026-06-02", "2026-06-02"), ("b", "2026-06-02")]
    rejected = sorted(r.event_id or "" for r in read_rejected(spark, lake.rejected).collect())
    assert rejected == ["", "x2026-06-01", "x2026-06-02", "y"]
    again = jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS)
    assert again.bronze_rows == 7 and len(read) == 2


def set_aside_by(monkeypatch, load):
    """What a load sets aside: the partitions it replaces, the plan of the survivors, their ids."""
    whole, seen = publish.set_aside, []

    def spied(spark, folder, label, replaced, survivors):
        ids = sorted(r.event_id for r in survivors.collect())
        seen.append((len(replaced), plan(survivors), ids))
        whole(spark, folder, label, replaced, survivors)

    monkeypatch.setattr(publish, "set_aside", spied)
    load()
    monkeypatch.setattr(publish, "set_aside", whole)
    return seen


def test_partitions_replaced_as_a_whole_are_not_read_for_survivors(spark, lake, monkeypatch):
    rows = [event("a"), event("b"), event("b", user_id="copy"), event("c", event_type="login")]
    file_events(lake, "2026-06-01", *rows)
    daily(spark, lake, "2026-06-01")
    [(replaced, shape, ids)] = set_aside_by(monkeypatch, lambda: daily(spark, lake, "2026-06-01"))
    assert (replaced, ids) == (2, []) and "Scan parquet" not in shape
    assert [i for i, _ in held(spark, lake)] == ["a", "b", "b", "c"]
    # d comes from another folder: its partition has a survivor, that of logins has none
    file_events(lake, "2026-06-02", event("d"))
    daily(spark, lake, "2026-06-02")
    [(replaced, shape, ids)] = set_aside_by(monkeypatch, lambda: daily(spark, lake, "2026-06-01"))
    assert (replaced, ids) == (2, ["d"]) and "event_type=login" not in shape
    assert [i for i, _ in held(spark, lake)] == ["a", "b", "b", "c", "d"]
    # rows without an id, by another hand, are nobody's copies
    nobody = read_silver(spark, lake.silver).where("event_id = 'c'").withColumn("event_id", F.lit(None).cast("string"))
    nobody.write.mode("append").partitionBy("event_date", "event_type").parquet(lake.silver)
    daily(spark, lake, "2026-06-01")
    assert sorted(str(r.event_id) for r in read_silver(spark, lake.silver).collect()) == ["None", "a", "b", "b", "c", "d"]


def test_a_row_that_comes_while_a_run_lies_broken_off_survives(spark, lake, monkeypatch):
    """A run has compared its ids and breaks off; as many other rows then take the place of those
    it found, so their number says nothing."""
    file_events(lake, "2026-06-01", event("a"))
    daily(spark, lake, "2026-06-01")
    whole = publish._old_copies

    def then_broken(*args):
        done = whole(*args)
        broken(monkeypatch, (publish, "_among"))
        return done

    monkeypatch.setattr(publish, "_old_copies", then_broken)
    with pytest.raises(RuntimeError):
        daily(spark, lake, "2026-06-01")
    monkeypatch.undo()
    other = read_silver(spark, lake.silver).withColumn("event_id", F.lit("other")).collect()
    rows = spark.createDataFrame(other, read_silver(spark, lake.silver).schema)
    publish.write_partitions(rows, lake.silver)
    daily(spark, lake, "2026-06-01")
    assert [i for i, _ in held(spark, lake)] == ["a", "other"]


def test_generations_are_merged_in_one_shuffle(spark):
    entries = spark.createDataFrame([(n % 7, None, "login") for n in range(20)], id_index.SCHEMA)
    spread = id_index._spread(entries.union(entries), 4, copies=True)
    assert plan(spread).split("(1) Scan")[0].count("Exchange") == 1
    assert spread.count() == 7


def test_ids_meet_by_their_hash_and_equal_columns(spark):
    """Ids of one hash are told apart, and nulls meet nothing; the sort is of the hash alone."""
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None)], "id_hash long, event_id string")
    others = spark.createDataFrame([(1, "a"), (1, "z"), (2, "x"), (3, None)], "id_hash long, event_id string")
    met = {how: id_index.matched(rows.hint("merge"), others, ("event_id",), how) for how in ("left_semi", "left_anti")}
    assert [tuple(r) for r in met["left_semi"].collect()] == [(1, "a")]
    assert sorted((r.id_hash for r in met["left_anti"].collect())) == [1, 2, 3]
    assert all("Left keys [1]: [id_hash" in plan(x) and "SortMergeJoin" in plan(x) for x in met.values())
