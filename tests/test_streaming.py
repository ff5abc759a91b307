"""Streaming pipeline vs its batch twin: one file a micro-batch, a backlog, a restart, a crash.

The log is replayed from text files, one per five-day slot, each as old as its newest row.
"""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from shoplens.operators import ads as ad
from shoplens.params import AdsParams
from shoplens.plans.queries import parsed_ads
from shoplens.sources.ads import file_lines, parse_lines
from shoplens.sources.tables import ads_log_lines
from shoplens.streaming import app, bans
from shoplens.streaming import versions as vs

SLOT = 5 * 86_400
PARAMS = AdsParams(ban_threshold=2, batch_seconds=SLOT, trend_minutes=60,
                   sliding_window="60 minutes", sliding_slide="10 seconds")
ONCE = {"availableNow": True}
KEPT_COLS = ["ms", "day", "area", "city", "user_id", "ads_id"]


def _write(folder, name, rows, arrival_s):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("".join(f"{r}\n" for r in rows))
    os.utime(path, (arrival_s, arrival_s))
    return path


def _write_slot_files(spark, folder):
    """Test input: the sf0.001 log lines (1,000), one text file per slot."""
    lines = ads_log_lines(spark, SF001)
    rows = ad.with_batch(parse_lines(lines, keep_rejects=True), SLOT) \
        .select("batch_id", "line", F.unix_seconds("ts").alias("s")).toPandas()
    return [_write(folder, f"{slot:08d}.txt", grp["line"], int(grp["s"].max()) + 1)
            for slot, grp in sorted(rows.groupby("batch_id"))]


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _run(spark, src, paths, files_per_batch=1, close=True, params=PARAMS):
    q = app.run_pipeline(spark, lambda: file_lines(spark, src, files_per_batch), paths, params, ONCE, 900, close)
    assert q.exception() is None
    return q


@pytest.fixture(scope="module")
def replay(spark):
    """One file a micro-batch; three files a micro-batch; half, a stop, and the rest."""
    root = tempfile.mkdtemp(prefix="shoplens-stream-")
    src_all, src_part = os.path.join(root, "all"), os.path.join(root, "part")
    os.makedirs(src_all)
    os.makedirs(src_part)
    files = _write_slot_files(spark, src_all)
    runs = {n: app.Paths(os.path.join(root, f"out_{n}"), os.path.join(root, f"ckpt_{n}")) for n in ("each", "backlog", "half")}
    _run(spark, src_all, runs["each"])
    _run(spark, src_all, runs["backlog"], files_per_batch=3)
    for last in (False, True):
        for f in files[len(files) // 2:] if last else files[: len(files) // 2]:
            os.link(f, os.path.join(src_part, os.path.basename(f)))
        _run(spark, src_part, runs["half"], close=last)
    return runs


@pytest.fixture(scope="module")
def twin(spark):
    parsed = parsed_ads(spark, SF001)
    kept = ad.ads_filtered(parsed, PARAMS.ban_threshold, PARAMS.batch_seconds)
    return {"parsed": parsed, "kept": kept, "totals": ad.area_city_ads_day(kept),
            "bans": ad.ads_blacklist(parsed, PARAMS.ban_threshold, PARAMS.batch_seconds)}


@pytest.mark.parametrize("run", ["each", "backlog", "half"])
def test_all_tables_equal_the_batch_twin(spark, replay, twin, run):
    paths = replay[run]
    ms = F.unix_millis("ts").alias("ms")
    got = app.kept_rows(spark, paths).select("*", ms)
    assert _rows(got, KEPT_COLS) == _rows(twin["kept"].select("*", ms), KEPT_COLS)
    assert twin["bans"].count() > 0 and twin["kept"].count() < 1000  # the feedback loop did drop rows
    assert _rows(app.current_blacklist(spark, paths), ["user_id", "ban_slot"]) == _rows(twin["bans"], ["user_id", "ban_batch"])
    cols = app.TOTAL_KEYS + ["click_count"]
    assert _rows(app.current_totals(spark, paths), cols) == _rows(twin["totals"], cols)
    cols = [*ad.DAY_USER_AD, "click_count"]
    assert _rows(app.current_user_counts(spark, paths), cols) == _rows(ad.user_ads_day_counts(twin["kept"]), cols)
    top = ad.area_top_ads(ad.area_ads_day(twin["totals"]), 3)
    cols = ["day", "area", "rank", "ads_id", "click_count"]
    assert _rows(app.current_top_ads(spark, paths), cols) == _rows(top, cols)
    cols = ["day", "area", "top3_json"]
    assert _rows(app.current_top_ads_json(spark, paths), cols) == _rows(ad.area_top_ads_json(top), cols)
    trend = ad.last_hour_ads_trend(ad.last_hour_ads_minutes(twin["parsed"], 60))
    assert _rows(app.current_trend(spark, paths), ["ads_id", "trend_json"]) == _rows(trend, ["ads_id", "trend_json"])


@pytest.mark.parametrize("run", ["each", "backlog"])
def test_sliding_windows_of_judged_slots_equal_the_batch_twin(spark, replay, twin, run):
    cols = ["window_start", "window_end", "ads_id", "click_count"]
    got = app.sliding_counts(spark, replay[run], PARAMS).select(cols)
    until = vs.Versions(spark, replay[run].out).head().state["judged_to"] * SLOT
    want = ad.ads_sliding_counts(twin["parsed"], PARAMS.sliding_window, PARAMS.sliding_slide).select(cols) \
        .filter(F.unix_timestamp(F.to_timestamp("window_end")) <= until)
    assert got.count() == want.count() > 100_000 and got.exceptAll(want).isEmpty()


def test_the_source_is_read_once_a_micro_batch(spark, scratch):
    """Every line passes one counter once, whatever is made of it."""
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    for f in _write_slot_files(spark, src)[3:]:
        os.remove(f)
    n = sum(len(open(os.path.join(src, f)).readlines()) for f in os.listdir(src))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(line):
        seen.add(1)
        return line

    lines = lambda: file_lines(spark, src).withColumn("line", counted.asNondeterministic()("line"))
    paths = app.Paths(os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    app.run_pipeline(spark, lines, paths, PARAMS, ONCE, 600, True)
    assert seen.value == n == app.log_lines(spark, paths).count()


def test_rejects_and_a_row_dated_ahead(spark, scratch):
    """One row 400 days ahead is rejected and moves nothing: the rows after it all count."""
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    t = 1_704_153_600  # 2024-01-02
    day = 86_400
    _write(src, "a", [f"{(t + 400 * day) * 1000} ASIA C 1 1", "no click", "", f"{t * 1000} ASIA C 2 1"], t + 5)
    _write(src, "b", [f"{(t + 60 * i) * 1000} ASIA C {i} 2" for i in range(1, 21)], t + 60 * 20)
    _write(src, "c", [f"{(t - 2 * day) * 1000} ASIA C 9 3"], t + 60 * 21)  # its slot was judged by then
    _write(src, "d", [f"{(t + 3 * day) * 1000} ASIA C 8 3"], t + 3 * day)
    paths = app.Paths(os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    params = AdsParams(ban_threshold=100, batch_seconds=60)
    _run(spark, src, paths, params=params)
    reasons = {r["reason"]: r["count"] for r in app.log_lines(spark, paths).groupBy("reason").count().collect()}
    assert reasons == {"ok": 22, "malformed": 2, "ahead": 1, "late": 1}
    assert app.rejected_lines(spark, paths).count() == 4
    assert sum(r.click_count for r in app.current_totals(spark, paths).filter("ads_id = '2'").collect()) == 20
    assert {r.user_id for r in app.kept_rows(spark, paths).collect()} == {"2", "8", *map(str, range(1, 21))}


def test_rows_of_one_user_are_judged_by_several_tasks(spark):
    t = F.timestamp_seconds(F.lit(1_704_153_600) + F.col("id") % 600)
    due = spark.range(20_000).select(
        t.alias("ts"), F.lit("2024-01-02").alias("day"), F.lit("A").alias("area"), F.lit("C").alias("city"),
        F.lit("bot").alias("user_id"), F.lit("1").alias("ads_id"), (F.col("id") % 600).alias("slot"))
    none = spark.createDataFrame([], bans.BANS_SCHEMA)
    so_far = spark.createDataFrame([("bot", "1", 10, "2024-01-02")], app.USER_COUNTS_SCHEMA)
    found = bans.new_bans(due, so_far, none, 210, 0)
    assert [tuple(r) for r in found.collect()] == [("bot", 5)]  # ten before, then 34 a slot
    kept = bans.judged(due, found)
    per_task = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 6 * 34
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        all_kept = bans.judged(due, spark.createDataFrame([("bot", 10_000)], bans.BANS_SCHEMA))
        per_task = [r["count"] for r in all_kept.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 20_000 and len(per_task) >= 4 and max(per_task) < 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # a user banned before gives no new ban and passes no row
    old = spark.createDataFrame([("bot", -1)], bans.BANS_SCHEMA)
    assert bans.new_bans(due, so_far, old, 210, 0).isEmpty() and bans.judged(due, old).isEmpty()


def test_a_run_that_dies_before_its_commit_loses_and_doubles_nothing(spark, scratch, monkeypatch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    t = 1_704_153_600
    _write(src, "a", [f"{(t + i) * 1000} ASIA C {i % 3} 1" for i in range(30)], t + 100)
    paths = app.Paths(os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    params = AdsParams(ban_threshold=4, batch_seconds=5, settle_seconds=0)
    _run(spark, src, paths, close=False, params=params)
    before = app.current_trend(spark, paths).collect()
    assert before and app.current_totals(spark, paths).count() == 1
    _write(src, "b", [f"{(t + 60 + i) * 1000} ASIA C {i % 3 + 10} 1" for i in range(30)], t + 200)
    commit = vs.Versions.commit

    def die(self, draft):
        raise RuntimeError("died before the manifest was switched")

    monkeypatch.setattr(vs.Versions, "commit", die)
    with pytest.raises(Exception):
        _run(spark, src, paths, close=False, params=params)
    assert app.current_trend(spark, paths).collect() == before  # a reader still finds the last snapshot whole
    monkeypatch.setattr(vs.Versions, "commit", commit)
    _run(spark, src, paths, close=True, params=params)
    lines = spark.read.text(src).withColumnRenamed("value", "line")
    twin = ad.kept_counts(parse_lines(lines), 4, 5)
    cols = app.TOTAL_KEYS + ["click_count"]
    assert _rows(app.current_totals(spark, paths), cols) == _rows(ad.area_city_ads_day(twin), cols)
    assert app.log_lines(spark, paths).count() == 60
    # and one that died after it is not done again
    store = vs.Versions(spark, paths.out)
    head = store.head()
    app.process(store, lines, head.state["stream_batch"], params)
    assert store.head() == head


def test_folders_a_batch_meets_do_not_grow(spark, scratch):
    store = vs.Versions(spark, os.path.join(scratch, "t"))
    schema = "k string, n bigint, day string"
    most = 0
    for i in range(2 * vs.MERGE + 3):
        draft = store.next()
        changes = spark.createDataFrame([("a", 1, "d1"), (f"k{i}", 1, "d1")], schema)
        store.add(draft, "t", schema, changes, ["day", "k"], "n", ["d1"])
        store.replace(draft, "s", spark.createDataFrame([(i,)], "i int"), [""])
        store.commit(draft)
        most = max(most, len(store.head().folders("t")))
        assert [r.i for r in store.read("s", "i int").collect()] == [i]
    got = {r.k: r.n for r in store.read("t", schema).groupBy("k").agg(F.sum("n").alias("n")).collect()}
    assert got == {"a": 2 * vs.MERGE + 3, **{f"k{i}": 1 for i in range(2 * vs.MERGE + 3)}}
    assert most < vs.MERGE and len(store.head().folders("s")) == 1
    # folders of older versions are gone, those a reader may still be on are not
    held = {d for d in os.listdir(os.path.join(scratch, "t", "s")) if d.startswith("v=")}
    assert len(held) <= vs.KEEP + 1
    manifests = [m for m in os.listdir(os.path.join(scratch, "t", "_manifests")) if m.endswith(".json")]
    assert len(manifests) <= vs.KEEP


def test_two_hundred_versions_keep_a_bounded_manifest():
    draft, sizes = vs.Manifest(), []
    store = vs.Versions.__new__(vs.Versions)
    for i in range(200):
        draft.batch = i
        store._place(draft, "t", "d", len(draft.tables.get("t", {}).get("d", [])) + 1 >= vs.MERGE)
        store._place(draft, "s", "", True)
        sizes.append(len(draft.folders("t")) + len(draft.folders("s")))
    assert max(sizes[100:]) == max(sizes[:20]) <= vs.MERGE


def test_pipeline_with_processing_time(spark, scratch):
    """The application mode: a time trigger, and batches that find nothing to judge yet."""
    every, src = os.path.join(scratch, "all"), os.path.join(scratch, "src")
    os.makedirs(every)
    os.makedirs(src)
    for f in _write_slot_files(spark, every)[:2]:
        os.link(f, os.path.join(src, os.path.basename(f)))
    paths = app.Paths(os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    assert app.current_totals(spark, paths).isEmpty()  # no version yet
    q = app.run_pipeline(spark, lambda: file_lines(spark, src), paths, PARAMS, {"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        assert app.kept_rows(spark, paths).count() > 0
        assert app.current_totals(spark, paths).count() > 0
    finally:
        q.stop()


def test_streaming_command(spark, scratch):
    from shoplens.plans import jobs

    src = os.path.join(scratch, "src")
    os.makedirs(src)
    t = 1_704_153_600
    for i in range(4):
        _write(src, f"{i}", [f"{(t + 60 * i + j) * 1000} ASIA C {j % 2} {j % 3}" for j in range(20)], t + 60 * i + 30)
    out = os.path.join(scratch, "out")
    jobs.main(["streaming", "--lines", src, "--out", out, "--checkpoints", os.path.join(scratch, "ckpt"), "--available-now",
               "--close", "--max-per-trigger", "3", "--batch-seconds", "30", "--ban-threshold", "1000", "--ads-per-area", "2",
               "--settle-seconds", "10"])
    paths = app.Paths(out, os.path.join(scratch, "ckpt"))
    assert vs.Versions(spark, out).head().state["stream_batch"] == 1  # two micro-batches: admission was limited
    assert sum(r.click_count for r in app.current_totals(spark, paths).collect()) == 80
    assert {r["rank"] for r in app.current_top_ads(spark, paths).collect()} == {1, 2}
