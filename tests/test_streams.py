"""Streams: many batches, restarts and repeated batches equal the batch result."""

import pytest
from pyspark.sql import functions as F

from footfall.operators import ads as batch
from footfall.operators.relational import word_count
from footfall.sources import tables as src
from footfall.streaming import ads, ledger, words
from footfall.streaming.base import file_lines, kafka_lines, run_continuously


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def clicks(spark, small, tmp_path_factory):
    """Click lines in seven files, in time order."""
    path = str(tmp_path_factory.mktemp("clicks") / "in")
    lines = src.ad_click_lines(spark, small)
    lines.repartitionByRange(7, "event_id").sortWithinPartitions("event_id").select("value").write.text(path)
    return path, batch.parse_clicks(spark.read.text(path)).cache()


JOBS = {
    "user_ad": (ads.user_ad_totals, batch.user_ad_counts, {}),
    "totals": (ads.ad_totals, batch.ad_stat, {}),
    "top3": (ads.province_top3, lambda c: batch.province_top_ads(batch.ad_stat(c)), {}),
}


@pytest.mark.parametrize("name", list(JOBS))
def test_many_batches_with_folding(spark, clicks, tmp_path, name):
    path, parsed = clicks
    job, plain, extra = JOBS[name]
    lines = file_lines(spark, path, files_per_batch=1)
    got = job(lines, f"{tmp_path}/out", f"{tmp_path}/cp", every=3, **extra)
    want = plain(parsed)
    assert rows_of(got.select(*want.columns)) == rows_of(want)


def test_blacklist_depends_on_batches(spark, tmp_path):
    """Clicks of a banned user no longer count in later batches."""
    source = tmp_path / "in"
    source.mkdir()
    day = 1_705_276_800_000
    out, cp = f"{tmp_path}/out", f"{tmp_path}/cp"

    def arrive(name, clicks):
        (source / name).write_text("".join(f"{day + i} P C {u} {a}\n" for i, (u, a) in enumerate(clicks)))
        return ads.dynamic_blacklist(file_lines(spark, str(source)), out, cp, threshold=3, every=2)

    assert rows_of(arrive("1.txt", [(1, 1), (1, 1), (2, 1)])) == []
    assert rows_of(arrive("2.txt", [(1, 1), (2, 1)])) == [(1,)]
    assert rows_of(arrive("3.txt", [(1, 2), (1, 2), (1, 2), (2, 1)])) == [(1,), (2,)]
    assert rows_of(arrive("4.txt", [(3, 1)])) == [(1,), (2,)]
    counts = ledger.content(spark, f"{out}/counts", ads.USER_AD, ads._summed, 2)
    assert {(r["user_id"], r["ad_id"]): r["click_count"] for r in counts.collect()} == {(1, 1): 3, (2, 1): 3, (3, 1): 1}


def test_repeated_batch_counts_once(spark, tmp_path):
    path, schema = f"{tmp_path}/t", ads.USER_AD

    def step(batch_id, n):
        ledger.fold_if_due(spark, path, schema, batch_id, ads._summed, 2)
        rows = spark.createDataFrame([("2024-01-15", 1, 1, n)], schema)
        ledger.store(rows, path, batch_id)

    for batch_id, n in ((0, 1), (1, 2), (1, 2), (2, 4), (2, 4), (3, 8), (4, 16), (4, 16)):
        step(batch_id, n)
        total = ledger.content(spark, path, schema, ads._summed, 2).first()["click_count"]
        assert total == 2 ** (batch_id + 1) - 1
    assert ledger.last_batch(spark, path) == 4
    assert ledger.before(spark, path, schema, 3, 2).agg(F.sum("click_count")).first()[0] == 7


def test_blacklist_is_loaded_for_each_batch(spark, clicks, tmp_path):
    path, parsed = clicks
    loads = []

    def load(session):
        loads.append(1)
        return session.range(10).withColumnRenamed("id", "user_id")

    got = ads.allowed_clicks(file_lines(spark, path, 3), load, f"{tmp_path}/out", f"{tmp_path}/cp")
    want = parsed.where("user_id >= 10")
    assert rows_of(got.select(*want.columns)) == rows_of(want)
    assert len(loads) == 3


def test_restart_goes_on(spark, small, tmp_path):
    lines = src.ad_click_lines(spark, small)
    half = lines.count() // 2
    for part in (F.col("event_id") < half, F.col("event_id") >= half):
        lines.where(part).select("value").write.mode("append").text(f"{tmp_path}/in")
        got = ads.user_ad_totals(file_lines(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp")
    want = batch.user_ad_counts(batch.parse_clicks(lines.select("value")))
    assert rows_of(got) == rows_of(want)
    assert ledger.last_batch(spark, f"{tmp_path}/out") == 1


def test_late_clicks_count(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    day = 1_705_276_800_000

    def arrive(name, ms):
        (source / name).write_text(f"{ms} P C 1 1\n")
        lines = file_lines(spark, str(source))
        totals = ads.ad_totals(lines, f"{tmp_path}/out", f"{tmp_path}/cp", every=2)
        top = ads.province_top3(lines, f"{tmp_path}/top", f"{tmp_path}/cp2", every=2)
        trend = ads.click_trend(lines, f"{tmp_path}/trend", f"{tmp_path}/cp3", every=2)
        slides = ads.sliding_counts(lines, f"{tmp_path}/slides", f"{tmp_path}/cp4", 60_000, 10_000, every=2)
        return totals, top, trend, slides

    arrive("1.txt", day)
    arrive("2.txt", day + 3 * 86_400_000)
    arrive("3.txt", day + 4 * 86_400_000)
    totals, top, trend, slides = arrive("4.txt", day + 1)  # four days late
    want = {"2024-01-15": 2, "2024-01-18": 1, "2024-01-19": 1}
    for frame in (totals, top, trend):
        assert {r["date"]: r["click_count"] for r in frame.collect()} == want
    rows = slides.where("window_start < '2024-01-16'").orderBy("window_start").collect()
    assert [r["click_count"] for r in rows] == [2] * 6
    assert (rows[0]["window_start"], rows[5]["window_end"]) == ("2024-01-14 23:59:10", "2024-01-15 00:01:00")


def test_old_batches_are_deleted(spark, tmp_path):
    import os

    path, schema = f"{tmp_path}/t", ads.USER_AD
    for batch_id in range(9):
        ledger.fold_if_due(spark, path, schema, batch_id, ads._summed, 2)
        ledger.store(spark.createDataFrame([("2024-01-15", 1, 1, 1)], schema), path, batch_id)
        assert ledger.content(spark, path, schema, ads._summed, 2).first()["click_count"] == batch_id + 1
    assert sorted(os.listdir(f"{path}/snapshots")) == ["before=6", "before=8"]
    assert len([f for f in os.listdir(f"{path}/batches") if f.startswith("batch_id")]) == 3


def test_unfinished_batches_are_not_read(spark, tmp_path):
    import os

    path, schema = f"{tmp_path}/t", ads.USER_AD
    assert ledger.appended(spark, path, schema).count() == 0
    for batch_id in range(2):
        ledger.store(spark.createDataFrame([("2024-01-15", 1, 1, 1)], schema), path, batch_id)
    os.remove(f"{path}/batches/batch_id=1/_SUCCESS")
    assert ledger.appended(spark, path, schema).count() == 1


def test_continuous_run(spark, clicks, tmp_path):
    path, parsed = clicks
    started = []

    def run(writer, checkpoint):
        started.append(run_continuously(writer, checkpoint, "0 seconds"))
        return started[0]

    ads.user_ad_totals(file_lines(spark, path, 2), f"{tmp_path}/out", f"{tmp_path}/cp", every=2, run=run)
    try:
        started[0].processAllAvailable()
    finally:
        started[0].stop()
    got = ledger.content(spark, f"{tmp_path}/out", ads.USER_AD, ads._summed, 2)
    assert rows_of(got) == rows_of(batch.user_ad_counts(parsed))


def test_word_totals(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, text in enumerate(["a b  a", "b c"]):
        (source / f"{i}.txt").write_text(text + "\n")
        got = words.word_totals(file_lines(spark, str(source)), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert rows_of(got) == rows_of(word_count(spark.read.text(str(source)), "value"))


def test_kafka_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_lines(spark, "localhost:1", "a, b")


def test_a_fold_writes_the_days_its_batches_touched(spark, tmp_path):
    import os

    path, schema = f"{tmp_path}/t", ads.USER_AD
    days = ["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03", "2024-01-01", "2024-01-03", "2024-01-03", None, "2024-01-03"]
    for batch_id, day in enumerate(days):
        for _ in range(2):  # every batch is repeated
            ledger.fold_if_due(spark, path, schema, batch_id, ads._summed, 2)
            ledger.store(spark.createDataFrame([(day, 1, 1, 1)], schema), path, batch_id)
        got = {r["date"]: r["click_count"] for r in ledger.content(spark, path, schema, ads._summed, 2).collect()}
        assert got == {d: days[: batch_id + 1].count(d) for d in days[: batch_id + 1]}
    written = sorted(os.listdir(f"{path}/snapshots/before=6"))
    assert [f for f in written if f.startswith("date=")] == ["date=2024-01-01", "date=2024-01-03"]  # the days of batches 4 and 5
    assert not os.path.exists(f"{path}/snapshots/before=2/date=2024-01-01")  # superseded
    assert os.path.exists(f"{path}/snapshots/before=4/date=2024-01-02")  # nothing since


def test_keyed_state_restarts_and_counts_late_clicks(spark, tmp_path):
    """Out of order, with a restart between batches; a key that has left the state starts another life."""
    source = tmp_path / "in"
    source.mkdir()
    day = 1_705_276_800_000
    want = {}
    for i, clicks in enumerate([[(1, 5)], [(0, 5), (1, 5), (1, 6)], [(-3, 5), (0, 5)], [(1, 5)]]):
        (source / f"{i}.txt").write_text("".join(f"{day + d * 86_400_000} P C 9 {ad}\n" for d, ad in clicks))
        for d, ad in clicks:
            want[d, ad] = want.get((d, ad), 0) + 1
        out = ads.ad_state_totals(file_lines(spark, str(source)), f"{tmp_path}/out", f"{tmp_path}/cp", idle="1 ms", every=2)
        assert sorted(r["click_count"] for r in out.collect()) == sorted(want.values())
    lives = ledger.content(spark, f"{tmp_path}/out", ads.LIVES, ads._newest_lives, 2)
    assert lives.count() > len(want)  # keys came back


def test_changes_of_a_sliding_window(spark, tmp_path):
    """Every window, from the runs, against counting each of them."""
    source = tmp_path / "in"
    source.mkdir()
    start = 1_705_276_800_000
    clicks = [(start + ms, ad) for ms, ad in [(0, 1), (5, 1), (10_000, 1), (3_600_000, 1), (86_400_000, 1), (20_000, 2), (-1, 2)]]
    (source / "a.txt").write_text("".join(f"{ms} P C 9 {ad}\n" for ms, ad in clicks))
    out = ads.sliding_changes(file_lines(spark, str(source)), f"{tmp_path}/out", f"{tmp_path}/cp", size_ms=60_000, slide_ms=10_000)
    runs = out.selectExpr("unix_millis(CAST(first_start AS TIMESTAMP)) AS a", "unix_millis(CAST(last_start AS TIMESTAMP)) AS b", "ad_id", "click_count").collect()
    got = {(s, r["ad_id"]): r["click_count"] for r in runs for s in range(r["a"], r["b"] + 1, 10_000)}
    want = {}
    for ms, ad in clicks:
        for k in range(6):
            s = (ms // 10_000 - k) * 10_000
            want[s, ad] = want.get((s, ad), 0) + 1
    assert got == want and len(runs) <= 2 * len(clicks)
