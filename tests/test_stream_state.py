import datetime
import os
import random

import pytest

from weftline.operators import dedup, jobs
from weftline.streaming import ingest
from weftline.streaming.state import LatestRows, SeenDocuments, dropped_late, read_batches


def near_copies(seed, n):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(30)] for _ in range(8)]
    out = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        out.append((f"{i:04d}", " ".join(words)))
    return out + [("9998", ""), ("9999", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_batch_walk(spark, tmp_path, seed):
    rows = near_copies(seed, 120)
    df = spark.createDataFrame(rows, "id string, content string")
    wanted = sorted(r["id"] for r in dedup.dedup_lsh(df).select("id").collect())
    seen = SeenDocuments(spark, str(tmp_path / "seen"))
    for part in (rows[:40], rows[40:41], rows[41:]):
        spark.createDataFrame(part, "id string, content string").write.mode("append").json(str(tmp_path / "in"))
        seen.run(ingest.read_stream(spark, str(tmp_path / "in"), schema="id string, content string"), str(tmp_path / "state")).awaitTermination()
    got = sorted(r["id"] for r in seen.survivors("id string, content string").collect())
    assert got == wanted and len(got) < len(rows)
    last = spark.createDataFrame(rows[41:], "id string, content string")
    seen.take(last, 2)      # replayed: nothing changes
    assert sorted(r["id"] for r in seen.survivors("id string, content string").collect()) == wanted


def test_pairs_of_a_batch_and_the_state_meet_with_outlines(spark, tmp_path, monkeypatch):
    """Unlike documents of common buckets make no pair, a batch leaves no table but its own, and slices change nothing."""
    pairs = []
    monkeypatch.setattr(dedup, "SLICE_ROWS", 500)
    monkeypatch.setattr(dedup, "_met", lambda *a, f=dedup._met: (r := f(*a), pairs.append(r[0].count()))[0])
    shared = " ".join(f"same{i}" for i in range(60))  # Jaccard 0.6
    texts = [shared + " " + " ".join(f"own{k}x{i}" for i in range(20)) for k in range(40)]
    rows = [(f"{k:02d}", t) for k, t in enumerate(texts)] + [("90", texts[3] + " more"), ("91", texts[5])]
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    seen = SeenDocuments(spark, str(tmp_path / "seen"))
    for n, part in enumerate((rows[:20], rows[20:])):
        seen.take(spark.createDataFrame(part, "id string, content string"), n)
    assert sorted(r["id"] for r in seen.survivors("id string").collect()) == [f"{k:02d}" for k in range(40)]
    assert sum(pairs) < 20
    assert set(os.listdir(folder)) == before


def test_forgets_after_its_time(spark, tmp_path):
    seen = SeenDocuments(spark, str(tmp_path / "seen"), ts="at", ttl=60)
    text = " ".join(f"w{i}" for i in range(40))
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    batches = [[("a", text, at(0)), ("b", text + " more", at(1))], [("c", text + " new", at(50))], [("d", "other words here", at(200))], [("e", text, at(210))]]
    for n, rows in enumerate(batches):
        seen.take(spark.createDataFrame(rows, "id string, content string, at timestamp"), n)
    assert sorted(r["id"] for r in seen.survivors("id string").collect()) == ["a", "d", "e"]
    held = read_batches(spark, f"{seen.path}/leaders", seen._schema)
    assert sorted(r["ord"] for r in held.collect()) == ["d", "e"]    # the first batches' state is gone


ROWS = "job_id string, status string, progress double, message string, updated_at int, event_id long"


@pytest.mark.parametrize("compact", [1, 2, 100])
def test_upsert_of_replayed_batches(spark, tmp_path, compact):
    rng = random.Random(3)
    events = [(f"j{rng.randrange(9)}", rng.choice(["queued", "running", "done"]), rng.random(), None, rng.randrange(40), i) for i in range(200)]
    latest = LatestRows(spark, str(tmp_path / "jobs"), ROWS, "job_id", ("updated_at", "event_id"), compact)
    parts = [events[i:i + 50] for i in range(0, 200, 50)]
    for n, part in enumerate(parts):
        for _ in range(2):
            latest.take(spark.createDataFrame(part, ROWS), n)
        if n:
            latest.take(spark.createDataFrame(parts[n - 1], ROWS), n - 1)
    wanted = jobs.job_latest_status(spark.createDataFrame(events, ROWS))
    key = ["job_id", "status", "progress", "message", "updated_at"]
    assert sorted(map(tuple, latest.read().select(key).collect())) == sorted(map(tuple, wanted.select(key).collect()))


def test_upsert_of_nothing(spark, tmp_path):
    latest = LatestRows(spark, str(tmp_path / "jobs"), ROWS, "job_id", ("updated_at",))
    assert latest.read().collect() == []
    latest.take(spark.createDataFrame([], ROWS), 0)
    assert latest.read().collect() == []


def test_late_rows_are_counted(spark, tmp_path):
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    out, source = str(tmp_path / "out"), str(tmp_path / "in")
    late = 0
    for seconds in ([1, 2, 11], [3600], [3601], [3, 4], [7200], [7201]):
        spark.createDataFrame([(at(s), "r") for s in seconds], "ts timestamp, reason string").coalesce(1).write.mode("append").json(source)
        sdf = ingest.read_stream(spark, source, schema="ts timestamp, reason string")
        query = ingest.metrics_window(sdf, watermark="5 seconds").writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(out)
        query.awaitTermination()
        late += dropped_late(query)
    assert late >= 1                       # one window's rows reach the state summed up, as one row
    windows = [(r["window_start"], r["docs"]) for r in spark.read.parquet(out).collect()]
    assert len(windows) == len(set(w for w, _ in windows)) and sorted(n for _, n in windows)[-1] == 2


def test_a_late_row_is_counted_and_windows_come_out_once(spark, tmp_path):
    from weftline.streaming import ingest

    arriving, out, state_at = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "ts timestamp_ntz, reason string"
    late = 0
    for seconds in ((1, 2, 11, 61), (3, 55, 200), (12, 199)):  # 3 and 12 come after their windows are out
        spark.createDataFrame([(f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}", "a") for s in seconds], "ts string, reason string").selectExpr(
            "CAST(ts AS TIMESTAMP_NTZ) AS ts", "reason").coalesce(1).write.mode("append").parquet(arriving)
        query = ingest.stream_metrics(spark.readStream.schema(schema).parquet(arriving), out, state_at, "20 seconds")
        query.awaitTermination()
        late += ingest.late_rows(query)
    got = {str(r["window_start"])[14:]: r["docs"] for r in spark.read.parquet(out).collect()}
    assert late == 2 and got == {"00:00": 2, "00:10": 1, "00:50": 1, "01:00": 1}
    assert spark.read.parquet(out).count() == 4


def test_flushed_files_come_alone(spark, tmp_path):
    """Ten rows a file and no checksum file beside it; the session's settings are as before."""
    src, out = str(tmp_path / "docs"), tmp_path / "out"
    spark.createDataFrame([(str(i), f"text {i}") for i in range(25)], "id string, content string").coalesce(1).write.parquet(src)
    sdf = spark.readStream.schema("id string, content string").parquet(src)
    ingest.periodic_flush(sdf, str(out), str(tmp_path / "state")).awaitTermination()
    files = [p for p in out.iterdir() if p.is_file()]
    assert sorted(len(p.read_text().splitlines()) for p in files) == [5, 10, 10]
    assert sorted(r["id"] for r in spark.read.json(str(out)).collect()) == sorted(map(str, range(25)))
    assert all(spark.conf.get(name, None) is None for name in ingest.PLAIN_FILES)
