import os
import time

import pytest
from pyspark.sql import functions as F

from weftline import schemas
from weftline.operators import jobs, versions as V
from weftline.sources import readers, writers
from weftline.streaming import ingest

GOOD = '{"id":"1","url":"u","domain":"d","content":"é text","content_hash":"h","timestamp":"t"}'


@pytest.fixture
def raw_dir(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.jsonl").write_text(GOOD + "\n\n   \nnot json\n" + '{"id":"2"}\n', encoding="utf-8")
    (folder / "skip.txt").write_text("x")
    (folder / "sub").mkdir()
    (folder / "sub" / "b.jsonl").write_text(GOOD)
    return str(folder)


def test_scan_raw_routes_bad_lines(spark, raw_dir):
    good, rejects = readers.scan_raw(spark, raw_dir)
    (row,) = good.collect()
    assert row["content"] == "é text" and row["title"] == "No Title"
    assert sorted(r["id"] or "-" for r in rejects.collect()) == ["-", "2"]
    assert readers.raw_counts(spark, raw_dir).select("total_docs").first()[0] == 2


def test_scan_recent(spark, raw_dir):
    old = os.path.join(raw_dir, "old.jsonl")
    with open(old, "w") as f:
        f.write(GOOD.replace('"1"', '"9"'))
    start = time.time()
    os.utime(old, (start - 60, start - 60))
    os.utime(os.path.join(raw_dir, "a.jsonl"), (start - 9, start - 9))
    assert [r["id"] for r in readers.scan_raw(spark, raw_dir, since=start)[0].collect()] == ["1"]
    assert readers.scan_raw(spark, raw_dir, since=None)[0].count() == 2


def test_marker(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    assert readers.read_marker(spark, str(raw)) is None
    (tmp_path / readers.MARKER).write_text("12.5\n")
    assert readers.read_marker(spark, str(raw)) == 12.5
    (tmp_path / readers.MARKER).write_text("soon")
    assert readers.read_marker(spark, str(raw)) is None


def test_cleaned_defaults(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"id":"1","content":"x"}\nbroken\n')
    (row,) = readers.scan_cleaned(spark, str(tmp_path)).collect()
    assert readers.scan_cleaned(spark, str(tmp_path)).count() == 1
    assert (row["language"], row["quality_score"], row["content_length"]) == ("unknown", 0.5, 0)


def test_raw_files_hold_ten_documents(spark, tmp_path):
    df = spark.range(25).select(F.col("id").cast("string"), F.lit("é").alias("content")).coalesce(1)
    writers.write_raw(df, str(tmp_path / "o"))
    files = [f for f in os.listdir(tmp_path / "o") if f.startswith("part")]
    assert len(files) == 3
    assert "é" in open(tmp_path / "o" / files[0], encoding="utf-8").read()


def shard_rows(spark):
    rows = [(f"d{i}", [1, 2, 3], [1, 1, 1], "en" if i % 2 else "fr", 0.5, 3, "val" if i < 2 else "train", f"{i % 3:04d}") for i in range(9)]
    return spark.createDataFrame(rows, "id string, tokens array<int>, attention_mask array<int>, language string, quality_score double, "
                                       "token_count int, split string, shard_id string")


def test_shards_round_trip(spark, tmp_path):
    df, path = shard_rows(spark), str(tmp_path / "s")
    writers.write_shards(df, path)
    for folder, _, files in os.walk(path):
        assert sum(f.endswith(".snappy.parquet") for f in files) <= 1
    back = readers.scan_shards(spark, path)
    assert back.count() == 9 and {r["shard_id"] for r in back.collect()} == {"0000", "0001", "0002"}
    assert dict(back.dtypes)["quality_score"] == "float"
    meta = writers.shard_meta(df, path, "now").collect()
    assert sum(r["total_documents"] for r in meta) == 9 and all(r["file_size_mb"] > 0 for r in meta)
    broken = os.path.join(path, "split=train", "shard_id=0009")
    os.makedirs(broken)
    open(os.path.join(broken, "x.parquet"), "w").write("not parquet")
    assert readers.scan_shards(spark, path).count() == 9


def test_no_shards_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.scan_shards(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.scan_shards(spark, str(tmp_path / "empty"))


def test_manifest_round_trip(spark, tmp_path):
    writers.write_split_manifest(shard_rows(spark), str(tmp_path / "m"), "now")
    rows = readers.scan_manifest(spark, str(tmp_path / "m")).collect()
    assert {r["total_documents"] for r in rows} == {2, 7}
    assert all(sum(r["languages"].values()) == r["documents"] for r in rows)
    (tmp_path / "p.json").write_text('{"version":"1.0"}')
    (row,) = readers.scan_manifest(spark, str(tmp_path / "p.json")).collect()
    assert row["total_documents"] == 0 and row["total_tokens"] == 0


def test_stats_csv_keeps_quotes_and_newlines(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "q", b\nc')], "id string, content string")
    writers.write_stats_csv(df, str(tmp_path / "c"))
    (row,) = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "c")).collect()
    assert row["content"] == 'a "q", b\nc'


def test_insert_absent(spark, tmp_path):
    path = str(tmp_path / "v")
    first = spark.createDataFrame([("1.0", "one")], "version string, description string")
    again = spark.createDataFrame([("1.0", "other"), ("1.1", "two"), ("1.1", "two")], "version string, description string")
    writers.insert_absent(first, "dataset_versions", path)
    got = {r["version"]: r["description"] for r in writers.insert_absent(again, "dataset_versions", path).collect()}
    assert got == {"1.0": "one", "1.1": "two"}


# -- versions -------------------------------------------------------------------------------------

def snapshot(spark, hashes, tokens=5):
    return spark.createDataFrame([(str(i), h, tokens) for i, h in enumerate(hashes)], "id string, content_hash string, token_count int")


SHA = ["%064x" % n for n in range(1, 20)]


def test_version_life(spark, tmp_path):
    store = V.VersionStore(spark, str(tmp_path / "store"))
    assert V.list_versions(store).collect() == [] and V.current_version(store).first()[0] is None
    with pytest.raises(ValueError):
        V.get_version(store)
    assert V.create_version(store, "a", snapshot(spark, SHA[:3]), "2024-01-01") == "1.0"
    assert V.create_version(store, "b", snapshot(spark, SHA[:5]), "2024-01-02") == "1.1"
    V.save_version(store, "named", "c", snapshot(spark, SHA[:1]), "2024-01-03")
    with pytest.raises(ValueError):
        V.save_version(store, "named", "c", snapshot(spark, SHA[:1]), "2024-01-04")
    with pytest.raises(ValueError):
        V.save_version(store, "empty", "c", snapshot(spark, SHA[:1]).limit(0), "2024-01-04")
    assert [r["version"] for r in V.list_versions(store).collect()] == ["1.0", "1.1", "named"]
    assert V.get_version(store).first()["version"] == "named"
    assert V.load_version(store, "1.1").count() == 5
    with pytest.raises(ValueError):
        V.load_version(store, "nope")
    assert V.mark_trained(store, "now", "1.0") == "1.0" and V.mark_trained(store, "now", "1.0") == "1.0"
    assert V.mark_trained(store, "now") == "named"
    assert [r["version"] for r in V.untrained_versions(store).collect()] == ["1.1"]
    assert V.unique_trained(store).count() == 2
    counts = {r["metric"]: r["diff"] for r in V.compare_counts(store, "1.1", "1.0").collect()}
    assert counts == {"total_docs": -2, "total_tokens": -10}
    V.export_version(store, "1.0", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "documents")).count() == 3


@pytest.mark.parametrize("last,expected", [(None, "1.0"), ("1.9", "1.10"), ("1.10", "1.11")])
def test_numbering(spark, last, expected):
    rows = [(v, "2024", None, None, None, None, None, None) for v in ([last, "1.8", "1.9"] if last == "1.10" else [last] if last else [])]
    assert V.next_version(spark.createDataFrame(rows, schemas.VERSIONS)) == expected


def test_compare_metrics(spark):
    a = spark.createDataFrame([({"total_docs": 10.0, "total_tokens": 100.0},)], "statistics map<string,double>")
    b = spark.createDataFrame([({"total_docs": 12.0, "x": 1.0},)], "statistics map<string,double>")
    got = {r["metric"]: (r["diff"], r["pct_change"]) for r in V.compare_metrics(a, b).collect()}
    assert got == {"total_docs": (2.0, 20.0), "total_tokens": (-100.0, -100.0), "x": (1.0, 0.0)}
    assert {r["metric"] for r in V.key_union(a, b).collect()} == set(got)


def test_checksum_ignores_order_but_not_copies(spark):
    def digest(hashes):
        return V.dataset_checksum(snapshot(spark, hashes)).first()["checksum"]

    assert digest(SHA[:4]) == digest(SHA[:4][::-1]) != digest(SHA[:4] + SHA[:1])
    assert len(digest([])) == 64


def test_diff(spark):
    got = {r["content_hash"]: r["change"] for r in V.version_diff_docs(snapshot(spark, ["a", "b", "b"]), snapshot(spark, ["b", "c"])).collect()}
    assert got == {"a": "removed", "b": "unchanged", "c": "added"}


# -- jobs and streams -----------------------------------------------------------------------------

def test_job_log(spark):
    events = spark.createDataFrame([("a", "queued", 0.0, "m1", 1), ("a", "running", 0.1, "m2", 2), ("x", "failed", 0.0, "m3", 3)],
                                   "job_id string, status string, progress double, message string, updated_at int")
    known = spark.createDataFrame([("a",)], "job_id string")
    (row,) = jobs.job_latest_status(events, known).collect()
    assert (row["job_id"], row["status"], row["message"]) == ("a", "running", "m2")
    (p,) = jobs.job_params(spark.createDataFrame([('{"max_length": 7}',)], "params string")).collect()
    assert p["max_length"] == 7 and p["val_split"] == 0.05 and p["raw_dir"] == "dataset/raw"


def stream_dir(tmp_path, texts):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"{i}.jsonl").write_text(f'{{"id":"{i}","content":"{text}","content_hash":"{text[:8]}"}}\n')
    return str(folder)


def test_stream_equals_batch(spark, tmp_path):
    source = stream_dir(tmp_path, ["good text. " * 60, "short", "good text. " * 60, "other text. " * 60])
    sdf = ingest.read_stream(spark, source, files_per_batch=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    ingest.stream_ingest_clean(sdf, out, state).awaitTermination()
    batch = ingest.clean_rows(spark.read.schema(schemas.RAW).json(source))
    key = ["id", "content", "token_estimate"]
    assert sorted(map(tuple, spark.read.parquet(out).select(*key).collect())) == sorted(map(tuple, batch.select(*key).collect()))
    with open(os.path.join(source, "9.jsonl"), "w") as f:  # a later file is taken once, the old ones are not read again
        f.write('{"id":"9","content":"' + "late text. " * 60 + '"}\n')
    ingest.stream_ingest_clean(ingest.read_stream(spark, source), out, state).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["0", "2", "3", "9"]


def test_stream_dedup(spark, tmp_path):
    source = stream_dir(tmp_path, ["aaaaaaaa", "bbbbbbbb", "aaaaaaaa"])
    out = str(tmp_path / "o")
    ingest.stream_dedup(ingest.read_stream(spark, source, files_per_batch=1)).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_windows_drop_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    def put(name, *seconds):
        lines = [f'{{"ts":"2024-01-01T00:00:{s:02d}Z","reason":"r"}}' if s < 60 else f'{{"ts":"2024-01-01T01:00:00Z","reason":"r"}}' for s in seconds]
        (folder / name).write_text("\n".join(lines))
        os.utime(folder / name, (int(name[0]), int(name[0])))
    put("1.jsonl", 1, 2, 11)
    put("2.jsonl", 60)
    put("3.jsonl", 60)  # rows are late with respect to the batch before the last one
    put("4.jsonl", 3)
    put("5.jsonl", 60)
    sdf = ingest.read_stream(spark, str(folder), schema="ts timestamp, reason string", files_per_batch=1)
    out = str(tmp_path / "o")
    ingest.metrics_window(sdf, watermark="5 seconds").writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start(out).awaitTermination()
    got = sorted(r["docs"] for r in spark.read.parquet(out).collect())
    assert got == [1, 2]


# -- snapshots by content -------------------------------------------------------------------------

def corpus(spark, changed=()):
    rows = [(str(i), f"text {i}" + (" changed" if i in changed else ""), 0.5) for i in range(1000)]
    return spark.createDataFrame(rows, "id string, content string, quality_score double")


def test_a_new_version_writes_what_is_new(spark, tmp_path):
    store = V.VersionStore(spark, str(tmp_path))
    first = V.create_version(store, "all", corpus(spark), "2024-01-01")
    second = V.create_version(store, "ten changed", corpus(spark, range(10)), "2024-01-02")
    assert spark.read.parquet(store.at(f"documents/version={second}")).count() == 10
    for name, changed in ((first, ()), (second, range(10))):
        assert sorted(map(tuple, V.load_version(store, name).collect())) == sorted(map(tuple, corpus(spark, changed).collect()))
    diff = V.version_diff(store, first, second)
    assert {r["change"]: r["count"] for r in diff.groupBy("change").count().collect()} == {"added": 10, "removed": 10}
    read = diff._jdf.queryExecution().executedPlan().toString()
    assert read.count("PushedFilters: [In(bucket") + read.count("PushedFilters: [Or(") + read.count("bucket#") >= 2
    assert V.version_diff(store, first, first).collect() == []


def test_repeated_rows_other_columns_and_no_rows(spark, tmp_path):
    store = V.VersionStore(spark, str(tmp_path))
    rows = [(1, "a"), (1, "a"), (2, None)]
    V.save_version(store, "one", "", spark.createDataFrame(rows, "id int, content string"), "2024-01-01")
    V.save_version(store, "two", "", spark.createDataFrame([("1", [1.5])], "id string, scores array<double>"), "2024-01-02")
    V.create_version(store, "none", corpus(spark).limit(0), "2024-01-03")
    assert sorted(map(tuple, V.load_version(store, "one").collect()), key=repr) == sorted(rows, key=repr)
    assert [tuple(r) for r in V.load_version(store, "two").collect()] == [("1", [1.5])]
    assert V.load_version(store, "1.0").columns == ["id", "content", "quality_score"] and V.load_version(store, "1.0").count() == 0


def test_a_failed_save_is_repeated(spark, tmp_path, monkeypatch):
    store = V.VersionStore(spark, str(tmp_path))
    with monkeypatch.context() as m:
        m.setattr(V, "corpus_metrics", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            V.save_version(store, "v", "", corpus(spark), "2024-01-01")
    V.save_version(store, "other", "", corpus(spark, range(5)), "2024-01-02")
    V.save_version(store, "v", "", corpus(spark), "2024-01-03")
    assert V.load_version(store, "v").count() == 1000 and V.load_version(store, "other").count() == 1000
    with pytest.raises(ValueError):
        V.save_version(store, "v", "", corpus(spark), "2024-01-04")


def test_checksum_covers_files(spark, tmp_path):
    files = tmp_path / "tokenizer"
    files.mkdir()
    (files / "vocab.json").write_text("{}")
    df = corpus(spark).withColumn("content_hash", V.T.content_hash("content"))
    plain = V.dataset_checksum(df).first()[0]
    first = V.dataset_checksum(df, files=V.file_hashes(spark, str(files))).first()[0]
    assert V.dataset_checksum(df.repartition(7)).first()[0] == plain != first
    (files / "vocab.json").write_text('{"a": 1}')
    assert V.dataset_checksum(df, files=V.file_hashes(spark, str(files))).first()[0] != first
    store = V.VersionStore(spark, str(tmp_path / "store"))
    V.create_version(store, "", df, "2024-01-01", files=str(files))
    (files / "merges.txt").write_text("a b")
    V.create_version(store, "", df, "2024-01-02", files=str(files))
    sums = [r["checksum"] for r in store.versions.orderBy("created_at").collect()]
    assert sums[0] != sums[1]


def test_what_readers_leave_out_is_listed(spark, tmp_path):
    folder = tmp_path / "cleaned"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"id": "1", "content": "x"}\n{"content": "y"}\nno json\n')
    assert [r["id"] for r in readers.scan_cleaned(spark, str(folder)).collect()] == ["1"]
    got = {r["reason"]: r["line"] for r in readers.cleaned_rejects(spark, str(folder)).collect()}
    assert got == {"corrupt": "no json", "no_id": '{"content":"y"}'}
    shards = str(tmp_path / "shards")
    spark.createDataFrame([("d", "train", "0000"), ("e", "train", "0001")], "doc_id string, split string, shard_id string").repartition(
        "shard_id").write.partitionBy("split", "shard_id").parquet(shards)
    broken = tmp_path / "shards" / "split=train" / "shard_id=0002" / "part-x.parquet"
    broken.parent.mkdir()
    broken.write_bytes(b"no parquet")
    assert {r["doc_id"] for r in readers.scan_shards(spark, shards).collect()} == {"d", "e"}
    assert [r["file"].rsplit("/", 1)[1] for r in readers.silent_shards(spark, shards).collect()] == ["part-x.parquet"]


def test_a_version_computes_its_rows_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def marked(x):
        runs.add(1)
        return f"text {x}"

    s = V.VersionStore(spark, str(tmp_path / "store"))
    rows = spark.range(50).select(F.col("id").cast("string").alias("id"), marked.asNondeterministic()("id").alias("content"), F.expr("uuid()").alias("mark"))
    V.create_version(s, "marked", rows, "2024-01-01T00:00:00")
    assert runs.value == 50 and V.load_version(s, "1.0").count() == 50


def test_a_shard_folder_is_looked_into_up_to_its_first_file(spark, tmp_path):
    (tmp_path / "shards" / "split=val").mkdir(parents=True)
    (tmp_path / "shards" / "split=val" / "note.txt").write_text("x")
    assert not readers._any_parquet(spark, str(tmp_path / "shards")) and not readers._any_parquet(spark, str(tmp_path / "none"))
    spark.range(3).write.parquet(str(tmp_path / "shards" / "split=train"))
    assert readers._any_parquet(spark, str(tmp_path / "shards"))
