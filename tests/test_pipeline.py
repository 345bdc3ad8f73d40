"""Sources, sinks, stages and streams on temporary folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from filmloom import schema
from filmloom.plans import stages
from filmloom.sources import files, sinks
from filmloom.streaming import microbatch


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_media_and_captions(spark, tmp_path):
    for n in ("a/x.jpg", "a/y.PNG", "a/z.txt", "b/x.jpg"):
        write(tmp_path / n, "data")
    write(tmp_path / "a/x.txt", " a caption ")
    found = files.media(spark, str(tmp_path), files.IMAGES)
    assert sorted(os.path.relpath(r.path, tmp_path) for r in found.collect()) == ["a/x.jpg", "a/y.PNG", "b/x.jpg"]
    pairs = {os.path.relpath(r.path, tmp_path): r.caption_txt for r in files.precaptioned(spark, str(tmp_path)).collect()}
    assert pairs == {"a/x.jpg": "a caption", "a/y.PNG": None, "b/x.jpg": None}
    assert {os.path.basename(r.folder): r.n for r in files.source_folders(found).collect()} == {"a": 2, "b": 1}


def test_lists_and_logs(spark, tmp_path):
    write(tmp_path / "movies.csv", "path,source_type\n /m/a.mp4 ,\n,internal\n/m/b.mp4,external\n")
    assert {tuple(r) for r in files.movie_list(spark, str(tmp_path / "movies.csv")).collect()} == {("/m/a.mp4", "youtube"), ("/m/b.mp4", "external")}
    write(tmp_path / "registry.csv", "video_id,source_path,status\na,/x,\nb,/y,done\n")
    assert [r.video_id for r in files.registry(spark, str(tmp_path / "registry.csv"), pending=True).collect()] == ["a"]
    for s, text in (("s1", json.dumps({"service": "s1", "movie": "a", "status": "ok", "runtime_seconds": 2.5})), ("s2", "{broken")):
        write(tmp_path / "logs" / s / "a_runtime.json", text)
    assert [(r.service, r.runtime_seconds) for r in files.runtime_logs(spark, str(tmp_path / "logs")).collect()] == [("s1", 2.5)]
    lines = spark.createDataFrame([(1, "Step 'score' completed in 3.5s"), (2, "noise"), (3, "Step 'score' completed in 4s")], "line int, value string")
    assert [tuple(r) for r in files.step_times(lines).collect()] == [("score", 4.0)]
    for i in range(3):
        write(tmp_path / f"prompts/bucket_{i:02d}_b{i}.txt", "describe " * 10)
    assert {r.bucket for r in files.prompts(spark, str(tmp_path / "prompts"), least=3).collect()} == {"b0", "b1", "b2"}
    with pytest.raises(ValueError):
        files.prompts(spark, str(tmp_path / "prompts"))


def test_records(spark, tmp_path):
    for m in ("a", "b"):
        write(tmp_path / m / "metadata.jsonl", json.dumps({"clip_id": f"{m}_1", "video_id": m, "keep": True}) + "\n\n")
    assert {(r.movie, r.clip_id) for r in files.movies_of(spark, str(tmp_path)).collect()} == {("a", "a_1"), ("b", "b_1")}
    write(tmp_path / "bad.jsonl", "{broken\n")
    with pytest.raises(Exception):
        files.json_lines(spark, str(tmp_path / "bad.jsonl")).collect()
    write(tmp_path / "side/x.json", json.dumps({"clip_id": "x"}))
    assert [(r.unique_stem, r.clip_id) for r in files.sidecars(spark, str(tmp_path / "side"), "clip_id string").collect()] == [("x", "x")]
    calls = []

    def compute():
        calls.append(1)
        return spark.createDataFrame([("1.10",)], "id string")

    for _ in range(2):
        assert files.cached(spark, str(tmp_path / "cache"), "id string", compute).first().id == "1.10"
    assert len(calls) == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", ["p", "q"], "FINAL", True, None), ("b", None, None, "Discard ", None, None), ("c", "x", [], "final", None, True)], "clip_id string, bucket string, clip_actors array<string>, verdict string, keep boolean, reject boolean")
    assert [r.clip_id for r in sinks.accepted(df, ["FINAL"]).collect()] == ["a"]
    sinks.snapshot(df, str(tmp_path / "snap"), by="bucket")
    assert {r.schema_version for r in spark.read.parquet(str(tmp_path / "snap")).collect()} == {"1.0"}
    sinks.write_buckets(df, str(tmp_path / "buckets"))
    assert sorted(p.name for p in (tmp_path / "buckets").iterdir() if p.is_dir()) == ["bucket=unknown", "bucket=x"]
    sinks.table_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 3
    assert sinks.filled(df).where("clip_id = 'b'").first().bucket == ""
    assert {r.bucket: r["count"] for r in sinks.bucket_index(df, "e").collect()} == {"x": 2, "unknown": 1}
    runs = spark.createDataFrame([("/r/m_20250101_000000",), ("/r/m_20250301_000000",), ("/r/other",)], "path string")
    assert {r.run for r in sinks.runs(runs).collect()} == {"m_20250101_000000", "m_20250301_000000"}
    assert sinks.run_folder("b", "v", "s") == "b/v_s"


def clips(spark):
    rows = [("m", f"c{i}", f"{(0 if i < 2 else 0x9E3779B97F4A7C15 * i % 2**64):016x}", float(i), 0.1 * i, 0.9, 0.5, "portrait", 0.8, "A man.", True) for i in range(6)]
    names = "video_id string, clip_id string, phash string, timestamp_start double, motion_score double, dover_score double, clip_score double, bucket string, bucket_confidence double, caption string, keep boolean"
    df = spark.createDataFrame(rows, names)
    return df.withColumns({"bits": F.conv("phash", 16, -10).cast("bigint"), "reject": F.lit(False), "dup_of": F.lit(None).cast("string"), "generated_caption": F.col("caption"), "caption_struct": F.lit("{}")})


def test_stages(spark):
    out = {r.clip_id: r for r in stages.run(clips(spark), stages.Config.of({"dedup_distance": 1, "unknown": 3}, {"motion_ceiling": 0.95})).collect()}
    assert out["c1"].dup_of == "c0" and not out["c1"].keep and out["c1"].final_score == 0.0 and out["c1"].verdict == "DISCARD"
    assert out["c0"].s2_reject_reason == "static" and out["c3"].verdict == "FINAL" and out["c3"].route == "people"
    assert set(out["c3"].processing_status) == set(stages.STAGES)
    kept = stages.run(clips(spark), stages.Config(score_only=True, dedup_distance=1), last="motion").collect()
    assert all(r.keep for r in kept)
    assert stages.chosen("s9") == ["score", "gate"] and stages.chosen("dedup_cross", "motion") == ["dedup", "motion"]
    done = stages.run(stages.run(clips(spark), stages.Config(), last="dedup"), stages.Config(), last="dedup")
    assert done.columns.count("dup_of") == 1


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i)) for i in range(20)], "event_id bigint, value double")
    for part in range(3):
        df.where(F.col("event_id") % 3 == part).unionByName(df.limit(1)).coalesce(1).write.parquet(str(tmp_path / f"in/p{part}"))
    flat = tmp_path / "flat"
    flat.mkdir()
    for p in (tmp_path / "in").rglob("*.parquet"):
        p.rename(flat / p.name)
    work = lambda rows: microbatch.split(rows, F.col("value") > 4)[0]
    for _ in range(2):
        stream = microbatch.file_stream(spark, str(flat), "event_id bigint, value double")
        microbatch.run_once(stream, work, str(tmp_path / "out"), str(tmp_path / "state"), ["event_id"])
        assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(5, 20))


def test_schema(spark):
    assert spark.createDataFrame([], schema.CLIP).columns[:2] == ["video_id", "clip_id"]
