"""Operators on hand-made cases that SQL checks poorly."""

import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmloom.functions import captions as C
from filmloom.functions import names as N
from filmloom.functions import naming as P
from filmloom.functions import pixels as X
from filmloom.functions import scoring as S
from filmloom.functions.geometry import iou
from filmloom.functions.hashing import md5_mod, phash_bits
from filmloom.operators import dedup as D
from filmloom.operators import intervals as I
from filmloom.operators import lookups as L
from filmloom.operators import reports as R
from filmloom.operators import voting as O
from filmloom.operators.positions import cumulative, positions
from filmloom.operators.similarity import assign
from filmloom.operators.snapshot import current_rows


def one(spark, column, *values, schema="a string"):
    return [r[0] for r in spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema).select(column).collect()]


def test_positions_of_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 40}", rng.randint(0, 20), i) for i in range(3000)] + [(None, 5, -1)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    got = {(r.g, r.i): (r.p, r.n) for r in positions(df, ["g"], [F.col("v").desc(), F.col("i")], name="p", total="n").collect()}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[(g, r[2])] for r in own] == [(k + 1, len(own)) for k in range(len(own))]


def test_cumulative_sums(spark):
    rows = [("a", i, i % 5 + 1) for i in range(500)] + [("b", 1, 2)]
    out = cumulative(spark.createDataFrame(rows, "g string, v int, w int"), ["g"], [F.col("v")], "w").collect()
    total = sum(r[2] for r in rows[:500])
    for r in out:
        assert r.below == (sum(x[2] for x in rows[: r.v]) if r.g == "a" else 0)
        assert r["size"] == (total if r.g == "a" else 2)
    assert positions(spark.createDataFrame([], "g string, v int"), ["g"], [F.col("v")]).count() == 0


def test_current_rows(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("a", 2, "new"), ("b", None, "x"), (None, 3, "y"), ("c", None, "p"), ("c", 0, "q")]
    df = spark.createDataFrame(rows, "clip_id string, processed_at int, k string")
    assert {tuple(r) for r in current_rows(df, {"k": F.col("k")}).collect()} == {("a", "new"), ("b", "x"), ("c", "q")}


@pytest.mark.parametrize("n", [1000, 40, 35, 12])
def test_md5_remainders(spark, n):
    words = ["x", "", "हिन्दी", "a" * 1000]
    assert one(spark, md5_mod(F.col("a"), n), *words) == [int(hashlib.md5(w.encode()).hexdigest(), 16) % n for w in words]


def test_phash(spark):
    assert one(spark, phash_bits(F.col("a")), "ffffffffffffffff", "0000000000000001", "zz", None) == [-1, 1, None, None]


def test_gates_at_their_limits(spark):
    rows = [0.25, 0.15, 0.2499, 0.1499, float("nan"), None]
    assert one(spark, S.image_gate(F.col("a")), *[(v,) for v in rows], schema="a double") == ["final", "review", "review", "discard", "discard", "discard"]
    clip = [(0.18, None, None), (0.10, True, False), (0.0999, True, False), (0.9, True, True), (0.9, False, None), (float("nan"), None, None)]
    assert one(spark, S.clip_gate(F.col("a"), F.col("k"), F.col("r")), *clip, schema="a double, k boolean, r boolean") == ["FINAL", "REVIEW", "DISCARD", "DISCARD", "DISCARD", "DISCARD"]
    assert one(spark, S.verify_score(F.col("a")), *[(v,) for v in (0, 4, 9, None)], schema="a int") == [(1, 0.0, False), (4, 0.75, True), (5, 1.0, True), (None, None, False)]


def test_logo_decision(spark):
    rows = [([("top_left", 0.3, 0.7), ("top_right", 0.9, 0.1)], "top_left"), ([("top_left", 0.1, 0.2), ("top_right", 0.4, 0.7)], "top_left"), ([("top_left", 0.1, 0.2), ("top_right", 0.6, 0.1)], None), ([("top_left", 0.1, 0.2)], None)]
    got = one(spark, S.logo_decision(F.col("c"), F.col("t")), *rows, schema="c array<struct<corner: string, heuristic: double, template_match: double>>, t string")
    assert got == [(True, "top_left", "template", 0.7), (True, "top_right", "template_fallback", 0.7), (True, "top_right", "heuristic", 0.6), (False, None, "rejected", 0.1)]


def greedy(hashes, distance):
    kept, out, first = [], {}, {}
    for i, h in hashes:
        if h is None:
            out[i] = None
        elif h in first:
            out[i] = first[h]
        else:
            first[h] = i
            near = [k for k, g in kept if bin((h ^ g) & (2**64 - 1)).count("1") <= distance]
            out[i] = near[0] if near else None
            if not near:
                kept.append((i, h))
    return out


@pytest.mark.parametrize("seed", [1])
def test_greedy_removal(spark, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(6)]
    rows = []
    for i in range(150):
        h = rng.choice(base)
        for _ in range(rng.randint(0, 7)):
            h ^= 1 << rng.randrange(64)
        rows.append((f"m{i % 2}", f"c{i:04d}", None if i % 30 == 0 else h - (1 << 64 if h >> 63 else 0)))
    df = spark.createDataFrame(rows, "m string, i string, h bigint")
    got = {r.i: (r.keep, r.dup_of) for r in D.greedy_keep(df, ["m"], "i", "h", ["i"], 6).collect()}
    for m in ("m0", "m1"):
        for i, dup in greedy([r[1:] for r in rows if r[0] == m], 6).items():
            assert got[i] == (dup is None, dup)
    marked = D.greedy_keep(df, ["m"], "i", "h", ["i"], 6, score_only=True)
    assert marked.where("not keep").count() == 0 and marked.where("dup_of is not null").count() == sum(d is not None for _, d in got.values())


def test_pairs_of_a_hot_group(spark, monkeypatch):
    # More than LEAF hashes that agree on a band, among them tight families; batches cut the runs.
    monkeypatch.setattr(D, "BATCH", 500)
    rng = np.random.default_rng(3)
    near = np.uint64(0xABCD << 48) | rng.integers(0, 1 << 48, 2500, dtype=np.uint64)
    family = near[:40, None] ^ (np.uint64(1) << rng.integers(0, 64, (40, 5), dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, (40, 5), dtype=np.uint64))
    h = np.unique(np.concatenate([near, family.ravel()]))
    rows = [(g, int(x)) for g, part in ((None, h[:50]), ("hot", h), ("b", h[::9])) for x in part.view(np.int64)]
    want = set()
    for g in (None, "hot", "b"):
        own = np.sort(np.array([x for k, x in rows if k == g]))
        i, j = np.nonzero(np.triu(np.bitwise_count((own[:, None] ^ own).view(np.uint64)) <= 8, 1))
        want |= {(g, int(own[x]), int(own[y])) for x, y in zip(i, j, strict=True)}
    df = spark.createDataFrame(rows + rows[:99], "m string, h bigint")
    got = [tuple(r) for r in D.near_pairs(df, ["m"], "h", 8).select("m", "a", "b").collect()]
    assert len(want) > 400 and len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("at_once", [0, 1 << 20])
def test_removal_along_a_long_chain(spark, monkeypatch, at_once):
    # Each hash is near the two before it; a round decides what it can, or one task goes through all.
    monkeypatch.setattr(D, "AT_ONCE", at_once)
    calls, write = [], D.materialise
    monkeypatch.setattr(D, "materialise", lambda df: calls.append(1) or write(df))
    rows = [("m", i, (1 << i) - 1) for i in range(24 if not at_once else 60)]
    got = {r.i: r.dup_of for r in D.greedy_keep(spark.createDataFrame(rows, "m string, i int, h bigint"), ["m"], "i", "h", ["i"], 2).collect()}
    assert got == {i: i - i % 3 if i % 3 else None for i, *_ in [r[1:] for r in rows]}
    assert len(calls) < (20 if not at_once else 4)


def test_chain_of_near_hashes(spark):
    # A~B~C without A~C: A and C stay.
    rows = [("m", "a", 0), ("m", "b", 0b1111), ("m", "c", 0b11111111)]
    got = {r.i: r.dup_of for r in D.greedy_keep(spark.createDataFrame(rows, "m string, i string, h bigint"), ["m"], "i", "h", ["i"], 4).collect()}
    assert got == {"a": None, "b": "a", "c": None}


def test_intervals(spark):
    rows = [("m", 0.0, 5.0), ("m", 5.0, 6.0), ("m", 5.5, 5.8), ("m", 6.4, 8.0), ("m", 3600.0, 3700.0), ("m", 3590.0, 3650.0), (None, 1.0, 2.0), ("m", None, 3.0)]
    df = spark.createDataFrame(rows, "v string, a double, b double")
    strict = sorted((r.a, r.b, r.n) for r in I.merge_intervals(df, ["v"], "a", "b").where("v = 'm'").collect())
    assert strict == [(0.0, 5.0, 1), (5.0, 6.0, 2), (6.4, 8.0, 1), (3590.0, 3700.0, 2)]
    loose = sorted((r.a, r.b, r.n) for r in I.merge_intervals(df, ["v"], "a", "b", 0.5, touching=True).where("v = 'm'").collect())
    assert loose == [(0.0, 8.0, 4), (3590.0, 3700.0, 2)]
    small = {(r.a, r.b): r.n for r in I.merge_intervals(df, ["v"], "a", "b", 0.5, touching=True, span=1.0).where("v = 'm'").collect()}
    assert small == {(0.0, 8.0): 4, (3590.0, 3700.0): 2}
    tiles = [(r.clip_start, r.clip_end, r.clip_index) for r in I.tile(df.where("v = 'm' and a < 6"), ["v"], "a", "b", 2.0, most=2).collect()]
    assert sorted(tiles) == [(0.0, 2.0, 0), (2.0, 4.0, 1)]
    split = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], 10.0), ([], 10.0)], "k array<double>, d double")
    assert [r.boundaries for r in I.even_split(split, "k", "d", 2).collect()] == [[3.0], [5.0]]
    times = one(spark, I.sample_times(F.col("a"), F.col("b")), (0.0, 1.5), (0.0, 0.4), schema="a double, b double")
    assert times == [[0.0, 0.5, 1.0], [0.0, 0.399]]


def test_votes(spark):
    rows = [("x", 1, "p", 0.8, False), ("x", 2, "q", 0.6, False), ("y", 1, "p", 0.0, True), ("y", 2, "p", None, True), ("y", 3, "q", 0.9, False), ("z", 1, "p", 0.5, True), ("z", 2, "p", 0.7, False)]
    got = {r.k: (r.frames, r.reject, r.b, r.c) for r in O.frame_vote(spark.createDataFrame(rows, "k string, o int, b string, c double, r boolean"), ["k"], "o", "b", "c", "r").collect()}
    assert got == {"x": (2, False, "p", 0.4), "y": (3, True, "p", 0.1667), "z": (2, False, "p", 0.6)}
    boxes = one(spark, O.crop_vote(F.col("a")), ([[1, 2, 3, 4], [5, 6, 7, 8], [1, 2, 3, 4]],), ([[1, 9, 3, 4], [5, 6, 7, 8], [3, 2, 3, 4]],), schema="a array<array<int>>")
    assert boxes == [[1, 2, 3, 4], [3, 6, 3, 4]]


def test_iou(spark):
    rows = [([0, 0, 10, 10], [5, 0, 15, 10]), ([0, 0, 1, 1], [0, 0, 1, 1]), ([0, 0, 1, 1], [2, 2, 3, 3]), ([0, 0, 0, 0], [0, 0, 0, 0])]
    assert one(spark, F.round(iou(F.col("a"), F.col("b")), 4), *rows, schema="a array<int>, b array<int>") == [0.3333, 1.0, 0.0, 0.0]


def test_assignment_in_blocks(spark):
    rng = np.random.default_rng(0)
    labels = [(f"l{i}", rng.normal(size=8).tolist()) for i in range(9)]
    items = [(i, rng.normal(size=8).tolist()) for i in range(40)] + [(99, [])]
    a, b = spark.createDataFrame(items, "i int, v array<double>"), spark.createDataFrame(labels, "l string, e array<double>")
    whole, parts = (sorted(map(tuple, assign(a, "i", "v", b, "l", "e", least=0.0, block=n).collect())) for n in (100, 2))
    assert whole == parts and len(whole) == 40
    assert assign(a, "i", "v", b.limit(0), "l", "e").where("label is null").count() == 40


def test_percentiles_and_histogram(spark):
    rows = [("a", v) for v in (1.0, 2.0, 4.0, 9.0)] + [("b", 3.0), ("c", None), ("c", float("nan"))]
    got = {r.g: (round(r.p, 4), round(r.q, 4)) for r in R.group_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"p": 0.1, "q": 0.9}).collect()}
    assert got == {"a": (1.3, 7.5), "b": (3.0, 3.0)}
    h = R.histogram(spark.createDataFrame([(-0.5,), (0.1,), (0.8,), (5.0,), (None,)], "m double"), ["m"], F.lit(False)).collect()
    assert {(r.bin, r.n) for r in h} == {(0, 1), (4, 3)}


def test_lookups(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, s double")
    new = spark.createDataFrame([("a", 0.0), ("c", 3.0)], "k string, s double")
    assert {tuple(r) for r in L.upsert(old, new, "k", ["s"]).collect()} == {("a", 1.0, 1.0), ("b", 2.0, 2.0), ("c", 3.0, 3.0)}
    there, missing = L.ids_and_missing(old, "k", ["a", "z", "z"])
    assert [r.k for r in there.collect()] == ["a"] and [r.k for r in missing.collect()] == ["z"]


def test_names_and_codes(spark):
    assert one(spark, P.unique_stem(F.col("a")), "/x/movie/frame.v1.jpg", "frame.jpg") == ["movie__frame.v1", "__frame"]
    assert one(spark, P.slug(F.col("a")), "  Ravi-Kumar  Rao! ", "!!") == ["ravi_kumar_rao", "actor"]
    assert one(spark, P.timecode(F.col("a")), (3723.5,), (0.0,), (59.9996,), schema="a double") == ["01:02:03.500", "00:00:00.000", "00:01:00.000"]
    assert one(spark, P.seconds(F.col("a")), "01:02:03.500", "x") == [3723.5, None]
    assert one(spark, P.crop_box(F.col("a")), "crop=1:2:3:4", "1:2:3", None) == [(1, 2, 3, 4), None, None]
    assert one(spark, P.outside_dupes(F.col("a")), "/a/x_dupes/b.jpg", "/a/b.jpg") == [False, True]


def test_json_and_captions(spark):
    texts = ['```json\n{"short_description": "A b."}\n```', 'So: {"short_description": "A b."} done', '{"short_description": "A b', '{"short_description": "A b.", "mood', "plain", "", None]
    assert one(spark, C.json_text(F.col("a"), "short_description"), *texts) == ["A b.", "A b.", None, None, None, None, None]
    assert one(spark, C.caption_text(F.col("a")), *texts[1:]) == ['So: {"short_description": "A b."} done', '{"short_description": "A b', "A b.", "plain", "", ""]
    assert one(spark, C.strip_openers(F.col("a")), "In this video clip, a man", "The clip shows a dog", "x", "") == ["A man", "A dog", "X", ""]
    assert one(spark, C.parsed_score(F.col("a")), "4", "4. good", "9", "", "hm\n1) bad") == [(4, ""), (4, "good"), None, None, (1, "bad hm")]
    odd = one(spark, C.classified(F.col("a")), '{"primary_bucket": "portrait", "keep": false, "reject_reason": "None", "bucket_confidence": 0}', "broken", None)
    assert [(r.bucket, r.reject, r.reject_reason, r.bucket_confidence) for r in odd] == [("portrait_closeup", True, None, 0.5), ("portrait_closeup", False, None, 0.5), ("portrait_closeup", False, None, 0.5)]


def test_actor_names():
    m, f = "male", "female"
    assert N.put_names("A man waits. The man sits.", ["Ravi Rao"], [m]) == "Ravi Rao waits. The man sits."
    assert N.put_names("Two men talk.", ["Ravi Rao"], [m]) == "Ravi Rao and another man talk."
    assert N.put_names("A woman faces the man's car.", ["Ravi", "Mira"], [m, f]) == "Mira faces Ravi's car."
    assert N.put_names("Two women sing. One wears red, the other blue.", ["Mira", "Tara"], [f, f]) == "Mira and Tara sing. Mira wears red, Tara blue."
    assert N.fit_attire("Ravi in a saree walks. He meets Ravi in a dhoti.", "Ravi", m) == "A woman in a saree walks. He meets Ravi in a dhoti."
    assert N.over_tagged("Ravi stands beside him, and Ravi and Ravi talk", ["Ravi"])
    assert not N.over_tagged("Ravi walks. Ravi sits.", ["Ravi"])
    assert N.meets_self("Ravi in a long conversation with Ravi", ["Ravi"])
    assert N.untag("Ravi sits facing Ravi.", ["Ravi"], [m]) == "Ravi sits facing another man."
    assert not N.over_tagged("Ravi sits. A clerk speaks with him. He sees the old Ravi", ["Ravi"])
    assert N.over_tagged("Ravi sits and greets the tired Ravi", ["Ravi"]) and N.over_tagged("Ravi sits near another Ravi", ["Ravi"])
    assert N.untag("Ravi sits with Ravi, who smiles. Ravi goes.", ["Ravi"], [None]) == "Ravi sits with another person, who smiles. Ravi goes."
    assert N.untag("Ravi speaks to Ravi's friend and stays embracing with Ravi.", ["Ravi"], [m]) == "Ravi speaks to another man's friend and stays embracing with another man."
    assert N.untag("Ravi faces Mira. Mira stands beside her, Mira smiles, with Mira.", ["Ravi", "Mira"], [m, f]) == "Ravi faces Mira. Mira stands beside her, another woman smiles, with Mira."
    assert N.put_names("The person sits. Another man waits.", ["Ravi"], [m]) == "Ravi sits. Another man waits."
    assert N.put_names("", ["Ravi"], [m]) == "" and N.put_names("A man", [], []) == "A man"
    assert N.fit_attire("Mira's friend in a long coat and Mira in a tall turban.", "Mira", f) == "A man's friend in a long coat and a man in a tall turban."
    assert not N.meets_self("Ravi walks. Ravi sits.", ["Ravi"]) and not N.meets_self("Ravi and Mira", ["Ravi", "Mira"])
    assert N.targeted("Ravi and Ravi see the another dog", ["Ravi"], [m]) == "Ravi and another man see the other dog"
    assert N.genders(["Ravi Rao", "X"], {"ravi rao": "M"}, [{"actor": "x", "face_gender": "Female"}]) == [m, f]


def test_repair_names_with_nulls(spark):
    rows = [("A man waits.", ["Ravi"], ["male"]), (None, ["Ravi"], None), ("A man waits.", None, None), ("A man waits.", [], [])]
    df = spark.createDataFrame(rows, "c string, n array<string>, g array<string>")
    assert [r.c_fixed for r in N.repair_names(df, "c", "n", F.col("g")).collect()] == ["Ravi waits.", None, "A man waits.", "A man waits."]


def test_pixels():
    flat, noise = np.full((64, 64), 90, np.uint8), np.random.default_rng(0).integers(0, 255, (64, 64)).astype(np.uint8)
    assert X.grid_sharpness(flat) == 0 < X.grid_sharpness(noise)
    boxed = np.vstack([np.zeros((25, 90)), np.full((100, 90), 99), np.zeros((25, 90))]).astype(np.uint8)
    assert X.letterbox(boxed) == (25, 125) and X.dark_rows(boxed) == 50
    assert X.letterbox(np.zeros((10, 10), np.uint8)) == (0, 10)
    assert X.stable_template(np.stack([flat] * 3))[0] == 1.0


def test_image_measures(spark):
    rows = [(bytearray([10, 20, 30, 40]), 2, 2), (bytearray([1, 2, 3]), 2, 2), (None, 2, 2)]
    got = one(spark, X.image_measures(F.col("p"), F.col("h"), F.col("w")), *rows, schema="p binary, h int, w int")
    assert got[0].brightness == 25.0 and got[1].brightness is None and got[2].brightness is None


def test_pivot_of_many_steps(spark, tmp_path):
    from filmloom.plans import records

    rows = [(u, f"step {i:02d}", 1.5) for u in (1, 2) for i in range(60)]
    spark.createDataFrame(rows, "user_id bigint, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = records.runtime_summary_pivot(spark, str(tmp_path)).collect()
    assert len(got) == 120 and {r.total for r in got} == {90.0} and {r.seconds for r in got} == {1.5}


def test_duplicates_across_movies(spark, monkeypatch):
    from filmloom.plans import records

    rows = [("a", "a1", "00000000000000ff", 0.0), ("a", "a2", "00000000000000fe", 1.0), ("b", "b1", "00000000000000f0", 0.0), ("b", "b2", "ffffffff00000000", 1.0), ("c", "c1", "0000000000007fff", 0.0), ("c", "c2", None, 1.0)]
    df = spark.createDataFrame(rows, "video_id string, clip_id string, phash string, timestamp_start double")
    monkeypatch.setattr(records, "clips", lambda spark, folder, *columns: df)
    got = {r.clip_id: (r.keep, r.dup_of) for r in records.dup_cross_source(spark, "").collect()}
    assert got == {"a1": (True, None), "b1": (False, "a1"), "b2": (True, None), "c1": (True, None), "c2": (True, None)}


def test_scenes_of_a_movie_with_many_cuts(spark):
    rng = random.Random(4)
    cuts = [round(rng.uniform(-5, 4100), 3) for _ in range(8000)]
    rows = [("hot", c, 4000.0) for c in cuts] + [(None, c, d) for c, d in ((0.0, 9.0), (3.0, None), (3.0, 10.0), (3.2, 8.0), (10.0, 8.0), (11.0, 1.0), (None, 2.0), (float("nan"), 3.0))]
    rows += [("short", 0.1, 0.4), ("none", 1.0, None), ("still", 0.0, 2.0), ("back", 1.0, -1.0)]
    began = time.monotonic()
    got = sorted(I.scenes_from_cuts(spark.createDataFrame(rows, "m string, c double, d double"), ["m"], "c", "d").collect(), key=lambda r: (str(r.m), r.scene_id))
    assert time.monotonic() - began < 100  # as an array of all cuts per movie this took minutes
    edges = [0.0, *sorted({c for c in cuts if 0 < c < 4000}), 4000.0]
    scenes = [(a, b) for a, b in zip(edges, edges[1:], strict=False) if b - a >= 0.5]
    want = [(None, 0, 0.0, 3.0), (None, 1, 3.2, 10.0)] + [("hot", i, a, b) for i, (a, b) in enumerate(scenes)] + [("still", 0, 0.0, 2.0)]
    assert [tuple(r) for r in got] == want
