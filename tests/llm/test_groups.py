"""Sampling, components, rankings, caps and cutoffs against plain Python."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from filmloom.llm.capping import capped
from filmloom.llm.components import consolidate
from filmloom.llm.cutoffs import fraction_cutoffs
from filmloom.llm.ranking import borda
from filmloom.llm.sampling import proportional_sample

NAN = float("nan")


# Sampling


def targets(spark, rows):
    return spark.createDataFrame(rows, "bucket string, verdict string, target_permille int, min_clips int")


def test_sample_meets_targets(spark):
    rng = random.Random(5)
    rows = [(f"c{i}", "hot" if i % 3 == 0 else rng.choice("abcd"), "F", i) for i in range(4000)] + [("n1", None, "F", 1), (None, "a", "F", 2)]
    pool = spark.createDataFrame(rows, "clip_id string, bucket string, verdict string, size int")
    goal = targets(spark, [("hot", "F", 500, 5), ("a", "F", 250, 5), ("b", "F", 249, 5), ("c", "F", 1, 30), ("gone", "F", 0, 3), ("d", "X", 10, 0)])
    sample, report = proportional_sample(pool, goal, ["bucket", "verdict"], item="clip_id")
    got = {(r.bucket, r.verdict): r for r in report.collect()}
    drawn = sample.collect()
    assert sample.columns == [*pool.columns, "drawn_by"]
    assert len({r.clip_id for r in drawn}) == len(drawn) and None not in {r.clip_id for r in drawn}
    counts = Counter((r.bucket, r.verdict) for r in drawn)
    size = 4001 // 10
    for key, r in got.items():
        assert r["size"] == size and r.drawn == counts[key] and r.met == (r.drawn >= r.wanted)
    for b, share in (("hot", 500), ("a", 250), ("b", 249)):
        need = math.ceil(share * size / 1000)
        assert need <= counts[(b, "F")] <= need + 1
    assert counts[("c", "F")] == 30
    assert not got[("gone", "F")].met and not got[("d", "X")].met and ("d", "F") not in counts
    again, _ = proportional_sample(pool.repartition(9), goal, ["bucket", "verdict"], item="clip_id")
    assert {r.clip_id for r in again.collect()} == {r.clip_id for r in drawn}
    other, _ = proportional_sample(pool, goal, ["bucket", "verdict"], item="clip_id", seed=3)
    assert {r.clip_id for r in other.collect()} != {r.clip_id for r in drawn}


def test_sample_of_nothing(spark):
    pool = spark.createDataFrame([], "clip_id string, bucket string, verdict string")
    sample, report = proportional_sample(pool, targets(spark, [("a", "F", 1000, 2), ("b", None, None, None)]), ["bucket", "verdict"], item="clip_id")
    assert sample.count() == 0
    assert [(r.bucket, r["size"], r.available, r.wanted, r.drawn, r.met) for r in report.collect()] == [("a", 0, 0, 2, 0, False)]


def test_sample_too_small_a_category(spark):
    pool = spark.createDataFrame([(f"c{i}", "a" if i < 7 else "z", "F") for i in range(100)], "clip_id string, bucket string, verdict string")
    sample, report = proportional_sample(pool, targets(spark, [("a", "F", 1000, 2)]), ["bucket", "verdict"], item="clip_id")
    assert sample.count() == 7 and [(r.wanted, r.drawn, r.met) for r in report.collect()] == [(10, 7, False)]


# Components


def groups(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def chain(names):
    return list(zip(names, names[1:], strict=False))


@pytest.mark.parametrize("case", ["mixed", "long tail", "one pair"])
def test_components(spark, case):
    rng = random.Random(3)
    n = lambda i: f"v{i:05d}"
    if case == "mixed":
        edges = [(n(500), n(i)) for i in range(501, 700)] + [(n(rng.randrange(0, 400)), n(rng.randrange(0, 400))) for _ in range(150)]
        shuffled = [n(i) for i in range(800, 860)]
        rng.shuffle(shuffled)
        edges += chain(shuffled) + [(b, a) for a, b in edges[:20]] + [(n(1), n(1)), (None, n(2)), (n(3), None), edges[0]]
    elif case == "long tail":  # the hub hangs on to smaller ids through a long chain
        edges = [(n(900), n(i)) for i in range(901, 960)] + chain([n(i) for i in range(840, 901)]) + [(n(3), n(840))]
    else:
        edges = [("b", "a")]
    df = spark.createDataFrame(edges, "x string, y string").withColumn("id", F.lit(1))
    got = {r.id: r.group_id for r in consolidate(df, "x", "y").collect()}
    assert got == groups(edges)


def test_no_components(spark):
    assert consolidate(spark.createDataFrame([("a", "a"), (None, "b")], "x string, y string"), "x", "y").collect() == []


# Ranking


def places(rows, missing):
    out = {}
    for g in {r[0] for r in rows if r[0] is not None}:
        own = [r for r in rows if r[0] == g and r[1] is not None]
        points = Counter()
        for k in (2, 3):
            v = [x[k] if x[k] is not None and x[k] == x[k] else -math.inf for x in own]
            for r, x in zip(own, v, strict=True):
                rank = sum(y < x for y in v) + (sum(y == x for y in v) + 1) / 2
                points[r[1]] += (len(v) + 1) / 2 if missing == "middle" and x == -math.inf else rank
        for p, i in enumerate(sorted(points, key=lambda i: (-points[i], i))):
            out[(g, i)] = (points[i], p + 1)
    return out


@pytest.mark.parametrize("missing", ["lowest", "middle"])
def test_borda(spark, missing):
    rng = random.Random(2)
    value = lambda: rng.choice([None, NAN, 1.0, 2.0, rng.random() * 100])
    rows = [("hot" if i % 2 else f"g{i % 6}", f"i{i}", value(), value()) for i in range(300)] + [(None, "x", 1.0, 1.0), ("hot", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "grp string, item string, a double, b double").withColumns({"g": F.lit(0), "place": F.lit("x")})
    got = {(r.grp, r.item): (r.points, r.place) for r in borda(df, "grp", "item", {"a": 1.0, "b": 1.0}, missing=missing).collect()}
    assert got == places(rows, missing)


def test_borda_of_copies_and_nothing(spark):
    df = spark.createDataFrame([("g", "a", 1.0), ("g", "a", 1.0), ("g", "b", 2.0)], "g string, i string, s double")
    assert [(r.i, r.points, r.place) for r in borda(df, "g", "i", {"s": 1.0}).orderBy("place").collect()] == [("b", 3.0, 1), ("a", 1.5, 2)]
    assert borda(df.limit(0), "g", "i", {"s": 1.0}).count() == 0


# Caps


@pytest.mark.parametrize("bins", [4, 1000])
def test_caps(spark, bins):
    rng = random.Random(8)
    score = lambda: rng.choice([None, NAN, float("inf"), -1.0, 0.5, rng.random()])
    rows = [("hot" if i % 3 == 0 else "warm" if i % 3 == 1 else f"s{i}", f"i{i:04d}", score()) for i in range(900)] + [(None, f"n{i}", 0.1) for i in range(60)] + [("hot", None, 9.0)]
    df = spark.createDataFrame(rows, "who string, item string, q double").withColumn("kept", F.lit("clash"))
    out = capped(df, "who", "item", "q", share=(1, 20), bins=bins)
    rows = [r for r in rows if r[1] is not None]
    cap, fallen = len(rows) // 20, set()
    for w in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == w), key=lambda r: (r[2] is None or r[2] != r[2], -(r[2] if r[2] is not None and r[2] == r[2] else 0), r[1]))
        fallen |= {r[1] for r in own[cap:]}
    got = out.collect()
    assert len(got) == len(rows) and {r.item for r in got if not r.kept} == fallen


def test_caps_of_ties_and_nothing(spark):
    df = spark.createDataFrame([("a", f"i{i}", 1.0) for i in range(9)], "w string, i string, q double")
    assert sorted(r.i for r in capped(df, "w", "i", "q", cap=4).where("kept").collect()) == ["i0", "i1", "i2", "i3"]
    assert capped(df, "w", "i", "q", cap=0).where("kept").count() == 0
    assert capped(df.limit(0), "w", "i", "q", share=(1, 50)).count() == 0
    with pytest.raises(ValueError):
        capped(df, "w", "i", "q")


# Cutoffs


def test_cutoffs(spark):
    rng = random.Random(4)
    rows = [("hot" if i % 2 else f"m{i % 10}", f"i{i}", rng.choice([None, NAN, 0.5, round(rng.random(), 2)])) for i in range(700)]
    pct = {"hot": 25, "m0": 0, "m2": 100, "m4": 33, "m6": 150, "m8": None}
    df = spark.createDataFrame([(*r, pct[r[0]]) for r in rows] + [(None, "x", 1.0, 50), ("hot", None, 1.0, 25)], "src string, item string, v double, pct int").withColumn("position", F.lit(0))
    cut, kept = fraction_cutoffs(df, "src", "item", "v", "pct")
    by, want, cuts = defaultdict(list), set(), {}
    for s, i, v in rows:
        if v is not None and v == v and pct[s]:
            by[s].append((v, i))
    for s, xs in by.items():
        n = min(len(xs), math.ceil(len(xs) * pct[s] / 100))
        cuts[s] = sorted(xs, reverse=True)[n - 1][0]
        want |= {i for v, i in xs if v >= cuts[s]}
    assert {r.item for r in kept.collect()} == want
    got = {r.src: r for r in cut.collect()}
    assert {s: r.cutoff for s, r in got.items()} == cuts
    assert all(r.kept == sum(v >= cuts[s] for v, _ in by[s]) and r.n == len(by[s]) for s, r in got.items())
    cut, kept = fraction_cutoffs(df.limit(0), "src", "item", "v", "pct")
    assert cut.count() == 0 and kept.count() == 0
