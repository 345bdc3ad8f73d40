"""Queries on joins, duplicates, intervals, votes, order and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import scoring as S
from filmloom.functions import vocabulary as V
from filmloom.functions.hashing import phash_bits
from filmloom.functions.naming import clip_id as make_id
from filmloom.functions.naming import crop_box, display_name, escape_html, frame_offsets, human_duration, local_range, outside_dupes, seconds, slug, stem, timecode, unique_stem
from filmloom.functions.rounding import rounded
from filmloom.operators import dedup as D
from filmloom.operators import intervals as I
from filmloom.operators import lookups as L
from filmloom.operators import reports as R
from filmloom.operators import voting as O
from filmloom.plans.base import CUR, REG, clips, nn, r, source_types
from filmloom.session import materialise
from filmloom.sources import sinks
from filmloom.sources.tables import table

# Joins


def manifest_source_join(spark, folder: str) -> DataFrame:
    """Source type of every clip by its movie, else by the stem of its file, else youtube."""
    rows = clips(spark, folder, "video_id", "source_video")
    keys = [F.col("video_id"), F.lower(stem(F.col("source_video")))]
    return L.with_lookup(rows, keys, source_types(spark, folder), "movie", "source_type", "youtube", "source_type").select("clip_id", "source_type")


def prompt_lookup_fallback(spark, folder: str) -> DataFrame:
    """A prompt for every clip: by its label, else by what the label stands for, else that of the fallback bucket."""
    prompts = table(spark, folder, "mix_targets").select(F.col("bucket").alias("b"), F.concat(F.lit("Describe "), F.translate("bucket", "_", " ")).alias("prompt"))
    rows = clips(spark, folder, "bucket")
    raw = F.lower(F.trim("bucket"))
    return L.with_lookup(rows, [raw, S.clip_bucket(F.regexp_replace(raw, "[ -]", "_"))], prompts, "b", "prompt", "Describe portrait closeup", "prompt").select("clip_id", "prompt")


def verify_defaults(spark, folder: str) -> DataFrame:
    """The greatest valid caption check of every clip, 0 without one."""
    checks = table(spark, folder, "verify_results").where("score between 1 and 5").select("clip_id", "score")
    return L.with_defaults(clips(spark, folder, "verdict"), checks, "clip_id", {"score": 0}).select("clip_id", "verdict", "score")


def done_skip_antijoin(spark, folder: str) -> DataFrame:
    """Documents that no rater has seen."""
    return L.without_done(table(spark, folder, "documents").select("doc_id", "source"), table(spark, folder, "reading_labels"), ["doc_id"])


def status_pending(spark, folder: str) -> DataFrame:
    """Clips whose status map lacks the caption step."""
    rows = clips(spark, folder, "caption", "verdict")
    status = F.create_map(F.lit("done_s8"), F.length(F.trim(F.coalesce("caption", F.lit("")))) > 0, F.lit("done_s10"), F.col("verdict").isNotNull())
    return L.pending(rows, status, "done_s8").select("clip_id")


def rejected_union(spark, folder: str) -> DataFrame:
    """Clips that the gate discarded, and clips that were refused; with their origin."""
    rows = clips(spark, folder, "verdict", "reject")
    return sinks.rejected_union(rows.where(F.upper(F.trim("verdict")) == "DISCARD").select("clip_id"), rows.where(S.rejected(F.col("reject"))).select("clip_id"))


def cast_semi_join(spark, folder: str) -> DataFrame:
    """Clips of movies that are listed as internal."""
    named = source_types(spark, folder).where(F.col("source_type") == "internal")
    rows = clips(spark, folder, "video_id")
    return rows.join(named, F.col("video_id") == F.col("movie"), "left_semi").select("clip_id")


def movie_by_name(spark, folder: str) -> DataFrame:
    """Nations by a name that is written without regard to case and blanks."""
    names = table(spark, folder, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.concat(F.lit(" "), F.col("n_name"))).alias("name"))
    return L.by_name(names, "name", table(spark, folder, "nation"), "n_name").select("n_nationkey", "found")


def clip_locations(spark, folder: str) -> DataFrame:
    """The first place in order of priority that has a clip."""
    rows = clips(spark, folder, "s2_reject_reason", "verdict")
    where = sinks.reject_folder(F.col("s2_reject_reason"))
    path = lambda p: F.concat(F.lit(p), F.lit("/"), F.col("clip_id"), F.lit(".mp4")).alias("path")
    places = [
        ("clips", rows.where("s2_reject_reason is null").select("clip_id", path("clips"))),
        ("static", rows.where(where == "static_clips").select("clip_id", path("static_clips"))),
        ("excessive", rows.where(where == "excessive_motion").select("clip_id", path("excessive_motion"))),
        ("dups", rows.where(where == "dups").select("clip_id", path("dups"))),
        ("export", rows.where(F.upper(F.trim("verdict")) == "FINAL").select("clip_id", path("export"))),
    ]
    return L.in_priority(rows.select("clip_id"), "clip_id", places, "path")


def _steps(spark, folder: str) -> list[str]:
    return sorted(x[0] for x in table(spark, folder, "events").select("event_type").distinct().collect())


def runtime_summary_pivot(spark, folder: str) -> DataFrame:
    """Seconds per user and event type, as a wide table in long form again: (user_id, step, seconds, total)."""
    steps = _steps(spark, folder)
    wide = R.runtime_table(table(spark, folder, "events"), "user_id", "event_type", "value", steps)
    long = F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("seconds")) for s in steps])
    return wide.select("user_id", "total", F.inline(long))


def runtime_upsert(spark, folder: str) -> DataFrame:
    """Runtimes of one half of the users merged over older ones of all."""
    e = table(spark, folder, "events")
    sums = lambda rows: rows.groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("seconds"))
    old, new = sums(e), sums(e.where("value > 50"))
    return L.upsert(old, new, "user_id", ["seconds"]).select("user_id", F.round("seconds", 2).alias("seconds"), F.round("total", 2).alias("total"))


def actor_name_hits(spark, folder: str) -> DataFrame:
    return R.name_hits(clips(spark, folder, "clip_actors", "caption"), "clip_actors", "caption")


# Duplicates


def dup_exact_first_seen(spark, folder: str) -> DataFrame:
    """The first clip of the movie with the same hash."""
    rows = clips(spark, folder, "video_id", "phash", "timestamp_start").withColumn("bits", phash_bits(F.col("phash")))
    return D.first_seen(rows, ["video_id"], "bits", ["timestamp_start", "clip_id"], "clip_id").select("clip_id", "first_item")


def dup_near_pairs(spark, folder: str) -> DataFrame:
    """Pairs of different hashes of a movie within eight bits."""
    rows = clips(spark, folder, "video_id", "phash").withColumn("bits", phash_bits(F.col("phash")))
    return D.near_pairs(rows, ["video_id"], "bits", 8)


def dup_greedy_keep(spark, folder: str) -> DataFrame:
    """Greedy removal of near duplicates within each movie."""
    rows = clips(spark, folder, "video_id", "phash", "timestamp_start").withColumn("bits", phash_bits(F.col("phash")))
    return D.greedy_keep(rows, ["video_id"], "clip_id", "bits", ["timestamp_start", "clip_id"], 8)


def dup_cross_source(spark, folder: str) -> DataFrame:
    """Near duplicates across all movies, six bits apart, among the clips that removal within each movie keeps."""
    rows = clips(spark, folder, "video_id", "phash", "timestamp_start").withColumn("bits", phash_bits(F.col("phash")))
    kept = dup_greedy_keep(spark, folder).where("keep").select("clip_id")
    return D.greedy_keep(materialise(rows.join(kept, "clip_id", "left_semi")), [], "clip_id", "bits", ["video_id", "timestamp_start", "clip_id"], 6)


def dup_content(spark, folder: str) -> DataFrame:
    """The first document of every text."""
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", "text", "source")
    return D.distinct_content(rows, "text", ["doc_id"]).select("doc_id", "source")


def actors_in_order(spark, folder: str) -> DataFrame:
    """Distinct actors of a clip over all its states, as the newest and the other lists give them."""
    rows = clips(spark, folder, "clip_actors")
    back = F.reverse(F.coalesce("clip_actors", F.array().cast("array<string>")))
    return rows.select("clip_id", F.array_join(D.ordered_union(F.col("clip_actors"), back), ",").alias("actors"))


# Intervals


def _timed(spark, folder: str) -> DataFrame:
    return clips(spark, folder, "video_id", "timestamp_start", "timestamp_end")


def scene_merge(spark, folder: str) -> DataFrame:
    m = I.merge_intervals(_timed(spark, folder), ["video_id"], "timestamp_start", "timestamp_end", 0.5)
    return m.select("video_id", "island", F.round("timestamp_start", 3).alias("start"), F.round("timestamp_end", 3).alias("end"), "n")


def scene_gaps(spark, folder: str) -> DataFrame:
    g = I.gaps(_timed(spark, folder), ["video_id"], "timestamp_start", "timestamp_end", 0.5)
    return g.select("video_id", F.round("timestamp_start", 3).alias("start"), F.round("timestamp_end", 3).alias("end"))


def scene_boundaries(spark, folder: str) -> DataFrame:
    s = I.scenes_from_cuts(_timed(spark, folder).where("timestamp_start is not null"), ["video_id"], "timestamp_start", "timestamp_end")
    return s.select("video_id", "scene_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


def clip_tiling(spark, folder: str) -> DataFrame:
    """Two-second tiles of every clip, counted through the movie, and their ids."""
    t = I.tile(_timed(spark, folder), ["video_id"], "timestamp_start", "timestamp_end", 2.0)
    return t.select("video_id", "clip_start", "clip_end", make_id(F.col("video_id"), F.col("clip_index")).alias("tile_id"))


def chunk_bounds(spark, folder: str) -> DataFrame:
    """Chunks of five minutes with ten seconds of overlap that cover each movie."""
    movies = _timed(spark, folder).groupBy("video_id").agg(F.max("timestamp_end").alias("duration"))
    c = I.chunks(movies, "duration", 300.0, 10.0)
    return c.select("video_id", "chunk", F.round("chunk_start", 3).alias("chunk_start"), F.round("chunk_end", 3).alias("chunk_end"))


def frame_tasks(spark, folder: str) -> DataFrame:
    """Sample times of three frames of each clip, relative and as time codes."""
    rows = clips(spark, folder, "timestamp_start", "duration").where("timestamp_start is not null")
    f = rows.select("clip_id", "timestamp_start", F.posexplode(frame_offsets(F.col("duration"))).alias("frame", "seconds"))
    return f.select("clip_id", "frame", "seconds", timecode(F.round(F.col("timestamp_start") + F.col("seconds"), 3)).alias("at"))


def timecodes_read(spark, folder: str) -> DataFrame:
    """Time codes written and read again, and a readable duration."""
    rows = clips(spark, folder, "timestamp_start", "timestamp_end")
    local = local_range(F.col("timestamp_start"), F.col("timestamp_end"), F.lit(10.0))
    return rows.where("timestamp_start is not null and timestamp_end is not null").select("clip_id", F.round(seconds(timecode(F.col("timestamp_start"))), 3).alias("seconds"), human_duration(F.col("timestamp_end")).alias("readable"), F.round(local["start"], 3).alias("local_start"))


def motion_steps(spark, folder: str) -> DataFrame:
    """Mean absolute change of the motion score from clip to clip of a movie, over all movies' hash buckets."""
    e = table(spark, folder, "events").where("value is not null")
    at = R.batches(e.select("user_id", "ts", "event_id", "value"), ["user_id"], [F.col("ts"), F.col("event_id")], 1, name="b")
    nxt = at.select(F.col("user_id").alias("u"), (F.col("ordinal") - 1).alias("o"), F.col("value").alias("v"))
    pairs = at.join(nxt, (F.col("user_id") == F.col("u")) & (F.col("ordinal") == F.col("o")))
    return pairs.groupBy("user_id").agg(rounded(F.avg(F.abs(F.col("v") - F.col("value")))).alias("mean_change"), F.count(F.lit(1)).alias("n"))


# Votes


def frame_vote(spark, folder: str) -> DataFrame:
    """The states of a clip as frames that vote on its bucket."""
    rows = table(spark, folder, "clips").where("clip_id is not null").select("clip_id", "processed_at", "bucket", S.known(F.col("bucket_confidence")).alias("bucket_confidence"), "reject", "route").distinct()
    return O.frame_vote(rows, ["clip_id"], "processed_at", "bucket", "bucket_confidence", "reject")


def frame_actor_summary(spark, folder: str) -> DataFrame:
    """The states of a clip as frames, by the weekday of their time: chosen actors, least scores and mean score."""
    rows = table(spark, folder, "clips").where("clip_id is not null").select("clip_id", "processed_at", "clip_actors", "bucket_confidence", "motion_score", "icr").distinct()
    rows = rows.withColumn("frame", F.dayofweek("processed_at") % 3 + 1)
    one = rows.groupBy("clip_id", "frame").agg(F.max(F.struct("processed_at", "clip_actors", "bucket_confidence", "motion_score", "icr")).alias("m")).select("clip_id", "frame", "m.*")
    s = O.frame_summary(one, ["clip_id"], "frame", "clip_actors", "bucket_confidence", "motion_score", "icr")
    return s.select("clip_id", F.array_join("actors", ",").alias("actors"), rounded("least_similarity").alias("least_similarity"), rounded("least_margin").alias("least_margin"), rounded("clip_score").alias("clip_score"))


def verify_targets(spark, folder: str) -> DataFrame:
    """What the check of each clip's caption comes to; a clip with a source is there."""
    rows = clips(spark, folder, "keep", "reject", "verdict", "caption", "source_video")
    outcome = S.verify_outcome(F.col("keep"), F.col("reject"), F.upper(F.trim("verdict")), F.col("caption"), F.col("source_video").isNotNull())
    return rows.select("clip_id", outcome.alias("outcome"))


def step_filters(spark, folder: str) -> DataFrame:
    """Which steps each clip goes through: band flag, text on screen, caption, actors; the box and the text flag come from its scores."""
    c = F.col
    rows = clips(spark, folder, "keep", "reject", "route", "clip_actors", "scene_id", "s2_reject_reason", "bucket")
    text = c("scene_id") % 7 == 0
    out = S.without_text(c("keep"), c("reject"), c("s2_reject_reason"), text)
    step = S.actor_step(c("keep"), c("reject"), F.lower(F.trim("route")))
    return rows.select(
        "clip_id",
        S.band_removed(c("keep"), F.when(c("scene_id") % 2 == 0, "crop=8:4:0:0")).alias("band_removed"),
        out["keep"].alias("keep"),
        out["reject"].alias("reject"),
        out["reason"].alias("reason"),
        S.wants_caption(c("keep"), c("reject"), every=False).alias("captioned"),
        step.alias("actor_step"),
        F.size(S.caption_actors(F.when(step.isNull(), "tagged"), c("clip_actors"))).alias("caption_actors"),
        S.accepted_portrait(c("reject"), F.when(F.contains(F.coalesce("bucket", F.lit("")), F.lit("portrait")), "people_portraits")).alias("portrait"),
    )


def common_verdict(spark, folder: str) -> DataFrame:
    """The most frequent verdict of each movie, of equals the one with the least time."""
    rows = clips(spark, folder, "video_id", "verdict", "timestamp_start").where("verdict is not null and timestamp_start is not null").withColumn("verdict", F.upper(F.trim("verdict")))
    return O.most_common(rows, ["video_id"], "verdict", "timestamp_start")


def corner_vote(spark, folder: str) -> DataFrame:
    """Corner votes per supplier, with deviations that come from order lines."""
    rows = table(spark, folder, "lineitem")
    c = {"top_left": "a", "top_right": "b", "bottom_left": "c", "bottom_right": "d"}
    named = rows.select("l_suppkey", F.col("l_quantity").alias("a"), (F.col("l_discount") * 600).alias("b"), (F.col("l_tax") * 700).alias("c"), (F.col("l_extendedprice") / 1500).alias("d"))
    return O.corner_vote(named, ["l_suppkey"], c)


# Order


def batch_numbers(spark, folder: str) -> DataFrame:
    """Orders in batches of 500 by date and key, over all tasks."""
    return R.batches(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), [], [F.col("o_orderdate"), F.col("o_orderkey")], 500).select("o_orderkey", "ordinal", "batch")


def worker_split(spark, folder: str) -> DataFrame:
    """Parts assigned to seven workers in turn, and in stretches."""
    p = table(spark, folder, "part").select("p_partkey")
    turn = R.spread(p, [F.col("p_partkey")], 7).select("p_partkey", F.col("worker").alias("turn"))
    stretch = R.spread(p, [F.col("p_partkey")], 7, contiguous=True).select("p_partkey", F.col("worker").alias("stretch"))
    return turn.join(stretch, "p_partkey")


def top_captions(spark, folder: str) -> DataFrame:
    """The five best and the five worst captions by final score."""
    rows = clips(spark, folder, "final_score").withColumn("s", S.known(F.col("final_score"))).where("s is not null")
    best = R.top(rows, F.col("s"), [F.col("clip_id")], 5).withColumn("end", F.lit("top"))
    worst = R.top(rows, -F.col("s"), [F.col("clip_id")], 5).withColumn("end", F.lit("bottom"))
    return best.unionByName(worst).select("clip_id", F.col("s").alias("final_score"), "place", "end")


def clip_browser_page(spark, folder: str) -> DataFrame:
    """The third page of the final clips by quality, missing scores as 0."""
    rows = clips(spark, folder, "bucket", "dover_score", "verdict", "clip_actors").where(F.upper(F.trim("verdict")) == "FINAL")
    score = F.coalesce(S.known(F.col("dover_score")), F.lit(0.0))
    return R.paged(rows.withColumn("dover", score), [F.col("dover").desc(), F.col("clip_id")], 24, 2).select("clip_id", "dover", (F.coalesce(F.size("clip_actors"), F.lit(0)) > 0).alias("tagged"))


def bucket_order(spark, folder: str) -> DataFrame:
    """Buckets from the most frequent one on, by name among equals, with their place."""
    key = S.clip_bucket(F.regexp_replace(F.trim("bucket"), "[ -]", "_"))
    n = R.value_counts(clips(spark, folder, "bucket").select(key.alias("bucket")), "bucket")
    return R.top(n, F.col("n"), [F.col("bucket")], 15)


def seeded_sample(spark, folder: str) -> DataFrame:
    """A hundred clips by a seeded hash."""
    return R.seeded_sample(clips(spark, folder, "verdict"), "clip_id", 100)


def ids_lookup(spark, folder: str) -> DataFrame:
    """Wanted regions that there are, and those that are missing."""
    there, missing = L.ids_and_missing(table(spark, folder, "region").select(F.col("r_name").alias("name")), "name", ["ASIA", "EUROPE", "ATLANTIS"])
    return there.withColumn("found", F.lit(True)).unionByName(missing.withColumn("found", F.lit(False)))


# Exports


def export_captions(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "video_id", "verdict", "keep", "reject", "bucket", "caption", "final_score")
    return sinks.accepted(rows, ["FINAL", "REVIEW"]).select("clip_id", "video_id", "bucket", "caption", S.known(F.col("final_score")).alias("final_score"), "verdict")


def export_partition_index(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "verdict", "keep", "reject", "bucket")
    key = S.clip_bucket(F.regexp_replace(F.trim("bucket"), "[ -]", "_"))
    return sinks.bucket_index(sinks.accepted(rows, ["FINAL"]).withColumn("bucket", key), "export")


def export_names(spark, folder: str) -> DataFrame:
    """Names that registered files get in an export, and slugs of their movies."""
    rows = table(spark, folder, "movie_registry").where("source_path is not null").select("source_path", "video_id").distinct()
    p = F.col("source_path")
    return rows.select("source_path", unique_stem(p).alias("unique_stem"), sinks.export_name(p).alias("name"), slug(F.col("video_id")).alias("slug"), display_name(F.col("video_id")).alias("display"), outside_dupes(p).alias("outside"), escape_html(p).alias("html"))


def crop_boxes(spark, folder: str) -> DataFrame:
    """Crop boxes packed from parts, read back, and the filter text they give."""
    rows = table(spark, folder, "part")
    packed = F.concat_ws(":", *[(F.col("p_size") * k).cast("int").cast("string") for k in (40, 20, 1, 2)])
    c = crop_box(F.concat(F.lit("crop="), packed))
    return rows.select("p_partkey", c["w"].alias("w"), c["h"].alias("h"), c["x"].alias("x"), c["y"].alias("y"), sinks.video_filter(packed, F.array(*[F.col("p_size") for _ in range(4)])).alias("vf"), F.size(sinks.filter_attempts(packed, F.array().cast("array<int>"))).alias("attempts"))


_ALL = [
    manifest_source_join, prompt_lookup_fallback, verify_defaults, done_skip_antijoin, status_pending, rejected_union, cast_semi_join, movie_by_name, clip_locations, runtime_summary_pivot, runtime_upsert, actor_name_hits,
    dup_exact_first_seen, dup_near_pairs, dup_greedy_keep, dup_cross_source, dup_content, actors_in_order, scene_merge, scene_gaps, scene_boundaries, clip_tiling, chunk_bounds, frame_tasks, timecodes_read, motion_steps,
    frame_vote, frame_actor_summary, verify_targets, step_filters, common_verdict, corner_vote, batch_numbers, worker_split, top_captions, clip_browser_page, bucket_order, seeded_sample, ids_lookup, export_captions, export_partition_index, export_names, crop_boxes,
]
QUERIES = {f.__name__: f for f in _ALL}

_KEY = "lower(regexp_replace(trim(bucket), '[ -]', '_', 'g'))"
_KNOWN = ", ".join(f"'{b}'" for b in V.CLIP_BUCKETS)
_BUCKET = f"CASE WHEN {_KEY} IN ({_KNOWN}) THEN {_KEY} " + " ".join(f"WHEN {_KEY} = '{a}' THEN '{b}'" for a, b in V.CLIP_ALIASES.items()) + f" ELSE '{V.CLIP_BUCKETS[0]}' END"
_BITS = "('0x' || lower(trim(phash)))::UBIGINT"
_TIMED = f"{CUR}, t AS (SELECT video_id, timestamp_start AS a, timestamp_end AS b FROM cur WHERE timestamp_start IS NOT NULL AND timestamp_end >= timestamp_start)"
_ACCEPT = "coalesce(keep, true) AND NOT coalesce(reject, false)"
_STAMP = "printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000)"

SQL = {
    "manifest_source_join": f"WITH {CUR}, {REG} SELECT clip_id, coalesce(r1.source_type, r2.source_type, 'youtube') AS source_type FROM cur LEFT JOIN reg r1 ON r1.movie = video_id LEFT JOIN reg r2 ON r2.movie = lower(regexp_replace(source_video, '(.)\\.[^.]*$', '\\1'))",
    "prompt_lookup_fallback": f"""WITH {CUR}, p AS (SELECT DISTINCT bucket AS b, 'Describe ' || replace(bucket, '_', ' ') AS prompt FROM mix_targets)
SELECT clip_id, coalesce(p1.prompt, p2.prompt, 'Describe portrait closeup') AS prompt FROM cur LEFT JOIN p p1 ON p1.b = lower(trim(bucket)) LEFT JOIN p p2 ON p2.b = {_BUCKET}""",
    "verify_defaults": f"WITH {CUR}, v AS (SELECT clip_id, max(score) AS score FROM verify_results WHERE score BETWEEN 1 AND 5 GROUP BY 1) SELECT clip_id, verdict, coalesce(score, 0) AS score FROM cur LEFT JOIN v USING (clip_id)",
    "done_skip_antijoin": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM reading_labels WHERE doc_id IS NOT NULL)",
    "status_pending": f"WITH {CUR} SELECT clip_id FROM cur WHERE length(trim(coalesce(caption, ''))) = 0",
    "rejected_union": f"WITH {CUR} SELECT clip_id, 'gate' AS origin FROM cur WHERE upper(trim(verdict)) = 'DISCARD' UNION ALL SELECT clip_id, 'classify' FROM cur WHERE coalesce(reject, false)",
    "cast_semi_join": f"WITH {CUR}, {REG} SELECT clip_id FROM cur WHERE video_id IN (SELECT movie FROM reg WHERE source_type = 'internal')",
    "movie_by_name": "SELECT n_nationkey, n_name AS found FROM nation",
    "clip_locations": f"""WITH {CUR}, k AS (SELECT clip_id, s2_reject_reason AS s, upper(trim(verdict)) = 'FINAL' AS f FROM cur),
w AS (SELECT clip_id, CASE WHEN s IS NULL THEN 'clips' WHEN s = 'static' THEN 'static' WHEN s = 'excessive_motion' THEN 'excessive' WHEN s = 'duplicate' THEN 'dups' WHEN f THEN 'export' END AS place FROM k)
SELECT clip_id, place, CASE place WHEN 'static' THEN 'static_clips' WHEN 'excessive' THEN 'excessive_motion' ELSE place END || '/' || clip_id || '.mp4' AS path FROM w""",
    "runtime_summary_pivot": """WITH s AS (SELECT user_id, event_type AS step, round(sum(value), 2) AS seconds FROM events GROUP BY ALL), u AS (SELECT DISTINCT user_id FROM events), e AS (SELECT DISTINCT event_type AS step FROM events),
f AS (SELECT user_id, step, coalesce(seconds, 0.0) AS seconds FROM u CROSS JOIN e LEFT JOIN s USING (user_id, step)) SELECT user_id, step, seconds, round(sum(seconds) OVER (PARTITION BY user_id), 2) AS total FROM f""",
    "runtime_upsert": """WITH o AS (SELECT user_id, round(sum(value), 2) AS s FROM events GROUP BY 1), n AS (SELECT user_id, round(sum(value), 2) AS s FROM events WHERE value > 50 GROUP BY 1)
SELECT user_id, round(CASE WHEN n.s > 0 THEN n.s ELSE coalesce(o.s, 0.0) END, 2) AS seconds, round(CASE WHEN n.s > 0 THEN n.s ELSE coalesce(o.s, 0.0) END, 2) AS total FROM o FULL JOIN n USING (user_id)""",
    "actor_name_hits": f"""WITH {CUR}, e AS (SELECT unnest(list_distinct(clip_actors)) AS name, lower(coalesce(caption, '')) AS c FROM cur)
SELECT name, count(*) AS tagged, count(*) FILTER (contains(c, lower(name))) AS named FROM e WHERE trim(name) <> '' GROUP BY 1""",
    "dup_exact_first_seen": f"WITH {CUR} SELECT clip_id, CASE WHEN regexp_full_match(lower(trim(phash)), '[0-9a-f]{{16}}') THEN first_value(clip_id) OVER (PARTITION BY video_id, lower(trim(phash)) ORDER BY timestamp_start NULLS FIRST, clip_id) END AS first_item FROM cur",
    "dup_near_pairs": f"""WITH {CUR}, h AS (SELECT DISTINCT video_id, {_BITS} AS u FROM cur WHERE regexp_full_match(lower(trim(phash)), '[0-9a-f]{{16}}')),
s AS (SELECT video_id, CASE WHEN u >= 9223372036854775808 THEN (u::HUGEINT - 18446744073709551616)::BIGINT ELSE u::BIGINT END AS b FROM h)
SELECT x.video_id, x.b AS a, y.b, bit_count(xor(x.b, y.b))::INT AS distance FROM s x JOIN s y ON x.video_id = y.video_id AND x.b < y.b AND bit_count(xor(x.b, y.b)) <= 8""",
    "dup_content": "SELECT doc_id, source FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "scene_merge": f"""WITH {_TIMED},
f AS (SELECT *, max(b) OVER w AS p FROM t WINDOW w AS (PARTITION BY video_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR a >= p + 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) - 1 AS island FROM f)
SELECT video_id, island::BIGINT AS island, round(min(a), 3) AS start, round(max(b), 3) AS "end", count(*) AS n FROM i GROUP BY 1, 2""",
    "scene_gaps": f"""WITH {_TIMED}, f AS (SELECT *, max(b) OVER (PARTITION BY video_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM t)
SELECT video_id, round(p, 3) AS start, round(a, 3) AS "end" FROM f WHERE a - p > 0.5""",
    "scene_boundaries": f"""WITH {CUR}, t AS (SELECT video_id, timestamp_start AS a, timestamp_end AS b FROM cur WHERE timestamp_start IS NOT NULL), d AS (SELECT video_id, max(b) AS d FROM t GROUP BY 1),
e AS (SELECT video_id, 0.0::DOUBLE AS x FROM d WHERE d > 0 UNION SELECT video_id, d FROM d WHERE d > 0 UNION SELECT video_id, a FROM t JOIN d USING (video_id) WHERE a > 0 AND a < d),
p AS (SELECT video_id, x, lead(x) OVER (PARTITION BY video_id ORDER BY x) AS y FROM e), k AS (SELECT * FROM p WHERE y - x >= 0.5)
SELECT video_id, (row_number() OVER (PARTITION BY video_id ORDER BY x) - 1)::INT AS scene_id, round(x, 3) AS start, round(y, 3) AS "end" FROM k""",
    "clip_tiling": f"""WITH {CUR}, c AS (SELECT video_id, timestamp_start AS a, timestamp_end AS b, clip_id, greatest(floor((timestamp_end - timestamp_start) / 2.0 + 5e-4), 0)::INT AS n FROM cur WHERE timestamp_start IS NOT NULL AND timestamp_end IS NOT NULL),
s AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY video_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM c WHERE n > 0), k AS (SELECT video_id, a, base, unnest(range(n)) AS i FROM s)
SELECT video_id, round(a + i * 2.0, 3) AS clip_start, round(a + i * 2.0 + 2.0, 3) AS clip_end, video_id || '_' || lpad((base + i)::BIGINT::VARCHAR, 6, '0') AS tile_id FROM k""",
    "chunk_bounds": f"""WITH {CUR}, d AS (SELECT video_id, max(timestamp_end) AS d FROM cur GROUP BY 1), k AS (SELECT video_id, d, unnest(range(greatest(ceil(d / 300.0), 1)::INT)) AS i FROM d WHERE d > 0)
SELECT video_id, i::INT AS chunk, round(greatest(i * 300.0 - 10.0, 0), 3) AS chunk_start, round(least((i + 1) * 300.0 + 10.0, d), 3) AS chunk_end FROM k""",
    "frame_tasks": f"""WITH {CUR}, k AS (SELECT clip_id, timestamp_start AS a, greatest(coalesce(duration, 5.0), 1.0) AS d FROM cur WHERE timestamp_start IS NOT NULL),
f AS (SELECT clip_id, a, unnest([0, 1, 2])::INT AS frame, unnest([{r('d * 0.2', 3)}, {r('d * 0.5', 3)}, {r('d * 0.8', 3)}]) AS seconds FROM k), m AS (SELECT *, round(round(a + seconds, 3) * 1000)::BIGINT AS ms FROM f)
SELECT clip_id, frame, seconds, {_STAMP} AS at FROM m""",
    "timecodes_read": f"""WITH {CUR}, k AS (SELECT clip_id, timestamp_start AS a, floor(timestamp_end)::BIGINT AS n FROM cur WHERE timestamp_start IS NOT NULL AND timestamp_end IS NOT NULL)
SELECT clip_id, round(round(a * 1000) / 1000, 3) AS seconds, CASE WHEN n >= 3600 THEN printf('%dh %02dm', n // 3600, n // 60 % 60) WHEN n >= 60 THEN printf('%dm %02ds', n // 60 % 60, n % 60) ELSE printf('%ds', n) END AS readable, round(a - 10.0, 3) AS local_start FROM k""",
    "motion_steps": f"""WITH k AS (SELECT user_id, value, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events WHERE value IS NOT NULL)
SELECT user_id, {r('avg(abs(nx - value))')} AS mean_change, count(*) AS n FROM k WHERE nx IS NOT NULL GROUP BY 1""",
    "frame_vote": f"""WITH f AS (SELECT DISTINCT clip_id, processed_at, bucket, {nn("bucket_confidence")} AS c, reject, route FROM clips WHERE clip_id IS NOT NULL),
p AS (SELECT clip_id, bucket, count(*) AS n, min(processed_at) AS o, sum(coalesce(c, 0.5)) AS c, count(*) FILTER (coalesce(reject, false)) AS rj FROM f GROUP BY 1, 2),
t AS (SELECT clip_id, sum(n) AS frames, sum(rj) AS rj FROM p GROUP BY 1), w AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY n DESC, o) = 1)
SELECT clip_id, frames::INT AS frames, t.rj >= greatest(1, frames // 2 + 1) AS reject, bucket, {r("c / n * n / frames")} AS bucket_confidence FROM w JOIN t USING (clip_id)""",
    "frame_actor_summary": f"""WITH f AS (SELECT DISTINCT clip_id, processed_at, clip_actors, bucket_confidence AS s, motion_score AS g, icr AS i, (dayofweek(processed_at) + 1) % 3 + 1 AS frame FROM clips WHERE clip_id IS NOT NULL),
o AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY clip_id, frame ORDER BY processed_at DESC NULLS LAST) = 1),
k AS (SELECT *, list_position([2, 1, 3], frame::INT) AS p FROM o),
a AS (SELECT clip_id, array_to_string(arg_min(clip_actors, p), ',') AS actors FROM k WHERE len(clip_actors) > 0 GROUP BY 1),
m AS (SELECT clip_id, {r("coalesce(min(" + nn("s") + "), 0)")} AS least_similarity, {r("coalesce(min(" + nn("g") + "), 0)")} AS least_margin, {r("coalesce(avg(" + nn("i") + "), 0)")} AS clip_score FROM k GROUP BY 1)
SELECT clip_id, coalesce(actors, '') AS actors, least_similarity, least_margin, clip_score FROM m LEFT JOIN a USING (clip_id)""",
    "verify_targets": f"""WITH {CUR} SELECT clip_id, CASE WHEN NOT ({_ACCEPT}) OR coalesce(upper(trim(verdict)), '') <> 'FINAL' THEN 'no_target' WHEN trim(coalesce(caption, '')) = '' THEN 'no_caption' WHEN source_video IS NULL THEN 'no_clip' ELSE 'check' END AS outcome FROM cur""",
    "step_filters": f"""WITH {CUR}, k AS (SELECT *, coalesce(scene_id % 7 = 0, false) AS t, NOT ({_ACCEPT}) AS x, CASE WHEN NOT ({_ACCEPT}) THEN 'skipped' WHEN coalesce(lower(trim(route)), '') <> 'people' THEN 'not_applicable' END AS st FROM cur)
SELECT clip_id, CASE WHEN coalesce(keep, true) THEN coalesce(scene_id % 2 = 0, false) END AS band_removed, coalesce(keep, true) AND NOT t AS keep, coalesce(reject, false) OR t AS reject, CASE WHEN t THEN 'has_text' ELSE s2_reject_reason END AS reason,
NOT x AS captioned, st AS actor_step, CASE WHEN st IS NULL THEN coalesce(len(clip_actors), 0) ELSE 0 END::INT AS caption_actors, NOT coalesce(reject, true) AND contains(coalesce(bucket, ''), 'portrait') AS portrait FROM k""",
    "common_verdict": f"""WITH {CUR}, p AS (SELECT video_id, upper(trim(verdict)) AS verdict, count(*) AS n, min(timestamp_start) AS o FROM cur WHERE verdict IS NOT NULL AND timestamp_start IS NOT NULL GROUP BY 1, 2)
SELECT video_id, verdict, n FROM p QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY n DESC, o, verdict) = 1""",
    "corner_vote": """WITH k AS (SELECT l_suppkey, l_quantity::DOUBLE AS a, l_discount::DOUBLE * 600 AS b, l_tax::DOUBLE * 700 AS c, l_extendedprice::DOUBLE / 1500 AS d FROM lineitem), m AS (SELECT *, greatest(a, b, c, d) AS g FROM k),
v AS (SELECT l_suppkey, CASE WHEN g <= 40 THEN NULL WHEN a = g THEN 'top_left' WHEN b = g THEN 'top_right' WHEN c = g THEN 'bottom_left' ELSE 'bottom_right' END AS corner FROM m),
n AS (SELECT l_suppkey, corner, count(*) AS votes FROM v GROUP BY ALL),
b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY corner IS NULL, votes DESC, list_position(['top_left', 'top_right', 'bottom_left', 'bottom_right'], corner)) = 1)
SELECT l_suppkey, corner, CASE WHEN corner IS NULL THEN 0 ELSE votes END AS votes, corner IS NOT NULL AND votes >= 2 AS present FROM b""",
    "batch_numbers": "WITH k AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS ordinal FROM orders) SELECT o_orderkey, ordinal, (ordinal - 1) // 500 AS batch FROM k",
    "worker_split": "WITH k AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i, count(*) OVER () AS n FROM part) SELECT p_partkey, (i % 7)::INT AS turn, (i // ceil(n / 7.0)::BIGINT)::INT AS stretch FROM k",
    "top_captions": f"""WITH {CUR}, s AS (SELECT clip_id, final_score FROM cur WHERE final_score IS NOT NULL AND NOT isnan(final_score)),
k AS (SELECT *, row_number() OVER (ORDER BY final_score DESC, clip_id) AS t, row_number() OVER (ORDER BY final_score, clip_id) AS b FROM s)
SELECT clip_id, final_score, t::INT AS place, 'top' AS "end" FROM k WHERE t <= 5 UNION ALL SELECT clip_id, final_score, b::INT, 'bottom' FROM k WHERE b <= 5""",
    "clip_browser_page": f"""WITH {CUR}, k AS (SELECT clip_id, coalesce({nn("dover_score")}, 0.0) AS dover, coalesce(len(clip_actors), 0) > 0 AS tagged FROM cur WHERE upper(trim(verdict)) = 'FINAL')
SELECT * FROM k ORDER BY dover DESC, clip_id LIMIT 24 OFFSET 48""",
    "bucket_order": f"WITH {CUR}, k AS (SELECT {_BUCKET} AS bucket, count(*) AS n FROM cur GROUP BY 1) SELECT bucket, n, row_number() OVER (ORDER BY n DESC, bucket)::INT AS place FROM k",
    "ids_lookup": "SELECT r_name AS name, true AS found FROM region WHERE r_name IN ('ASIA', 'EUROPE', 'ATLANTIS') UNION ALL SELECT 'ATLANTIS', false",
    "export_captions": f"WITH {CUR} SELECT clip_id, video_id, bucket, caption, {nn('final_score')} AS final_score, verdict FROM cur WHERE upper(trim(verdict)) IN ('FINAL', 'REVIEW') AND {_ACCEPT}",
    "export_partition_index": f"WITH {CUR}, k AS (SELECT {_BUCKET} AS bucket FROM cur WHERE upper(trim(verdict)) = 'FINAL' AND {_ACCEPT}) SELECT bucket, count(*) AS count, 'export/' || bucket || '/manifest.jsonl' AS manifest, 'export/' || bucket || '/clips' AS clips_dir FROM k GROUP BY 1",
    "crop_boxes": """SELECT p_partkey, (p_size * 40)::INT AS w, (p_size * 20)::INT AS h, p_size::INT AS x, (p_size * 2)::INT AS y,
printf('crop=%d:%d:%d:%d,delogo=x=%d:y=%d:w=%d:h=%d', (p_size * 40)::INT, (p_size * 20)::INT, p_size::INT, (p_size * 2)::INT, p_size::INT, p_size::INT, p_size::INT, p_size::INT) AS vf, 2::INT AS attempts FROM part""",
}
SQL["actors_in_order"] = f"WITH {CUR} SELECT clip_id, coalesce(array_to_string(list_filter(clip_actors, lambda x, i: list_position(clip_actors, x) = i), ','), '') AS actors FROM cur"
SQL["export_names"] = """
WITH f AS (SELECT DISTINCT source_path AS p, video_id AS v FROM movie_registry WHERE source_path IS NOT NULL),
k AS (SELECT p, v, string_split(p, '/') AS s FROM f), m AS (SELECT p, v, s[-2] AS d, regexp_replace(s[-1], '(.)\\.[^.]*$', '\\1') AS st, regexp_extract(s[-1], '(\\.[^.]*)$', 1) AS x FROM k)
SELECT p AS source_path, d || '__' || st AS unique_stem, d || '__' || st || x AS name, trim(regexp_replace(lower(trim(v)), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
array_to_string(list_transform(string_split(replace(v, '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS display, true AS outside, p AS html FROM m"""
