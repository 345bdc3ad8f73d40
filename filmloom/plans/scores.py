"""Queries on scores, gates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import scoring as S
from filmloom.functions import vocabulary as V
from filmloom.functions.captions import classified
from filmloom.functions.rounding import rounded
from filmloom.operators import reports as R
from filmloom.operators.lookups import with_lookup
from filmloom.plans.base import CUR, REG, clips, md5_mod, nn, r, source_types
from filmloom.sources.tables import table

GATES = ["final", "review", "discard"]
_SCORED = ["clip_score", "icr", "aod", "dover_score", "motion_score", "bucket_confidence", "final_score"]


def _gated(spark, folder: str) -> DataFrame:
    """Current clips with source type, combined score and image gate; every word counts as a noun here."""
    rows = clips(spark, folder, "video_id", "bucket", "caption", "clip_score", "icr", "aod")
    rows = with_lookup(rows, [F.col("video_id")], source_types(spark, folder), "movie", "source_type", "internal", "source_type")
    nouns = F.size(F.split(F.coalesce("caption", F.lit("")), " ")).cast("double")
    zero = F.lit(0.0)
    score = S.combined_score(F.coalesce(S.known(F.col("clip_score")), zero) / 100, F.coalesce(S.known(F.col("icr")), zero), F.coalesce(S.known(F.col("aod")), zero), nouns)
    return rows.withColumn("combined", score).withColumn("gate", S.image_gate(F.col("combined")))


_GATED = f"""
{CUR}, {REG},
sc AS (
  SELECT clip_id, bucket, coalesce(source_type, 'internal') AS source_type,
         {r("0.55 * (coalesce(" + nn("clip_score") + ", 0) / 100) + 0.0 * coalesce(" + nn("icr") + ", 0) + 0.45 * least(coalesce(" + nn("aod") + ", 0), 1) * least(len(string_split(coalesce(caption, ''), ' ')) / 5.0, 1)")} AS combined
  FROM cur LEFT JOIN reg ON reg.movie = cur.video_id
),
gated AS (SELECT *, CASE WHEN combined >= 0.25 THEN 'final' WHEN combined >= 0.15 THEN 'review' ELSE 'discard' END AS gate FROM sc)"""


def gate_report_by_source(spark, folder: str) -> DataFrame:
    return R.cross_tab(_gated(spark, folder), "source_type", "gate", GATES)


def gate_counts(spark, folder: str) -> DataFrame:
    return R.value_counts(_gated(spark, folder), "gate")


def gate_nested_stats(spark, folder: str) -> DataFrame:
    out = R.nested_statistics(_gated(spark, folder), "source_type", "gate", "combined")
    text = F.array_join(F.transform(F.map_entries("gate_counts"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    return out.withColumn("gate_counts", text)


def bucket_mean_scores(spark, folder: str) -> DataFrame:
    final = _gated(spark, folder).where(F.col("gate") == "final").withColumn("bucket", S.clip_bucket(F.lower(F.regexp_replace(F.trim("bucket"), "[ -]", "_"))))
    return final.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("combined")).alias("mean_combined"))


_CLEAN_BUCKET = "lower(regexp_replace(trim(bucket), '[ -]', '_', 'g'))"


def _bucket_sql(key: str) -> str:
    known = ", ".join(f"'{b}'" for b in V.CLIP_BUCKETS)
    alias = " ".join(f"WHEN {key} = '{a}' THEN '{b}'" for a, b in V.CLIP_ALIASES.items())
    return f"CASE WHEN {key} IN ({known}) THEN {key} {alias} ELSE '{V.CLIP_BUCKETS[0]}' END"


def clip_gate_verdict(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "final_score", "keep", "reject")
    return rows.select("clip_id", S.clip_gate(F.col("final_score"), F.col("keep"), F.col("reject")).alias("verdict"))


def motion_bounds_by_source(spark, folder: str) -> DataFrame:
    return R.clamped_bounds(clips(spark, folder, "video_id", "motion_score"), ["video_id"], "motion_score")


def motion_gate(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "video_id", "motion_score", "dover_score")
    b = R.clamped_bounds(rows, ["video_id"], "motion_score").select(F.col("video_id").alias("v"), "lower", "upper")
    reason = S.first_reason(S.motion_reason(F.col("motion_score"), F.col("lower"), F.col("upper")), S.quality_reason(F.col("dover_score")))
    return rows.join(b, F.col("video_id") == F.col("v"), "left").select("clip_id", reason.alias("reason"), reason.isNull().alias("passed"))


_BOUNDS = f"""
{CUR},
b AS (
  SELECT video_id, count(*) AS n, {r("greatest(quantile_cont(motion_score, 0.1), 0.05)")} AS lower, {r("least(quantile_cont(motion_score, 0.9), 0.95)")} AS upper
  FROM cur WHERE motion_score IS NOT NULL AND NOT isnan(motion_score) GROUP BY 1
)"""


def final_score_fusion(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "clip_score", "dover_score", "motion_score", "bucket_confidence", "caption", "keep")
    k = lambda n: S.known(F.col(n))
    fused = S.clip_final_score(k("clip_score"), k("dover_score"), F.lit(None).cast("double"), S.motion_fusion(k("motion_score"), k("motion_score")), k("bucket_confidence"), F.col("caption"), F.col("keep"))
    return rows.select("clip_id", fused.alias("fused"))


_M = f"coalesce({nn('motion_score')}, 0)"
_FUSED = (
    f"0.25 * coalesce({nn('clip_score')}, 0) + 0.30 * greatest(0, least(1, coalesce({nn('dover_score')}, 0))) + 0.20 * greatest(0, least(1, {r(f'(0.7 * {_M} + 0.3 * {_M}) / 1.0')}))"
    f" + 0.15 * greatest(0, least(1, coalesce({nn('bucket_confidence')}, 0))) + 0.10 * CASE WHEN length(trim(coalesce(caption, ''))) > 0 THEN 1.0 ELSE 0.0 END"
)


def standin_scores(spark, folder: str) -> DataFrame:
    """Deterministic stand-ins of the models, and the older fusion of them."""
    rows = clips(spark, folder, "bucket", "bucket_confidence", "reject", "source_video", "caption")
    text = F.coalesce(F.nullif(F.col("caption"), F.lit("")), F.lit("untitled scene"))
    d = S.standin_dover(F.col("source_video"))
    out = rows.select("clip_id", rounded(S.standin_clip(text)).alias("clip"), rounded(S.standin_icr(F.col("bucket"), F.col("bucket_confidence"), F.col("reject"))).alias("icr"), rounded(S.standin_aod(F.col("clip_id"))).alias("aod"), rounded(d["overall"]).alias("dover"))
    return out.withColumn("final", S.first_final_score(F.col("clip"), F.col("icr"), F.col("aod")))


_BASE8 = "('0x' || substr(md5(source_video), 1, 8))::BIGINT"


def score_histogram(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, *_SCORED, "keep")
    return R.histogram(rows, _SCORED, S.keeps(F.col("keep")))


_LONG = f"SELECT clip_id, coalesce(keep, true) AS k, unnest([{', '.join(repr(c) for c in _SCORED)}]) AS metric, unnest([{', '.join(_SCORED)}]) AS v FROM cur"


def score_statistics(spark, folder: str) -> DataFrame:
    return R.statistics(clips(spark, folder, *_SCORED), _SCORED)


def model_means(spark, folder: str) -> DataFrame:
    """Mean scores per prompt version, and how many clips look like hallucinations."""
    rows = clips(spark, folder, "prompt_version", "icr", "aod", "motion_score", "clip_score")
    return rows.groupBy("prompt_version").agg(
        F.count(F.lit(1)).alias("n"),
        *[rounded(F.avg(S.known(F.col(c)))).alias(f"mean_{c}") for c in ("icr", "aod", "motion_score")],
        F.count_if(S.known(F.col("clip_score")) < 0.2).alias("low"),
    )


def funnel_counts(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "keep", "reject", "caption", "verdict", "clip_actors")
    stages = {
        "extracted": F.lit(True),
        "kept": S.keeps(F.col("keep")),
        "not_rejected": ~S.rejected(F.col("reject")),
        "captioned": F.length(F.trim(F.coalesce("caption", F.lit("")))) > 0,
        "final": F.upper(F.trim("verdict")) == "FINAL",
        "with_actors": F.size("clip_actors") > 0,
    }
    return R.funnel(rows, stages)


_STAGES = ["true", "coalesce(keep, true)", "NOT coalesce(reject, false)", "length(trim(coalesce(caption, ''))) > 0", "upper(trim(verdict)) = 'FINAL'", "len(clip_actors) > 0"]


def report_clip_summary(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "keep", "reject", "s2_reject_reason", "verdict", "final_score", "duration")
    return R.clip_summary(rows, S.keeps(F.col("keep")), S.rejected(F.col("reject")))


def label_distributions(spark, folder: str) -> DataFrame:
    """Counts by label, null included: reject reasons, routes and verdicts."""
    rows = clips(spark, folder, "s2_reject_reason", "route", "verdict")
    labels = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("value")) for c in ("s2_reject_reason", "route", "verdict")])
    return rows.select(F.inline(labels)).groupBy("label", "value").agg(F.count(F.lit(1)).alias("n"))


def verify_pass_rate(spark, folder: str) -> DataFrame:
    v = S.verify_score(F.col("score"))
    rows = table(spark, folder, "verify_results").select(v.alias("v"), F.col("error"))
    none = F.coalesce(F.trim("error"), F.lit("")) == ""
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~none).alias("errors"),
        rounded(F.avg("v.score"), 3).alias("mean_score"),
        rounded(F.avg("v.norm"), 3).alias("mean_norm"),
        rounded(F.avg(F.col("v.passed").cast("int")), 3).alias("pass_rate"),
    )


def bucket_alias_route(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "bucket")
    key = F.regexp_replace(F.trim("bucket"), "[ -]", "_")
    return rows.select("clip_id", S.clip_bucket(key).alias("bucket"), S.route(key).alias("route"), S.image_bucket(F.lower(key)).alias("image_bucket"))


def classify_json_normalise(spark, folder: str) -> DataFrame:
    """A classifier's fenced answer about each clip, read back."""
    rows = clips(spark, folder, "bucket", "keep", "s2_reject_reason", "bucket_confidence", "route")
    answer = F.to_json(F.struct(F.col("bucket").alias("primary_bucket"), "keep", F.col("s2_reject_reason").alias("reject_reason"), S.known(F.col("bucket_confidence")).alias("bucket_confidence"), F.col("route").alias("motion_type")))
    fenced = F.concat(F.lit("Here it is:\n```json\n"), answer, F.lit("\n```"))
    c = classified(fenced)
    return rows.select("clip_id", c.alias("c")).select("clip_id", "c.bucket", "c.bucket_confidence", "c.reject", "c.reject_reason", F.try_element_at("c.attributes", F.lit("motion_type")).alias("motion_type"))


def caption_mix_md5(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "caption", "generated_caption", "source_video", "bucket")
    c = S.caption_choice(F.col("caption"), F.col("generated_caption"), F.lit("Film_Archive"), F.col("bucket"), F.col("clip_id"), ("archive", "library"))
    return rows.select("clip_id", c.alias("c")).select("clip_id", "c.caption", "c.caption_source")


def quality_flags(spark, folder: str) -> DataFrame:
    """Image quality flags of measures that come from order lines."""
    rows = table(spark, folder, "lineitem")
    q, e, d, t = (F.col(f"l_{c}") for c in ("quantity", "extendedprice", "discount", "tax"))
    flags = S.image_flags(q, d * 400, e / 400, q / 3, e / 380, q, t * 6)
    return rows.select("l_orderkey", "l_linenumber", S.joined_reasons(flags).alias("reasons"), (F.size(flags) > 0).alias("rejected"))


def logo_scores(spark, folder: str) -> DataFrame:
    """Logo score of corner patches whose features come from order lines."""
    rows = table(spark, folder, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", S.logo_score(F.col("l_quantity") * 2.0, F.col("l_discount") * 2.0, F.col("l_extendedprice") / 100).alias("score"))


def adjective_categories(spark, folder: str) -> DataFrame:
    """Words of the parts' names by category of adjective."""
    words = table(spark, folder, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("word"))
    return words.groupBy(S.adjective_category(F.col("word")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def _adjective_sql() -> str:
    return "CASE " + " ".join(f"WHEN word IN ({', '.join(repr(w) for w in ws)}) THEN '{n}'" for n, ws in V.ADJECTIVES.items()) + " ELSE 'other' END"


def noun_coverage(spark, folder: str) -> DataFrame:
    """Share of a clip's bucket words that its caption covers."""
    rows = clips(spark, folder, "bucket", "caption")
    nouns = F.split(F.lower(F.regexp_replace(F.trim(F.coalesce("bucket", F.lit("none"))), "[ -]", "_")), "_")
    labels = F.array_distinct(F.filter(F.split(F.coalesce("caption", F.lit("")), " "), lambda w: F.length(w) > 3))
    return rows.select("clip_id", S.noun_coverage(labels, nouns).alias("coverage"))


def caption_stats(spark, folder: str) -> DataFrame:
    """Per bucket: captions, those with a parse error, and those without caption."""
    rows = clips(spark, folder, "bucket", "caption", "caption_struct")
    key = S.clip_bucket(F.regexp_replace(F.trim("bucket"), "[ -]", "_"))
    empty = F.length(F.trim(F.coalesce("caption", F.lit("")))) == 0
    broken = F.coalesce(F.contains("caption_struct", F.lit('"_parse_error"')), F.lit(False))
    return rows.groupBy(key.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~empty & ~broken).alias("success"), F.count_if(broken).alias("parse_error"), F.count_if(empty & ~broken).alias("empty"))


def actor_status_counts(spark, folder: str) -> DataFrame:
    rows = clips(spark, folder, "clip_actors", "bucket_confidence", "motion_score")
    status = S.actor_status(F.col("clip_actors"), S.known(F.col("bucket_confidence")), S.known(F.col("motion_score")))
    return R.value_counts(rows.select(status.alias("actor_status")), "actor_status")


def watermark_states(spark, folder: str) -> DataFrame:
    """States of logo removal, with flags that come from order lines."""
    rows = table(spark, folder, "lineitem")
    boxes = F.when(F.col("l_quantity") > 20, F.array(F.lit(1)))
    status = S.watermark_status(F.col("l_returnflag") == "R", boxes, F.col("l_linestatus") == "F", F.col("l_discount") > 0.05)
    return R.value_counts(rows.select(status.alias("status")), "status")


QUERIES = {
    f.__name__: f
    for f in [
        gate_report_by_source, gate_counts, gate_nested_stats, bucket_mean_scores, clip_gate_verdict, motion_bounds_by_source, motion_gate, final_score_fusion, standin_scores, score_histogram, score_statistics, model_means,
        funnel_counts, report_clip_summary, label_distributions, verify_pass_rate, bucket_alias_route, classify_json_normalise, caption_mix_md5, quality_flags, logo_scores, adjective_categories, noun_coverage, caption_stats, actor_status_counts, watermark_states,
    ]
}

_SQL_BUCKET = _bucket_sql("key")
SQL = {
    "gate_report_by_source": f"WITH {_GATED} SELECT source_type, count(*) FILTER (gate = 'final') AS final, count(*) FILTER (gate = 'review') AS review, count(*) FILTER (gate = 'discard') AS discard FROM gated GROUP BY 1",
    "gate_counts": f"WITH {_GATED} SELECT gate, count(*) AS n FROM gated GROUP BY 1",
    "gate_nested_stats": f"""WITH {_GATED}, per AS (SELECT source_type, gate, count(*) AS n, sum(combined) AS s FROM gated GROUP BY ALL)
SELECT source_type, sum(n)::BIGINT AS count, string_agg(gate || ':' || n, ',' ORDER BY gate) AS gate_counts, {r("sum(s) / sum(n)")} AS mean_score FROM per GROUP BY 1""",
    "bucket_mean_scores": f"WITH {_GATED}, k AS (SELECT {_CLEAN_BUCKET} AS key, combined FROM gated WHERE gate = 'final') SELECT {_SQL_BUCKET} AS bucket, count(*) AS n, {r('avg(combined)')} AS mean_combined FROM k GROUP BY 1",
    "clip_gate_verdict": f"""WITH {CUR}, k AS (SELECT *, coalesce({nn('final_score')}, 0) AS s FROM cur)
SELECT clip_id, CASE WHEN NOT coalesce(keep, true) OR coalesce(reject, false) OR s < 0.10 THEN 'DISCARD' WHEN s < 0.18 THEN 'REVIEW' ELSE 'FINAL' END AS verdict FROM k""",
    "motion_bounds_by_source": f"WITH {_BOUNDS} SELECT * FROM b",
    "motion_gate": f"""WITH {_BOUNDS},
k AS (SELECT clip_id, {nn('motion_score')} AS m, coalesce({nn('dover_score')}, 0) AS d, lower, upper FROM cur LEFT JOIN b USING (video_id)),
w AS (SELECT clip_id, CASE WHEN m < lower THEN 'static' WHEN m > upper THEN 'excessive_motion' WHEN d < 0.60 THEN 'low_quality' END AS reason FROM k)
SELECT *, reason IS NULL AS passed FROM w""",
    "final_score_fusion": f"WITH {CUR} SELECT clip_id, CASE WHEN coalesce(keep, true) THEN {r(_FUSED)} ELSE 0.0 END AS fused FROM cur",
    "standin_scores": f"""WITH {CUR},
k AS (
  SELECT clip_id, {r("0.55 + " + md5_mod("coalesce(nullif(caption, ''), 'untitled scene')", 40) + " / 100.0")} AS clip,
         {r("CASE WHEN coalesce(reject, false) THEN 0.1 ELSE least(1.0, 0.5 + " + md5_mod("coalesce(bucket, '')", 35) + " / 100.0 + coalesce(bucket_confidence, 0) * 0.2) END")} AS icr,
         {r("0.45 + " + md5_mod("clip_id", 40) + " / 100.0")} AS aod,
         {r(f"0.7 * (0.45 + ({_BASE8} % 35) / 100.0) + 0.3 * (0.50 + (({_BASE8} >> 8) % 30) / 100.0)")} AS dover
  FROM cur
)
SELECT *, {r("0.35 * clip + 0.40 * icr + 0.25 * aod")} AS final FROM k""",
    "score_histogram": f"""WITH {CUR}, long AS ({_LONG}), ok AS (SELECT * FROM long WHERE v IS NOT NULL AND NOT isnan(v)),
s AS (SELECT metric, 'all' AS scope, v FROM ok UNION ALL SELECT metric, 'kept', v FROM ok WHERE k)
SELECT metric, scope, (CASE WHEN v >= 0 AND v < 0.8 THEN floor(v * 5) ELSE 4 END)::INT AS bin, count(*) AS n, {r("avg(v)")} AS mean FROM s GROUP BY ALL""",
    "score_statistics": f"""WITH {CUR}, long AS ({_LONG}), ok AS (SELECT * FROM long WHERE v IS NOT NULL AND NOT isnan(v))
SELECT metric, count(*) AS n, {r("avg(v)")} AS mean, {r("stddev_samp(v)")} AS std, {r("min(v)")} AS min, {r("max(v)")} AS max, {r("median(v)")} AS median FROM ok GROUP BY 1""",
    "model_means": f"""WITH {CUR} SELECT prompt_version, count(*) AS n, {r("avg(" + nn("icr") + ")")} AS mean_icr, {r("avg(" + nn("aod") + ")")} AS mean_aod, {r("avg(" + nn("motion_score") + ")")} AS mean_motion_score,
count(*) FILTER ({nn("clip_score")} < 0.2) AS low FROM cur GROUP BY 1""",
    "funnel_counts": f"WITH {CUR} " + " UNION ALL ".join(f"SELECT {i}::INT AS step, '{n}' AS stage, count(*) FILTER ({' AND '.join(f'coalesce({c}, false)' for c in _STAGES[: i + 1])}) AS n FROM cur" for i, n in enumerate(["extracted", "kept", "not_rejected", "captioned", "final", "with_actors"])),
    "report_clip_summary": f"""WITH {CUR}, k AS (SELECT *, coalesce(keep, true) AS kp, coalesce(reject, false) AS rj, CASE WHEN coalesce(keep, true) AND NOT coalesce(reject, false) THEN {nn('final_score')} END AS s FROM cur)
SELECT count(*) AS clips, count(*) FILTER (kp) AS kept, count(*) FILTER (NOT kp) AS not_kept, count(*) FILTER (rj) AS rejected, count(*) FILTER (NOT kp AND s2_reject_reason = 'duplicate') AS duplicates,
count(*) FILTER (upper(trim(verdict)) = 'FINAL') AS final, {r("coalesce(min(s), 0)")} AS least_score, {r("coalesce(max(s), 0)")} AS greatest_score, {r("coalesce(avg(s), 0)")} AS mean_score,
{r("coalesce(sum(duration) FILTER (kp AND NOT rj), 0)", 2)} AS kept_seconds FROM k""",
    "label_distributions": f"WITH {CUR}, l AS (SELECT unnest(['s2_reject_reason', 'route', 'verdict']) AS label, unnest([s2_reject_reason, route, verdict]) AS value FROM cur) SELECT label, value, count(*) AS n FROM l GROUP BY ALL",
    "verify_pass_rate": f"""WITH k AS (SELECT greatest(1, least(5, score)) AS s, error, score FROM verify_results), v AS (SELECT CASE WHEN score IS NULL THEN NULL ELSE s END AS s, error FROM k)
SELECT count(*) AS n, count(*) FILTER (coalesce(trim(error), '') <> '') AS errors, {r("avg(s)", 3)} AS mean_score, {r("avg((s - 1) / 4.0)", 3)} AS mean_norm, {r("avg(CASE WHEN s >= 4 THEN 1 ELSE 0 END)", 3)} AS pass_rate FROM v""",
    "bucket_alias_route": f"""WITH {CUR}, k AS (SELECT clip_id, {_CLEAN_BUCKET} AS key FROM cur), b AS (SELECT clip_id, key, {_SQL_BUCKET} AS bucket FROM k)
SELECT clip_id, bucket, CASE WHEN bucket IN ({", ".join(f"'{x}'" for x in V.PEOPLE_BUCKETS)}) THEN 'people' ELSE 'other' END AS route,
CASE WHEN key IN ({", ".join(f"'{x}'" for x in V.IMAGE_BUCKETS)}) THEN key {" ".join(f"WHEN key = '{a}' THEN '{b}'" for a, b in V.IMAGE_ALIASES.items())} ELSE '{V.IMAGE_BUCKETS[0]}' END AS image_bucket FROM b""",
    "classify_json_normalise": f"""WITH {CUR}, k AS (SELECT *, lower(trim(bucket)) AS key, NOT coalesce(keep, true) AS rj FROM cur)
SELECT clip_id, {_SQL_BUCKET} AS bucket, {r("coalesce(nullif(" + nn("bucket_confidence") + ", 0), 0.5)")} AS bucket_confidence, rj AS reject,
CASE WHEN rj AND lower(trim(s2_reject_reason)) NOT IN ('none', 'null', '') THEN s2_reject_reason END AS reject_reason, route AS motion_type FROM k""",
    "caption_mix_md5": f"""WITH {CUR}, k AS (SELECT *, {md5_mod('clip_id', 1000)} < 150 AND trim(coalesce(generated_caption, '')) <> '' AS own FROM cur)
SELECT clip_id, CASE WHEN own THEN generated_caption ELSE caption END AS caption, CASE WHEN own THEN 'original' ELSE 'model' END AS caption_source FROM k""",
    "quality_flags": """
WITH k AS (SELECT l_orderkey, l_linenumber, l_quantity AS g, l_discount * 400 AS f, l_extendedprice / 400 AS sat, l_quantity / 3 AS loc, l_extendedprice / 380 AS br, l_quantity AS con, l_tax * 6 AS txt FROM lineitem),
w AS (SELECT l_orderkey, l_linenumber, list_filter([
  CASE WHEN (g < 25 AND f < 18) OR (sat < 60 AND loc < 11) THEN 'blurry' END, CASE WHEN br < 40 THEN 'too_dark' END, CASE WHEN br > 245 THEN 'overexposed' END,
  CASE WHEN con < 12 THEN 'low_contrast' END, CASE WHEN txt > 0.45 AND g < 500 THEN 'text_heavy' END], lambda x: x IS NOT NULL) AS flags FROM k)
SELECT l_orderkey, l_linenumber, coalesce(array_to_string(flags, '|'), '') AS reasons, len(flags) > 0 AS rejected FROM w""",
    "logo_scores": f"""WITH k AS (SELECT l_orderkey, l_linenumber, l_quantity * 2.0 AS s, l_discount * 2.0 AS e, l_extendedprice / 100 AS l FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN s BETWEEN 18 AND 90 AND e >= 0.10 AND l >= 80 AND NOT (s > 55 AND e < 0.12)
THEN {r("0.35 * least(1.0, (s - 18) / 72.0) + 0.40 * least(1.0, e / 0.10) + 0.25 * least(1.0, l / 80)")} ELSE 0.0 END AS score FROM k""",
    "adjective_categories": f"WITH w AS (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part) SELECT {_adjective_sql()} AS category, count(*) AS n FROM w GROUP BY 1",
    "noun_coverage": f"""WITH {CUR},
k AS (SELECT clip_id, string_split(lower(regexp_replace(trim(coalesce(bucket, 'none')), '[ -]', '_', 'g')), '_') AS nouns,
      list_transform(list_distinct(list_filter(string_split(coalesce(caption, ''), ' '), lambda w: length(w) > 3)), lambda w: lower(w)) AS low, coalesce(caption, '') AS c FROM cur),
h AS (SELECT clip_id, len(nouns) AS n, len(list_filter(nouns, lambda x: len(list_filter(low, lambda l: contains(l, x) OR contains(x, l))) > 0)) AS m FROM k)
SELECT clip_id, CASE WHEN n > 0 THEN {r("least(m / n, 1.0)")} ELSE 0.0 END AS coverage FROM h""",
    "caption_stats": f"""WITH {CUR}, k AS (SELECT {_CLEAN_BUCKET} AS key, length(trim(coalesce(caption, ''))) = 0 AS e, coalesce(contains(caption_struct, '"_parse_error"'), false) AS p FROM cur)
SELECT {_SQL_BUCKET} AS bucket, count(*) AS n, count(*) FILTER (NOT e AND NOT p) AS success, count(*) FILTER (p) AS parse_error, count(*) FILTER (e AND NOT p) AS empty FROM k GROUP BY 1""",
    "actor_status_counts": f"""WITH {CUR}, k AS (SELECT CASE WHEN coalesce(len(clip_actors), 0) = 0 THEN 'no_match' WHEN coalesce({nn('bucket_confidence')}, 0) >= 0.50 AND coalesce({nn('motion_score')}, 0) >= 0.10 THEN 'tagged' ELSE 'low_confidence' END AS actor_status FROM cur)
SELECT actor_status, count(*) AS n FROM k GROUP BY 1""",
    "watermark_states": """WITH k AS (SELECT CASE WHEN l_returnflag <> 'R' THEN 'clean' WHEN NOT (l_linestatus = 'F' AND l_quantity > 20) THEN 'pending_inpaint' WHEN l_discount > 0.05 THEN 'rejected_yolo_verify' ELSE 'cleaned' END AS status FROM lineitem)
SELECT status, count(*) AS n FROM k GROUP BY 1""",
}
