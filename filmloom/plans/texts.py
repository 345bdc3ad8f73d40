"""Queries on captions and answers of models, on streams, and on whole runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import captions as C
from filmloom.functions import scoring as S
from filmloom.functions.hashing import hamming, phash_bits, simhash
from filmloom.functions.names import repair_names
from filmloom.functions.rounding import rounded
from filmloom.plans import stages
from filmloom.plans.base import CUR, clips, nn, r
from filmloom.session import checkpoint_dir
from filmloom.sources.tables import table
from filmloom.streaming import microbatch


def json_repair(spark, folder: str) -> DataFrame:
    """The description that each generated caption holds as an object, whole, fenced or broken off."""
    rows = clips(spark, folder, "generated_caption")
    g = F.col("generated_caption")
    return rows.select("clip_id", C.json_text(g, "short_description").alias("described"), C.rescued_description(g).alias("rescued"), C.repair_json(g).isNotNull().alias("whole"))


def single_line(spark, folder: str) -> DataFrame:
    """Each structured caption on one line."""
    rows = clips(spark, folder, "caption_struct")
    return rows.select("clip_id", C.single_line_json(F.col("caption_struct")).alias("line"))


def caption_coerce(spark, folder: str) -> DataFrame:
    """Plain text of each caption, and the prose for exports."""
    rows = clips(spark, folder, "caption", "generated_caption", "caption_struct")
    return rows.select("clip_id", C.caption_text(F.col("caption")).alias("text"))


def caption_prose(spark, folder: str) -> DataFrame:
    """The prose caption for exports and the one for reviewers."""
    rows = clips(spark, folder, "caption", "generated_caption", "caption_struct")
    return C.with_captions(rows, "caption", "generated_caption", "caption_struct", review="review").select("clip_id", "prose", "review")


_LEADS = ["In the video clip, ", "In this clip ", "The video shows ", "This clip depicts ", ""]


def caption_strip_openers(spark, folder: str) -> DataFrame:
    """Captions with an opener put before them and taken off again."""
    rows = clips(spark, folder, "caption").where("caption is not null")
    lead = F.element_at(F.array(*[F.lit(x) for x in _LEADS]), (F.length("caption") % len(_LEADS) + 1).cast("int"))
    text = F.concat(lead, F.lower(F.substring("caption", 1, 1)), F.substring("caption", 2, 1 << 30))
    return rows.select("clip_id", C.strip_openers(text).alias("caption"))


def verify_score_parse(spark, folder: str) -> DataFrame:
    """Scores and explanations written as answers and read back."""
    rows = table(spark, folder, "verify_results").select("clip_id", "checked_at", "score", F.trim(F.coalesce("explanation", F.lit(""))).alias("e")).distinct()
    answer = F.concat(F.lit("Checked.\n"), F.coalesce(F.col("score").cast("string"), F.lit("none")), F.lit(". "), F.col("e"))
    p = C.parsed_score(answer)
    return rows.select("clip_id", "checked_at", p.alias("p")).select("clip_id", "checked_at", "p.score", "p.explanation")


def caption_mentions(spark, folder: str) -> DataFrame:
    """Clips whose caption names an actor, with the number of names."""
    rows = clips(spark, folder, "clip_actors", "caption").where("caption is not null and size(clip_actors) > 0")
    m = C.mentions(F.col("clip_actors"), F.col("caption"))
    return rows.select("clip_id", F.size(m).alias("named"), F.size("clip_actors").alias("tagged"))


def prompt_texts(spark, folder: str) -> DataFrame:
    """Prompt of each clip from its bucket, its cast and a short label."""
    rows = clips(spark, folder, "bucket", "clip_actors", "route")
    base = F.concat(F.lit("Describe "), F.coalesce("bucket", F.lit("it")))
    return rows.select("clip_id", C.caption_prompt(base, F.col("clip_actors"), F.col("route")).alias("prompt"))


def caption_actor_repair(spark, folder: str) -> DataFrame:
    """Actor names put into captions, and wrong uses found."""
    rows = clips(spark, folder, "caption", "clip_actors")
    sex = F.transform("clip_actors", lambda n: F.when(F.length(n) % 2 == 0, "male").otherwise("female"))
    return repair_names(rows, "caption", "clip_actors", sex).select("clip_id", "caption_fixed", "over_tagged")


def document_simhash(spark, folder: str) -> DataFrame:
    """64-bit SimHash of each document over pairs of words."""
    return simhash(table(spark, folder, "documents").select("doc_id", F.lower("text").alias("text")), "doc_id", "text")


def hash_distance(spark, folder: str) -> DataFrame:
    """Hamming distance of each clip's hash from the alternating bit pattern."""
    rows = clips(spark, folder, "phash")
    bits = phash_bits(F.col("phash"))
    return rows.select("clip_id", hamming(bits, F.lit(0x5555555555555555)).alias("distance"))


def clip_pipeline(spark, folder: str) -> DataFrame:
    """All stages over the current clips in score-only mode: reasons, scores and verdicts."""
    rows = clips(spark, folder, "video_id", "phash", "timestamp_start", "keep", "reject", "motion_score", "dover_score", "clip_score", "bucket", "bucket_confidence", "caption", "generated_caption", "caption_struct", dup_of=F.lit(None).cast("string"))
    rows = rows.withColumns({"bits": phash_bits(F.col("phash")), "motion_score": S.known(F.col("motion_score"))})
    out = stages.run(rows, stages.Config.of({"score_only": True}))
    return out.select("clip_id", "keep", "dup_of", "s2_reject_reason", "bucket", "route", "final_score", "verdict")


def stream_gate_microbatch(spark, folder: str) -> DataFrame:
    """Events of a file stream through a cheap filter and a gate, micro-batch by micro-batch, as the table they leave."""
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    source = table(spark, folder, "events")
    stream = microbatch.file_stream(spark, f"{folder.rstrip('/')}/events.parquet", source.schema)

    def work(rows: DataFrame) -> DataFrame:
        dear, _ = microbatch.split(rows, F.col("value") > 10)
        score = F.col("value") / 400
        return dear.select("event_id", "event_type", rounded(score).alias("score"), S.image_gate(score).alias("gate"))

    microbatch.run_once(stream, work, f"{base}/out", f"{base}/state", ["event_id"])
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type", "score", "gate")


def event_windows(spark, folder: str) -> DataFrame:
    """Events per type and window of an hour, as the streaming form counts them too."""
    e = table(spark, folder, "events")
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def props_values(spark, folder: str) -> DataFrame:
    """Sum and number of the keys in the events' JSON properties."""
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, folder, "events").select("event_type", v.alias("k")).groupBy("event_type").agg(F.sum("k").alias("total"), F.count("k").alias("n"))


QUERIES = {
    f.__name__: f
    for f in [json_repair, single_line, caption_coerce, caption_prose, caption_strip_openers, verify_score_parse, caption_mentions, prompt_texts, caption_actor_repair, document_simhash, hash_distance, clip_pipeline, stream_gate_microbatch, event_windows, props_values]
}

_BARE = "trim(regexp_replace(regexp_replace(trim(generated_caption), '^```(json)?\\s*', ''), '\\s*```$', ''))"
_WIDE = "regexp_extract(generated_caption, '(?s)\\{.*\\}', 0)"
_OBJECT = f"CASE WHEN json_valid({_BARE}) AND {_BARE} LIKE '{{%' THEN {_BARE} WHEN json_valid({_WIDE}) AND {_WIDE} LIKE '{{%' THEN {_WIDE} END"
_RESCUE = """nullif(regexp_extract({0}, '"short_description"\\s*:\\s*"([^"]*)"', 1), '')"""

SQL = {
    "json_repair": f"WITH {CUR} SELECT clip_id, ({_OBJECT}) ->> '$.short_description' AS described, {_RESCUE.format('generated_caption')} AS rescued, ({_OBJECT}) IS NOT NULL AS whole FROM cur",
    "caption_coerce": f"""WITH {CUR}, k AS (SELECT clip_id, trim(coalesce(caption, '')) AS t, trim(regexp_replace(regexp_replace(trim(coalesce(caption, '')), '^```(json)?\\s*', ''), '\\s*```$', '')) AS b, regexp_extract(caption, '(?s)\\{{.*\\}}', 0) AS w FROM cur),
o AS (SELECT *, CASE WHEN json_valid(b) AND b LIKE '{{%' THEN b WHEN json_valid(w) AND w LIKE '{{%' THEN w END AS j FROM k)
SELECT clip_id, CASE WHEN t LIKE '{{%' AND contains(t, 'short_description') THEN coalesce(nullif(trim(j ->> '$.short_description'), ''), {_RESCUE.format('t')}, t) ELSE t END AS text FROM o""",
    "caption_strip_openers": f"""WITH {CUR}, k AS (SELECT clip_id, caption, ['In the video clip, ', 'In this clip ', 'The video shows ', 'This clip depicts ', ''][length(caption) % 5 + 1] AS lead FROM cur WHERE caption IS NOT NULL),
t AS (SELECT clip_id, CASE WHEN lead = '' OR trim(caption) = '' THEN trim(lead || caption) ELSE trim(caption) END AS c FROM k)
SELECT clip_id, CASE WHEN c IN ('In the video clip,', 'In this clip', 'The video shows', 'This clip depicts') THEN '' ELSE upper(substr(c, 1, 1)) || substr(c, 2) END AS caption FROM t""",
    "verify_score_parse": "WITH k AS (SELECT DISTINCT clip_id, checked_at, score, trim(coalesce(explanation, '')) AS e FROM verify_results) SELECT clip_id, checked_at, CASE WHEN score BETWEEN 1 AND 5 THEN score END::INT AS score, CASE WHEN score BETWEEN 1 AND 5 THEN trim(CASE WHEN e = '' THEN 'Checked.' ELSE e || ' Checked.' END) END AS explanation FROM k",
    "caption_mentions": f"WITH {CUR} SELECT clip_id, len(list_filter(clip_actors, lambda a: contains(lower(caption), lower(a))))::INT AS named, len(clip_actors)::INT AS tagged FROM cur WHERE caption IS NOT NULL AND len(clip_actors) > 0",
    "prompt_texts": f"""WITH {CUR} SELECT clip_id, CASE WHEN coalesce(len(clip_actors), 0) > 0 THEN 'Identified cast: ' || array_to_string(clip_actors, ' and ') || '. Use each full name.' || chr(10) || chr(10) ELSE '' END
|| 'Describe ' || coalesce(bucket, 'it') || CASE WHEN trim(coalesce(route, '')) <> '' AND length(trim(route)) <= 100 THEN chr(10) || chr(10) || 'Known fact: ' || trim(route) ELSE '' END AS prompt FROM cur""",
    "hash_distance": f"""WITH {CUR} SELECT clip_id, CASE WHEN regexp_full_match(lower(trim(phash)), '[0-9a-f]{{16}}') THEN bit_count(xor(('0x' || lower(trim(phash)))::UBIGINT, 6148914691236517205::UBIGINT)::HUGEINT)::INT END AS distance FROM cur""",
    "stream_gate_microbatch": f"SELECT event_id, event_type, {r('value / 400')} AS score, CASE WHEN value / 400 >= 0.25 THEN 'final' WHEN value / 400 >= 0.15 THEN 'review' ELSE 'discard' END AS gate FROM events WHERE value > 10 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1",
    "document_simhash": f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, unnest(list_zip(w[:-2], w[2:])) AS z FROM w WHERE len(w) > 1), h AS (SELECT doc_id, ('0x' || substr(md5(z[1] || ' ' || z[2]), 1, 16))::UBIGINT AS h FROM p),
v AS (SELECT doc_id, {" + ".join(f"CASE WHEN 2 * sum((h >> {k}) & 1) > count(*) THEN {1 << k}::HUGEINT ELSE 0 END" for k in range(64))} AS u FROM h GROUP BY 1)
SELECT doc_id, CASE WHEN u >= 9223372036854775808 THEN (u - 18446744073709551616)::BIGINT ELSE u::BIGINT END AS simhash FROM v""",
    "event_windows": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
    "props_values": "SELECT event_type, sum((props ->> '$.k')::BIGINT)::BIGINT AS total, count(props ->> '$.k') AS n FROM events GROUP BY 1",
}
