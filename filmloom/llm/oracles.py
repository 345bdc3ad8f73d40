"""SQL with the results of the queries that SQL can express."""

_CURRENT = """
cur AS (
  SELECT * FROM clips WHERE clip_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY processed_at DESC NULLS LAST) = 1
),
standing AS (
  SELECT *, lower(replace(replace(trim(video_id), ' ', '_'), '-', '_')) AS movie,
         CASE WHEN isnan(final_score) THEN NULL ELSE final_score END AS score
  FROM cur WHERE coalesce(keep, true) AND NOT coalesce(reject, false)
)"""

_POOL = """
pool AS (
  SELECT lower(replace(replace(trim(bucket), ' ', '_'), '-', '_')) AS bucket,
         upper(replace(replace(trim(verdict), ' ', '_'), '-', '_')) AS verdict
  FROM cur WHERE bucket IS NOT NULL AND verdict IS NOT NULL
),
size AS (SELECT count(*) // 10 AS size FROM pool),
report AS (
  SELECT t.bucket, t.verdict, size, coalesce(n, 0) AS available,
         greatest(min_clips, (target_permille * size + 999) // 1000) AS wanted
  FROM mix_targets t CROSS JOIN size
  LEFT JOIN (SELECT bucket, verdict, count(*) AS n FROM pool GROUP BY ALL) p USING (bucket, verdict)
)"""

SQL = {
    "p2_found": f"WITH {_CURRENT}, {_POOL} SELECT bucket, verdict FROM report WHERE available < wanted",
    "p3_found": f"""
WITH RECURSIVE {_CURRENT},
pairs AS (
  SELECT clip_id AS a, lower(trim(dup_of)) AS b FROM cur WHERE lower(trim(dup_of)) <> '' AND lower(trim(dup_of)) <> clip_id
  UNION SELECT clip_a, clip_b FROM clip_matches WHERE clip_a <> clip_b AND hamming_distance <= 8
),
arcs AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a, a AS r FROM arcs UNION SELECT reach.a, arcs.b FROM reach JOIN arcs ON reach.r = arcs.a)
SELECT a AS clip_id, min(r) AS group_id FROM reach GROUP BY a""",
    "p4_found": f"""
WITH {_CURRENT},
long AS (
  SELECT batch_id, clip_id, unnest([1, 2, 3, 4]) AS k, unnest([clip_score, icr, aod, dover_score]) AS v0
  FROM standing WHERE batch_id IS NOT NULL
),
vals AS (SELECT batch_id, clip_id, k, CASE WHEN isnan(v0) THEN NULL ELSE v0 END AS v FROM long),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY batch_id, k ORDER BY v NULLS FIRST)
            + (count(*) OVER (PARTITION BY batch_id, k, v) - 1) / 2.0 AS r FROM vals
),
points AS (SELECT batch_id, clip_id, sum(r) AS p FROM ranked GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY p DESC, clip_id) AS place FROM points),
runs AS (SELECT batch_id, arg_max(shortlist_size, started_at) AS shortlist_size FROM score_batches WHERE status = 'done' GROUP BY ALL)
SELECT batch_id, clip_id FROM placed JOIN runs USING (batch_id) WHERE place <= shortlist_size""",
    "p6_found": f"""
WITH {_CURRENT},
placed AS (SELECT clip_id, row_number() OVER (PARTITION BY movie ORDER BY score DESC NULLS LAST, clip_id) AS place FROM standing)
SELECT clip_id FROM placed WHERE place > (SELECT count(*) // 50 FROM standing)""",
}

_CUTOFFS = f"""
WITH {_CURRENT},
reg AS (
  SELECT lower(replace(replace(trim(video_id), ' ', '_'), '-', '_')) AS movie,
         arg_max(coalesce(nullif(lower(replace(replace(trim(source_type), ' ', '_'), '-', '_')), ''), 'youtube'), registered_at) AS kind
  FROM movie_registry GROUP BY 1
),
scored AS (
  SELECT movie, clip_id, score, keep_pct, count(*) OVER (PARTITION BY movie) AS n,
         row_number() OVER (PARTITION BY movie ORDER BY score DESC, clip_id) AS place
  FROM standing JOIN reg USING (movie) JOIN keep_targets k ON k.source_type = reg.kind WHERE score IS NOT NULL
),
cuts AS (SELECT movie, n, (n * keep_pct + 99) // 100 AS target, score AS cutoff FROM scored WHERE place = (n * keep_pct + 99) // 100)"""
SQL["p7_found"] = f"{_CUTOFFS} SELECT clip_id FROM scored JOIN cuts USING (movie) WHERE score >= cutoff"
SQL["p7_cutoffs"] = f"""{_CUTOFFS}
SELECT movie AS video_id, cuts.n, target, cutoff, count(*) AS kept FROM scored JOIN cuts USING (movie) WHERE score >= cutoff GROUP BY ALL"""

SQL["p4_ranking"] = SQL["p4_found"].split("runs AS")[0].rstrip().rstrip(",") + " SELECT batch_id, clip_id, p AS points, place FROM placed"

SQL["p5_found"] = f"""
WITH {_CURRENT},
texts AS (SELECT clip_id, unnest(['caption', 'generated_caption']) AS field, unnest([caption, generated_caption]) AS t FROM cur),
words AS (SELECT clip_id, field, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{M}}]+') AS w FROM texts WHERE t IS NOT NULL),
grams AS (
  SELECT clip_id, field, i, len(w) AS n, array_to_string(w[i + 1 : i + 5], ' ') AS g
  FROM (SELECT *, unnest(range(len(w) - 4)) AS i FROM words WHERE len(w) > 4)
),
again AS (SELECT * FROM grams QUALIFY i > min(i) OVER (PARTITION BY clip_id, field, g)),
covered AS (SELECT DISTINCT clip_id, field, n, i + k AS at FROM (SELECT *, unnest([0, 1, 2, 3, 4]) AS k FROM again))
SELECT clip_id, field FROM covered GROUP BY clip_id, field, n HAVING count(*) >= 0.4 * n"""


def _plain(x: str) -> str:
    """Text without tags, entities, invisible characters, hyphens at line ends and time codes at line starts."""
    x = f"regexp_replace({x}, '</?[A-Za-z][^<>]*>', '', 'g')"
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "’")):
        x = f"replace({x}, '{a}', '{b}')"
    x = f"regexp_replace({x}, '[\\x{{00AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]', '', 'g')"
    x = f"regexp_replace({x}, '[-\\x{{2010}}][ ]*\\n[ ]*', '', 'g')"
    x = f"regexp_replace({x}, '(^|\\n)[ ]*[0-9]+:[0-9]+:[0-9]+', '\\1', 'g')"
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}\\p{{M}}]+')"


_LEAKS = f"""
docs AS (SELECT doc_id, {_plain('text')} AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
items AS (SELECT item_id, {_plain('text')} AS w FROM eval_items WHERE text IS NOT NULL AND item_id IS NOT NULL),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 12], ' ') AS g FROM (SELECT *, unnest(range(len(w) - 11)) AS i FROM docs WHERE len(w) > 11)),
ig AS (SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + 12], ' ') AS g FROM (SELECT *, unnest(range(len(w) - 11)) AS i FROM items WHERE len(w) > 11)),
leaks AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))"""
SQL["p9_found"] = f"WITH {_LEAKS} SELECT doc_id, item_id FROM leaks"
SQL["p9_items"] = f"WITH {_LEAKS} SELECT item_id, count(*) AS documents FROM leaks GROUP BY 1"
