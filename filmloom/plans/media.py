"""Queries on vectors, boxes and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import geometry as G
from filmloom.functions.pixels import image_measures
from filmloom.functions.rounding import rounded
from filmloom.functions.vectors import correlation, cosine, norm
from filmloom.operators import similarity as M
from filmloom.plans.base import r
from filmloom.sources.tables import table


def _faces(spark, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings")


def actor_centroids(spark, folder: str) -> DataFrame:
    """Unit mean vector of each label, one row per position."""
    c = M.centroids(_faces(spark, folder), "label", "embedding")
    return c.select("label", "n", F.posexplode("embedding").alias("k", "x")).select("label", "n", "k", rounded("x").alias("x"))


def actor_assign_top1(spark, folder: str) -> DataFrame:
    """The nearest label of each vector, above the least similarity."""
    f = _faces(spark, folder)
    return M.assign(f, "vec_id", "embedding", M.centroids(f, "label", "embedding"), "label", "embedding").select("vec_id", "label", "similarity")


def actor_assign_margin(spark, folder: str) -> DataFrame:
    """The same with the lead over the second one; labels are compatible with vectors of the same parity or none."""
    f = _faces(spark, folder).withColumn("sex", F.when(F.col("vec_id") % 3 != 0, (F.col("vec_id") % 2).cast("string")))
    c = M.centroids(f, "label", "embedding").withColumn("sex", (F.col("label") % 2).cast("string"))
    return M.assign(f, "vec_id", "embedding", c, "label", "embedding", least_margin=0.10, item_class="sex", label_class="sex")


def actor_consensus(spark, folder: str) -> DataFrame:
    return M.consensus(_faces(spark, folder), "label", "vec_id", "embedding").withColumn("mean_similarity", rounded("mean_similarity"))


def vector_measures(spark, folder: str) -> DataFrame:
    """Length of each vector, and its similarity and correlation with its own reverse."""
    f = _faces(spark, folder)
    v = F.col("embedding")
    back = F.reverse(v)
    return f.select("vec_id", rounded(norm(v)).alias("length"), rounded(cosine(v, back)).alias("cosine"), rounded(correlation(v, back)).alias("correlation"))


def _boxes(spark, folder: str) -> DataFrame:
    """Boxes from order lines: one frame per order."""
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    x, y = (F.col("l_partkey") % 1000).cast("int"), (F.col("l_suppkey") % 500).cast("int")
    return table(spark, folder, "lineitem").select("l_orderkey", n.alias("n"), F.array(x, y, x + q * 20, y + q * 12).alias("box"))


def box_iou_match(spark, folder: str) -> DataFrame:
    """For each box the later box of the frame that it overlaps most."""
    b = _boxes(spark, folder)
    odd, even = b.where("n % 2 = 1"), b.where("n % 2 = 0").select("l_orderkey", F.col("n").alias("m"), "box")
    return M.match_boxes(odd, even, ["l_orderkey"], "n", "m", "box").withColumn("iou", rounded("iou"))


def screen_positions(spark, folder: str) -> DataFrame:
    b = _boxes(spark, folder)
    w, h = F.lit(1920), F.lit(1080)
    pct = F.transform(F.col("box"), lambda v: (v % 100).cast("double"))
    return b.select(
        "l_orderkey",
        "n",
        G.screen_position(F.col("box"), w, h).alias("position"),
        G.horizontal_position(F.col("box"), F.lit("1200:800:0:0")).alias("side"),
        (G.area(F.col("box")) > 0.15 * 1920 * 1080).alias("implausible"),
        F.array_join(G.corner_box(F.when(F.col("n") % 2 == 0, "top_right").otherwise("bottom_left"), w, h).cast("array<string>"), ",").alias("corner"),
        G.box_pixels(pct, w, h).isNull().alias("too_small"),
    )


def pixel_measures(spark, folder: str) -> DataFrame:
    """Brightness and contrast of small grey frames made from vectors."""
    f = _faces(spark, folder)
    grey = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(x.cast("double") * 40 + 128, F.lit(0.0)), F.lit(255.0))).cast("int"))
    hexed = F.array_join(F.transform(grey, lambda g: F.lpad(F.hex(g.cast("bigint")), 2, "0")), "")
    m = image_measures(F.unhex(hexed), F.lit(8), F.lit(8))
    return f.select("vec_id", m.alias("m")).select("vec_id", rounded("m.brightness").alias("brightness"), rounded("m.contrast").alias("contrast"))


QUERIES = {f.__name__: f for f in [actor_centroids, actor_assign_top1, actor_assign_margin, actor_consensus, vector_measures, box_iou_match, screen_positions, pixel_measures]}

_UNIT = """
e AS (SELECT vec_id, label, unnest(range(64)) AS k, unnest(embedding)::DOUBLE AS x FROM embeddings),
n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY 1),
u AS (SELECT vec_id, label, k, x / n AS x FROM e JOIN n USING (vec_id)),
m AS (SELECT label, k, avg(x) AS x, count(*) AS n FROM u GROUP BY 1, 2),
l AS (SELECT label, sqrt(sum(x * x)) AS l FROM m GROUP BY 1),
c AS (SELECT label, k, x / l AS x, n FROM m JOIN l USING (label))"""
_SIM = f"WITH {_UNIT}, s AS (SELECT vec_id, c.label, sum(u.x * c.x) AS s FROM u JOIN c USING (k) GROUP BY 1, 2)"
_BOXES = "b AS (SELECT l_orderkey, l_linenumber AS n, (l_partkey % 1000)::INT AS x, (l_suppkey % 500)::INT AS y, l_quantity::INT AS q FROM lineitem)"

SQL = {
    "actor_centroids": f"WITH {_UNIT} SELECT label, n, k::INT AS k, {r('x')} AS x FROM c",
    "actor_assign_top1": f"{_SIM} SELECT vec_id, CASE WHEN {r('max(s)')} >= 0.35 THEN arg_max(label, s) END AS label, {r('max(s)')} AS similarity FROM s GROUP BY 1",
    "actor_assign_margin": f"""{_SIM}, k AS (SELECT * FROM s WHERE vec_id % 3 = 0 OR vec_id % 2 = label % 2),
t AS (SELECT vec_id, label, s, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC) AS i, lead(s) OVER (PARTITION BY vec_id ORDER BY s DESC) AS s2 FROM k),
p AS (SELECT vec_id, label, {r('s')} AS similarity, {r('s - coalesce(s2, 0)')} AS margin FROM t WHERE i = 1)
SELECT vec_id, CASE WHEN similarity >= 0.35 AND margin >= 0.10 THEN label END AS label, similarity, margin FROM p""",
    "actor_consensus": f"""WITH {_UNIT}, s AS (SELECT vec_id, u.label, round(sum(u.x * m.x), 6) AS s, max(m.n) AS n FROM u JOIN m USING (label, k) GROUP BY 1, 2), k AS (SELECT * FROM s WHERE n >= 5)
SELECT label, vec_id, {r('s')} AS mean_similarity, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) = 1 AS is_consensus, s >= 0.35 AS keep FROM k""",
    "vector_measures": f"""WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(list_reverse(embedding))::DOUBLE AS y FROM embeddings)
SELECT vec_id, {r('sqrt(sum(x * x))')} AS length, {r('sum(x * y) / sum(x * x)')} AS cosine, {r('corr(x, y)')} AS correlation FROM e GROUP BY 1""",
    "box_iou_match": f"""WITH {_BOXES}, p AS (
  SELECT a.l_orderkey, a.n, c.n AS m, greatest(least(a.x + a.q * 20, c.x + c.q * 20) - greatest(a.x, c.x), 0)::BIGINT * greatest(least(a.y + a.q * 12, c.y + c.q * 12) - greatest(a.y, c.y), 0) AS i,
         a.q::BIGINT * a.q * 240 + c.q::BIGINT * c.q * 240 AS s
  FROM b a JOIN b c ON a.l_orderkey = c.l_orderkey AND a.n % 2 = 1 AND c.n % 2 = 0),
k AS (SELECT *, i / (s - i) AS iou FROM p WHERE i > 0)
SELECT l_orderkey, n, m, {r(r('iou', 6))} AS iou FROM k WHERE iou > 0 QUALIFY row_number() OVER (PARTITION BY l_orderkey, n ORDER BY iou DESC, m) = 1""",
    "screen_positions": f"""WITH {_BOXES}, k AS (SELECT *, (2 * x + q * 20) / 2.0 AS cx, (2 * y + q * 12) / 2.0 AS cy FROM b),
t AS (SELECT *, CASE WHEN cx / 1920 < 0.33 THEN 'left' WHEN cx / 1920 > 0.66 THEN 'right' ELSE 'center' END AS px, CASE WHEN cy / 1080 < 0.33 THEN 'top' WHEN cy / 1080 > 0.66 THEN 'bottom' ELSE 'middle' END AS py FROM k),
z AS (SELECT *, floor((x % 100) / 100.0 * 1920) AS a, floor((y % 100) / 100.0 * 1080) AS b_, floor(((x + q * 20) % 100) / 100.0 * 1920) AS c_, floor(((y + q * 12) % 100) / 100.0 * 1080) AS d_ FROM t)
SELECT l_orderkey, n, CASE WHEN px = 'center' AND py = 'middle' THEN 'center' ELSE py || '-' || px END AS position,
CASE WHEN cx / 1200 < 0.4 THEN 'left' WHEN cx / 1200 > 0.6 THEN 'right' ELSE 'center' END AS side, q::BIGINT * q * 240 > 0.15 * 1920 * 1080 AS implausible,
CASE WHEN n % 2 = 0 THEN '1800,0,120,50' ELSE '0,1030,120,50' END AS corner, NOT (c_ - a >= 10 AND d_ - b_ >= 10) AS too_small FROM z""",
    "pixel_measures": f"""WITH e AS (SELECT vec_id, floor(least(greatest(unnest(embedding)::DOUBLE * 40 + 128, 0), 255)) AS g FROM embeddings)
SELECT vec_id, {r('avg(g)')} AS brightness, {r('stddev_pop(g)')} AS contrast FROM e GROUP BY 1""",
}
