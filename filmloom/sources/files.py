"""Sources: folders of media, sidecars, lists, logs and snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom import schema
from filmloom.functions.naming import file_name, parent_name, slug, stem
from filmloom.functions.vectors import unit

# Extensions of media files.
IMAGES = ["jpg", "jpeg", "png", "webp", "bmp", "tiff"]
VIDEOS = ["mp4", "mkv", "avi", "mov", "webm", "m4v"]


def path_of() -> Column:
    """Path of the file that a row was read from, without scheme."""
    return F.regexp_replace(F.input_file_name(), "^file:/*(?=/)", "")


def media(spark: SparkSession, folder: str, extensions: list[str], *, content: bool = False) -> DataFrame:
    """Files with one of the extensions (any case) below a folder: (path, length[, content]). Without ``content`` no file is read."""
    glob = "*.{" + ",".join(x for e in extensions for x in (e.lower(), e.upper())) + "}"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    path = F.regexp_replace("path", "^file:/*(?=/)", "").alias("path")
    return found.select(path, "length", *(["content"] if content else []))


def movie_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, source_type) of a list with header; blank paths are dropped, the default type is youtube."""
    rows = spark.read.schema(schema.MOVIE_LIST).csv(path, header=True)
    kind = F.coalesce(F.nullif(F.trim("source_type"), F.lit("")), F.lit("youtube"))
    return rows.select(F.trim("path").alias("path"), kind.alias("source_type")).where("path <> ''")


def registry(spark: SparkSession, path: str, *, pending: bool = False) -> DataFrame:
    """Movies of a registry with header; a missing status counts as pending."""
    rows = spark.read.schema(schema.REGISTRY).csv(path, header=True)
    status = F.coalesce(F.nullif(F.trim("status"), F.lit("")), F.lit("pending"))
    rows = rows.withColumn("status", status)
    return rows.where(F.col("status") == "pending") if pending else rows


def precaptioned(spark: SparkSession, folder: str) -> DataFrame:
    """(path, caption_txt) of images with the text file of the same stem, null without one."""
    bare = F.regexp_replace("path", r"\.[^./]*$", "")
    images = media(spark, folder, IMAGES).select("path", bare.alias("s"))
    texts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    texts = texts.select(F.regexp_replace(path_of(), r"\.[^./]*$", "").alias("s"), F.trim("value").alias("caption_txt"))
    return images.join(texts, "s", "left").drop("s")


def source_folders(images: DataFrame, path: str = "path") -> DataFrame:
    """(folder, n) of the folders that hold the images."""
    return images.groupBy(F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("folder")).agg(F.count(F.lit(1)).alias("n"))


def json_lines(spark: SparkSession, path: str, kind: str = schema.CLIP) -> DataFrame:
    """Records of a JSON Lines file or folder; blank lines are skipped, other broken ones fail."""
    return spark.read.schema(kind).option("mode", "FAILFAST").json(path)


def sidecars(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """One row per JSON file of a folder with its stem; unreadable files are left out."""
    rows = spark.read.schema(kind + ", _broken string").option("multiLine", "true").option("columnNameOfCorruptRecord", "_broken").json(f"{folder}/*.json")
    return rows.withColumn("unique_stem", stem(path_of())).where("_broken is null").drop("_broken")


def scorer_input(spark: SparkSession, path: str) -> DataFrame:
    """(image_path, caption, model) of a table with header; a missing column is an error."""
    rows = spark.read.csv(path, header=True)
    missing = {"image_path", "caption", "model"} - set(rows.columns)
    if missing:
        raise ValueError(f"columns missing in {path}: {sorted(missing)}")
    return rows.select("image_path", "caption", "model")


def with_images(records: DataFrame, images: DataFrame) -> DataFrame:
    """Records whose image path is missing get the image of the same stem (the least of several)."""
    by_stem = images.groupBy(stem(F.col("path")).alias("__s")).agg(F.min("path").alias("__p"))
    return records.join(by_stem, F.col("unique_stem") == F.col("__s"), "left").withColumn("image_path", F.coalesce(F.nullif(F.col("image_path"), F.lit("")), F.col("__p"))).drop("__s", "__p")


def distinct_videos(files: DataFrame, real: str = "real_path") -> DataFrame:
    """Videos without those that are the same real file: the least path stays."""
    return files.groupBy(real).agg(F.min("path").alias("path")).select("path", real)


def cached(spark: SparkSession, path: str, kind: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The snapshot at a path, or the computed table, which is written there first. The schema is fixed, nothing is inferred again."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        compute().write.parquet(path)
    return spark.read.schema(kind).parquet(path)


def actor_vectors(spark: SparkSession, path: str, cast: DataFrame | None = None) -> DataFrame:
    """Actor vectors of unit length, of the cast only if one is given (names compared as slugs)."""
    rows = spark.read.schema(schema.ACTOR).parquet(path)
    if cast is not None:
        rows = rows.join(cast.select(slug(F.col("actor_name")).alias("__s")), slug(F.col("actor_name")) == F.col("__s"), "left_semi")
    return rows.withColumn("embedding", unit(F.col("embedding")))


def prompts(spark: SparkSession, folder: str, *, least: int = 12, least_chars: int = 50) -> DataFrame:
    """(number, bucket, prompt) of files ``bucket_NN_slug.txt``; too few of them or too short ones are an error."""
    rows = spark.read.option("pathGlobFilter", "bucket_*.txt").text(folder, wholetext=True)
    rows = rows.select(file_name(path_of()).alias("f"), F.trim("value").alias("prompt"))
    form = r"^bucket_(\d{2})_(.+)\.txt$"
    rows = rows.where(F.col("f").rlike(form)).select(F.regexp_extract("f", form, 1).cast("int").alias("number"), F.regexp_extract("f", form, 2).alias("bucket"), "prompt")
    n, short = rows.agg(F.count(F.lit(1)), F.count_if(F.length("prompt") < least_chars)).first()
    if n < least or short:
        raise ValueError(f"{n} prompts, {short} too short")
    return rows


def movies_of(spark: SparkSession, folder: str, kind: str = schema.CLIP) -> DataFrame:
    """Records of every movie below a folder, with the name of its own folder as ``movie``."""
    return spark.read.schema(kind).json(f"{folder}/*/metadata.jsonl").withColumn("movie", parent_name(path_of()))


def runtime_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Service runs from JSON logs in one folder per service; unreadable ones are left out."""
    rows = spark.read.schema(schema.RUNTIME).option("multiLine", "true").option("mode", "DROPMALFORMED").json(f"{folder}/s*/*_runtime.json")
    return rows.where("service is not null")


def step_times(lines: DataFrame, text: str = "value", order: str = "line") -> DataFrame:
    """(step, seconds) of the last ``Step '<name>' completed in <n>s`` of each step in a log."""
    form = r"Step '(\w+)' completed in ([\d.]+)s"
    hits = lines.where(F.col(text).rlike(form)).select(F.regexp_extract(text, form, 1).alias("step"), F.regexp_extract(text, form, 2).cast("double").alias("seconds"), order)
    return hits.groupBy("step").agg(F.max_by("seconds", order).alias("seconds"))


def manifest(videos: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Videos, images, and (folder, type, source_type, n) of the folders they come from."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")
    both = videos.select("path", "source_type", F.lit("video").alias("type")).unionByName(images.select("path", "source_type", F.lit("image").alias("type")))
    return videos, images, both.groupBy(folder, "type", "source_type").agg(F.count(F.lit(1)).alias("n"))
