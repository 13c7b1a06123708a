"""Scans: images, object listings, CSV and JSON records, class folders."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import keys, text

MANIFEST = "file string, label string, page_count string, rotation double, orientation_conf double, mask_area double, text_frac double, is_blank boolean, needs_review boolean, reasons string, source string"
TRANSCRIPTS = "array<struct<file:string,transcription:string>>"
IMAGE_GLOB = "*.{jpg,jpeg,png,tif,tiff,JPG,JPEG,PNG,TIF,TIFF}"


def plain_uri(uri: Column) -> Column:
    """Local files are named file:/x by one of Spark's sources and file:///x by another; here file:/x."""
    return F.regexp_replace(uri, "^file:///", "file:/")


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths (or patterns) that name something."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        if at.getFileSystem(conf).globStatus(at):
            found.append(p)
    return found


def listing(spark: SparkSession, paths: list[str] | str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """source_key, length and modification time of image files, by name; the files are not read. A path that is not there has none."""
    paths = existing(spark, [paths] if isinstance(paths, str) else paths)
    if not paths:
        return spark.createDataFrame([], "source_key string, length long, modificationTime timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern or "*").load(paths)
    return files.select(F.col("path").alias("source_key"), "length", "modificationTime").where(keys.is_image(F.col("source_key"))).orderBy("source_key")


def uploads(spark: SparkSession, path: str) -> DataFrame:
    """Files that may be handed on for transcription: images and PDFs; a folder without any raises."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("source_key"), "length")
    files = files.where(keys.is_image(F.col("source_key")) | F.col("source_key").rlike(r"(?i)\.pdf$"))
    if files.isEmpty():
        raise FileNotFoundError(f"nothing to upload in {path}")
    return files


def crops(spark: SparkSession, path: str) -> DataFrame:
    """The crops of a folder, by name: JPEG only."""
    return listing(spark, path, "*.jpg")


def images(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """source_key, height, width, nChannels and BGR data; a file that cannot be decoded keeps a row with height -1."""
    found = spark.read.format("image").option("dropInvalid", False).option("pathGlobFilter", IMAGE_GLOB).load(paths)
    return found.select(plain_uri(F.col("image.origin")).alias("source_key"), "image.height", "image.width", "image.nChannels", "image.data")


def images_of(spark: SparkSession, wanted: DataFrame, at_once: int = 10_000) -> Iterator[DataFrame]:
    """The images of the wanted keys, so many files in each DataFrame.

    The keys are filtered before anything is read: only their files are opened and decoded, and no pixel is
    shuffled. The driver holds the keys of one batch at a time."""
    keys_left = (r["source_key"] for r in wanted.select("source_key").toLocalIterator())
    while batch := list(islice(keys_left, at_once)):
        yield images(spark, batch)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=MANIFEST)


def rectangles(spark: SparkSession, path: str) -> DataFrame:
    """FILE and the rectangle of ground-truth rows."""
    rows = spark.read.csv(path, header=True, schema="FILE string, ANCHOR string")
    return rows.select(F.col("FILE").alias("file"), keys.parse_rect(F.col("ANCHOR")).alias("r")).select("file", "r.*")


def labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="path string, count string, input_k int")


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of transcription files (JSON lists, also spoilt ones): volume, file, transcription."""
    files = spark.read.text(path, wholetext=True).select(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("path"), "value")
    rows = files.select(keys.stem(F.col("path")).alias("volume"), F.explode(text.lenient_records(F.col("value"), TRANSCRIPTS)).alias("r"))
    return rows.select("volume", "r.file", "r.transcription")


def sidecars(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Provenance records, one row per page: a JSON document in each file, or (as our own sink writes them) in each line."""
    found = spark.read.json(path, multiLine=not lines)
    return found.select("source_key", "page_count", "count_conf", *(["error"] if "error" in found.columns else [F.lit(None).cast("string").alias("error")]), F.explode_outer("folios").alias("folio")).select("source_key", "page_count", "count_conf", "error", "folio.*")


def review_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def class_folders(spark: SparkSession, path: str) -> DataFrame:
    """Files in class folders with the folder's name as label."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("source_key"), F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("label")).where(keys.is_image(F.col("source_key")))
