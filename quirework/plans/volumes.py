"""The volume driver: crop, report, submit, archive; one volume after another."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import keys
from quirework.operators import records, summaries
from quirework.plans.pages import PAGE_SCHEMA, pages
from quirework.sources import readers, writers
from quirework.streaming import jobs


@dataclass
class Run:
    volume: str
    crops: int = 0
    skipped: int = 0
    submitted: int = 0
    blank: int = 0
    flagged: int = 0
    error: str | None = None
    artefacts: list[str] = field(default_factory=list)


def volume_images(listing: DataFrame, volume: str, separator: str = "-") -> DataFrame:
    """The volume's files: equality on the volume, so 1768 never takes those of 17689."""
    return listing.where(keys.volume_of(keys.basename(F.col("source_key")), separator) == volume)


def crop(spark: SparkSession, source: str, out: str, volume: str, limit: int | None = None, head_set: str = "classical") -> tuple[DataFrame, int]:
    """The crop records of a volume, new and carried over, and how many sources were skipped."""
    listing = volume_images(readers.listing(spark, source), volume)
    if limit:
        listing = listing.orderBy("source_key").limit(limit)
    from quirework.streaming.runner import done_keys

    done = done_keys(spark, out)
    todo = listing if done is None else listing.join(done, "source_key", "left_anti")
    skipped = listing.count() - todo.count()
    for images in readers.images_of(spark, todo):
        pages(images, head_set).write.mode("append").parquet(f"{out}/results")
    if done_keys(spark, out) is None:
        return records_of(spark.createDataFrame([], PAGE_SCHEMA)), skipped
    results = spark.read.parquet(f"{out}/results").join(listing.select("source_key"), "source_key", "left_semi")
    if results.where("label IS NOT NULL").isEmpty():
        return records_of(results), skipped
    writers.write_views(results, f"{out}/volumes/{volume}")
    return records_of(results), skipped


def records_of(results: DataFrame) -> DataFrame:
    """Crop records in the order of their keys, numbers rounded as the records have them."""
    rows = results.where("label IS NOT NULL")
    return rows.select(keys.crop_key(F.col("source_key"), F.col("label")).alias("crop"), "source_key", "label", "is_blank", "needs_review", "review_reasons", F.round("blank_conf", 3).alias("blank_conf"), F.round("orientation_conf", 3).alias("orientation_conf"), F.round("text_frac", 4).alias("text_frac"), F.round("rotation_deg", 2).alias("rotation_deg"), "ocr_rescued").orderBy("crop")


def run(spark: SparkSession, config: dict, volume: str, service: jobs.Service, out: str, now: str, steps: list[str] | None = None, dry_run: bool = False, submit: bool = True, limit: int | None = None, head_set: str = "classical", sleep: Callable[[float], None] = time.sleep) -> Run:
    """One volume from photographs to archived transcripts. The review report is written before anything is submitted."""
    separator = config["source"].get("separator", "-")
    name = volume.rstrip(separator) if separator else volume
    state = Run(name)
    crops, state.skipped = crop(spark, config["source"]["path"], out, name, limit, head_set)
    report = summaries.review_report(crops.withColumn("volume", F.lit(name)), "volume", F.col("crop"), F.col("is_blank"), F.col("review_reasons"))
    report = report.withColumn("generated", F.lit(now))
    row = report.first()
    if row is None:
        state.error = "no crops"
        return state
    state.crops, state.blank, state.flagged = row["total"], row["blank"], row["flagged"]
    if dry_run:
        return state
    report.write.mode("overwrite").json(f"{out}/review/{name}")
    if not submit:
        return state
    wanted = [r["crop"] for r in crops.where(~F.col("is_blank")).select("crop").collect()]  # the pages of one book
    if not wanted:
        state.error = "all crops blank"
        return state
    title = name.removeprefix(config["api"].get("strip_prefix", "")).rstrip(separator or None)
    try:
        found = jobs.run(service, jobs.metadata(config, title, steps or ["transcribe"]), wanted, sleep=sleep)
    except (jobs.JobFailed, TimeoutError, SystemExit) as e:
        state.error = str(e)
        return state
    state.submitted = len(wanted)
    if not found:
        state.error = "no artefacts"
        return state
    kept, _ = writers.archived(spark.createDataFrame([{"kind": a["kind"], "url": a.get("url", "")} for a in found]), config["transcripts"].get("prefix", ""), title)
    kept = kept.orderBy("key")
    kept.write.mode("overwrite").json(f"{out}/transcripts/{name}")
    state.artefacts = [r["key"] for r in kept.collect()]  # two kinds at most
    manifest = spark.createDataFrame([(json.dumps(state.__dict__ | {"generated": now}),)], "value string")
    manifest.coalesce(1).write.mode("overwrite").text(f"{out}/runs/{name}")
    return state


def run_all(volumes: list[str], one: Callable[[str], Run], keep_going: bool = False) -> list[Run]:
    """The volumes in order, up to the first failure unless told to go on."""
    done = []
    for volume in volumes:
        done.append(one(volume))
        if done[-1].error and not keep_going:
            break
    return done


def carried(new: DataFrame, old: DataFrame) -> DataFrame:
    """New records and those carried over, by crop key."""
    return records.unioned(new, old).orderBy("crop")
