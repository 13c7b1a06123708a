"""Keyed records: resume, joins with truth and masks, unions, ordering and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import keys


def resume(sources: DataFrame, existing: DataFrame, key: str = "source_key", crop: str = "crop", prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """(sources still to do, existing crops of the others).

    A source is done if any crop that it may have led to exists; those crops are carried forward. The
    existing keys are joined on equality, so a volume never matches the keys of a longer name."""
    wanted = sources.select(key, F.explode(keys.expected_keys(F.col(key), prefix)).alias(crop))
    done = wanted.join(existing.select(crop).distinct(), crop, "left_semi")
    return sources.join(done.select(key).distinct(), key, "left_anti"), done


def resume_by_stem(sources: DataFrame, done: DataFrame, key: str = "source_key", crop: str = "crop") -> DataFrame:
    """Sources whose stem has no crop; a crop's stem is without its page label."""
    stems = done.select(F.regexp_replace(keys.stem(F.col(crop)), "-?[AB]$", "").alias("_stem")).distinct()
    return sources.withColumn("_stem", keys.stem(F.col(key))).join(stems, "_stem", "left_anti").drop("_stem")


def resume_local(sources: DataFrame, existing: DataFrame, key: str = "source_key", name: str = "name") -> DataFrame:
    """Sources whose crop (``stem.jpg``) or left crop (``stem-A.jpg``) is not there yet; a right crop alone shows a broken run and counts for nothing."""
    done = existing.select(F.col(name).alias("_file")).distinct()
    wanted = sources.select(key, F.explode(F.array(*(F.concat(keys.stem(F.col(key)), F.lit(end)) for end in (".jpg", "-A.jpg")))).alias("_file"))
    return sources.join(wanted.join(done, "_file", "left_semi").select(key).distinct(), key, "left_anti")


def with_review(crops: DataFrame, manifest: DataFrame, name: str = "file", flag: str = "needs_review") -> DataFrame:
    """Crops with their review flag from the manifest; one that it does not list is not flagged."""
    return crops.join(manifest.select(name, flag), name, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def flagged_for(crops: DataFrame, reasons: Column, reason: str) -> DataFrame:
    return crops.where(F.array_contains(reasons, reason))


def with_place(crops: DataFrame, coords: DataFrame, originals: DataFrame) -> DataFrame:
    """Crops with their place in an original that is there; a crop without coords, place or original is left out."""
    known = coords.where("source_key IS NOT NULL AND source_size IS NOT NULL AND crop_quad_norm IS NOT NULL")
    return crops.join(known, "crop").join(originals, "source_key")


def upload_targets(urls: DataFrame, files: DataFrame) -> DataFrame:
    """Each upload address (name, url) with the local file of that base name (source_key); ``unknown`` where there is none."""
    own = files.select(keys.basename(F.col("source_key")).alias("name"), "source_key")
    return urls.join(own, "name", "left").withColumn("unknown", F.col("source_key").isNull())


def unioned(new: DataFrame, carried: DataFrame) -> DataFrame:
    """New and carried records; what one side lacks is null there."""
    return new.unionByName(carried, allowMissingColumns=True)


def with_truth(predicted: DataFrame, truth: DataFrame, on: str) -> DataFrame:
    """Every prediction, with its truth where it is known."""
    return predicted.join(truth, on, "left")


def first_match(images: DataFrame, masks: DataFrame, key: str, preference: Column) -> DataFrame:
    """Each image with its most preferred mask."""
    order = Window.partitionBy(key).orderBy(preference)
    return images.join(masks.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n"), key)


def common_names(*sets: DataFrame, key: str) -> DataFrame:
    """The rows of several crop sets that share a name (enhanced copies left out), joined one after another."""
    kept = [s.where(~F.col(key).contains("_enhanced")) for s in sets]
    out = kept[0]
    for other in kept[1:]:
        out = out.join(other, key)
    return out


def control_set(everything: DataFrame, flagged: DataFrame, key: str, n: int = 60) -> DataFrame:
    """At most n keys that are not flagged, the first in order."""
    return everything.join(flagged.select(key).distinct(), key, "left_anti").orderBy(key).limit(n)


def top_boxes(boxes: DataFrame, image: str, score: Column, left: Column, n: int, *ties: Column) -> DataFrame:
    """The n best boxes of each image, numbered from left to right."""
    best = Window.partitionBy(image).orderBy(score.desc(), *ties)
    across = Window.partitionBy(image).orderBy(left, *ties)
    return boxes.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= n).drop("_n").withColumn("position", F.row_number().over(across))


def reading_order(boxes: DataFrame, page: str, x: Column, y: Column, height: Column, *ties: Column) -> DataFrame:
    """Boxes numbered line by line; a line is a twentieth of the page's height."""
    line = F.floor(y / F.greatest(F.lit(1), F.floor(height / 20)))
    return boxes.withColumn("line", line.cast("long")).withColumn("position", F.row_number().over(Window.partitionBy(page).orderBy("line", x, *ties)))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in an order that a seed fixes."""
    return rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def train_valid(rows: DataFrame, key: str, seed: int, valid: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """A split by a seeded hash of the key: the same row always falls on the same side."""
    held = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(10_000)) < int(10_000 * valid)
    return rows.where(~held), rows.where(held)


def systematic_sample(rows: DataFrame, group: str, order: list[str], step: int) -> DataFrame:
    """Every step-th row of each group, from the first on."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("n", n).where((F.col("n") - 1) % step == 0)


def vocabulary_violations(chosen: DataFrame, allowed: DataFrame, on: list[str]) -> DataFrame:
    """Chosen values that are not allowed, each once."""
    return chosen.select(*on).distinct().join(allowed, on, "left_anti")


def latest_status(log: DataFrame, job: str, status: str, at: list[str]) -> DataFrame:
    """The last status of each job and whether the job has come to an end."""
    last = F.max_by(status, F.struct(*at)).alias("status")
    return log.groupBy(job).agg(last, F.count("*").alias("n_events"))
