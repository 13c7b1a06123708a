"""Sinks: projections of the one table of page results."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import keys

#: image bytes of a (height, width, channels) BGR array
Encoder = Callable[[np.ndarray], bytes]


def png(image: np.ndarray) -> bytes:
    """Lossless, without any image library."""
    x = image[..., ::-1] if image.ndim == 3 else image[..., None]
    h, w, c = x.shape
    raw = np.zeros((h, 1 + w * c), np.uint8)
    raw[:, 1:] = np.ascontiguousarray(x).reshape(h, w * c)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2 if c == 3 else 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes(), 6)) + chunk(b"IEND", b"")


def encoded(pages: DataFrame, encode: Encoder = png, faint: bool = False) -> DataFrame:
    """source_key, label, needs_review and ``content``; with ``faint`` the enhanced copies of faint pages."""
    from quirework.pixels.stages import enhanced

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for c in frame["crop"]:
                x = np.frombuffer(c["data"], np.uint8).reshape(c["height"], c["width"], c["nChannels"])
                x = x[..., 0] if c["nChannels"] == 1 else x
                out.append(encode(enhanced(x) if faint else x))
            yield frame.drop(columns="crop").assign(content=out)

    rows = pages.where("crop IS NOT NULL")
    if faint:
        rows = rows.where((F.col("text_frac") < 0.12) & ~F.col("is_blank"))
    return rows.select("source_key", "label", "needs_review", "crop").mapInPandas(run, "source_key string, label string, needs_review boolean, content binary")


def manifest_rows(pages: DataFrame) -> DataFrame:
    """The manifest's columns, numbers as text with fixed decimals."""
    said = lambda c, n: F.format_string(f"%.{n}f", F.col(c))
    yes = lambda c: F.when(F.col(c), "True").otherwise("False")
    rows = pages.where("label IS NOT NULL")
    return rows.select(
        F.concat(keys.stem(F.col("source_key")), "label", F.lit(".jpg")).alias("file"), "label", "page_count", said("rotation_deg", 3).alias("rotation"), said("orientation_conf", 3).alias("orientation_conf"),
        said("mask_area_frac", 3).alias("mask_area"), said("text_frac", 4).alias("text_frac"), yes("is_blank").alias("is_blank"), yes("needs_review").alias("needs_review"), F.array_join("review_reasons", ";").alias("reasons"), F.col("source_key").alias("source"),
    )


def sidecar_rows(pages: DataFrame) -> DataFrame:
    """One provenance record per image; images with an error have no pages."""
    folio = F.struct("label", "rotation_deg", "orientation_conf", "mask_area_frac", "text_frac", "is_blank", "blank_conf", "needs_review", "review_reasons", "partial_spread", "ocr_rescued", "ocr_flipped", "ocr_margin", "source_size", "crop_quad_norm")
    folios = F.sort_array(F.collect_list(F.when(F.col("label").isNotNull(), folio)))
    head = ["source_key", "page_count", "pre_rotation_k", "seam", "error", "version"]
    return pages.groupBy(*head, F.round("count_conf", 4).alias("count_conf")).agg(folios.alias("folios"))


def coord_rows(pages: DataFrame, prefix: str = "") -> DataFrame:
    """Where each crop lies in its source."""
    rows = pages.where("crop_quad_norm IS NOT NULL")
    return rows.select(keys.crop_key(F.col("source_key"), F.col("label"), prefix).alias("crop"), "source_key", "source_size", "crop_quad_norm", F.lit("TL,TR,BR,BL").alias("corner_order"), "label", "page_count", F.round("rotation_deg", 2).alias("rotation"), "is_blank", "needs_review")


def metadata_rows(pages: DataFrame, prefix: str = "") -> DataFrame:
    """crop and the string map that goes with it as user metadata, from which a resumed run takes its verdict."""
    record = {"blank": F.col("is_blank"), "review": F.col("needs_review"), "reasons": F.array_join("review_reasons", ","), "blank_conf": F.col("blank_conf"), "orientation_conf": F.col("orientation_conf"), "source": F.col("source_key"), "label": F.col("label"), "text_frac": F.col("text_frac"), "rotation": F.col("rotation_deg")}
    meta = keys.encode_metadata(record, {"blank_conf": 3, "orientation_conf": 3, "text_frac": 4, "rotation": 2})
    return pages.where("label IS NOT NULL").select(keys.crop_key(F.col("source_key"), F.col("label"), prefix).alias("crop"), meta.alias("metadata"))


def write_faint(results: DataFrame, path: str) -> None:
    """The enhanced copies of faint pages."""
    encoded(results, faint=True).withColumn("file", F.concat(keys.stem(F.col("source_key")), F.when(F.col("label") != "", F.concat(F.lit("-"), "label")).otherwise(""), F.lit("_enhanced.jpg"))).write.mode("overwrite").parquet(f"{path}/enhanced")


def volume_report(crops: DataFrame, norms: DataFrame, path: str) -> None:
    """One CSV line per crop: its size and aspect against its volume's norm and canvas, and whether it is suspect."""
    said = lambda c: F.format_string("%.3f", F.col(c))
    rows = crops.join(norms, "volume").withColumn("aspect", F.col("w") / F.col("h")).withColumn("deviation", F.abs(F.col("aspect") - F.col("norm")))
    rows = rows.select("file", "volume", "w", "h", said("aspect").alias("aspect"), said("norm").alias("volume_aspect"), said("deviation").alias("deviation"), "canvas_width", "canvas_height", F.when(F.col("deviation") > 0.12, "True").otherwise("False").alias("suspect"))
    rows.write.mode("overwrite").csv(f"{path}/volume_report", header=True)


def on_canvases(crops: DataFrame, norms: DataFrame, fill: int | None = None) -> DataFrame:
    """file and ``crop`` (height, width, nChannels, data) in the middle of its volume's canvas, the rest in the colour of its border."""
    from quirework.pixels.stages import on_canvas

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, c, w, h in zip(frame["file"], frame["crop"], frame["canvas_width"], frame["canvas_height"], strict=True):
                x = on_canvas(np.frombuffer(c["data"], np.uint8).reshape(c["height"], c["width"], c["nChannels"]), int(w), int(h), fill)
                yield pd.DataFrame({"file": [file], "crop": [{"height": x.shape[0], "width": x.shape[1], "nChannels": x.shape[2], "data": x.tobytes()}]})

    rows = crops.join(norms.select("volume", "canvas_width", "canvas_height"), "volume").select("file", "crop", "canvas_width", "canvas_height")
    return rows.mapInPandas(run, "file string, crop struct<height:int,width:int,nChannels:int,data:binary>")


def evaluation(rows: DataFrame, summary: DataFrame, path: str) -> None:
    """The rows of an evaluation as CSV and its summary as one JSON line."""
    rows.write.mode("overwrite").csv(f"{path}/eval_rows", header=True)
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/eval_summary")


def matched_coords(crops: DataFrame, coords: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(coords of the crops that have one, sorted key lists of all crops per volume)."""
    lists = crops.groupBy(keys.volume_of(keys.basename(F.col("crop"))).alias("volume")).agg(F.sort_array(F.collect_list("crop")).alias("crops"))
    return crops.select("crop").join(coords, "crop", "left").where("source_key IS NOT NULL"), lists


def write_results(pages: DataFrame, path: str) -> DataFrame:
    """The results as one table, from which every other sink is projected; returns it, read again."""
    pages.write.mode("append").parquet(f"{path}/results")
    return pages.sparkSession.read.parquet(f"{path}/results")


def write_views(results: DataFrame, path: str) -> None:
    """Sidecars, manifest, coords, crops and (by review flag) their copies for review."""
    sidecar_rows(results).write.mode("overwrite").json(f"{path}/sidecars")
    manifest_rows(results).coalesce(1).write.mode("overwrite").csv(f"{path}/manifest", header=True)
    coord_rows(results).write.mode("overwrite").json(f"{path}/coords")
    metadata_rows(results).write.mode("overwrite").parquet(f"{path}/metadata")
    encoded(results).write.mode("overwrite").partitionBy("needs_review").parquet(f"{path}/crops")
    write_faint(results, path)


def sparse_lists(rows: DataFrame, path: str) -> None:
    """A table of all pages by length, and the names of the sparse ones."""
    rows.write.mode("overwrite").csv(f"{path}/pages", header=True)
    rows.where("sparse").select(F.col("image").cast("string")).write.mode("overwrite").text(f"{path}/sparse")


def archived(artefacts: DataFrame, prefix: str, title: str) -> tuple[DataFrame, DataFrame]:
    """(artefacts to keep with their keys, kinds that are missing). Only the listed kinds are kept, whatever they are called."""
    allowed = artefacts.sparkSession.createDataFrame([("json", ".json"), ("markdown", ".md")], "kind string, extension string")
    kept = artefacts.join(F.broadcast(allowed), "kind").withColumn("key", F.concat(F.lit(f"{prefix}{title}"), "extension"))
    return kept, allowed.join(artefacts.select("kind").distinct(), "kind", "left_anti")


def preflight(spark: SparkSession, sources: list[str], destinations: list[str]) -> list[str]:
    """What is wrong with the folders: each must be listable, the destinations writable too."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    failures = []
    for uri in [*sources, *destinations]:
        try:
            path = jvm.org.apache.hadoop.fs.Path(uri)
            fs = path.getFileSystem(conf)
            fs.listStatus(path)
            if uri in destinations:
                probe = jvm.org.apache.hadoop.fs.Path(path, "_probe")
                fs.create(probe, True).close()
                fs.delete(probe, False)
        except Exception as e:
            failures.append(f"{uri}: {str(e).splitlines()[0]}")
    return failures
