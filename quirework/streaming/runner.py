"""The streaming page runner: new files in, results appended, work done before skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from quirework.config import Settings
from quirework.functions import keys
from quirework.plans.pages import pages
from quirework.sources.readers import IMAGE_GLOB, plain_uri

_IMAGE = "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"


def done_keys(spark: SparkSession, out: str) -> DataFrame | None:
    """Source keys with a result, flagged or not; null before the first one."""
    try:
        return spark.read.parquet(f"{out}/results").select("source_key").distinct()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def start(spark: SparkSession, source: str, out: str, checkpoint: str, per_trigger: int = 64, shard: tuple[int, int] = (0, 1), head_set: str = "classical", settings: Settings | None = None) -> StreamingQuery:
    """Processes the images of a folder in micro-batches until none is left.

    A file belongs to one shard by its key. The checkpoint knows the files taken before; what an earlier
    run with another checkpoint has finished is dropped by an anti-join with the results. Files that
    cannot be decoded leave an error row."""
    stream = spark.readStream.format("image").schema(_IMAGE).option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", IMAGE_GLOB).load(source)
    found = stream.select(plain_uri(F.col("image.origin")).alias("source_key"), "image.height", "image.width", "image.nChannels", "image.data").where(keys.in_shard(F.col("source_key"), *shard))

    def batch(rows: DataFrame, _: int) -> None:
        done, todo = done_keys(rows.sparkSession, out), rows
        if done is not None:
            # the keys of one micro-batch are few; only they are compared, and no pixel is shuffled
            batch_keys = [r["source_key"] for r in rows.select("source_key").collect()]
            old = [r["source_key"] for r in done.where(F.col("source_key").isin(batch_keys)).collect()]
            todo = rows.where(~F.col("source_key").isin(old)) if old else rows
        pages(todo, head_set, settings).write.mode("append").parquet(f"{out}/results")

    return found.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counters(results: DataFrame) -> DataFrame:
    """processed, folios, review and errors of a results table."""
    return results.agg(F.countDistinct("source_key").alias("processed"), F.count("label").alias("folios"), F.count_if("needs_review").alias("review"), F.countDistinct(F.when(F.col("error").isNotNull(), F.col("source_key"))).alias("errors"))


class Progress(StreamingQueryListener):
    """Says how many rows a stream has taken whenever another ``step`` of them are done, and why it ended."""

    def __init__(self, step: int = 25, say: Callable[[str], None] = print):
        self.step, self.say, self.rows = step, say, 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.say(f"started {event.name or event.id}")

    def onQueryProgress(self, event) -> None:  # noqa: N802
        before, self.rows = self.rows, self.rows + event.progress.numInputRows
        if self.rows // self.step > before // self.step:
            self.say(f"{self.rows} images")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.say(f"ended after {self.rows} images" + (f": {event.exception}" if event.exception else ""))
