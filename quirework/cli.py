"""quirework PATH --out PATH [--shard i/n] [--stream]: crops the pages of a folder of photographs."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quirework.functions.keys import in_shard, parse_shard
from quirework.plans.pages import pages
from quirework.sources import readers, writers
from quirework.streaming import runner


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quirework", description=__doc__)
    p.add_argument("path")
    p.add_argument("--out", required=True)
    p.add_argument("--shard", type=parse_shard, default=(0, 1))
    p.add_argument("--stream", action="store_true", help="in micro-batches, with a checkpoint")
    p.add_argument("--limit", type=int)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("quirework").getOrCreate()
    if a.stream:
        runner.start(spark, a.path, a.out, f"{a.out}/_checkpoint", shard=a.shard).awaitTermination()
    else:
        todo = readers.listing(spark, a.path)
        todo = todo.where(in_shard(todo.source_key, *a.shard))
        todo = todo.limit(a.limit) if a.limit else todo
        done = runner.done_keys(spark, a.out)
        todo = todo if done is None else todo.join(done, "source_key", "left_anti")
        for images in readers.images_of(spark, todo):
            writers.write_results(pages(images), a.out)
    results = spark.read.parquet(f"{a.out}/results")
    writers.write_views(results, a.out)
    runner.counters(results).show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
