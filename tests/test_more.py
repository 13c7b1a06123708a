"""Percentiles without sorting, resume rules, scratch folders, progress of streams, heads from models."""

import json
import random
import statistics
import subprocess
import sys

import numpy as np
import pytest

import __spark_entry__ as entry
from quirework.operators import records, summaries
from quirework.pixels import kernels as K
from quirework.pixels import stages as S
from quirework.plans import models as M
from quirework.sources import readers, scratch
from quirework.streaming import jobs, runner


def test_percentiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(summaries, "FEW", 5)
    monkeypatch.setattr(summaries, "BINS", 4)
    rng = random.Random(1)
    for own in ([rng.choice([0.5, 1.0, 1.0 + 2**-52, -3.0, rng.gauss(0, 9)]) for _ in range(200)], [2.0] * 30, [1.0], [1e300, -1e300, 0.0]):
        rows = spark.createDataFrame([(x,) for x in own] + [(None,)], "v double").coalesce(1).cache()
        got = summaries.percentiles(rows, "v", [0.0, 0.5, 0.9, 1.0])
        assert got == pytest.approx([float(np.quantile(own, q)) for q in (0.0, 0.5, 0.9, 1.0)]) and got[1] == pytest.approx(statistics.median(own))
    assert summaries.percentiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


def test_a_right_page_alone_is_not_done(spark):
    sources = spark.createDataFrame([("x/1-0001.jpg",), ("x/1-0002.jpg",), ("x/1-0003.jpg",)], "source_key string")
    there = spark.createDataFrame([("1-0001.jpg",), ("1-0002-B.jpg",), ("1-0003-A.jpg",)], "name string")
    assert [r.source_key for r in records.resume_local(sources, there).collect()] == ["x/1-0002.jpg"]


def test_folders_of_a_cluster_must_be_shared():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

        class sparkContext:  # noqa: N801
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        scratch.folder(Session, "x")


def test_no_pixels_are_shuffled_on_resume(spark, tmp_path):
    from quirework.sources.writers import png

    for i in range(5):
        (tmp_path / f"1-{i:04d}.png").write_bytes(png(np.full((4, 5, 3), i, np.uint8)))
    listing = readers.listing(spark, str(tmp_path))
    done = listing.where("source_key LIKE '%0001.png'").select("source_key")
    batches = list(readers.images_of(spark, listing.join(done, "source_key", "left_anti"), 3))
    assert [b.count() for b in batches] == [3, 1]
    plan = batches[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert readers.listing(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        (tmp_path / "empty" / "x.txt").write_text("x")
        readers.uploads(spark, str(tmp_path / "empty"))


def test_progress():
    said = []
    p = runner.Progress(25, said.append)
    event = lambda n: type("E", (), {"progress": type("P", (), {"numInputRows": n})()})()
    for n in (10, 10, 10, 40):
        p.onQueryProgress(event(n))
    p.onQueryTerminated(type("E", (), {"exception": None})())
    assert said == ["30 images", "70 images", "ended after 70 images"]


def test_job_metadata():
    m = jobs.metadata({"api": {"job": {"language": "es"}, "models": {"ner": "m"}, "metadata_schema": {"title": "t?"}, "transcription_preferences": {"ignore_marginalia": True}}}, "v", ["metadata"])
    assert m["language"] == "es" and m["ner_model"] == "m" and m["captioning_model"] == "" and m["metadata_schema"]["title"] == "t?" and len(m["metadata_schema"]) == 15
    assert m["transcription_preferences"]["ignore_marginalia"] and m["transcription_preferences"]["preserve_line_breaks"] and m["foliation_override_discrete"] and m["delete_data"]
    json.dumps(m)


# ---------------------------------------------------------------- kernels against slow versions
def test_median_and_running_extremes():
    g = np.random.default_rng(0).integers(0, 256, (40, 50)).astype(np.uint8)
    for size in (3, 7):
        p = np.pad(g, size // 2, "edge")
        boxes = np.lib.stride_tricks.sliding_window_view(p, (size, size)).reshape(40, 50, -1)
        assert (K.median(g, size) == np.median(boxes, axis=2)).all()
        assert (K.running(K.running(g, size, np.maximum, 0), size, np.maximum, 1) == boxes.max(2)).all()


def test_colours_there_and_back():
    x = np.random.default_rng(0).integers(0, 256, (30, 30, 3), dtype=np.uint8)
    assert np.abs(K.from_lab(K.lab(x)).astype(int) - x).max() <= 1
    white, red = K.lab(np.array([[[255, 255, 255], [0, 0, 255]]], np.uint8))[0]
    assert np.allclose(white, [255, 128, 128], atol=0.5) and np.allclose(red, [136, 208, 195], atol=1)


def test_canny_finds_one_thin_line():
    g = np.full((40, 60), 50.0, np.float32)
    g[:, 30:] = 200
    e = K.canny(g, 40, 120)
    assert e.sum(1).tolist() == [1] * 40 and 28 <= np.flatnonzero(e.any(0))[0] <= 31
    assert not K.canny(np.full((20, 20), 9.0, np.float32), 40, 120).any()


def test_warp_is_cubic_convolution():
    x = np.random.default_rng(0).integers(0, 256, (20, 24)).astype(np.float32)
    got = K.warp(x, np.array([[1, 0, 0.5], [0, 1, 0], [0, 0, 1.0]]), 24, 20)
    weights = np.array([-0.09375, 0.59375, 0.59375, -0.09375])
    assert np.allclose(got[5, 10], (x[5, 8:12] * weights).sum(), atol=1e-3)
    assert (K.warp(x, np.eye(3), 24, 20) == x).all()


def test_convex_polygons():
    m = S.inside(np.array([[10.0, 5], [30, 5], [30, 25], [10, 25]]), (40, 50))
    assert m.sum() == 21 * 21 and m[5, 10] and m[25, 30] and not m[4, 10]
    diamond = S.inside(np.array([[20.0, 0], [40, 20], [20, 40], [0, 20]]), (41, 41))
    y, x = np.mgrid[:41, :41]
    assert (diamond == (abs(x - 20) + abs(y - 20) <= 20)).all()


def test_resized_keeps_means():
    x = np.random.default_rng(0).random((64, 48))
    assert abs(K.resized(x, 12, 16).mean() - x.mean()) < 0.01 and K.resized(x, 96, 128).shape == (128, 96)
    assert M.montage([], 3) is None


def test_missing_subpackage_and_real_errors(tmp_path):
    """Without the training-data folders the rest imports; an import that fails inside them is an error."""
    import os
    import shutil

    here = os.path.dirname(os.path.abspath(entry.__file__))
    there = tmp_path / "copy"
    shutil.copytree(here, there, ignore=shutil.ignore_patterns(".git", "*.pyc", "__pycache__", "llm", "corpus_pipeline.py"))
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(n for n in e.queries() if n.startswith('op') or n == 'pipeline'))"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=there, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(there)})
    out = run()
    assert out.returncode == 0 and "[]" in out.stdout and int(out.stdout.split()[0]) > 140, out.stderr[-500:]
    (there / "corpus_pipeline.py").write_text("import no_such_thing\n")
    assert run().returncode != 0
