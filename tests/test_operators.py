import numpy as np
from pyspark.sql import functions as F

from quirework.operators import profiles, records, summaries
from quirework.plans.volumes import carried
from quirework.sources import readers, writers

C, L = F.col, F.lit


def test_resume_keeps_volumes_apart(spark):
    sources = spark.createDataFrame([(f"{v}-{i:04d}.jpg",) for v, i in (("176899", 1), ("176899", 2), ("176899", 3), ("1768", 1))], "source_key string")
    existing = spark.createDataFrame([("176899-0001.jpg",), ("176899-0002A.jpg",), ("176899-0002B.jpg",), ("17689-0003.jpg",)], "crop string")
    todo, done = records.resume(sources, existing)
    assert sorted(r.source_key for r in todo.collect()) == ["1768-0001.jpg", "176899-0003.jpg"]
    assert sorted(r.crop for r in done.collect()) == ["176899-0001.jpg", "176899-0002A.jpg", "176899-0002B.jpg"]
    stems = spark.createDataFrame([("x/176899-0001-A.jpg",)], "crop string")
    assert records.resume_by_stem(sources, stems).count() == 3


def test_union_and_samples(spark):
    new = spark.createDataFrame([("b", True)], "crop string, is_blank boolean")
    old = spark.createDataFrame([("a", True)], "crop string, status_unknown boolean")
    rows = carried(new, old).collect()
    assert [r.crop for r in rows] == ["a", "b"] and rows[1].status_unknown is None
    n = spark.range(1000)
    train, valid = records.train_valid(n, "id", 7)
    assert train.count() + valid.count() == 1000 and 100 < valid.count() < 200 and train.join(valid, "id").count() == 0
    assert records.seeded_sample(n, "id", 10, 1).collect() == records.seeded_sample(n.repartition(7), "id", 10, 1).collect()


def test_report_with_nulls(spark):
    rows = spark.createDataFrame([("v", "2", True, []), ("v", "1", False, ["x"]), ("v", "3", None, None)], "volume string, crop string, b boolean, r array<string>")
    r = summaries.review_report(rows, "volume", C("crop"), C("b"), C("r")).first()
    assert (r.total, r.blank, r.flagged, r.submitted, r.blank_crops) == (3, 1, 1, 1, ["2"]) and r.flagged_crops[0].crop == "1"


def test_coverage_is_the_area_of_the_union(spark):
    rng = np.random.default_rng(0)
    rects, want = [], {}
    for image in range(6):
        full = np.zeros((80, 80), bool)
        for _ in range(5):
            x, y, w, h = (int(v) for v in rng.integers(0, 25, 4))
            rects.append((image, float(x), float(y), float(x + w + 1), float(y + h + 1)))
            full[y : y + h + 1, x : x + w + 1] = True
        want[image] = (full[5:30, 10:35].sum() / full.sum(), full[5:30, 10:35].sum() / 625)
    df = spark.createDataFrame(rects, "image int, x0 double, y0 double, x1 double, y1 double")
    for r in summaries.coverage(df, "image", (L(10.0), L(5.0), L(35.0), L(30.0))).collect():
        assert np.allclose((r.coverage, r.meaningful), want[r.image])


def test_coverage_makes_no_row_of_a_cell(spark):
    rects = [("a", float(i), float(i % 7), float(i + 60), float(i % 7 + 3)) for i in range(120)] + [("b", None, 1.0, 9.0, 9.0), ("b", 0.0, 0.0, 4.0, 2.0), ("b", 3.0, 5.0, 1.0, 9.0), ("c", None, 0.0, 1.0, 1.0), (None, 0.0, 0.0, 20.0, 10.0)]
    df = spark.createDataFrame(rects, "image string, x0 double, y0 double, x1 double, y1 double")
    out = summaries.coverage(df, "image", (L(10.0), L(5.0), L(35.0), L(30.0)))
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.image: (r.coverage, r.meaningful) for r in out.collect()}
    full = np.zeros((30, 180), bool)
    for i in range(120):
        full[i % 7 : i % 7 + 3, i : i + 60] = True
    assert np.allclose(got["a"], (full[5:, 10:35].sum() / full.sum(), full[5:, 10:35].sum() / 625))
    assert got["b"] == got["c"] == (0.0, 0.0) and np.allclose(got[None], (50 / 200, 50 / 625))


def test_profiles(spark):
    p = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([5, 5, 1, 5, 5, 0, 9])], "id string, pos int, value double")
    best = profiles.deepest(profiles.prominence(p, 1)).first()
    assert (best.pos, best.prominence) == (5, 5.0)
    assert profiles.off_line(p.where("pos < 2")).first().curvature == 0.0
    runs = profiles.border_runs(p, C("value") == 5).first()
    assert (runs.leading, runs.trailing) == (0, 2)
    none = profiles.border_runs(p, C("value") > 99).first()
    assert (none.leading, none.trailing) == (7, 7)


def test_lenient_files_and_reports(spark, tmp_path):
    (tmp_path / "v1.json").write_text(r'\[{"file":"a","transcription":"x"},{"file":"b","transcription":"y \[z\]"}\]')
    got = readers.transcripts(spark, str(tmp_path / "v1.json")).orderBy("file").collect()
    assert [tuple(r) for r in got] == [("v1", "a", "x"), ("v1", "b", "y [z]")]
    (tmp_path / "gt.csv").write_text('FILE,ANCHOR\np.jpg,"rect:x=1,y=2,w=3,h=4"\n')
    assert tuple(readers.rectangles(spark, str(tmp_path / "gt.csv")).first()) == ("p.jpg", 1, 2, 3, 4)
    for c in ("good", "bad"):
        (tmp_path / "set" / c).mkdir(parents=True)
        (tmp_path / "set" / c / "i.png").write_bytes(b"x")
    assert sorted(r.label for r in readers.class_folders(spark, str(tmp_path / "set")).collect()) == ["bad", "good"]
    assert writers.preflight(spark, [str(tmp_path)], [str(tmp_path / "set")]) == []
    assert len(writers.preflight(spark, [str(tmp_path / "none")], [])) == 1


def test_artefacts(spark):
    kept, missing = writers.archived(spark.createDataFrame([("json", "u"), ("tables_zip", "v")], "kind string, url string"), "t/", "1768")
    assert [r.key for r in kept.collect()] == ["t/1768.json"] and [r.kind for r in missing.collect()] == ["markdown"]


def test_png_is_read_back(spark, tmp_path):
    x = np.random.default_rng(0).integers(0, 255, (5, 7, 3), dtype=np.uint8)
    (tmp_path / "a.PNG").write_bytes(writers.png(x))
    r = readers.images(spark, str(tmp_path)).first()
    assert (np.frombuffer(r.data, np.uint8).reshape(5, 7, 3) == x).all()
