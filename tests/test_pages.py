import inspect
import time

import numpy as np
import pytest

from quirework.config import Quality, Settings
from quirework.plans import heads as H
from quirework.plans import pages as P
from quirework.plans import volumes
from quirework.sources import readers, writers
from quirework.streaming import jobs, runner


class Sideways:
    def __init__(self, p):
        self.p = np.array(p)

    def probs(self, image):
        return self.p


def stub(**other):
    base = H.heads()
    return H.Heads(base.segmenter, base.counter, Sideways((1.0, 0, 0, 0)), **other)


def test_spread_gives_two_pages():
    r = P.process(P.synthetic(0, True), stub())
    assert [p.label for p in r.pages] == ["A", "B"] and r.seam is not None and r.error is None


def test_prepass():
    x = P.synthetic(1, False)
    assert P.process(np.rot90(x), stub(coarse=Sideways((0, 0.9, 0.1, 0)))).pre_rotation_k == 1
    assert P.process(x, stub(coarse=Sideways((0, 0.1, 0.9, 0)))).pre_rotation_k == 0


def test_one_box_is_halved():
    class One(H.ClassicalSegmenter):
        def detect(self, image, most):
            return super().detect(image, 1)

    h = stub()
    h.segmenter = One()
    assert [p.label for p in P.process(P.synthetic(0, True), h).pages] == ["A", "B"]


def test_errors_stay_rows():
    class Bad:
        def predict(self, image):
            raise KeyError("x")

    h = stub()
    h.counter = Bad()
    assert P.process(P.synthetic(0, True), h).error.startswith("exception:KeyError")
    assert P.process(None, h).error == "decode_failed"
    h.counter = type("R", (), {"predict": lambda s, i: ("reject", 0.9)})()
    assert P.process(P.synthetic(0, True), h).error == "rejected_non_page"


def test_blank_and_reading():
    page = P.process(P.synthetic(1, False), stub(blank=lambda x: (True, 0.8))).pages[0]
    assert page.is_blank and page.blank_conf == 0.8
    h = H.Heads(H.heads().segmenter, H.heads().counter, Sideways((0.6, 0, 0.4, 0)), reader=lambda x: float(x[:60].mean() < x[-60:].mean()))
    page = P.process(P.synthetic(1, False), h).pages[0]
    assert page.ocr_rescued and "low_orientation_conf" not in page.reasons
    assert not Settings().quality.rescue_partial_spread and not P.process(P.synthetic(1, False), stub()).pages[0].ocr_rescued


def test_low_text_gate():
    blank = np.full((420, 300, 3), 235, np.uint8)
    h = stub()
    h.counter = type("One", (), {"predict": lambda s, i: ("one_folio", 0.9)})()
    h.segmenter = type("Whole", (), {"detect": lambda s, i, n: [(0, 0, i.shape[1], i.shape[0])], "masks": lambda s, i, b: [np.ones(i.shape[:2], bool)]})()
    assert "low_text_for_orientation" in P.process(blank, h).pages[0].reasons
    assert Quality().aspect_high == 0.95


def test_quad_of_a_turned_image():
    image = np.zeros((7, 5))
    image[2, 3] = 1
    for k in range(4):
        y, x = np.argwhere(np.rot90(image, -k))[0]
        q = P.normal_quad(np.array([[x, y]] * 4, float), k, (7, 5))
        assert np.allclose(q[0] * [5, 7], [3, 2], atol=1e-3)


@pytest.fixture(scope="module")
def shelf(tmp_path_factory):
    d = tmp_path_factory.mktemp("shelf")
    for name, seed, two in (("1768-0001", 1, False), ("176899-0001", 1, False), ("176899-0002", 2, True), ("176899-0003", 3, False)):
        (d / f"{name}.png").write_bytes(writers.png(P.synthetic(seed, two)))
    (d / "176899-0004.png").write_bytes(b"no image")
    (d / "notes.txt").write_text("x")
    return str(d)


def test_reader(spark, shelf):
    assert readers.listing(spark, shelf).count() == 5
    rows = {r.source_key.rsplit("/")[-1]: r for r in readers.images(spark, shelf).collect()}
    assert rows["176899-0004.png"].height == -1
    r = rows["176899-0002.png"]
    x = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels)
    assert (x == P.synthetic(2, True)).all()


def test_stream_and_resume(spark, shelf, tmp_path):
    out = str(tmp_path / "out")
    q = runner.start(spark, shelf, out, str(tmp_path / "c1"), per_trigger=2)
    q.awaitTermination(240)
    c = runner.counters(spark.read.parquet(f"{out}/results")).first()
    assert (c.processed, c.folios, c.errors) == (5, 5, 1)
    runner.start(spark, shelf, out, str(tmp_path / "c2")).awaitTermination(240)
    results = spark.read.parquet(f"{out}/results")
    assert runner.counters(results).first().folios == 5 and results.count() == 6
    writers.write_views(results, out)
    manifest = readers.manifest(spark, f"{out}/manifest").collect()
    assert sorted(r.file for r in manifest) == ["1768-0001.jpg", "176899-0001.jpg", "176899-0002A.jpg", "176899-0002B.jpg", "176899-0003.jpg"]
    assert spark.read.parquet(f"{out}/crops").count() == 5
    assert writers.sidecar_rows(results).where("size(folios) = 2").count() == 1


class Service:
    def __init__(self):
        self.keys, self.states, self.ready = [], iter(["IMPORTING", "DERIVED_READY", "ENQUEUEING", "COMPLETED"]), False

    def upload(self, key):
        self.keys.append(key)

    def create(self, meta, keys):
        self.meta = meta
        return "j"

    def status(self, job):
        return next(self.states)

    def enqueue(self, job):
        self.ready = True

    def artefacts(self, job):
        return [{"kind": "json", "url": "x"}, {"kind": "tables_zip", "url": "y"}]


CONFIG = {"source": {"path": ""}, "crops": {}, "coords": {}, "transcripts": {"prefix": "t/"}, "crop": {}, "api": {}}


def test_volume(spark, shelf, tmp_path):
    config = CONFIG | {"source": {"path": shelf}}
    out, s = str(tmp_path / "v"), Service()
    dry = volumes.run(spark, config, "176899-", s, out, "now", dry_run=True)
    assert (dry.crops, dry.skipped, s.keys) == (4, 0, [])
    done = volumes.run(spark, config, "176899-", s, out, "now")
    assert (done.crops, done.skipped, done.submitted, done.error) == (4, 4, 4, None) and s.ready and done.artefacts == ["t/176899.json"]
    assert readers.review_reports(spark, f"{out}/review/176899").first().total == 4
    assert volumes.run(spark, config, "9", Service(), out, "now").error == "no crops"
    failed = Service()
    failed.states = iter(["FAILED"])
    assert "FAILED" in volumes.run(spark, config, "1768", failed, out, "now").error
    runs = volumes.run_all(["a", "b"], lambda v: volumes.Run(v, error="x"))
    assert [r.volume for r in runs] == ["a"]


def test_volume_waits_between_polls(spark, shelf, tmp_path):
    slept, s = [], Service()
    volumes.run(spark, CONFIG | {"source": {"path": shelf}}, "176899-", s, str(tmp_path / "w"), "now", sleep=slept.append)
    assert slept == [5.0, 5.0] and s.ready
    assert inspect.signature(volumes.run).parameters["sleep"].default is time.sleep


def test_jobs():
    assert jobs.with_steps(["metadata", "transcribe"]) == ["foliate", "metadata", "transcribe"]
    tried, slept = [], []

    def flaky():
        tried.append(1)
        if len(tried) < 3:
            raise OSError("network")

    jobs.attempt(flaky, sleep=slept.append)
    assert slept == [1.0, 2.0]
    bad = type("E", (Exception,), {"status": 404})
    with pytest.raises(bad):
        jobs.attempt(lambda: (_ for _ in ()).throw(bad()), sleep=slept.append)
    assert slept == [1.0, 2.0]
    waiting = Service()
    waiting.states = iter(["IMPORTING"] * 99)
    with pytest.raises(TimeoutError):
        jobs.run(waiting, {}, [], poll=5, limit=20, sleep=lambda _: None)


def test_photographs_one_at_a_time(spark):
    import pandas as pd

    first = next(P.drawn(iter([pd.DataFrame({"page_id": range(1_000_000)})])))
    assert len(first) == 1 and first.data[0] == P.synthetic(0, True).tobytes()
    out = P.demo(spark, "/root/testdata/sf0.001")
    assert out.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_canvases_one_at_a_time(spark, monkeypatch):
    kept = []
    with monkeypatch.context() as m:
        m.setattr(type(spark.range(1)), "mapInPandas", lambda self, run, schema: kept.append((run, self)))
        crops = spark.range(3).selectExpr("'v' AS volume", "string(id) AS file", "named_struct('height', 1, 'width', 1, 'nChannels', 3, 'data', X'010203') AS crop")
        writers.on_canvases(crops, spark.createDataFrame([("v", 40, 30)], "volume string, canvas_width int, canvas_height int"))
    run, rows = kept[0]
    made = list(run(iter([rows.toPandas()])))
    assert [len(x) for x in made] == [1, 1, 1] and {len(x.crop[0]["data"]) for x in made} == {3600}
