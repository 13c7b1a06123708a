import pytest
from pyspark.sql import functions as F

from quirework.config import Settings, load_volume_config
from quirework.functions import gates, keys, text, tiles

C, L = F.col, F.lit


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_keys(spark):
    k = L("a.b/vol-0001.tar.jpg")
    assert one(spark, keys.stem(k), keys.crop_key(k, L("A"), "p/"), keys.coord_key(k, L("")), keys.volume_of(keys.basename(k))) == ("vol-0001.tar", "p/a.b/vol-0001.tarA.jpg", "a.b/vol-0001.tar.json", "vol")
    assert one(spark, keys.normalize_prefix(L("176899---")), keys.job_title(L("src/1768-"), "src/"), keys.normalize_prefix(L("a.b.."), ".")) == ("176899", "1768", "a.b")
    assert one(spark, keys.store_uri(L("s3://b/p/q")))[0].asDict() == {"bucket": "b", "prefix": "p/q"}
    with pytest.raises(Exception, match="not an object-store address"):
        one(spark, keys.store_uri(L("/tmp/x")))


def test_shards_are_complete_and_disjoint(spark):
    rows = spark.range(900).select(F.format_string("vol/%d-%d.jpg", C("id"), C("id") * 7).alias("k"))
    found = [{r.k for r in rows.where(keys.in_shard(C("k"), i, 6)).collect()} for i in range(6)]
    assert sum(map(len, found)) == 900 == len(set().union(*found)) and all(found)
    assert rows.where(keys.in_shard(C("k"), 0, 1)).count() == 900
    import zlib

    assert all(zlib.crc32(k.encode()) % 6 == i for i, s in enumerate(found) for k in s)
    assert keys.parse_shard("2/6") == (2, 6)
    for bad in ("6/6", "x", "-1/3", "1/0"):
        with pytest.raises(ValueError):
            keys.parse_shard(bad)


def test_metadata(spark):
    m = F.create_map(L("page-blank"), L("True"), L("page-orientation_conf"), L("oops"), L("page-reasons"), L("a,,b"))
    r = one(spark, keys.decode_metadata(m), keys.decode_metadata(F.create_map(L("x"), L("y"))))
    assert r[0].is_blank and r[0].orientation_conf == 0 and r[0].review_reasons == ["a", "b"] and r[0].text_frac is None and not r[0].status_unknown
    assert r[1].status_unknown
    e = one(spark, keys.encode_metadata({"label": L("Zürich" + "x" * 600), "conf": L(0.12345)}, {"conf": 3}))[0]
    assert e["page-label"].startswith("Zrich") and len(e["page-label"]) == 512 and e["page-conf"] == "0.123"


def test_lenient_json(spark):
    schema = "array<struct<file:string,transcription:string>>"
    for said in ('[{"file":"a","transcription":"x [1]"}]', r'\[{"file":"a","transcription":"x \[1\]"}\]', '{"file":"a","transcription":"x [1]"},,'):
        got = one(spark, text.lenient_records(L(said), schema))[0]
        assert [tuple(r) for r in got] == [("a", "x [1]")], said
    assert one(spark, text.lenient_records(L("junk"), schema))[0] == []


def test_first_kept(spark):
    for said in (None, "", "-" * 70_000 + "a_b" + "\n" * 9 + "c" * 300, "\U0001f600é a\r\nB", "x" * 199 + "--" + "yz"):
        want = F.substring(F.regexp_replace(F.coalesce(L(said).cast("string"), L("")), "[^A-Za-z0-9 _]", ""), 1, 200)
        got, old = one(spark, text.first_kept(L(said).cast("string"), "A-Za-z0-9 _", 200), want)
        assert got == old


def test_lenient_text_is_worked_out_once(spark):
    from quirework.plans.queries import QUERIES

    said = F.concat(L(r'\[{"file":"MARK'), C("id").cast("string"), L(r'","transcription":"x"}\]'))
    rows = spark.range(3).select(text.lenient_records(said, "array<struct<file:string,transcription:string>>").alias("r"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("MARK") == 1
    assert [r.r for r in rows.collect()] == [[(f"MARK{i}", "x")] for i in range(3)]
    docs = spark.createDataFrame([(i, "a_b [c]-" * 40, "en") for i in range(6)], "doc_id long, text string, lang string")
    out = QUERIES["lenient_transcriptions"].run(lambda _: docs)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("to_json") + out._jdf.queryExecution().optimizedPlan().toString().count("StructsToJson") == 1
    assert {tuple(r)[1:] for r in out.drop("file").collect()} == {(2, ("a_b c" * 40)[:200], "second_en")}


def test_text_counts(spark):
    assert one(spark, text.char_count(L("  a \n b ")), text.word_count(L("  a \n b ")), text.char_count(L(None).cast("string")), text.word_count(L(""))) == (3, 2, 0, 0)


def test_decisions(spark):
    p = F.array(*map(L, (0.4, 0.35, 0.2, 0.05)))
    assert tuple(one(spark, gates.quarter_turn(p, L(1.0), L(2.0)))[0]) == (1, 0.4)
    assert tuple(one(spark, gates.quarter_turn(p, L(2.0), L(1.0)))[0]) == (0, 0.4)
    assert one(spark, gates.prepass_turn(F.array(*map(L, (0.1, 0.8, 0.1, 0.0)))), gates.prepass_turn(F.array(*map(L, (0.0, 0.1, 0.9, 0.0))))) == (1, 0)
    r = one(spark, gates.rescue_by_reading(F.array(L("low_orientation_conf")), L(0.0), L(0.0), L(90.0)))[0]
    assert r.margin == 0 and not r.flip and r.reasons == ["low_orientation_conf"]
    r = one(spark, gates.partial_spread(L(1.0), L(0.1), L(2.0), L(0.5)))[0]
    assert (r.why, r.kept) == ("fired", "left")
    assert one(spark, gates.review_reasons(L(0.075), L(0.70), L(0.10), L(0.95)))[0] == []
    q = F.array(*[F.struct(L(float(x)).alias("x"), L(float(y)).alias("y")) for x, y in ((10, 0), (110, 10), (100, 210), (0, 200))])
    left = one(spark, gates.split_quad(q, L(0.5), L(True)))[0]
    assert [tuple(v) for v in left] == [(10, 0), (60, 5), (50, 205), (0, 200)]


def test_point_comes_back(spark):
    import numpy as np

    image = np.zeros((7, 5))
    image[2, 3] = 1
    for k in range(4):
        y, x = np.argwhere(np.rot90(image, k))[0]
        assert tuple(one(spark, gates.unrotate_point(L(int(x)), L(int(y)), L(k), L(5), L(7)))[0]) == (3, 2)


def test_tiles(spark):
    flat, grid = F.array(*[L(2.0)] * 16), F.array(*[L(float(i)) for i in range(16)])
    assert set(one(spark, tiles.normalise(flat))[0]) == {0.0}
    assert one(spark, tiles.best_rotation(grid, tiles.rotated(grid, 4, 3), 4))[0].k == 1
    assert one(spark, tiles.otsu(F.array(*map(L, (0, 0, 10, 10)))))[0] == 0


def test_config(monkeypatch):
    s = Settings.from_env({"QUIREWORK_QUALITY_BLANK": "0.7", "QUIREWORK_QUALITY_RESCUE_PARTIAL_SPREAD": "true"}, quality={"blank": 0.6, "min_area_frac": 0.2})
    assert (s.quality.blank, s.quality.min_area_frac, s.quality.rescue_partial_spread) == (0.7, 0.2, True)
    toml = '[source]\n[crops]\nprofile="p"\n[coords]\nprofile=""\n[transcripts]\n[crop]\n[api]\n'
    assert load_volume_config(toml)["coords"]["profile"] == "p"
    for bad in (toml.replace("[api]", ""), toml.replace('profile="p"', "write_coords=true"), toml + f'instructions="{"x" * 501}"'):
        with pytest.raises(ValueError):
            load_volume_config(bad)
