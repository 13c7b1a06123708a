"""Queries that write through the sinks and read back through the readers; small files are made from ``nation`` and ``region``."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import gates, keys, text
from quirework.operators import summaries
from quirework.plans import pages as P
from quirework.plans import volumes
from quirework.plans.queries import _CROPS, _SQUEEZED, C, L, _crops, _sparse, query
from quirework.sources import readers, writers
from quirework.sources.scratch import folder, put
from quirework.streaming import runner

# ---------------------------------------------------------------- a results table made of order lines
_REASONS = """list_filter([CASE WHEN tax < 0.075 THEN 'low_text_for_orientation' END, CASE WHEN 1 - 5 * d < 0.70 THEN 'low_orientation_conf' END,
CASE WHEN price / 100000 < 0.10 THEN 'page_too_small' END, CASE WHEN q / 50 < 0.4 OR q / 50 > 0.95 THEN 'unexpected_aspect' END], lambda x: x IS NOT NULL)"""
_RESULTS = f"""(SELECT *, {_REASONS} AS reasons, CASE WHEN n = 1 THEN '' WHEN line = 1 THEN 'A' ELSE 'B' END AS label, (o % 97) || '-' || printf('%07d', o) AS stem FROM
(SELECT *, count(*) OVER (PARTITION BY o) AS n FROM (SELECT l_orderkey AS o, l_linenumber AS line, max(l_quantity) AS q, max(l_tax) AS tax, max(l_discount) AS d, max(l_extendedprice) AS price FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL)))"""


def _results(t) -> DataFrame:
    li = t("lineitem").where("l_linenumber <= 2")
    best = {"q": "l_quantity", "tax": "l_tax", "d": "l_discount", "price": "l_extendedprice"}
    r = li.groupBy(C("l_orderkey").alias("o"), C("l_linenumber").alias("line")).agg(*(F.max(c).alias(a) for a, c in best.items()))
    n = li.groupBy(C("l_orderkey").alias("o")).agg(F.countDistinct("l_linenumber").alias("n"))
    r = r.join(n, "o")
    found = gates.review_reasons(C("tax"), 1 - 5 * C("d"), C("price") / 100000, C("q") / 50)
    spread = "struct<aspect_before:double,fired:boolean,why:string,page_ink:double,spine_x_frac:double,spine_score:double,kept:string,aspect_after:double>"
    h, w = L(2), (C("line") + 2).cast("int")
    byte = F.lpad(F.hex(C("o") % 256), 2, "0")
    crop = F.struct(h.alias("height"), w.alias("width"), L(3).alias("nChannels"), F.unhex(F.repeat(byte, (h * w * 3).cast("int"))).alias("data"))
    point = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    return r.select(
        F.format_string("in/%d-%07d.jpg", C("o") % 97, "o").alias("source_key"), F.when(C("n") == 1, "one_folio").otherwise("two_folios").alias("page_count"), (C("tax") + 0.5).alias("count_conf"), (C("o") % 4).cast("int").alias("pre_rotation_k"),
        L(None).cast("struct<min_x:int,max_x:int,mean_x:double,curvature_px:int>").alias("seam"), L(None).cast("string").alias("error"), L("1").alias("version"),
        F.when(C("n") == 1, "").when(C("line") == 1, "A").otherwise("B").alias("label"), (C("q") - 25).alias("rotation_deg"), (1 - 5 * C("d")).alias("orientation_conf"), (C("price") / 100000).alias("mask_area_frac"),
        C("tax").alias("text_frac"), (C("tax") == 0).alias("is_blank"), C("d").alias("blank_conf"), (F.size(found) > 0).alias("needs_review"), found.alias("review_reasons"), L(None).cast(spread).alias("partial_spread"),
        L(False).alias("ocr_rescued"), L(False).alias("ocr_flipped"), L(0.0).alias("ocr_margin"), F.array(L(3000), L(2000)).alias("source_size"),
        F.array(point(C("tax"), L(0)), point(L(1), C("d")), point(L(1), L(1)), point(L(0), L(1))).alias("crop_quad_norm"), crop.alias("crop"),
    )


@query(f"""SELECT stem || label || '.jpg' AS file, label, CASE WHEN n = 1 THEN 'one_folio' ELSE 'two_folios' END AS page_count, q - 25 AS rotation, printf('%.3f', 1 - 5 * d)::DOUBLE AS orientation_conf,
tax AS text_frac, tax = 0 AS is_blank, len(reasons) > 0 AS needs_review, array_to_string(reasons, ';') AS reasons, 'in/' || stem || '.jpg' AS source FROM {_RESULTS}""")
def manifest_files(t):
    r = _results(t)
    path = folder(r.sparkSession, "manifest")
    writers.manifest_rows(r).write.csv(path, header=True)
    m = readers.manifest(r.sparkSession, path)
    return m.select("file", F.coalesce("label", L("")).alias("label"), "page_count", "rotation", "orientation_conf", "text_frac", "is_blank", "needs_review", F.coalesce("reasons", L("")).alias("reasons"), "source")


@query(f"""SELECT 'in/' || stem || '.jpg' AS source_key, CASE WHEN n = 1 THEN 'one_folio' ELSE 'two_folios' END AS page_count, round(tax + 0.5, 4) AS count_conf, label, q - 25 AS rotation_deg, d AS blank_conf, len(reasons)::INT AS n_reasons, 3000::BIGINT AS width
FROM {_RESULTS}""")
def sidecar_files(t):
    r = _results(t)
    path = folder(r.sparkSession, "sidecars")
    writers.sidecar_rows(r).write.json(path)
    s = readers.sidecars(r.sparkSession, path, lines=True)
    return s.select("source_key", "page_count", "count_conf", "label", "rotation_deg", "blank_conf", F.size("review_reasons").alias("n_reasons"), C("source_size")[0].alias("width"))


@query(f"""SELECT 'c/in/' || stem || label || '.jpg' AS crop, 'in/' || stem || '.jpg' AS source_key, tax AS left_edge, d AS upper, label, q - 25 AS rotation, len(reasons) > 0 AS needs_review FROM {_RESULTS}""")
def coord_files(t):
    r = _results(t)
    path = folder(r.sparkSession, "coords")
    writers.coord_rows(r, "c/").write.json(path)
    c = r.sparkSession.read.json(path)
    return c.select("crop", "source_key", C("crop_quad_norm")[0][0].alias("left_edge"), C("crop_quad_norm")[1][1].alias("upper"), "label", "rotation", "needs_review")


@query(f"""SELECT 'in/' || stem || label || '.jpg' AS crop, label, tax = 0 AS is_blank, len(reasons) > 0 AS needs_review, array_to_string(reasons, ';') AS reasons, d AS blank_conf, printf('%.3f', 1 - 5 * d)::DOUBLE AS orientation_conf, tax AS text_frac, q - 25 AS rotation_deg, false AS status_unknown FROM {_RESULTS}""")
def metadata_maps(t):
    r = _results(t)
    path = folder(r.sparkSession, "metadata")
    writers.metadata_rows(r).write.parquet(path)
    m = r.sparkSession.read.parquet(path).select("crop", keys.decode_metadata(C("metadata")).alias("m")).select("crop", "m.*")
    return m.select("crop", "label", "is_blank", "needs_review", F.array_join("review_reasons", ";").alias("reasons"), "blank_conf", "orientation_conf", "text_frac", "rotation_deg", "status_unknown")


@query(f"""SELECT volume, count(*) AS total, count(*) FILTER (is_blank) AS blank, count(*) FILTER (len(reasons) > 0) AS flagged, count(*) FILTER (NOT is_blank) AS submitted, count(*) FILTER (flag) AS status_unknown FROM {_CROPS} GROUP BY volume""")
def review_report_files(t):
    c = _crops(t)
    path = folder(c.sparkSession, "review")
    summaries.review_report(c, "volume", C("image"), C("is_blank"), C("reasons"), C("flag")).write.json(path)
    return readers.review_reports(c.sparkSession, path).select("volume", "total", "blank", "flagged", "submitted", "status_unknown")


@query(f"""SELECT o % 97 AS volume, len(reasons) > 0 AS needs_review, count(*) AS crops, count(*) AS png FROM {_RESULTS} GROUP BY ALL""")
def crops_routed_for_review(t):
    r = _results(t)
    path = folder(r.sparkSession, "crops")
    writers.encoded(r).write.partitionBy("needs_review").parquet(path)
    c = r.sparkSession.read.parquet(path)
    volume = keys.volume_of(keys.basename(C("source_key"))).cast("long")
    return c.groupBy(volume.alias("volume"), C("needs_review").cast("boolean").alias("needs_review")).agg(F.count("*").alias("crops"), F.count_if(F.hex(F.substring("content", 1, 4)) == "89504E47").alias("png"))


@query(f"""SELECT stem || CASE WHEN label <> '' THEN '-' || label ELSE '' END || '_enhanced.jpg' AS file FROM {_RESULTS} WHERE tax < 0.12 AND tax <> 0 AND o % 97 = 5""")
def enhanced_copies(t):
    r = _results(t).where("source_key LIKE 'in/5-%'")
    path = folder(r.sparkSession, "faint")
    writers.write_faint(r, path)
    return r.sparkSession.read.parquet(f"{path}/enhanced").select("file")


@query(f"""SELECT 'in/' || stem || label || '.jpg' AS crop, tax AS left_edge, (count(*) OVER (PARTITION BY o % 97))::INT AS in_volume FROM {_RESULTS} WHERE label <> 'B'""")
def crops_with_coords(t):
    r = _results(t).where("label != 'B'")
    crops = r.select(keys.crop_key(C("source_key"), C("label")).alias("crop"))
    found, lists = writers.matched_coords(crops, writers.coord_rows(r))
    volume = keys.volume_of(keys.basename(C("crop")))
    return found.withColumn("volume", volume).join(lists, "volume").select("crop", C("crop_quad_norm")[0][0].alias("left_edge"), F.size("crops").alias("in_volume"))


@query(f"""WITH c AS (SELECT o, line, volume, floor(price / 100)::BIGINT AS w, floor(q * 20)::BIGINT + 100 AS h, len(reasons) = 0 AS sure FROM (SELECT *, o % 97 AS volume FROM {_RESULTS}) WHERE price >= 100),
v AS (SELECT volume, coalesce(median(w / h) FILTER (sure), median(w / h)) AS norm, max(w) AS mw, max(h) AS mh FROM c GROUP BY volume), g AS (SELECT *, greatest(mw, round_even(mh * norm, 0)::BIGINT) AS cw FROM v), k AS (SELECT *, greatest(round_even(cw / norm, 0)::BIGINT, mh) AS ch FROM g)
SELECT o || '-' || line AS file, volume::INT AS volume, w::INT AS w, h::INT AS h, greatest(cw, round_even(ch * norm, 0)::BIGINT)::INT AS canvas_width, ch::INT AS canvas_height, abs(w / h - norm) > 0.12 AS suspect FROM c JOIN k USING (volume)""")
def volume_report_files(t):
    r = t("lineitem").where("l_linenumber <= 2").groupBy(C("l_orderkey").alias("o"), C("l_linenumber").alias("line")).agg(F.max("l_quantity").alias("q"), F.max("l_tax").alias("tax"), F.max("l_discount").alias("d"), F.max("l_extendedprice").alias("price")).where("price >= 100")
    sure = F.size(gates.review_reasons(C("tax"), 1 - 5 * C("d"), C("price") / 100000, C("q") / 50)) == 0
    c = r.select(F.concat_ws("-", "o", "line").alias("file"), (C("o") % 97).alias("volume"), F.floor(C("price") / 100).alias("w"), (F.floor(C("q") * 20) + 100).alias("h"), sure.alias("sure"))
    norms = summaries.volume_norm(c, "volume", C("w") / C("h"), C("sure"), C("w"), C("h"))
    path = folder(r.sparkSession, "volumes")
    writers.volume_report(c, norms, path)
    out = r.sparkSession.read.csv(f"{path}/volume_report", header=True, inferSchema=True)
    return out.select(C("file").cast("string").alias("file"), "volume", "w", "h", "canvas_width", "canvas_height", "suspect")


@query(f"""WITH c AS (SELECT o, line, o % 97 AS volume, line + 2 AS w, 2 AS h FROM {_RESULTS} WHERE o % 97 = 7), v AS (SELECT volume, median(w / h) AS norm, max(w) AS mw, max(h) AS mh FROM c GROUP BY volume),
g AS (SELECT *, greatest(mw, round_even(mh * norm, 0)::BIGINT) AS cw FROM v), k AS (SELECT *, greatest(round_even(cw / norm, 0)::BIGINT, mh) AS ch FROM g)
SELECT o || '-' || line AS file, greatest(cw, round_even(ch * norm, 0)::BIGINT)::INT AS width, ch::INT AS height, (3 * greatest(cw, round_even(ch * norm, 0)::BIGINT) * ch * (o % 256))::BIGINT AS total FROM c JOIN k USING (volume)""")
def crops_on_canvases(t):
    """Crops of one colour: on a canvas filled with the colour of their border every byte is the same."""
    r = _results(t).where("source_key LIKE 'in/7-%'")
    line = F.when(C("label") == "B", 2).otherwise(1)
    only = t("lineitem").where("l_linenumber <= 2").groupBy(C("l_orderkey").alias("o")).agg(F.min("l_linenumber").alias("first"))
    o = F.regexp_extract("source_key", "-0*(\\d+)\\.", 1).cast("long")
    r = r.withColumn("o", o).join(only, "o").withColumn("line", F.when(C("label") == "", C("first")).otherwise(line))
    c = r.select(F.concat_ws("-", "o", "line").alias("file"), L(7).alias("volume"), "crop")
    norms = summaries.volume_norm(c, "volume", C("crop.width") / C("crop.height"), L(True), C("crop.width"), C("crop.height"))
    out = writers.on_canvases(c, norms)
    return out.select("file", "crop.width", "crop.height", _total(C("crop.data")).alias("total"))


def _total(data):
    """The sum of a binary column's bytes."""
    each = F.transform(F.sequence(L(1), F.greatest(F.length(data), L(1))), lambda i: F.coalesce(F.conv(F.hex(F.substring(data, i, L(1))), 16, 10).try_cast("long"), L(0)))
    return F.aggregate(each, L(0).cast("long"), lambda a, b: a + b)


@query(f"""SELECT count(*) AS n, count(quality) AS labelled, round(avg((quality = predicted)::INT), 6) AS accuracy, (SELECT count(*) FROM documents) AS lines FROM (SELECT (length({_SQUEEZED}) > 120)::INT AS predicted, quality FROM documents d LEFT JOIN labels USING (doc_id))""")
def evaluation_files(t):
    d = t("documents").select("doc_id", (text.char_count(C("text")) > 120).cast("int").alias("predicted")).join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    path = folder(d.sparkSession, "evaluation")
    writers.evaluation(d, summaries.accuracy(d, C("quality"), C("predicted")), path)
    spark = d.sparkSession
    rows = spark.read.csv(f"{path}/eval_rows", header=True).agg(F.count("*").alias("lines"))
    return spark.read.json(f"{path}/eval_summary").select("n", "labelled", F.round("accuracy", 6).alias("accuracy")).join(F.broadcast(rows))  # one row each


@query(f"""SELECT doc_id AS image, length({_SQUEEZED})::INT AS chars, length({_SQUEEZED}) <= 120 AS listed FROM documents""")
def sparse_files(t):
    rows = _sparse(t)
    path = folder(rows.sparkSession, "sparse")
    writers.sparse_lists(rows, path)
    spark = rows.sparkSession
    names = spark.read.text(f"{path}/sparse").select(C("value").cast("long").alias("image"), L(True).alias("listed"))
    table = spark.read.csv(f"{path}/pages", header=True, schema="image long, volume string, chars int, words int, sparse boolean")
    return table.join(names, "image", "left").select("image", "chars", F.coalesce("listed", L(False)).alias("listed"))


@query("""SELECT p_partkey, ('p' || p_partkey) AS file, p_size::DOUBLE AS x, NULL::DOUBLE AS y, p_retailprice AS w, (p_size * 2)::DOUBLE AS h FROM part""")
def rect_strings(t):
    p = t("part").select(F.concat(L("p"), "p_partkey").alias("FILE"), F.concat(L("rect:x="), "p_size", L(",y=oops,w="), "p_retailprice", L(",h="), C("p_size") * 2).alias("ANCHOR"))
    path = folder(p.sparkSession, "rectangles")
    p.write.csv(path, header=True)
    r = readers.rectangles(p.sparkSession, path)
    return r.select(F.substring("file", 2, 20).cast("long").alias("p_partkey"), "file", "x", "y", "w", "h")


@query("""SELECT 'c/' || o_orderkey || '.jpg' AS path, CASE WHEN o_custkey % 2 = 0 THEN 'one_folio' ELSE 'two_folios' END AS count, (o_custkey % 4)::INT AS input_k FROM orders""")
def label_files(t):
    o = t("orders").select(F.concat(L("c/"), "o_orderkey", L(".jpg")).alias("path"), F.when(C("o_custkey") % 2 == 0, "one_folio").otherwise("two_folios").alias("count"), (C("o_custkey") % 4).alias("input_k"))
    path = folder(o.sparkSession, "labels")
    o.write.csv(path, header=True)
    return readers.labels(o.sparkSession, path)


# ---------------------------------------------------------------- small files, one for each nation
_EXTENSIONS = ("jpg", "PNG", "tif", "txt", "pdf")
_FILE = "(SELECT n_nationkey AS k, n_name AS name, (n_nationkey % 4) || '-' || printf('%04d', n_nationkey) AS stem, ['jpg', 'PNG', 'tif', 'txt', 'pdf'][n_nationkey % 5 + 1] AS ext FROM nation)"


def _nations(t) -> list:
    return t("nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey").collect()  # 25 rows, whatever the scale


def _folder_of_files(t, name: str) -> tuple[SparkSession, str]:
    spark = t("nation").sparkSession
    path = folder(spark, name)
    for n in _nations(t):
        k = n["n_nationkey"]
        put(spark, f"{path}/{k % 4}-{k:04d}.{_EXTENSIONS[k % 5]}", n["n_name"].encode())
    return spark, path


@query(f"SELECT stem || '.' || ext AS file, octet_length(encode(name)) AS length FROM {_FILE} WHERE ext IN ('jpg', 'PNG', 'tif')")
def folder_listing(t):
    spark, path = _folder_of_files(t, "listing")
    both = readers.listing(spark, [path, f"{path}/not-there"])
    return both.select(keys.basename(C("source_key")).alias("file"), "length").unionByName(readers.listing(spark, f"{path}/nor-this").select(C("source_key").alias("file"), "length"))


@query(f"SELECT stem || '.' || ext AS file FROM {_FILE} WHERE ext IN ('jpg', 'PNG', 'tif') AND k % 4 = 1")
def volume_listing(t):
    spark, path = _folder_of_files(t, "volume")
    put(spark, f"{path}/17-0001.jpg", b"of another volume")
    return volumes.volume_images(readers.listing(spark, path), "1").select(keys.basename(C("source_key")).alias("file"))


@query(f"SELECT stem || '.' || ext AS file FROM {_FILE} WHERE ext = 'jpg'")
def crop_listing(t):
    spark, path = _folder_of_files(t, "crop")
    return readers.crops(spark, path).select(keys.basename(C("source_key")).alias("file"))


@query(f"SELECT stem || '.' || ext AS file FROM {_FILE} WHERE ext <> 'txt'")
def upload_listing(t):
    spark, path = _folder_of_files(t, "upload")
    return readers.uploads(spark, path).select(keys.basename(C("source_key")).alias("file"))


@query("SELECT r_name AS label, count(*) AS files FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def class_folder_files(t):
    spark = t("nation").sparkSession
    path = folder(spark, "classes")
    names = {r["r_regionkey"]: r["r_name"] for r in t("region").collect()}  # five rows
    for n in _nations(t):
        put(spark, f"{path}/{names[n['n_regionkey']]}/{n['n_nationkey']}.jpg", b"x")
        put(spark, f"{path}/{names[n['n_regionkey']]}/{n['n_nationkey']}.txt", b"x")
    return readers.class_folders(spark, path).groupBy("label").agg(F.count("*").alias("files"))


@query(r"""SELECT r_name AS volume, n_name AS file, 'said [' || n_nationkey || '] in a_b' AS transcription FROM nation JOIN region ON n_regionkey = r_regionkey""")
def transcript_files(t):
    """One list per region: the first as it is, the others with escaped brackets and underscores, or cut off at the end."""
    spark = t("nation").sparkSession
    path = folder(spark, "transcripts")
    names = {r["r_regionkey"]: r["r_name"] for r in t("region").collect()}
    for key, name in names.items():
        said = json.dumps([{"file": n["n_name"], "transcription": f"said [{n['n_nationkey']}] in a_b"} for n in _nations(t) if n["n_regionkey"] == key])
        if key % 3 == 1:
            said = said.replace("[", "\\[").replace("]", "\\]").replace("_", "\\_")
        put(spark, f"{path}/{name}.json", (said[:-1] if key % 3 == 2 else said).encode())
    return readers.transcripts(spark, path)


@query("""SELECT n_name AS source_key, 'one_folio' AS page_count, n_nationkey / 10.0 AS count_conf, 'A' AS label, n_nationkey % 2 = 0 AS needs_review FROM nation WHERE n_nationkey % 3 <> 0
UNION ALL SELECT n_name, 'reject', 0.5, NULL, NULL FROM nation WHERE n_nationkey % 3 = 0""")
def sidecar_values(t):
    """One JSON document for each image; an image with an error has no pages."""
    spark = t("nation").sparkSession
    path = folder(spark, "documents")
    for n in _nations(t):
        k = n["n_nationkey"]
        page = {"label": "A", "needs_review": k % 2 == 0}
        made = {"source_key": n["n_name"], "page_count": "one_folio" if k % 3 else "reject", "count_conf": k / 10 if k % 3 else 0.5, "error": None if k % 3 else "rejected_non_page", "folios": [page] if k % 3 else []}
        put(spark, f"{path}/{k}.json", json.dumps(made, indent=2).encode())
    return readers.sidecars(spark, path).select("source_key", "page_count", C("count_conf").cast("double").alias("count_conf"), "label", "needs_review")


# ---------------------------------------------------------------- images
def _pattern(k: int) -> np.ndarray:
    y, x, c = np.mgrid[: 2 + k % 3, : 3 + k % 4, :3]
    return ((k * 7 + y * 13 + x * 5 + c * 3) % 256).astype(np.uint8)


def _photographs(t, name: str, make) -> tuple[SparkSession, str]:
    """A PNG for each nation, every fifth broken."""
    spark = t("nation").sparkSession
    path = folder(spark, name)
    for n in _nations(t):
        k = n["n_nationkey"]
        put(spark, f"{path}/{k % 4}-{k:04d}.png", b"broken" if k % 5 == 4 else writers.png(make(k)))
    return spark, path


_PIXELS = "(SELECT n_nationkey AS k, y, x, c FROM nation, (SELECT unnest(range(0, 4)) AS y), (SELECT unnest(range(0, 6)) AS x), (SELECT unnest(range(0, 3)) AS c) WHERE y < 2 + n_nationkey % 3 AND x < 3 + n_nationkey % 4)"


@query(f"""SELECT (k % 4) || '-' || printf('%04d', k) AS stem, CASE WHEN k % 5 = 4 THEN -1 ELSE 2 + k % 3 END::INT AS height, CASE WHEN k % 5 = 4 THEN -1 ELSE 3 + k % 4 END::INT AS width,
CASE WHEN k % 5 = 4 THEN 0 ELSE sum((k * 7 + y * 13 + x * 5 + c * 3) % 256) END::BIGINT AS total FROM {_PIXELS} GROUP BY k""")
def decoded_images(t):
    spark, path = _photographs(t, "images", _pattern)
    return readers.images(spark, path).select(keys.stem(C("source_key")).alias("stem"), "height", "width", _total(C("data")).alias("total"))


@query(f"""SELECT (k % 4) || '-' || printf('%04d', k) AS stem, sum((k * 7 + y * 13 + x * 5 + c * 3) % 256)::BIGINT AS total FROM {_PIXELS} WHERE k % 2 = 0 AND k % 5 <> 4 GROUP BY k""")
def wanted_images(t):
    """The listing is filtered first; only the wanted files are opened, here three at a time."""
    spark, path = _photographs(t, "wanted", _pattern)
    number = F.substring_index(keys.stem(C("source_key")), "-", -1).cast("int")
    wanted = readers.listing(spark, path).where((number % 2 == 0) & (number % 5 != 4))
    first, *rest = readers.images_of(spark, wanted, 3)
    for batch in rest:
        first = first.unionByName(batch)
    return first.select(keys.stem(C("source_key")).alias("stem"), _total(C("data")).alias("total"))


def _page(k: int) -> np.ndarray:
    """A bright page on a dark table."""
    x = np.full((72, 52, 3), 25, np.uint8)
    x[6:66, 6:46] = 230
    for y in range(14, 50 - k % 7, 6):
        x[y : y + 2, 11:41] = 60
    return x


@query("""SELECT (n_nationkey % 4) || '-' || printf('%04d', n_nationkey) AS stem, CASE WHEN n_nationkey % 5 = 4 THEN 'reject' ELSE 'one_folio' END AS page_count, CASE WHEN n_nationkey % 5 <> 4 THEN '' END AS label,
CASE WHEN n_nationkey % 5 = 4 THEN 'decode_failed' END AS error, 1::BIGINT AS results FROM nation""")
def streamed_pages(t):
    """Two shards in micro-batches, then all again with another checkpoint: every photograph has one result."""
    spark, path = _photographs(t, "stream", _page)
    out = folder(spark, "streamed")
    for n, shard in enumerate(((0, 2), (1, 2), (0, 1))):
        runner.start(spark, path, out, f"{out}/checkpoint-{n}", per_trigger=16, shard=shard).awaitTermination(600)
    r = spark.read.parquet(f"{out}/results")
    return r.groupBy(keys.stem(C("source_key")).alias("stem"), "page_count", "label", "error").agg(F.count("*").alias("results"))


@query("""SELECT count(*) AS processed, count(*) FILTER (n_nationkey % 5 <> 4) AS folios, count(*) FILTER (n_nationkey % 5 = 4) AS errors FROM nation""")
def stream_counters(t):
    spark, path = _photographs(t, "counted", _page)
    out = folder(spark, "counters")
    runner.start(spark, path, out, f"{out}/checkpoint").awaitTermination(600)
    return runner.counters(spark.read.parquet(f"{out}/results")).select("processed", "folios", "errors")


class _Desk:
    """A transcription service that is done at once."""

    def __init__(self):
        self.states, self.sent, self.meta = iter(("IMPORTING", "DERIVED_READY", "ENQUEUEING", "COMPLETED")), [], {}

    def upload(self, key: str) -> None:
        self.sent.append(key)

    def create(self, metadata: dict, keys: list[str]) -> str:
        self.meta = metadata
        return "job"

    def status(self, job: str) -> str:
        return next(self.states)

    def enqueue(self, job: str) -> None:
        self.meta["started"] = True

    def artefacts(self, job: str) -> list[dict]:
        return [{"kind": "json", "url": "a"}, {"kind": "markdown", "url": "b"}, {"kind": "tables_zip", "url": "c"}]


@query("""SELECT '1' AS volume, count(*) FILTER (n_nationkey % 5 <> 4) AS crops, count(*) FILTER (n_nationkey % 5 <> 4) AS sent, count(*) FILTER (n_nationkey % 5 <> 4) AS coords, count(*) FILTER (n_nationkey % 5 <> 4) AS metadata,
't/1.json;t/1.md' AS artefacts, 'foliate;metadata;transcribe' AS steps, count(*) AS skipped_again FROM nation WHERE n_nationkey % 4 = 1""")
def volume_run(t):
    """A volume from photographs to archived transcripts, then once more without anything to do."""
    spark, path = _photographs(t, "book", _page)
    put(spark, f"{path}/17-0001.png", writers.png(_page(1)))
    out, desk = folder(spark, "books"), _Desk()
    config = {"source": {"path": path}, "crops": {}, "coords": {}, "transcripts": {"prefix": "t/"}, "crop": {}, "api": {}}
    run = volumes.run(spark, config, "1-", desk, out, "2024-01-01T00:00:00Z", steps=["metadata", "transcribe"], sleep=lambda _: None)
    again = volumes.run(spark, config, "1-", _Desk(), out, "2024-01-01T00:00:00Z", dry_run=True)
    views = f"{out}/volumes/{run.volume}"
    row = (run.volume, run.crops, len(desk.sent), spark.read.json(f"{views}/coords").count(), spark.read.parquet(f"{views}/metadata").count(), ";".join(run.artefacts), ";".join(desk.meta["steps"]), again.skipped)
    return spark.createDataFrame([row], "volume string, crops long, sent long, coords long, metadata long, artefacts string, steps string, skipped_again long")


@query("""SELECT 'json' AS kind, 'v/book.json' AS key, count(*) FILTER (o_orderpriority = '1-URGENT') AS n FROM orders UNION ALL SELECT 'markdown', 'missing', 1""")
def archived_artefacts(t):
    kind = F.when(C("o_orderpriority") == "1-URGENT", "json").otherwise("tables_zip")
    kept, missing = writers.archived(t("orders").select(kind.alias("kind")), "v/", "book")
    return kept.groupBy("kind", "key").agg(F.count("*").alias("n")).unionByName(missing.select("kind", L("missing").alias("key"), L(1).cast("long").alias("n")))


@query("SELECT 'destination' AS folder, false AS failed UNION ALL SELECT 'missing', true UNION ALL SELECT 'source', false")
def preflight_probe(t):
    spark, path = _folder_of_files(t, "source")
    failures = writers.preflight(spark, [path, f"{path}/missing"], [path])
    said = [("source", any(f.startswith(f"{path}:") for f in failures)), ("missing", any("/missing:" in f for f in failures)), ("destination", len(failures) > 1)]
    return spark.createDataFrame(said, "folder string, failed boolean")


# ---------------------------------------------------------------- the page pipeline on known scenes
def _scene(k: int) -> np.ndarray:
    """A page of known place, size and turn; from k = 14 on a spread whose fold is at a known column."""
    wide = k >= 14
    h, w = 200, 300 if wide else 150
    x = np.full((h, w, 3), 20, np.uint8)
    x[20 + k % 5 : 180, 12 + k % 7 : w - 12] = 235
    spine = 140 + k
    if wide:
        x[20 + k % 5 : 180, spine - 4 : spine + 5] = 150
    for y in range(40, 150, 10):
        for a, b in ((30, spine - 20), (spine + 20, w - 30)) if wide else ((32, w - 32),):
            x[y : y + 3, a:b] = 60
    return x


@query("""SELECT n_nationkey AS k, CASE WHEN n_nationkey >= 14 THEN 'two_folios' ELSE 'one_folio' END AS page_count, CASE WHEN n_nationkey >= 14 THEN 'A;B' ELSE '' END AS labels, CASE WHEN n_nationkey >= 14 THEN 140 + n_nationkey END::BIGINT AS fold,
true AS upright, CASE WHEN n_nationkey >= 14 THEN 2 ELSE 1 END::BIGINT AS pages FROM nation""")
def scene_pages(t):
    """Photographs of known scenes through the whole pipeline: how many pages, where the fold is, and how they are turned."""
    spark = t("nation").sparkSession
    path = folder(spark, "scenes")
    for n in _nations(t):
        k = n["n_nationkey"]
        put(spark, f"{path}/{k}.png", writers.png(_scene(k)))
    r = P.pages(readers.images(spark, path)).withColumn("k", keys.stem(C("source_key")).cast("long"))
    level = F.abs(F.pmod(C("rotation_deg") + 45, L(90.0)) - 45) < 1.5
    return r.groupBy("k", "page_count").agg(F.array_join(F.sort_array(F.collect_list("label")), ";").alias("labels"), F.max(F.round("seam.mean_x").cast("long")).alias("fold"), F.bool_and(level).alias("upright"), F.count("*").alias("pages")).select("k", "page_count", "labels", "fold", "upright", "pages")
