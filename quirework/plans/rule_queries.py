"""More queries over the supplied tables: rules on geometry and scores, joins and summaries of crops and volumes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quirework.functions import gates, keys, tiles
from quirework.operators import profiles, records, summaries
from quirework.plans.queries import _BOXES, _CROPS, _PROFILE, _SOURCES, _TILES, C, L, _boxes, _crops, _profile, _sources, _tiles, query
from quirework.streaming import jobs


# ---------------------------------------------------------------- keys
@query(r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)/?(.*)$', 1) AS bucket, regexp_extract(url, '^https?://([^/]+)/?(.*)$', 2) AS prefix FROM pages""")
def store_addresses(t):
    uri = F.regexp_replace("url", "^https?://", "s3://")
    return t("pages").select("page_id", keys.store_uri(uri).alias("u")).select("page_id", "u.bucket", "u.prefix")


@query("""SELECT p_partkey, regexp_replace(p_name || repeat('-', (p_partkey % 4)::INT), '-+$', '') AS prefix,
regexp_replace(regexp_replace(p_name || repeat('-', (p_partkey % 4)::INT), '^part ', ''), '-$', '') AS title FROM part""")
def prefixes_and_titles(t):
    name = F.concat("p_name", F.repeat(L("-"), (C("p_partkey") % 4).cast("int")))
    return t("part").select("p_partkey", keys.normalize_prefix(name).alias("prefix"), keys.job_title(name, "part ").alias("title"))


_LABEL = "CASE page % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE 'B' END"


def _labelled(t):
    return _sources(t).withColumn("label", F.when(C("page") % 3 == 0, "").when(C("page") % 3 == 1, "A").otherwise("B"))


@query(f"""SELECT source_key, 'c/' || replace(source_key, '.jpg', '') || {_LABEL} || '.json' AS coord, 'f/' || replace(source_key, '.jpg', '') || CASE WHEN {_LABEL} <> '' THEN '-' || {_LABEL} ELSE '' END || '.jpg' AS dashed FROM ({_SOURCES})""")
def coord_and_dashed_keys(t):
    return _labelled(t).select("source_key", keys.coord_key(C("source_key"), C("label"), "c/").alias("coord"), keys.dashed_key(C("source_key"), C("label"), "f/").alias("dashed"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'json' WHEN 1 THEN 'markdown' WHEN 2 THEN 'tables_zip' ELSE 'other' END AS kind,
CASE WHEN o_custkey % 3 = 0 THEN CASE o_orderkey % 4 WHEN 0 THEN 'artifact_json.json' WHEN 1 THEN 'artifact_markdown.md' WHEN 2 THEN 'artifact_tables_zip.zip' ELSE 'artifact_other' END
WHEN o_custkey % 3 = 1 THEN o_orderkey || CASE o_orderkey % 4 WHEN 0 THEN '.json' WHEN 1 THEN '.md' WHEN 2 THEN '.zip' ELSE '' END
ELSE o_orderkey || '.json' || CASE o_orderkey % 4 WHEN 1 THEN '.md' WHEN 2 THEN '.zip' ELSE '' END END AS name FROM orders""")
def artefact_names(t):
    n = C("o_orderkey") % 4
    kind = F.when(n == 0, "json").when(n == 1, "markdown").when(n == 2, "tables_zip").otherwise("other")
    name = C("o_orderkey").cast("string")
    key = F.when(C("o_custkey") % 3 == 0, "").when(C("o_custkey") % 3 == 1, F.concat(L("jobs/1/"), name)).otherwise(F.concat(L("jobs/1/"), name, L(".json")))
    return t("orders").select("o_orderkey", kind.alias("kind"), keys.artefact_name(kind, key).alias("name"))


@query("""SELECT l_orderkey, l_linenumber, ((l_linenumber % 4) + round_even((l_quantity * 7 - 180) / 90, 0) + 400)::BIGINT % 4 AS quarters FROM lineitem""")
def applied_turns(t):
    turns = gates.applied_quarters(C("l_linenumber") % 4, C("l_quantity") * 7 - 180)
    return t("lineitem").select("l_orderkey", "l_linenumber", turns.cast("long").alias("quarters"))


# ---------------------------------------------------------------- resume, joins
@query(f"""WITH s AS ({_SOURCES}), e AS (SELECT source_key, page FROM s) SELECT source_key, volume, page FROM s WHERE page % 4 NOT IN (0, 1)""")
def resume_local_files(t):
    s = _sources(t)
    ending = F.when(C("page") % 4 == 0, ".jpg").when(C("page") % 4 == 1, "-A.jpg").when(C("page") % 4 == 2, "-B.jpg")
    there = s.select(F.concat(keys.stem(C("source_key")), ending).alias("name")).where("name IS NOT NULL")
    return records.resume_local(s, there)


@query(f"""SELECT c.volume, count(*) AS crops, count(*) FILTER (coalesce(m.flag, false)) AS flagged, count(m.image) AS listed FROM {_CROPS} c
LEFT JOIN (SELECT image, line, bool_or(flag) AS flag FROM {_CROPS} WHERE line <> 2 GROUP BY ALL) m USING (image, line) GROUP BY c.volume""")
def review_flags(t):
    name = F.concat_ws("-", "image", "line")
    crops = _crops(t).select("volume", name.alias("file"))
    manifest = _crops(t).where("line != 2").groupBy(name.alias("file")).agg(F.bool_or("flag").alias("needs_review"))
    out = records.with_review(crops, manifest, "file").join(manifest.select("file", L(1).alias("listed")), "file", "left")
    return out.groupBy("volume").agg(F.count("*").alias("crops"), F.count_if("needs_review").alias("flagged"), F.count("listed").alias("listed"))


@query(f"SELECT volume, image, line, round(aspect, 6) AS aspect FROM {_CROPS} WHERE list_contains(reasons, 'unexpected_aspect')")
def flagged_for_aspect(t):
    return records.flagged_for(_crops(t), C("reasons"), "unexpected_aspect").select("volume", "image", "line", F.round("aspect", 6).alias("aspect"))


@query("""SELECT l.l_orderkey AS image, l.l_linenumber AS line, any_value(o.o_custkey) AS width, max(l.l_quantity) AS x FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_linenumber <= 2 AND l.l_discount > 0 AND o.o_orderkey % 3 <> 0 GROUP BY ALL""")
def crops_in_originals(t):
    name = F.concat_ws("-", "l_orderkey", "l_linenumber")
    li = t("lineitem")
    crops = li.where("l_linenumber <= 2").select(name.alias("crop"), C("l_orderkey").alias("image"), C("l_linenumber").alias("line")).distinct()
    place = F.max(F.when(C("l_discount") > 0, C("l_quantity")))
    coords = li.groupBy(name.alias("crop"), C("l_orderkey").alias("source_key")).agg(place.alias("x"))
    coords = coords.select("crop", "source_key", F.array("x").alias("source_size"), F.when(C("x").isNotNull(), F.array("x")).alias("crop_quad_norm"))
    originals = t("orders").where("o_orderkey % 3 != 0").select(C("o_orderkey").alias("source_key"), C("o_custkey").alias("width"))
    return records.with_place(crops, coords, originals).select("image", "line", "width", C("crop_quad_norm")[0].alias("x"))


@query(f"""SELECT source_key, page FROM (SELECT * FROM ({_SOURCES}) ORDER BY source_key LIMIT 100) WHERE page % 2 <> 0""")
def limit_then_resume(t):
    first = _sources(t).orderBy("source_key").limit(100)
    done = _sources(t).where("page % 2 = 0").select(C("source_key").alias("crop"))
    return records.resume(first, done)[0].select("source_key", "page")


# ---------------------------------------------------------------- summaries
@query(f"""SELECT count(DISTINCT image) AS sources, count(*) AS crops, count(*) FILTER (line = 1) AS one_folio, count(*) FILTER (line <> 1) AS two_folios, count(*) FILTER (flag) AS needs_review,
count(*) FILTER (is_blank) AS is_blank, min(quantity / (price / 1000)) AS aspect_min, max(quantity / (price / 1000)) AS aspect_max, count(*) FILTER (quantity / (price / 1000) < 1) AS portrait,
count(*) FILTER (quantity / (price / 1000) >= 1 OR greatest(quantity, price / 1000) > 2.41 * least(quantity, price / 1000) OR price / 500 < 45) AS odd, count(*) FILTER (discount > 0) AS with_provenance FROM {_CROPS}""")
def output_summary(t):
    count = F.when(C("line") == 1, "one_folio").otherwise("two_folios")
    return summaries.output_summary(_crops(t), C("image"), count, C("quantity"), C("price") / 1000, C("price") / 500, C("flag"), C("is_blank"), C("discount") > 0)


@query(f"""SELECT volume, count(*) AS images, count(*) FILTER (f > 0) AS review, sum(b)::BIGINT AS blank, sum(f)::BIGINT AS flagged FROM
(SELECT volume, image, count(*) FILTER (is_blank) AS b, count(*) FILTER (len(reasons) > 0) AS f FROM {_CROPS} GROUP BY ALL) GROUP BY volume""")
def prefix_counters(t):
    return summaries.prefix_counters(_crops(t), "volume", "image", F.size("reasons") > 0, C("is_blank"))


@query("""SELECT conv_id AS page, sum((0.5 + (turn % 5) / 10.0) * length(text)) AS score FROM conversations WHERE text IS NOT NULL GROUP BY conv_id""")
def legibility_scores(t):
    return summaries.legibility(t("conversations").where("text IS NOT NULL"), "conv_id", C("text"), 0.5 + (C("turn") % 5) / 10.0).withColumnRenamed("conv_id", "page")


_RECTS = "(SELECT l_orderkey AS image, floor(l_quantity) AS x0, floor(l_extendedprice / 1000) AS y0, floor(l_quantity) + 20 AS x1, floor(l_extendedprice / 1000) + 15 AS y1 FROM lineitem)"


@query(f"""WITH c AS (SELECT image, x, y FROM (SELECT DISTINCT image, unnest(range(x0::INT, x1::INT)) AS x, y0, y1 FROM {_RECTS}), LATERAL (SELECT unnest(range(y0::INT, y1::INT)) AS y) GROUP BY ALL)
SELECT image, count(*) FILTER (x BETWEEN 10 AND 49 AND y BETWEEN 5 AND 64) / count(*) AS coverage, count(*) FILTER (x BETWEEN 10 AND 49 AND y BETWEEN 5 AND 64) / 2400 AS meaningful FROM c GROUP BY image""")
def crop_coverage(t):
    li = t("lineitem")
    rects = li.select(C("l_orderkey").alias("image"), F.floor("l_quantity").alias("x0"), F.floor(C("l_extendedprice") / 1000).alias("y0"), (F.floor("l_quantity") + 20).alias("x1"), (F.floor(C("l_extendedprice") / 1000) + 15).alias("y1"))
    return summaries.coverage(rects, "image", (L(10), L(5), L(50), L(65)))


@query(f"""WITH b AS (SELECT page, greatest(0, floor(min(x0) - 0.02 * sqrt(1300.0 * 1300.0 + 70.0 * 70.0)))::BIGINT AS x0, greatest(0, floor(min(y0) - 0.02 * sqrt(1300.0 * 1300.0 + 70.0 * 70.0)))::BIGINT AS y0,
least(70, floor(max(x1) + 0.02 * sqrt(1300.0 * 1300.0 + 70.0 * 70.0)))::BIGINT AS x1, least(1300, floor(max(y1) + 0.02 * sqrt(1300.0 * 1300.0 + 70.0 * 70.0)))::BIGINT AS y1 FROM {_BOXES} GROUP BY page)
SELECT * FROM b WHERE x1 - x0 >= 0.45 * 70 AND y1 - y0 >= 0.45 * 1300""")
def text_regions(t):
    return summaries.text_region(_boxes(t), "page", L(70), L(1300))


@query(f"""WITH c AS (SELECT *, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy FROM {_BOXES}), m AS (SELECT page, median(cx) AS mx, median(cy) AS my, count(*) AS n FROM c GROUP BY page),
d AS (SELECT c.*, n, sqrt((cx - mx) * (cx - mx) + (cy - my) * (cy - my)) AS d FROM c JOIN m USING (page)), s AS (SELECT page, median(d) AS m FROM d GROUP BY page), a AS (SELECT page, median(abs(d - m)) AS mad FROM d JOIN s USING (page) GROUP BY page)
SELECT page, count(*) AS lines, min(floor(y0))::BIGINT AS top, max(floor(y1))::BIGINT AS bottom FROM d JOIN s USING (page) JOIN a USING (page) WHERE n < 4 OR d <= m + 3.0 * (mad + 1e-6) GROUP BY page""")
def text_lines_kept(t):
    kept = summaries.outliers_left_out(_boxes(t), "page")
    return kept.groupBy("page").agg(F.count("*").alias("lines"), F.min(F.floor("y0")).alias("top"), F.max(F.floor("y1")).alias("bottom"))


# ---------------------------------------------------------------- decisions
@query("""SELECT o_orderkey, CASE WHEN o_custkey % 11 = 0 THEN 'decode_failed' WHEN o_custkey % 7 = 0 THEN 'rejected_non_page' WHEN o_custkey % 3 = 0 THEN 'no_page_detected' WHEN o_orderkey % 5 = 0 THEN 'no_valid_folio' END AS error FROM orders""")
def image_errors(t):
    count = F.when(C("o_custkey") % 7 == 0, "reject").otherwise("one_folio")
    return t("orders").select("o_orderkey", gates.image_error(C("o_custkey") % 11, count, C("o_custkey") % 3, C("o_orderkey") % 5).alias("error"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CASE WHEN p_size * 30 > floor(p_retailprice) THEN 3 ELSE 0 END ELSE CASE WHEN floor(p_retailprice) > p_size * 30 THEN 3 ELSE 0 END END AS turns FROM part""")
def legacy_turns(t):
    return t("part").select("p_partkey", gates.legacy_turn(C("p_size") % 2 == 0, F.floor("p_retailprice"), C("p_size") * 30).alias("turns"))


@query(f"SELECT vec_id, avg((v > 0.3)::INT) > 0.05 AS replaced FROM (SELECT vec_id, unnest(x) AS v FROM {_TILES}) GROUP BY vec_id")
def learned_masks_used(t):
    share = F.aggregate(F.transform("x", lambda v: F.when(v > 0.3, 1.0).otherwise(0.0)), L(0.0), lambda a, b: a + b) / F.size("x")
    return _tiles(t).select("vec_id", gates.masks_used(share).alias("replaced"))


@query(f"""WITH c AS (SELECT vec_id, unnest(x) AS v, unnest(range(0, 64)) AS i FROM {_TILES}), s AS (SELECT vec_id, count(*) FILTER (v > 0) * 20 AS n, coalesce(avg(i // 8) FILTER (v > 0), 0) / 8 AS y FROM c GROUP BY vec_id),
p AS (SELECT vec_id, CASE WHEN n > 50 THEN 0.2 + 0.6 * (1 - y) ELSE 0.40 END AS up, CASE WHEN n > 50 THEN 0.2 + 0.6 * y ELSE 0.10 END AS down FROM s)
SELECT vec_id, round(up / (up + down), 9) AS upright, round(down / (up + down), 9) AS turned FROM p""")
def centroid_orientation(t):
    ink = F.filter(F.transform("x", lambda v, i: F.when(v > 0, F.floor(i / 8))), lambda r: r.isNotNull())
    rows = _tiles(t).select("vec_id", (F.size(ink) * 20).alias("n"), (F.coalesce(F.try_divide(F.aggregate(ink, L(0).cast("long"), lambda a, b: a + b), F.size(ink)), L(0.0)) / 8).alias("y"))
    p = gates.ink_centroid_probs(C("n"), 1 - C("y"), C("y"))
    return rows.select("vec_id", F.round(p[0], 9).alias("upright"), F.round(p[2], 9).alias("turned"))


@query(f"""SELECT volume, image, line, CASE WHEN price > 1.15 * 30000 THEN 0.1 ELSE 1 - discount * 10 END AS upright, CASE WHEN price > 1.15 * 30000 THEN 0.4 ELSE 0.0 END AS sideways FROM {_CROPS}""")
def legacy_orientations(t):
    p = gates.legacy_orientation(C("discount") * 10, C("price"), L(30000))
    return _crops(t).select("volume", "image", "line", p.alias("p")).select("volume", "image", "line", C("p")[0].alias("upright"), C("p")[1].alias("sideways"))


@query("""SELECT p_partkey, list_filter([CASE WHEN a < 0.5 THEN 'sliver' END, CASE WHEN a >= 1 THEN 'landscape' END, CASE WHEN least(w, h) < 200 THEN 'tiny' END, CASE WHEN p_size * 5 < 70 THEN 'dark' END, CASE WHEN p_size / 50.0 > 0.55 THEN 'mostly-white' END], lambda x: x IS NOT NULL)::VARCHAR AS flags
FROM (SELECT *, w / h AS a FROM (SELECT p_partkey, p_size, p_size * 40.0 AS w, floor(p_retailprice)::DOUBLE AS h FROM part))""")
def crop_shapes(t):
    w, h = C("p_size") * 40.0, F.floor("p_retailprice")
    flags = gates.shape_flags(w / h, w, h, C("p_size") * 5, C("p_size") / 50.0)
    return t("part").select("p_partkey", F.concat(L("["), F.array_join(flags, ", "), L("]")).alias("flags"))


@query(f"""WITH p AS ({"SELECT id, pos, value FROM " + _PROFILE}), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY id) AS n FROM p),
m AS (SELECT id, median(value) + 1e-6 AS m, min(value) FILTER (i >= floor(0.4 * n) AND i < floor(0.6 * n)) AS low FROM n GROUP BY id) SELECT id, coalesce(low, m) / m AS valley FROM m""")
def profile_priors(t):
    return profiles.priors(_profile(t), value="value")


@query(f"""WITH p AS ({"SELECT id, pos, value FROM " + _PROFILE}), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY id) AS n, median(value) OVER (PARTITION BY id) AS m FROM p)
SELECT id, i AS place, value / greatest(m, 0.05) AS ratio FROM n WHERE i >= floor(0.18 * n) AND i < floor(0.82 * n) QUALIFY row_number() OVER (PARTITION BY id ORDER BY value DESC, i) = 1""")
def profile_spine(t):
    return profiles.spine(_profile(t), value="value")


# ---------------------------------------------------------------- geometry
@query("""WITH b AS (SELECT p_partkey, p_size * 10 AS a2, p_size * 10 + (p_partkey % 5 - 2) * 20 AS b1, floor(p_retailprice)::BIGINT AS w FROM part)
SELECT p_partkey, greatest(0, CASE WHEN b1 > a2 THEN a2 - floor(0.04 * w) ELSE floor((0 + a2 + b1 + w) / 4) - greatest(floor(0.08 * w), 8) END)::BIGINT AS low,
least(w, CASE WHEN b1 > a2 THEN b1 + floor(0.04 * w) ELSE floor((0 + a2 + b1 + w) / 4) + greatest(floor(0.08 * w), 8) END)::BIGINT AS high FROM b""")
def gutter_bands(t):
    b = gates.gutter_band(L(0), C("p_size") * 10, C("p_size") * 10 + (C("p_partkey") % 5 - 2) * 20, F.floor("p_retailprice"), F.floor("p_retailprice"))
    return t("part").select("p_partkey", b.alias("b")).select("p_partkey", "b.low", "b.high")


def _quad(c):
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    a, b = C("l_quantity"), C("l_tax") * 100
    return F.array(point(a, b), point(a + 100, b + 5), point(a + 95, b + 150), point(a - 5, b + 140))


@query("""SELECT l_orderkey, l_linenumber, l_quantity + ((l_quantity + 100) - l_quantity) * (l_discount * 5) AS top_x, l_tax * 100 + ((l_tax * 100 + 5) - l_tax * 100) * (l_discount * 5) AS top_y, l_linenumber % 2 = 0 AS kept_left FROM lineitem""")
def quad_split(t):
    t_ = C("l_discount") * 5
    left = C("l_linenumber") % 2 == 0
    q = gates.split_quad(_quad(t), t_, left)
    cut = F.when(left, q[1]).otherwise(q[0])
    return t("lineitem").select("l_orderkey", "l_linenumber", cut.alias("p"), left.alias("kept_left")).select("l_orderkey", "l_linenumber", C("p.x").alias("top_x"), C("p.y").alias("top_y"), "kept_left")


@query("""SELECT l_orderkey, l_linenumber, (round_even(greatest(sqrt(100.0 * 100 + 5 * 5), sqrt(100.0 * 100 + 10 * 10)), 0) + 1)::BIGINT AS width, (round_even(greatest(sqrt(5.0 * 5 + 140 * 140), sqrt(5.0 * 5 + 145 * 145)), 0) + 1)::BIGINT AS height FROM lineitem""")
def straightened_sizes(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", gates.straight_size(_quad(t)).alias("s")).select("l_orderkey", "l_linenumber", "s.width", "s.height")


@query("""WITH a AS (SELECT p_partkey, p_size * 40 AS w, floor(p_retailprice)::BIGINT AS h, abs(cos(radians(p_size - 25.0))) AS c, abs(sin(radians(p_size - 25.0))) AS s FROM part)
SELECT p_partkey, round_even(h * s + w * c, 0)::BIGINT AS width, round_even(h * c + w * s, 0)::BIGINT AS height FROM a""")
def turned_sizes(t):
    s = gates.turned_size(C("p_size") * 40, F.floor("p_retailprice"), C("p_size") - 25.0)
    return t("part").select("p_partkey", s.alias("s")).select("p_partkey", "s.width", "s.height")


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, l_tax * 100 AS b, l_linenumber % 4 AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, a AS tl_x, b AS tl_y, a + 100 AS tr_x, a + 95 AS br_x, a - 5 AS bl_x FROM p""")
def corners_in_order(t):
    q = _quad(t)
    n = C("l_linenumber") % 4
    turned = F.concat(F.slice(q, n + 1, 4), F.slice(q, L(1), n))  # the same corners, begun at another one
    o = gates.order_quad(turned)
    return t("lineitem").select("l_orderkey", "l_linenumber", o.alias("o")).select("l_orderkey", "l_linenumber", C("o")[0]["x"].alias("tl_x"), C("o")[0]["y"].alias("tl_y"), C("o")[1]["x"].alias("tr_x"), C("o")[2]["x"].alias("br_x"), C("o")[3]["x"].alias("bl_x"))


@query(f"""WITH c AS (SELECT *, floor(quantity * 10)::BIGINT AS w, floor(price / 100)::BIGINT AS h FROM {_CROPS}), m AS (SELECT volume, max(w) AS cw, max(h) AS ch FROM c GROUP BY volume)
SELECT volume, image, line, floor((cw - w) / 2)::BIGINT AS x, floor((ch - h) / 2)::BIGINT AS y FROM c JOIN m USING (volume)""")
def canvas_places(t):
    w, h = F.floor(C("quantity") * 10), F.floor(C("price") / 100)
    v = Window.partitionBy("volume")
    p = gates.canvas_place(w, h, F.max(w).over(v), F.max(h).over(v))
    return _crops(t).select("volume", "image", "line", p.alias("p")).select("volume", "image", "line", "p.x", "p.y")


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size END::BIGINT AS x0, CASE WHEN p_size % 3 = 0 THEN 100 ELSE p_size + 40 END::BIGINT AS x1 FROM part""")
def candidate_crops(t):
    found = F.when(C("p_size") % 3 != 0, F.struct(C("p_size").cast("long").alias("x0"), L(5).cast("long").alias("y0"), (C("p_size") + 40).cast("long").alias("x1"), L(90).cast("long").alias("y1")))
    return t("part").select("p_partkey", gates.crop_box(found, L(100), L(200)).alias("b")).select("p_partkey", "b.x0", "b.x1")


# ---------------------------------------------------------------- measures on small grids
_GRAYS = f"(SELECT vec_id, unnest(list_transform(x, lambda v: least(255, greatest(0, floor(128 + 256 * v)))::INT)) AS g, unnest(range(0, 64)) AS i FROM {_TILES})"


def _grays(t):
    return _tiles(t).select("vec_id", F.transform("x", lambda v: F.least(L(255), F.greatest(L(0), F.floor(128 + 256 * v))).cast("int")).alias("g"))


@query(f"SELECT vec_id, avg((g >= 250)::INT) AS white, avg((g < 110 AND i // 8 = 0)::INT) * 8 AS top, avg((g < 110 AND i % 8 = 7)::INT) * 8 AS right FROM {_GRAYS} GROUP BY vec_id")
def tile_white_and_edges(t):
    e = tiles.edge_share(C("g"), 8, 110)
    return _grays(t).select("vec_id", tiles.share(C("g"), lambda v: v >= 250).alias("white"), e["top"].alias("top"), e["right"].alias("right"))


@query(f"""WITH p AS (SELECT a.vec_id, a.i, a.g < 110 AND b.g >= 128 AS gone, a.g < 110 AS ink FROM {_GRAYS} a JOIN {_GRAYS} b ON b.vec_id = a.vec_id + 1 AND b.i = a.i)
SELECT vec_id, coalesce(count(*) FILTER (gone) / nullif(count(*) FILTER (ink), 0), 0) AS erased, count(*) FILTER (gone AND i // 8 BETWEEN 1 AND 6 AND i % 8 BETWEEN 1 AND 6) AS inner FROM p GROUP BY vec_id""")
def tile_erased(t):
    a = _grays(t).withColumnRenamed("g", "a")
    b = _grays(t).select((C("vec_id") - 1).alias("vec_id"), C("g").alias("b"))
    gone = F.zip_with("a", "b", lambda x, y: (x < 110) & (y >= 128))
    n = lambda m: F.size(F.filter(m, lambda v: v))
    inner = F.filter(F.transform(gone, lambda v, i: v & F.floor(i / 8).between(1, 6) & (i % 8).between(1, 6)), lambda v: v)
    return a.join(b, "vec_id").select("vec_id", F.coalesce(F.try_divide(n(gone), n(F.transform("a", lambda x: x < 110))), L(0.0)).alias("erased"), F.size(inner).cast("long").alias("inner"))


@query(f"""WITH c AS (SELECT a.vec_id, a.i, a.g, avg(b.g) AS m FROM {_GRAYS} a JOIN {_GRAYS} b ON b.vec_id = a.vec_id AND b.i // 8 = a.i // 8 AND abs(b.i - a.i) <= 1 GROUP BY ALL)
SELECT vec_id, count(*) FILTER (g <= m - 10) AS ink, avg((m - g > 6)::INT) AS dark FROM c GROUP BY vec_id""")
def tile_local_ink(t):
    rows = _grays(t).select("vec_id", F.posexplode("g").alias("i", "g"))
    w = Window.partitionBy("vec_id", F.floor(C("i") / 8)).orderBy("i").rowsBetween(-1, 1)
    rows = rows.withColumn("m", F.avg("g").over(w))
    return rows.groupBy("vec_id").agg(F.count_if(C("g") <= C("m") - 10).alias("ink"), F.avg((C("m") - C("g") > 6).cast("int")).alias("dark"))


# ---------------------------------------------------------------- jobs
@query(f"""SELECT replace(source_key, '.jpg', '.pdf') AS name, NULL AS source_key, true AS unknown FROM ({_SOURCES}) WHERE page % 5 = 0
UNION ALL SELECT source_key, 'in/' || source_key, false FROM ({_SOURCES}) WHERE page % 5 <> 0""")
def upload_targets(t):
    s = _sources(t)
    name = F.when(C("page") % 5 == 0, F.regexp_replace("source_key", "jpg$", "pdf")).otherwise(C("source_key"))
    return records.upload_targets(s.select(name.alias("name"), L("u").alias("url")), s.select(F.concat(L("in/"), "source_key").alias("source_key"))).drop("url")


@query("""SELECT o_orderkey, o_orderstatus = 'F' AS override, CASE WHEN o_orderstatus = 'F' THEN 'foliate;metadata;transcribe' ELSE 'transcribe' END AS steps FROM orders""")
def job_steps(t):
    """The driver makes the two kinds of metadata; the rows take theirs by a map."""
    made = {s: jobs.metadata({"api": {"steps": s.split(";")}}, "t", s.split(";")) for s in ("metadata;transcribe", "transcribe")}
    steps = F.when(C("o_orderstatus") == "F", "metadata;transcribe").otherwise("transcribe")
    said = F.create_map(*[L(x) for k, m in made.items() for x in (k, ";".join(m["steps"]))])
    override = F.create_map(*[L(x) for k, m in made.items() for x in (k, m["foliation_override_discrete"])])
    return t("orders").select("o_orderkey", override[steps].alias("override"), said[steps].alias("steps"))


@query("""WITH t AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, event_type = 'error' AS failed FROM events), f AS (SELECT user_id, coalesce(min(i) FILTER (NOT failed), 99) AS good, count(*) AS n FROM t GROUP BY user_id)
SELECT user_id, (CASE WHEN least(good, 5) <= n THEN least(good, 5) ELSE n END)::INT AS tries, good <= 5 AS done, (pow(2, least(good, 5, n) - 1) - 1)::DOUBLE AS waited FROM f""")
def upload_retries(t):
    """Each user's events in order as the outcomes of one upload: five tries at most, 1, 2, 4 and 8 seconds between them."""
    return jobs.retried(t("events"), "user_id", ["ts", "event_id"], C("event_type") == "error")
