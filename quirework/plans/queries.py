"""The queries over the supplied tables, each with the DuckDB SQL that gives the same rows.

The tables stand in for the engine's own (see README): documents for transcriptions, lineitem for
crops with their measures, conversations for volume and page numbers, embeddings for probability
vectors and 8 x 8 tiles, events for profiles and status logs, pages for object keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import gates, keys, text, tiles
from quirework.operators import profiles, records, summaries

C, L = F.col, F.lit


@dataclass(frozen=True)
class Query:
    run: Callable[[Callable[[str], DataFrame]], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = Query(f, sql)
        return f

    return add


def bound(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: q.run(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


# ---------------------------------------------------------------- transcriptions
_SQUEEZED = r"regexp_replace(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"
_WORDS = f"len(list_filter(string_split({_SQUEEZED}, ' '), lambda w: w <> ''))"


def _sparse(t):
    return t("documents").select(C("doc_id").alias("image"), C("source").alias("volume"), text.char_count(C("text")).alias("chars"), text.word_count(C("text")).alias("words")).withColumn("sparse", C("chars") <= 120)


@query(f"SELECT doc_id AS image, source AS volume, length({_SQUEEZED})::INT AS chars, {_WORDS}::INT AS words, length({_SQUEEZED}) <= 120 AS sparse FROM documents")
def sparse_documents(t):
    return _sparse(t)


@query(f"""SELECT source AS volume, count(*) AS pages, count(*) FILTER (length({_SQUEEZED}) <= 120) AS sparse, count(*) FILTER (length({_SQUEEZED}) = 0) AS empty,
round(100.0 * count(*) FILTER (length({_SQUEEZED}) <= 120) / count(*), 6) AS percent FROM documents GROUP BY source""")
def sparse_summary(t):
    n = F.count("*")
    return _sparse(t).groupBy("volume").agg(n.alias("pages"), F.count_if("sparse").alias("sparse"), F.count_if(C("chars") == 0).alias("empty"), F.round(100.0 * F.count_if("sparse") / n, 6).alias("percent"))


@query(f"SELECT doc_id AS image, length({_SQUEEZED})::INT AS chars FROM documents ORDER BY chars, source, doc_id LIMIT 12")
def shortest_documents(t):
    return _sparse(t).orderBy("chars", "volume", "image").limit(12).select("image", "chars")


_SAID = "regexp_replace(coalesce(text, ''), '[^A-Za-z0-9 _]', '', 'g')[1:200]"


@query(f"SELECT doc_id, 2 AS n, doc_id || '.jpg' AS file, {_SAID} AS first, 'second_' || lang AS second FROM documents")
def lenient_transcriptions(t):
    """Two records per list, strict, with escaped marks or cut off; the texts hold underscores, brackets stand around."""
    said = text.first_kept(C("text"), "A-Za-z0-9 _", 200)
    name = F.concat(C("doc_id"), L(".jpg"))
    pair = lambda f, x: F.struct(f.alias("file"), x.alias("transcription"))
    whole = F.to_json(F.array(pair(name, said), pair(L("x"), F.concat(L("second_"), "lang"))))
    docs = t("documents").select("doc_id", whole.alias("whole"))
    whole = C("whole")
    spoilt = F.when(C("doc_id") % 3 == 1, F.regexp_replace(whole, r"[\[\]_]", r"\\$0")).when(C("doc_id") % 3 == 2, F.regexp_replace(whole, r"\]$", "")).otherwise(whole)
    found = text.lenient_records(spoilt, "array<struct<file:string,transcription:string>>")
    return docs.select("doc_id", found.alias("r")).select("doc_id", F.size("r").alias("n"), C("r")[0]["file"].alias("file"), C("r")[0]["transcription"].alias("first"), C("r")[1]["transcription"].alias("second"))


# ---------------------------------------------------------------- keys and records
@query(r"""SELECT page_id, regexp_extract(url, '^([a-z0-9]+)://', 1) AS scheme, regexp_extract(url, '^[a-z0-9]+://([^/?#]+)', 1) AS host,
regexp_extract(url, '^[a-z0-9]+://[^/?#]+([^?#]*)', 1) AS path,
regexp_replace(string_split(regexp_extract(url, '^[a-z0-9]+://[^/?#]+([^?#]*)', 1), '/')[-1], '(.)\.[^.]*$', '\1') AS stem,
regexp_replace(regexp_extract(url, '^[a-z0-9]+://[^/?#]+([^?#]*)', 1), '([^/])\.[^./]*$', '\1') || 'A.jpg' AS crop,
regexp_matches(lower(url), '\.(jpe?g|png|tiff?)$') AS is_image FROM pages""")
def key_parts(t):
    path = F.regexp_extract("url", "^[a-z0-9]+://[^/?#]+([^?#]*)", 1)
    return t("pages").select(
        "page_id", F.regexp_extract("url", "^([a-z0-9]+)://", 1).alias("scheme"), F.regexp_extract("url", "^[a-z0-9]+://([^/?#]+)", 1).alias("host"), path.alias("path"),
        keys.stem(path).alias("stem"), keys.crop_key(path, L("A")).alias("crop"), keys.is_image(C("url")).alias("is_image"),
    )


def _sources(t):
    return t("conversations").select(F.format_string("%d-%04d.jpg", "conv_id", "turn").alias("source_key"), C("conv_id").cast("string").alias("volume"), C("turn").alias("page"))


_SOURCES = "SELECT printf('%d-%04d.jpg', conv_id, turn) AS source_key, conv_id::VARCHAR AS volume, turn AS page FROM conversations"


@query(f"SELECT source_key, volume, replace(source_key, '.jpg', '') || s || '.jpg' AS crop FROM ({_SOURCES}), (SELECT unnest(['', 'A', 'B']) AS s)")
def expected_output_keys(t):
    return _sources(t).select("source_key", keys.volume_of(C("source_key")).alias("volume"), F.explode(keys.expected_keys(C("source_key"))).alias("crop"))


def _existing(t):
    return _sources(t).where("page % 2 = 0").select(keys.crop_key(C("source_key"), F.when(C("page") % 4 == 0, "A").otherwise("")).alias("crop"))


@query(f"SELECT source_key, volume, page FROM ({_SOURCES}) s WHERE page % 2 <> 0")
def resume_todo(t):
    return records.resume(_sources(t), _existing(t))[0]


@query(f"SELECT source_key, replace(source_key, '.jpg', '') || CASE WHEN page % 4 = 0 THEN 'A' ELSE '' END || '.jpg' AS crop FROM ({_SOURCES}) WHERE page % 2 = 0")
def resume_done(t):
    return records.resume(_sources(t), _existing(t))[1].select("source_key", "crop")


@query(f"SELECT source_key, volume, page FROM ({_SOURCES}) WHERE page % 2 <> 0")
def resume_by_stem(t):
    return records.resume_by_stem(_sources(t), _existing(t))


@query(f"SELECT source_key AS crop, page, NULL::BOOLEAN AS status_unknown FROM ({_SOURCES}) WHERE page % 2 <> 0 UNION ALL SELECT source_key, NULL, true FROM ({_SOURCES}) WHERE page % 2 = 0")
def record_union(t):
    s = _sources(t).withColumnRenamed("source_key", "crop")
    return records.unioned(s.where("page % 2 != 0").select("crop", "page"), s.where("page % 2 = 0").select("crop", L(True).alias("status_unknown"))).orderBy("crop")


@query(r"""SELECT doc_id, source AS label, lang = 'en' AS is_blank, printf('%.3f', n_chars / 1000.0)::DOUBLE AS orientation_conf, 0.0 AS blank_conf, NULL::DOUBLE AS text_frac, false AS status_unknown, 2 AS n_reasons FROM documents""")
def metadata_round_trip(t):
    record = {"label": C("source"), "blank": C("lang") == "en", "review": L(True), "reasons": L("a,, b"), "orientation_conf": C("n_chars") / 1000.0, "text_frac": L("none")}
    meta = keys.decode_metadata(keys.encode_metadata(record, {"orientation_conf": 3}))
    return t("documents").select("doc_id", meta.alias("m")).select("doc_id", "m.label", "m.is_blank", "m.orientation_conf", "m.blank_conf", "m.text_frac", "m.status_unknown", F.size("m.review_reasons").alias("n_reasons"))


@query()
def shard_assignment(t):
    return t("pages").select("page_id", keys.shard(C("url"), 8).alias("shard"), keys.in_shard(C("url"), 3, 8).alias("mine"))


@query("""SELECT conv_id, role, min(turn) AS first_turn FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system') GROUP BY ALL""")
def three_way_join(t):
    c = t("conversations")
    a = c.groupBy("conv_id", "role").agg(F.min("turn").alias("first_turn"))
    b = c.where("role = 'system'").select("conv_id").distinct()
    d = c.select("conv_id").distinct()
    return records.common_names(a, b, d, key="conv_id").select("conv_id", "role", "first_turn")


@query("""SELECT c.conv_id, c.turn, m.role FROM (SELECT conv_id, turn FROM conversations) c JOIN (SELECT conv_id, arg_min(role, turn) AS role FROM conversations GROUP BY conv_id) m USING (conv_id)""")
def first_matching_mask(t):
    c = t("conversations")
    return records.first_match(c.select("conv_id", "turn"), c.select("conv_id", "role", C("turn").alias("_t")), "conv_id", C("_t")).select("conv_id", "turn", "role")


@query("""SELECT d.doc_id FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY d.doc_id LIMIT 60""")
def control_set(t):
    return records.control_set(t("documents").select("doc_id"), t("labels"), "doc_id", 60)


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE (n - 1) % 5 = 0""")
def systematic_sample(t):
    return records.systematic_sample(t("events"), "user_id", ["ts", "event_id"], 5).select("user_id", "event_id")


@query("SELECT DISTINCT o_orderpriority AS model FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def model_vocab_violations(t):
    o = t("orders").select(C("o_orderpriority").alias("model"))
    allowed = o.sparkSession.createDataFrame([("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",)], "model string")
    return records.vocabulary_violations(o, F.broadcast(allowed), ["model"])  # a list in the code


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, count(*) AS n_events, arg_max(event_type, (ts, event_id)) IN ('purchase', 'error') AS ended FROM events GROUP BY user_id""")
def job_latest_status(t):
    return records.latest_status(t("events"), "user_id", "event_type", ["ts", "event_id"]).withColumn("ended", C("status").isin("purchase", "error"))


# ---------------------------------------------------------------- gates and reports
def _crops(t):
    return t("lineitem").select(
        C("l_suppkey").alias("volume"), C("l_orderkey").alias("image"), C("l_linenumber").alias("line"), (C("l_quantity") / 50).alias("aspect"), (1 - 5 * C("l_discount")).alias("orientation_conf"),
        C("l_tax").alias("text_frac"), (C("l_extendedprice") / 100000).alias("area_frac"), (C("l_returnflag") == "R").alias("flag"), (C("l_tax") == 0).alias("is_blank"),
        C("l_extendedprice").alias("price"), C("l_quantity").alias("quantity"), C("l_shipdate").alias("shipped"), C("l_discount").alias("discount"),
    ).withColumn("reasons", gates.review_reasons(C("text_frac"), C("orientation_conf"), C("area_frac"), C("aspect")))


_CROPS = """(SELECT l_suppkey AS volume, l_orderkey AS image, l_linenumber AS line, l_quantity / 50 AS aspect, 1 - 5 * l_discount AS orientation_conf, l_tax AS text_frac,
l_extendedprice / 100000 AS area_frac, l_returnflag = 'R' AS flag, l_tax = 0 AS is_blank, l_extendedprice AS price, l_quantity AS quantity, l_shipdate AS shipped, l_discount AS discount,
list_filter([CASE WHEN l_tax < 0.075 THEN 'low_text_for_orientation' END, CASE WHEN 1 - 5 * l_discount < 0.70 THEN 'low_orientation_conf' END,
CASE WHEN l_extendedprice / 100000 < 0.10 THEN 'page_too_small' END, CASE WHEN l_quantity / 50 < 0.4 OR l_quantity / 50 > 0.95 THEN 'unexpected_aspect' END], lambda x: x IS NOT NULL) AS reasons FROM lineitem)"""


@query(f"SELECT volume, image, line, array_to_string(reasons, ';') AS reasons, len(reasons) > 0 AS needs_review, text_frac < 0.12 AND NOT is_blank AS faint FROM {_CROPS}")
def quality_gates(t):
    return _crops(t).select("volume", "image", "line", F.array_join("reasons", ";").alias("reasons"), (F.size("reasons") > 0).alias("needs_review"), gates.is_faint(C("text_frac"), C("is_blank")).alias("faint"))


@query(f"""SELECT volume, count(*) AS total, count(*) FILTER (is_blank) AS blank, count(*) FILTER (len(reasons) > 0) AS flagged, count(*) FILTER (NOT is_blank) AS submitted,
coalesce(array_to_string(list_sort(list(image) FILTER (is_blank)), ';'), '') AS blank_crops, count(*) FILTER (len(reasons) > 0) AS n_listed FROM {_CROPS} GROUP BY volume""")
def review_report(t):
    r = summaries.review_report(_crops(t), "volume", C("image"), C("is_blank"), C("reasons"))
    return r.select("volume", "total", "blank", "flagged", "submitted", F.array_join(C("blank_crops").cast("array<string>"), ";").alias("blank_crops"), F.size("flagged_crops").cast("long").alias("n_listed"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM {_CROPS}) GROUP BY reason")
def failure_reasons(t):
    return summaries.reason_counts(_crops(t), C("reasons"))


@query(f"""SELECT count(*) AS images, sum(n)::BIGINT AS folios, sum(r)::BIGINT AS review, count(*) FILTER (n = 0) AS errors FROM
(SELECT image, count(*) FILTER (NOT is_blank) AS n, count(*) FILTER (NOT is_blank AND len(reasons) > 0) AS r FROM {_CROPS} GROUP BY image)""")
def run_counters(t):
    folios = F.collect_list(F.when(~C("is_blank"), F.struct((F.size("reasons") > 0).alias("needs_review"))))
    images = _crops(t).groupBy("image").agg(folios.alias("folios")).withColumn("error", F.when(F.size("folios") == 0, "no_valid_folio"))
    return summaries.run_counters(images)


@query(f"""WITH v AS (SELECT volume, coalesce(median(aspect) FILTER (NOT flag), median(aspect)) AS norm, floor(max(price))::BIGINT AS w, max(quantity)::BIGINT AS h, count(*) AS n FROM {_CROPS} GROUP BY volume),
c AS (SELECT *, greatest(w, round_even(h * norm, 0)::BIGINT) AS cw FROM v), d AS (SELECT *, greatest(round_even(cw / norm, 0)::BIGINT, h) AS ch FROM c)
SELECT volume, norm, greatest(cw, round_even(ch * norm, 0)::BIGINT) AS canvas_width, ch AS canvas_height, n FROM d""")
def volume_norm(t):
    return summaries.volume_norm(_crops(t), "volume", C("aspect"), ~C("flag"), F.floor("price"), C("quantity"))


@query(f"""WITH n AS (SELECT volume, coalesce(median(aspect) FILTER (NOT flag), median(aspect)) AS norm FROM {_CROPS} GROUP BY volume)
SELECT volume, count(*) FILTER (abs(aspect - norm) > 0.12) AS suspects, round(avg(abs(aspect - norm)), 6) AS mean_deviation FROM {_CROPS} JOIN n USING (volume) GROUP BY volume""")
def volume_suspects(t):
    c = _crops(t)
    out = summaries.suspects(c, summaries.volume_norm(c, "volume", C("aspect"), ~C("flag"), C("price"), C("quantity")), "volume", C("aspect"))
    return out.groupBy("volume").agg(F.count_if("suspect").alias("suspects"), F.round(F.avg("deviation"), 6).alias("mean_deviation"))


@query(f"""SELECT volume, count(DISTINCT image) AS images, count(*) AS folios, count(*) FILTER (line = 1) AS single, count(*) FILTER (line <> 1) AS halves, median(aspect) AS aspect_median,
min(aspect) AS aspect_min, max(aspect) AS aspect_max, count(*) FILTER (aspect >= 1.0) AS landscape, count(*) FILTER (flag) AS review, count(*) FILTER (is_blank) AS blank FROM {_CROPS} GROUP BY volume""")
def volume_qa(t):
    return summaries.volume_qa(_crops(t), "volume", C("image"), F.when(C("line") == 1, "").otherwise("A"), C("aspect"), C("flag"), C("is_blank"))


@query(f"""WITH s AS (SELECT quantile_cont(discount, 0.5) AS median, quantile_cont(discount, 0.9) AS p90, quantile_cont(discount, 0.99) AS p99, max(discount) AS greatest FROM {_CROPS})
SELECT s.*, t.threshold, (SELECT count(*) FROM {_CROPS} WHERE discount >= t.threshold) AS reaching FROM s, (SELECT unnest([0.02, 0.05, 0.08, 0.1])::DOUBLE AS threshold) t""")
def threshold_counts(t):
    return summaries.threshold_counts(_crops(t), "discount", [0.02, 0.05, 0.08, 0.1])


@query(f"SELECT volume, image, line, price FROM {_CROPS} ORDER BY price DESC, volume, image, line LIMIT 24")
def worst_offenders(t):
    return _crops(t).orderBy(F.desc("price"), "volume", "image", "line").limit(24).select("volume", "image", "line", "price")


@query("""SELECT l_suppkey % 10 AS part, count(*) AS n, count(*) FILTER (abs(a - b) > 100) AS changed, round(100.0 * count(*) FILTER (abs(a - b) > 100) / count(*), 6) AS percent,
coalesce(array_to_string(list_sort(list(l_suppkey) FILTER (abs(a - b) > 100)), ';'), '') AS names FROM
(SELECT l_suppkey, sum(l_extendedprice * (1 - l_discount)) AS a, count(*) % 2 AS s FROM lineitem GROUP BY 1) JOIN (SELECT l_suppkey, sum(l_extendedprice) AS b, count(*) % 2 AS s FROM lineitem WHERE l_linenumber > 1 GROUP BY 1) USING (l_suppkey, s) GROUP BY 1""")
def changed_crops(t):
    li = t("lineitem").withColumn("part", C("l_suppkey") % 10)
    shape = (F.count("*") % 2).alias("s")
    a = li.groupBy("part", "l_suppkey").agg(F.sum(C("l_extendedprice") * (1 - C("l_discount"))).alias("v"), shape)
    b = li.where("l_linenumber > 1").groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("v"), shape)
    return summaries.changed(a, b, "l_suppkey", "v", "part", 100, ["s"]).withColumn("percent", F.round("percent", 6)).withColumn("names", F.array_join(C("names").cast("array<string>"), ";"))


# ---------------------------------------------------------------- evaluation
def _judged(t):
    d = t("documents").select("doc_id", "lang", (text.char_count(C("text")) > 120).cast("int").alias("predicted"))
    return records.with_truth(d, t("labels").select("doc_id", "quality"), "doc_id")


_JUDGED = f"(SELECT d.doc_id, d.lang, (length({_SQUEEZED}) > 120)::INT AS predicted, quality FROM documents d LEFT JOIN labels USING (doc_id))"


@query(f"SELECT quality, predicted, count(*) AS n FROM {_JUDGED} WHERE quality IS NOT NULL GROUP BY ALL")
def confusion(t):
    return summaries.confusion(_judged(t), "quality", "predicted")


@query(f"SELECT lang, count(*) AS n, count(quality) AS labelled, round(avg((quality = predicted)::INT), 6) AS accuracy FROM {_JUDGED} GROUP BY ROLLUP (lang)")
def accuracy_by_bucket(t):
    return summaries.accuracy(_judged(t), C("quality"), C("predicted"), "lang").withColumn("accuracy", F.round("accuracy", 6))


_GAPS = "(SELECT user_id, epoch_us(ts) / 1000000.0 - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) / 1000000.0 AS s FROM events)"


@query(f"""SELECT round(avg(s), 4) AS mean_s, median(s) AS median_s, min(s) AS min_s, max(s) AS max_s, workers, round(workers / avg(s), 8) AS per_second, round(avg(s) * 750000 / workers / 3600, 3) AS hours
FROM {_GAPS}, (SELECT unnest([1, 8, 16, 32]) AS workers) GROUP BY workers""")
def latency_summary(t):
    from pyspark.sql import Window

    us = F.unix_micros(C("ts").cast("timestamp"))
    before = F.lag(us).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    gaps = t("events").select((us / 1000000.0 - before / 1000000.0).alias("s"))
    out = summaries.latency(gaps, "s", 750_000, [1, 8, 16, 32])
    return out.select(F.round("mean_s", 4).alias("mean_s"), "median_s", "min_s", "max_s", "workers", F.round("per_second", 8).alias("per_second"), F.round("hours", 3).alias("hours"))


# ---------------------------------------------------------------- probability vectors
_P = "list_transform(embedding[1:4], lambda x: exp(x::DOUBLE))"
_PROBS = f"(SELECT vec_id, label, list_transform({_P}, lambda e: e / list_sum({_P})) AS p FROM embeddings)"


def _probs(t):
    return t("embeddings").select("vec_id", "label", gates.softmax(F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double"))).alias("p"))


@query(f"""SELECT vec_id, (list_position(p, list_max(p)) - 1)::INT AS k, round(list_max(p), 6) AS top, round(list_max(p) - list_sort(p)[3], 6) AS margin, list_max(p) - list_sort(p)[3] < 0.015 AS ambiguous,
CASE WHEN list_position(p, list_max(p)) IN (2, 4) AND list_max(p) >= 0.3 THEN (list_position(p, list_max(p)) - 1)::INT ELSE 0 END AS pre_rotation FROM {_PROBS}""")
def prob_argmax(t):
    two = gates.top_two(C("p"))
    return _probs(t).select("vec_id", gates.prepass_turn(C("p"), 0.3).alias("pre_rotation"), two.alias("t")).select("vec_id", "t.k", F.round("t.top", 6).alias("top"), F.round("t.margin", 6).alias("margin"), (C("t.margin") < 0.015).alias("ambiguous"), "pre_rotation")


@query(f"""WITH r AS (SELECT vec_id, label, p, list_position(p, list_max(p)) AS i FROM {_PROBS}), s AS (SELECT *, list_transform(p, lambda x, j: CASE WHEN j = i THEN -1.0 ELSE x END) AS q FROM r)
SELECT vec_id, CASE WHEN p[i] - list_max(q) >= 0.02 OR label % 3 >= label % 2 THEN (i - 1)::INT ELSE (list_position(q, list_max(q)) - 1)::INT END AS k, round(p[i], 6) AS conf, ((4 - CASE WHEN p[i] - list_max(q) >= 0.02 OR label % 3 >= label % 2 THEN (i - 1) ELSE (list_position(q, list_max(q)) - 1) END) % 4)::INT AS undo FROM s""")
def quarter_turns(t):
    turn = gates.quarter_turn(C("p"), C("label") % 3, C("label") % 2, 0.02)
    return _probs(t).select("vec_id", turn.alias("t")).select("vec_id", "t.k", F.round("t.conf", 6).alias("conf"), gates.undo_turn(C("t.k")).alias("undo"))


_PAIRS = "(SELECT event_id, user_id, abs(value) AS up, lead(abs(value), 1, 0.0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS down FROM events)"


@query(f"""WITH m AS (SELECT *, CASE WHEN up + down = 0 THEN 0.0 ELSE abs(up - down) / (up + down) END AS margin, down > up AS flip, event_id % 2 = 0 AS doubt FROM {_PAIRS})
SELECT event_id, round(margin, 6) AS margin, flip, doubt AND NOT flip AND margin >= 0.2 AS confirmed, doubt AND flip AND margin >= 0.35 AS flipped,
CASE WHEN doubt AND flip AND margin >= 0.35 THEN 90.0 ELSE 270.0 END AS rotation_deg, CASE WHEN doubt AND ((NOT flip AND margin >= 0.2) OR (flip AND margin >= 0.35)) THEN '' WHEN doubt THEN 'low_orientation_conf' ELSE 'page_too_small' END AS reasons FROM m""")
def reading_rescue(t):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = t("events").select("event_id", F.abs("value").alias("up"), F.lead(F.abs("value"), 1, 0.0).over(w).alias("down"))
    found = F.array(F.when(C("event_id") % 2 == 0, "low_orientation_conf").otherwise("page_too_small"))
    r = e.select("event_id", gates.rescue_by_reading(found, C("up"), C("down"), L(270.0)).alias("r"))
    return r.select("event_id", F.round("r.margin", 6).alias("margin"), "r.flip", "r.confirmed", "r.flipped", "r.rotation_deg", F.array_join("r.reasons", ";").alias("reasons"))


@query("""WITH o AS (SELECT o_orderkey AS job, (o_custkey % 5) * 90 AS rotate, o_totalprice / 20000 AS conf FROM orders), s AS (SELECT *, CASE rotate WHEN 0 THEN 0 WHEN 90 THEN 3 WHEN 180 THEN 2 WHEN 270 THEN 1 END AS k, greatest(0.5, least(0.9, 0.5 + conf / 20)) AS peak FROM o)
SELECT job, round(CASE WHEN k IS NULL OR conf < 2 THEN 0.25 WHEN k = 0 THEN peak ELSE (1 - peak) / 3 END, 6) AS p0, round(CASE WHEN k IS NULL OR conf < 2 THEN 0.25 WHEN k = 1 THEN peak ELSE (1 - peak) / 3 END, 6) AS p1,
round(CASE WHEN k IS NULL OR conf < 2 THEN 0.5 WHEN k = 0 THEN peak / (peak + (1 - peak) / 3) WHEN k = 2 THEN ((1 - peak) / 3) / (peak + (1 - peak) / 3) ELSE 0.5 END, 6) AS upright FROM s""")
def reader_orientation(t):
    p = gates.osd_probs((C("o_custkey") % 5) * 90, C("o_totalprice") / 20000)
    return t("orders").select(C("o_orderkey").alias("job"), p.alias("p")).select("job", F.round(C("p")[0], 6).alias("p0"), F.round(C("p")[1], 6).alias("p1"), F.round(gates.upright_only(C("p"))[0], 6).alias("upright"))


@query(f"""SELECT volume, image, line, CASE WHEN line % 3 = 0 THEN 'reject' WHEN line % 3 = 2 THEN 'two_folios' ELSE 'one_folio' END AS page_count,
CASE WHEN line % 3 = 0 THEN 0.5 WHEN line % 3 = 2 THEN greatest(0.5, least(0.99, 1 - aspect)) ELSE greatest(0.5, least(0.99, aspect)) END AS conf,
CASE WHEN orientation_conf < 0.75 THEN CASE WHEN aspect > 1.15 * 0.7 OR (aspect > 1.05 * 0.7 AND area_frac < 0.92) THEN 'two_folios' ELSE 'one_folio' END ELSE 'reject' END AS tie_break FROM {_CROPS}""")
def page_counts(t):
    c = gates.classical_count(C("line") % 3, C("aspect"))
    tie = gates.legacy_count(L("reject"), C("orientation_conf"), C("aspect"), L(0.7), C("area_frac"))
    return _crops(t).select("volume", "image", "line", c.alias("c"), tie.alias("tie_break")).select("volume", "image", "line", "c.page_count", "c.conf", "tie_break")


@query(f"""WITH c AS (SELECT *, aspect * 1.5 AS w, text_frac AS ink, discount * 20 AS ratio, area_frac AS spot FROM {_CROPS}),
s AS (SELECT *, CASE WHEN spot >= 0.2 THEN abs(w * spot - 0.77) END AS a, CASE WHEN 1 - spot >= 0.2 THEN abs(w * (1 - spot) - 0.77) END AS b FROM c),
y AS (SELECT *, CASE WHEN w <= 0.95 THEN 'aspect_in_range' WHEN ink < 0.02 THEN 'too_little_ink' WHEN spot IS NULL OR ratio < 1.5 THEN 'no_confident_spine' WHEN a IS NULL AND b IS NULL THEN 'no_side_wide_enough' ELSE 'fired' END AS why FROM s)
SELECT volume, image, line, why, CASE WHEN why = 'fired' THEN CASE WHEN b IS NULL OR a <= b THEN 'left' ELSE 'right' END END AS kept,
CASE WHEN why = 'fired' THEN CASE WHEN b IS NULL OR a <= b THEN w * spot ELSE w * (1 - spot) END END AS aspect_after FROM y""")
def partial_spread_rule(t):
    r = gates.partial_spread(C("aspect") * 1.5, C("text_frac"), C("discount") * 20, C("area_frac"))
    return _crops(t).select("volume", "image", "line", r.alias("r")).select("volume", "image", "line", "r.why", "r.kept", "r.aspect_after")


@query(f"""WITH c AS (SELECT *, aspect * 1.5 AS w FROM {_CROPS}), f AS (SELECT volume, w AS before, CASE WHEN w > 0.95 AND text_frac >= 0.02 AND discount * 20 >= 1.5 AND area_frac BETWEEN 0.2 AND 0.8 THEN
CASE WHEN abs(w * area_frac - 0.77) <= abs(w * (1 - area_frac) - 0.77) THEN w * area_frac ELSE w * (1 - area_frac) END END AS after FROM c)
SELECT volume, count(after) AS fired, count(*) FILTER (after BETWEEN 0.65 AND 0.95) AS in_band, round(median(before) FILTER (after IS NOT NULL), 6) AS median_before, round(median(after), 6) AS median_after FROM f GROUP BY volume""")
def spread_evaluation(t):
    r = gates.partial_spread(C("aspect") * 1.5, C("text_frac"), C("discount") * 20, F.when(C("area_frac").between(0.2, 0.8), C("area_frac")))
    c = _crops(t).select("volume", (C("aspect") * 1.5).alias("before"), r["aspect_after"].alias("after"))
    return c.groupBy("volume").agg(F.count("after").alias("fired"), F.count_if(C("after").between(0.65, 0.95)).alias("in_band"), F.round(F.median(F.when(C("after").isNotNull(), C("before"))), 6).alias("median_before"), F.round(F.median("after"), 6).alias("median_after"))


# ---------------------------------------------------------------- geometry
@query("""SELECT l_orderkey, l_linenumber, l_quantity AS px, l_tax * 100 AS py, CASE l_linenumber % 4 WHEN 0 THEN l_quantity WHEN 1 THEN 100 - 1 - l_tax * 100 WHEN 2 THEN 100 - 1 - l_quantity ELSE l_tax * 100 END AS x,
CASE l_linenumber % 4 WHEN 0 THEN l_tax * 100 WHEN 1 THEN l_quantity WHEN 2 THEN 200 - 1 - l_tax * 100 ELSE 200 - 1 - l_quantity END AS y FROM lineitem""")
def quad_unrotate(t):
    # k quarter turns counter-clockwise carry (x, y) of a w x h image to (y, w-1-x); the point is carried back
    back = gates.unrotate_point(C("l_quantity"), C("l_tax") * 100, C("l_linenumber") % 4, L(100), L(200))
    return t("lineitem").select("l_orderkey", "l_linenumber", C("l_quantity").alias("px"), (C("l_tax") * 100).alias("py"), back.alias("p")).select("l_orderkey", "l_linenumber", "px", "py", "p.x", "p.y")


@query("""SELECT p_partkey, (CASE WHEN p_retailprice > 2.4 * p_size THEN ceil(p_retailprice / 2.4) ELSE p_size END)::BIGINT AS width, (CASE WHEN p_size > 2.4 * p_retailprice THEN ceil(p_size / 2.4) ELSE p_retailprice END)::BIGINT AS height FROM (SELECT p_partkey, p_size * 40 AS p_size, floor(p_retailprice) AS p_retailprice FROM part)""")
def pad_to_ratio(t):
    size = gates.padded_size(C("p_size") * 40, F.floor("p_retailprice"))
    return t("part").select("p_partkey", size.alias("s")).select("p_partkey", "s.width", "s.height")


@query("""WITH b AS (SELECT p_partkey, p_size AS top, p_size + 100 AS bottom, floor(p_retailprice / 2)::BIGINT AS width, 1000 AS height FROM part), n AS (SELECT *, greatest(0, least(height, round_even(width / 0.8, 0)) - (bottom - top)) AS extra FROM b),
u AS (SELECT *, least(top, floor(extra / 2)) AS up FROM n), d AS (SELECT *, least(height - bottom, extra - up) AS down FROM u)
SELECT p_partkey, (top - least(top, extra - down))::BIGINT AS y0, (bottom + down)::BIGINT AS y1 FROM d""")
def page_extent(t):
    e = gates.page_extent(C("p_size"), C("p_size") + 100, F.floor(C("p_retailprice") / 2), L(1000))
    return t("part").select("p_partkey", e.alias("e")).select("p_partkey", C("e.top").alias("y0"), C("e.bottom").alias("y1"))


@query("""SELECT p_partkey, floor(w / 2)::BIGINT + floor(w * 0.04)::BIGINT AS left_end, greatest(0, floor(w / 2)::BIGINT - floor(w * 0.04)::BIGINT) AS right_start FROM (SELECT p_partkey, floor(p_retailprice)::BIGINT AS w FROM part)""")
def spread_halves(t):
    h = gates.halves(F.floor("p_retailprice"), L(100))
    return t("part").select("p_partkey", h.alias("h")).select("p_partkey", C("h")[0]["x2"].cast("long").alias("left_end"), C("h")[1]["x1"].cast("long").alias("right_start"))


def _boxes(t):
    li = t("lineitem")
    return li.select(C("l_orderkey").alias("page"), C("l_quantity").alias("x0"), (C("l_extendedprice") / 100).alias("y0"), (C("l_quantity") + 10).alias("x1"), (C("l_extendedprice") / 100 + 5).alias("y1"), C("l_partkey").alias("part"), C("l_linenumber").alias("line"), C("l_suppkey").alias("supp"), C("l_discount").alias("score"))


_BOXES = "(SELECT l_orderkey AS page, l_quantity AS x0, l_extendedprice / 100 AS y0, l_quantity + 10 AS x1, l_extendedprice / 100 + 5 AS y1, l_partkey AS part, l_linenumber AS line, l_suppkey AS supp, l_discount AS score FROM lineitem)"


@query(f"""WITH c AS (SELECT *, (y0 + y1) / 2 AS y FROM {_BOXES}), m AS (SELECT page, median(y) AS m FROM c GROUP BY page), d AS (SELECT c.*, abs(y - m) AS d FROM c JOIN m USING (page)), s AS (SELECT page, median(d) AS s FROM d GROUP BY page)
SELECT page, round(min(x0) - (max(x1) - min(x0)) * 0.1, 6) AS x0, round(min(y0) - (max(y1) - min(y0)) * 0.1, 6) AS y0, round(max(x1) + (max(x1) - min(x0)) * 0.1, 6) AS x1, round(max(y1) + (max(y1) - min(y0)) * 0.1, 6) AS y1, count(*) AS n
FROM d JOIN s USING (page) WHERE s = 0 OR d <= 3 * s GROUP BY page""")
def box_union_trim(t):
    return summaries.box_union(_boxes(t), "page", 0.1, 3.0).select("page", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")], "n")


@query(f"SELECT page, part, line, supp, floor(y0 / 50)::BIGINT AS line_no, row_number() OVER (PARTITION BY page ORDER BY floor(y0 / 50), x0, y0, part, line, supp) AS position FROM {_BOXES}")
def reading_order(t):
    b = _boxes(t).withColumnRenamed("line", "number")
    return records.reading_order(b, "page", C("x0"), C("y0"), L(1000), C("y0"), C("part"), C("number"), C("supp")).select("page", "part", C("number").alias("line"), "supp", C("line").alias("line_no"), "position")


@query(f"SELECT page, part, line, supp, x0, y0 FROM {_BOXES} QUALIFY row_number() OVER (PARTITION BY page ORDER BY score DESC, part, line, supp, y0) <= 2")
def best_boxes(t):
    return records.top_boxes(_boxes(t), "page", C("score"), C("x0"), 2, C("part"), C("line"), C("supp"), C("y0")).select("page", "part", "line", "supp", "x0", "y0")


# ---------------------------------------------------------------- profiles
_PROFILE = "(SELECT event_type AS id, epoch(date_trunc('hour', ts))::BIGINT // 3600 AS pos, round(avg(value), 6) AS value FROM events GROUP BY ALL)"


def _profile(t):
    hour = F.floor(F.unix_seconds(C("ts").cast("timestamp")) / 3600)
    return t("events").groupBy(C("event_type").alias("id"), hour.alias("pos")).agg(F.round(F.avg("value"), 6).alias("value"))


@query(f"""SELECT id, pos, round(least(coalesce(lag(value, 3) OVER w, first_value(value) OVER w), coalesce(lead(value, 3) OVER w, last_value(value) OVER f)) - value, 6) AS prominence FROM {_PROFILE}
WINDOW w AS (PARTITION BY id ORDER BY pos), f AS (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def profile_prominence(t):
    return profiles.prominence(_profile(t), 3).select("id", "pos", F.round("prominence", 6).alias("prominence"))


@query(f"""WITH p AS (SELECT id, pos, round(least(coalesce(lag(value, 3) OVER w, first_value(value) OVER w), coalesce(lead(value, 3) OVER w, last_value(value) OVER f)) - value, 6) AS prominence, row_number() OVER w - 1 AS n, count(*) OVER (PARTITION BY id) AS c FROM {_PROFILE}
WINDOW w AS (PARTITION BY id ORDER BY pos), f AS (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT id, pos, prominence FROM p WHERE n >= floor(c * 0.2) AND n < floor(c * 0.8) QUALIFY row_number() OVER (PARTITION BY id ORDER BY prominence DESC, n) = 1""")
def profile_valley(t):
    p = profiles.prominence(_profile(t), 3).withColumn("prominence", F.round("prominence", 6))
    return profiles.deepest(p, low=0.2, high=0.8)


@query(f"""SELECT id, pos, round(avg(value) OVER w, 5) AS local_mean, round(sqrt(greatest(avg(value * value) OVER w - (avg(value) OVER w) * (avg(value) OVER w), 0)), 4) AS local_std, (avg(value) OVER w - value > 6)::INT AS dark FROM {_PROFILE}
WINDOW w AS (PARTITION BY id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)""")
def profile_local_dark(t):
    return profiles.local_stats(_profile(t), 7).select("id", "pos", F.round("local_mean", 5).alias("local_mean"), F.round("local_std", 4).alias("local_std"), "dark")


@query(f"""WITH s AS (SELECT id, pos, value, lag(value) OVER w AS a, lead(value) OVER w AS b FROM {_PROFILE} WINDOW w AS (PARTITION BY id ORDER BY pos))
SELECT id, pos, coalesce(a, b, value) * 0.25 + value * 0.5 + coalesce(b, a, value) * 0.25 AS smooth FROM s""")
def profile_smooth(t):
    return profiles.smoothed(_profile(t), [0.25, 0.5, 0.25]).select("id", "pos", "smooth")


@query(f"""WITH e AS (SELECT id, min(pos) AS p0, max(pos) AS p1, arg_min(value, pos) AS v0, arg_max(value, pos) AS v1 FROM {_PROFILE} GROUP BY id)
SELECT id, round(max(abs(value - (v0 + (v1 - v0) * (pos - p0) / (p1 - p0)))), 5) AS curvature FROM {_PROFILE} JOIN e USING (id) GROUP BY id""")
def profile_curvature(t):
    return profiles.off_line(_profile(t)).select("id", F.round("curvature", 5).alias("curvature"))


@query("""WITH p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n, event_type <> 'view' AS ok FROM events),
s AS (SELECT user_id, count(*) AS length, min(n) FILTER (ok) AS a, max(n) FILTER (ok) AS b FROM p GROUP BY user_id)
SELECT user_id, length, coalesce(a, length) AS leading, coalesce(length - 1 - b, length) AS trailing FROM s""")
def border_run_trim(t):
    e = t("events").withColumn("pos", F.struct("ts", "event_id"))
    return profiles.border_runs(e, C("event_type") != "view", "user_id", "pos")


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS page, l_partkey AS centre FROM lineitem)
SELECT page, centre, coalesce(floor((centre + lag(centre) OVER w) / 2), 0)::BIGINT AS low, coalesce(floor((centre + lead(centre) OVER w) / 2), 1000000)::BIGINT AS high FROM c WINDOW w AS (PARTITION BY page ORDER BY centre)""")
def territories(t):
    c = t("lineitem").select(C("l_orderkey").alias("page"), C("l_partkey").alias("centre")).distinct()
    return profiles.territories(c, "page", "centre", L(1000000))


# ---------------------------------------------------------------- tiles
_TILES = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings)"


def _tiles(t):
    return t("embeddings").select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("x"))


@query(f"SELECT vec_id, round(list_sum(list_transform(x, lambda v: (v - list_min(x)) / (list_max(x) - list_min(x)))), 6) AS total, round((x[1] - list_min(x)) / (list_max(x) - list_min(x)), 6) AS first FROM {_TILES}")
def tile_normalise(t):
    n = tiles.normalise(C("x"))
    return _tiles(t).select("vec_id", F.round(tiles.total(n), 6).alias("total"), F.round(n[0], 6).alias("first"))


@query(f"""WITH c AS (SELECT vec_id, unnest(x) AS v, unnest(range(0, 64)) AS i FROM {_TILES}), r AS (SELECT vec_id, i // 8 AS r, sum(v) / 8 AS m FROM c GROUP BY ALL) SELECT vec_id, round(var_pop(m), 8) AS variance FROM r GROUP BY vec_id""")
def tile_row_variance(t):
    return _tiles(t).select("vec_id", F.round(tiles.row_variance(C("x"), 8), 8).alias("variance"))


_GRAY = "(SELECT vec_id, least(255, greatest(0, floor(128 + 256 * v)))::INT AS g FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings))"


@query(f"""WITH h AS (SELECT vec_id, g, count(*) AS n FROM {_GRAY} GROUP BY ALL), c AS (SELECT vec_id, g, sum(n) OVER w AS w, sum(n * g) OVER w AS m, sum(n) OVER (PARTITION BY vec_id) AS n, sum(n * g) OVER (PARTITION BY vec_id) AS s FROM h WINDOW w AS (PARTITION BY vec_id ORDER BY g)),
v AS (SELECT vec_id, g, CASE WHEN w < n THEN (m * n - s * w)::DOUBLE * (m * n - s * w)::DOUBLE / (w * (n - w))::DOUBLE ELSE 0 END AS v FROM c)
SELECT vec_id, g AS threshold FROM v QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, g) = 1""")
def tile_otsu(t):
    gray = F.transform("x", lambda v: F.least(L(255), F.greatest(L(0), F.floor(128 + 256 * v))).cast("int"))
    return _tiles(t).select("vec_id", gray.alias("g")).select("vec_id", tiles.otsu(C("g")).alias("threshold"))


_NEXT = f"(SELECT a.vec_id, a.x AS a, b.x AS b FROM {_TILES} a JOIN {_TILES} b ON b.vec_id = a.vec_id + 1)"


def _next(t):
    a = _tiles(t).select("vec_id", C("x").alias("a"))
    return a.join(_tiles(t).select((C("vec_id") - 1).alias("vec_id"), C("x").alias("b")), "vec_id")


@query(f"SELECT vec_id, round((list_sum(list_transform(list_zip(a, b), lambda z: ((z[1] > 0) AND (z[2] > 0))::INT)) + 1) / (list_sum(list_transform(list_zip(a, b), lambda z: ((z[1] > 0) OR (z[2] > 0))::INT)) + 1), 6) AS iou FROM {_NEXT}")
def tile_iou(t):
    on = lambda c: F.transform(c, lambda v: (v > 0).cast("double"))
    return _next(t).select("vec_id", F.round(tiles.iou(on("a"), on("b")), 6).alias("iou"))


@query(f"""WITH z AS (SELECT vec_id, list_transform(a, lambda v: (v - list_avg(a)) / (list_stddev_pop(a) + 1e-6)) AS a, list_transform(b, lambda v: (v - list_avg(b)) / (list_stddev_pop(b) + 1e-6)) AS b FROM {_NEXT}),
i AS (SELECT r, c, k, CASE k WHEN 0 THEN r * 8 + c WHEN 1 THEN c * 8 + 7 - r WHEN 2 THEN (7 - r) * 8 + 7 - c ELSE (7 - c) * 8 + r END AS j FROM (SELECT unnest(range(0, 8)) AS r), (SELECT unnest(range(0, 8)) AS c), (SELECT unnest(range(0, 4)) AS k)),
s AS (SELECT vec_id, k, round(sum(a[r * 8 + c + 1] * b[j + 1]) / 64, 6) AS score FROM z, i GROUP BY ALL)
SELECT vec_id, k::INT AS k, score FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, k) = 1""")
def tile_rotation_match(t):
    best = tiles.best_rotation(C("a"), C("b"), 8)
    return _next(t).select("vec_id", best.alias("m")).select("vec_id", "m.k", F.round("m.score", 6).alias("score"))


@query("""WITH RECURSIVE g AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(0, 64)) AS i FROM embeddings), c AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, v FROM g),
w AS (SELECT vec_id, r, list(v ORDER BY c) AS v FROM c GROUP BY ALL),
f AS (SELECT vec_id, 0::BIGINT AS r, v AS s FROM w WHERE r = 0 UNION ALL
SELECT f.vec_id, f.r + 1, list_transform(w.v, lambda x, j: x + least(CASE WHEN j > 1 THEN f.s[j - 1] + 0.1 ELSE 'infinity'::DOUBLE END, f.s[j], CASE WHEN j < 8 THEN f.s[j + 1] + 0.1 ELSE 'infinity'::DOUBLE END)) FROM f JOIN w ON w.vec_id = f.vec_id AND w.r = f.r + 1)
SELECT vec_id, round(list_min(s), 6) AS cost, (list_position(list_transform(s, lambda x: round(x, 9)), round(list_min(s), 9)) - 1)::INT AS foot FROM f WHERE r = 7""")
def tile_seam(t):
    costs = tiles.seam_costs(C("x"), 8, 0.1)
    return _tiles(t).select("vec_id", costs.alias("s")).select("vec_id", F.round(F.array_min("s"), 6).alias("cost"), gates.argmax(F.transform("s", lambda v: -F.round(v, 9))).alias("foot"))


@query("""WITH c AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(0, 64)) % 8 AS col FROM embeddings)
SELECT label, col::INT AS col, round(avg(v) FILTER (v > 0.3), 6) AS mean, round(coalesce(median(v) FILTER (v > 0.3), 0.5), 6) AS median FROM c GROUP BY ALL""")
def masked_columns(t):
    cells = _tiles(t).select("label", F.posexplode("x").alias("i", "v")).withColumn("col", C("i") % 8)
    on = C("v") > 0.3
    mean = profiles.masked_mean(cells, ["label", "col"], "v", on).withColumn("mean", F.round("mean", 6))
    return mean.join(profiles.masked_median(cells, ["label", "col"], "v", on, 0.5).withColumn("median", F.round("median", 6)), ["label", "col"])
