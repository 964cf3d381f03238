"""Hand-made rows for the semantics ledger and the Java string rules."""

from __future__ import annotations

import datetime as dt
import decimal
import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from logengine.functions import lineproto as lp
from logengine.functions.text import java_split
from logengine.functions.time import iso_to_millis, java_timestamp_text, millis_to_iso, precision_name, scale_epoch
from logengine.operators import aggregate as agg
from logengine.operators import parse, points, series, shape, windows
from logengine.operators.batching import DATAGRAM_LIMIT, bucket_batches, oversize_batches, write_batches
from logengine.operators.greedy import greedy_batches
from logengine.operators.numbering import ordinal_within, range_bucket
from logengine.operators.series import chunked_result, group_by_all_tags, result_errors, series_rows

from .conftest import SF_SMALL, log_frame

EDGE_LINES = [
    "h1 svc 2017-01-13 19:57:16,367 ERROR boom happened",
    "h1 svc 2017-01-13 19:57:16,367 TRACE msg INFO inside",
    "\tat com.foo ERROR",
    "h1 svc 2017-01-13 19:57:16,367 ERROR",
    "h1 svc  2017-01-13 19:57:16,367 INFO x",
    "h,1 s=v 2017-01-13 19:57:16,367 INFO x",
    "h1 svc 2017-01-13 19:57:16,367 error x",
]


def test_java_split_rules(spark):
    df = spark.createDataFrame([("a  b ",), ("",), ("   ",), (" a",), ("a\tb c",)], "s string")
    got = [r[0] for r in df.select(java_split("s")).collect()]
    assert got == [["a", "", "b"], [""], [], ["", "a"], ["a\tb", "c"]]


def test_parse_edges(spark):
    rows = log_frame(spark, EDGE_LINES)
    recs = {r["off"]: r for r in parse.parse_log(rows).collect()}
    legacy = {r["off"]: r for r in parse.parse_log(rows, legacy_offset=True).collect()}
    # S1: legacy offset drops the first letter after a five-letter level
    assert recs[0]["logInfo"] == "boom happened"
    assert legacy[0]["logInfo"] == "oom happened"
    assert recs[0]["event_ts"] == dt.datetime(2017, 1, 13, 19, 57, 16, 367000)
    # S3: marker anywhere, unlisted level kept
    assert recs[1]["logType"] == "TRACE"
    # S2: short row is a reject, not a crash; no message gives ''
    assert 2 not in recs
    assert recs[3]["logInfo"] == "" and legacy[3]["logInfo"] == ""
    # S4: double space shifts tokens
    assert recs[4]["lineTimestamp"] == " 2017-01-13" and recs[4]["logType"] == "19:57:16,367"
    assert recs[4]["event_ts"] is None
    # markers are case-sensitive
    assert 6 not in recs
    rej = {r["off"]: r["reason"] for r in parse.rejects(rows).collect()}
    assert rej == {2: "too_few_tokens", 6: "no_level_marker"}


def test_format_log_null_prints_null(spark):
    df = spark.createDataFrame([(1, "h", None, "t", "INFO", "m")],
                               "off long, hostName string, serviceName string, lineTimestamp string, logType string, logInfo string")
    assert parse.format_log(df).first()["line"] == "h null t INFO m"


def test_count_line_escapes_tag(spark):
    recs = parse.parse_log(log_frame(spark, EDGE_LINES))
    counts = agg.level_count(recs).withColumn("tick", F.lit(None).cast("timestamp"))
    lines = {r["line"] for r in shape.count_lines(counts).collect()}
    assert "logtype_count,host_service_logtype=h\\,1_s\\=v_INFO count=1" in lines
    raw = {r["line"] for r in shape.count_lines(counts, escape=False).collect()}
    assert "logtype_count,host_service_logtype=h,1_s=v_INFO count=1" in raw


def test_count_line_with_time(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 13, 19, 57, 20), "h", "s", "INFO", 3)],
                               "tick timestamp, hostName string, serviceName string, logType string, cnt long")
    line = shape.count_lines(df, with_time=True).first()["line"]
    assert line == "logtype_count,host_service_logtype=h_s_INFO count=3 1484337440000000000"


def test_snapshot_and_documents_json(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 13, 19, 57, 20), "h", "s", "INFO", 3),
                                (dt.datetime(2017, 1, 13, 19, 57, 20), "a", "s", "WARN", 1)],
                               "tick timestamp, hostName string, serviceName string, logType string, cnt long")
    snap = shape.tick_snapshot(df, parts=1).first()
    assert snap["key"] == "2017-01-13 19:57:20.0" and snap["part"] == 0  # parts=1: one value per tick
    assert snap["value"] == ('[{"host_service_logtype":"a_s_WARN","count":"1"},'
                             '{"host_service_logtype":"h_s_INFO","count":"3"}]')
    doc = {r["key"]: r["value"] for r in shape.count_documents(df).collect()}
    assert doc["h_s_INFO"] == ('[{"timeStamp":"2017-01-13 19:57:20.0","hostName":"h","serviceName":"s",'
                               '"logType":"INFO","count":"3"}]')


def test_snapshot_parts(spark):
    df = spark.range(25).select(F.lit(dt.datetime(2017, 1, 13, 19, 57, 20)).cast("timestamp").alias("tick"),
                                F.format_string("h%02d", "id").alias("hostName"), F.lit("s").alias("serviceName"),
                                F.lit("INFO").alias("logType"), F.lit(1).cast("long").alias("cnt"))
    def cut(rows):
        return {r["part"]: r["value"] for r in shape.tick_snapshot(rows, parts=4).collect()}

    def keys(parts):
        return {k: p for p, v in parts.items() for k in __import__("re").findall(r'logtype":"(.*?)"', v)}

    parts = cut(df)
    assert set(parts) <= set(range(4)) and len(keys(parts)) == 25
    # the cut depends on the key alone: one row more or less moves nothing
    assert keys(cut(df.where("hostName <> 'h07'"))) == {k: p for k, p in keys(parts).items() if k != "h07_s_INFO"}
    for v in parts.values():
        assert v == "[" + ",".join(sorted(v[1:-1].replace("},{", "}|{").split("|"))) + "]"


def test_java_timestamp_text(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 13, 19, 57, 16, 370000),), (dt.datetime(2017, 1, 13, 19, 57, 16),),
                                (dt.datetime(2017, 1, 13, 19, 57, 16, 367000),)], "t timestamp")
    assert [r[0] for r in df.select(java_timestamp_text("t")).collect()] == [
        "2017-01-13 19:57:16.37", "2017-01-13 19:57:16.0", "2017-01-13 19:57:16.367"]


def test_iso_round_trip(spark):
    df = spark.createDataFrame([(0,), (1477896740020,)], "ms long")
    got = df.select(millis_to_iso("ms").alias("iso")).select("iso", iso_to_millis("iso").alias("ms")).collect()
    assert got[0]["iso"] == "1970-01-01T00:00:00.000Z" and got[0]["ms"] == 0
    assert got[1]["iso"] == "2016-10-31T06:52:20.020Z" and got[1]["ms"] == 1477896740020


def test_precision_names():
    assert [precision_name(u) for u in ("hours", "MINUTES", "seconds", "milliseconds", "microseconds", "nanoseconds")] == \
        ["h", "m", "s", "ms", "u", "n"]
    import pytest
    with pytest.raises(ValueError):
        precision_name("DAYS")


def test_scale_epoch_exact(spark):
    df = spark.createDataFrame([(1484337440123456789,)], "ns long")
    r = df.select(scale_epoch("ns", "MILLISECONDS").alias("ms"), scale_epoch("ns", "HOURS").alias("h")).first()
    assert r["ms"] == 1484337440123 and r["h"] == 412315


def test_field_formats(spark):
    df = spark.createDataFrame(
        [(1e-7, 1.5e20, 0.1, decimal.Decimal("12.50"), 5, True, 'a\\b"c', None)],
        "d1 double, d2 double, f float, dec decimal(10,2), n long, b boolean, s string, nul double",
    )
    specs = lp.field_specs(df.schema, ["d1", "d2", "f", "dec", "n", "b", "s", "nul"])
    txt = df.select(lp.fields_text(specs)).first()[0]
    assert txt == ('b=true,d1=0.0000001,d2=150000000000000000000.0,dec=12.5,f=0.10000000149011612,'
                   'n=5i,s="a\\\\b\\"c"')
    legacy = df.select(lp.fields_text(lp.field_specs(df.schema, ["n"]), legacy_numbers=True)).first()[0]
    assert legacy == "n=5.0"


def test_point_line_and_keys(spark):
    df = spark.createDataFrame([("north", 71, 6, 23, 4200)], "site string, gusts long, rain long, calm long, t long")
    line = points.encode_points(df, "weather", ["gusts", "rain", "calm"], tags=["site"], time_col="t",
                                time_unit="MILLISECONDS").first()["line"]
    assert line == "weather,site=north calm=23i,gusts=71i,rain=6i 4200000000"
    df2 = spark.createDataFrame([("a b", "x,y=z", 1)], "k string, v string, f long")
    line2 = points.encode_points(df2, "m e", ["f"], tags={"t k": "v", "": "k"}, with_time=False).first()["line"]
    assert line2 == "m\\ e,t\\ k=x\\,y\\=z f=1i"


def test_tags_sorted_empty_dropped_and_batch_wins(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1", "e": "", "": "x"}, 1)], "tags map<string,string>, f long")
    assert df.select(lp.tags_text_from_map("tags")).first()[0] == ",a=1,b=2"
    merged = df.select(lp.tags_text_from_map(lp.merge_batch_tags("tags", {"a": "batch", "async": "true"}))).first()[0]
    assert merged == ",a=batch,async=true,b=2"


def test_invalid_points(spark):
    df = spark.createDataFrame([(1, "x", None, None), (2, None, 1, None), (3, "y", 1, "s"), (4, "y", 2, None)],
                               "id long, tag string, n long, s string")
    bad = {r["id"]: r["reason"] for r in points.invalid_points(df, "m", ["n", "s"], tags=["tag"], keep=["id"]).collect()}
    assert bad == {1: "null_string_field", 2: "null_tag", 4: "null_string_field"}
    df2 = spark.createDataFrame([(1, None), (2, 3)], "id long, n long")
    bad2 = {r["id"]: r["reason"] for r in points.invalid_points(df2, "m", ["n"], keep=["id"]).collect()}
    assert bad2 == {1: "no_fields"}


def test_null_field_no_dangling_comma(spark):
    df = spark.createDataFrame([(1, None)], "a long, z long")
    assert df.select(lp.fields_text(lp.field_specs(df.schema, ["a", "z"]))).first()[0] == "a=1i"


def test_oversize_payload(spark):
    # one-field points repeated past 64 KB
    n = 6000
    df = spark.range(n).select(F.lit("db").alias("db"), F.lit("autogen").alias("rp"), F.col("id"),
                               F.concat(F.lit("gauge,site=north level="), F.col("id").cast("string"), F.lit("i")).alias("line"))
    out = oversize_batches(df, batch_size=n).first()
    assert out["n_points"] == n and out["oversize"] and out["n_bytes"] > DATAGRAM_LIMIT
    k = DATAGRAM_LIMIT // 40
    assert all(not r["oversize"] for r in oversize_batches(df, batch_size=k).collect())
    payloads = write_batches(df, batch_size=2500).orderBy("batch_no").collect()
    assert [p["n_points"] for p in payloads] == [2500, 2500, 1000]
    assert payloads[0]["payload"].startswith("gauge,site=north level=0i\ngauge,site=north level=1i\n")


def test_chunks_two_then_one(spark):
    # SELECT * FROM gauge with chunk size 2: three points (tags a, b, c) → 2 then 1
    pts = spark.createDataFrame(
        [("gauge", i, {"site": t}, 1000 + i, 1.0) for i, t in enumerate("abc")],
        "measurement string, point_id long, tags map<string,string>, time_ns long, value double",
    )
    got = sorted((r["row_idx"], r["chunk"]) for r in chunked_result(pts, "gauge", 2).collect())
    assert got == [(0, 0), (1, 0), (2, 1)]
    per_tag = chunked_result(pts, "gauge", 2, group_by_tags=True).collect()
    assert sorted((r["series"], r["row_idx"], r["chunk"]) for r in per_tag) == [
        ("site=a", 0, 0), ("site=b", 0, 0), ("site=c", 0, 0)]


def test_group_by_all_tags_three_series(spark):
    pts = spark.createDataFrame(
        [("weather", i, {"site": f"field{i}"}, i, float(i)) for i in (3, 1, 2)],
        "measurement string, point_id long, tags map<string,string>, time_ns long, value double",
    )
    got = [r["series"] for r in group_by_all_tags(pts, "weather").orderBy("series").collect()]
    assert got == ["site=field1", "site=field2", "site=field3"]


def test_series_rows_from_document(spark):
    body = ('{"results":[{"series":[{"name":"fan","tags":{"rack":"r7"},"columns":["time","rpm"],'
            '"values":[["2021-03-04T05:06:07.008Z",41],["2021-03-04T05:07:00.250Z",42]]}]},'
            '{"error":"bad"}],"error":"top"}')
    docs = spark.createDataFrame([(1, body)], "doc_id long, body string")
    rows = series_rows(docs).orderBy("result_idx", "row_idx").collect()
    assert [(r["name"], r["tags"]["rack"], r["cells"]["rpm"], r["cells"]["time"], r["error"]) for r in rows[:2]] == [
        ("fan", "r7", "41", "2021-03-04T05:06:07.008Z", "top"), ("fan", "r7", "42", "2021-03-04T05:07:00.250Z", "top")]
    assert [(r["result_idx"], r["name"], r["error"]) for r in rows[2:]] == [(1, None, "bad")]
    errs = sorted((r["level"], r["error"]) for r in result_errors(docs).collect())
    assert errs == [("query", "top"), ("result", "bad")]


def test_pane_and_window_forms_agree(spark):
    from logengine.sources.logtopic import logtopic

    recs = parse.parse_log(logtopic(spark, SF_SMALL))
    for length, slide in ((15, 5), (30, 5), (5, 5)):
        a = windows.sliding_count(recs, agg.LEVEL_KEYS, length, slide, method="pane")
        b = windows.sliding_count(recs, agg.LEVEL_KEYS, length, slide, method="window")
        c = windows.sliding_count(recs, agg.LEVEL_KEYS, length, slide, parts=5).select(a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
    a = windows.sliding_latest_level(recs, 30, 5, method="pane")
    b = windows.sliding_latest_level(recs, 30, 5, method="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fixed_levels_union_equals_one_pass(spark):
    from logengine.sources.logtopic import logtopic

    recs = parse.parse_log(logtopic(spark, SF_SMALL))
    a, b = agg.union_levels(recs), agg.union_levels_by_branch(recs)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_empty_ticks_global_and_brute_force(spark):
    from logengine.sources.logtopic import logtopic

    recs = parse.parse_log(logtopic(spark, SF_SMALL))
    got = {r["tick"] for r in windows.empty_ticks(recs, [], 15, 5).collect()}
    # brute force: all ticks between first and last non-empty window end
    ends = {r[0] for r in recs.select(F.explode(F.array(*[
        F.timestamp_micros(windows.pane_end_us("record_ts", 5) + F.lit(i * 5_000_000)) for i in range(3)]))).distinct().collect()}
    lo, hi = min(ends), max(ends)
    grid = set()
    t = lo
    while t <= hi:
        grid.add(t)
        t += dt.timedelta(seconds=5)
    assert got == grid - ends
    assert len(got) > 0


def test_tick_preview_at_most_ten(spark):
    from logengine.sources.logtopic import logtopic

    recs = parse.parse_log(logtopic(spark, SF_SMALL))
    prev = agg.tick_preview(agg.key_count_per_tick(recs), 10)
    assert prev.groupBy("tick").count().agg(F.max("count")).first()[0] <= 10


def test_ordinal_within_matches_row_number_under_skew(spark):
    # one group holds most rows; a column is carried along
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        (F.col("id") * 7919 % 20011).alias("o"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    ref = df.withColumn("ordinal", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")) - 1)
    for _ in range(3):
        got = ordinal_within(df, ["g"], ["o", "id"], buckets=16)
        cols = ["g", "id", "payload", "ordinal"]
        assert got.select(cols).exceptAll(ref.select(cols)).count() == 0
        assert got.count() == 20000


def test_ranges_are_even_whatever_the_keys(spark):
    """Few keys, and a key with a third of the rows: no range holds twice its share, numbers stay exact."""
    few = spark.range(400_000).select((F.col("id") % 40).alias("k"), F.xxhash64("id").alias("tie"))
    hot = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5000)).otherwise(F.col("id") % 9973).alias("k"), F.xxhash64("id").alias("tie"))
    gone = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.xxhash64("id").alias("tie"))
    for df in (few, hot, gone):
        sizes = [r["count"] for r in df.select(range_bucket(df, ["k", "tie"], 16, lead=1).alias("b")).groupBy("b").count().collect()]
        assert len(sizes) >= 12 and max(sizes) <= 2 * sum(sizes) / 16, sizes
    got = ordinal_within(few.withColumn("g", F.lit(1)), ["g"], ["k", "tie"], buckets=16, lead=1)
    ref = few.select("k", "tie", (F.row_number().over(Window.orderBy("k", "tie")) - 1).cast("long").alias("ordinal"))
    assert got.select("k", "tie", "ordinal").exceptAll(ref).count() == 0


def test_batches_of_a_hot_database_are_exact(spark):
    # one database holds 90% of the points
    df = spark.range(30000).select(
        F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.lit("cold")).alias("db"),
        F.lit("autogen").alias("rp"), F.col("id"), F.concat(F.lit("m v="), F.col("id").cast("string"), F.lit("i")).alias("line"))

    def sizes(rows):
        got = write_batches(rows, batch_size=1000).select("db", "batch_no", "n_points").collect()
        return {(r["db"], r["batch_no"]): r["n_points"] for r in got}

    whole = sizes(df)
    assert whole == {**{("hot", i): 1000 for i in range(27)}, **{("cold", i): 1000 for i in range(3)}}
    # one row less changes the last batch of its database only
    assert sizes(df.where("id <> 29998")) == {**whole, ("hot", 26): 999}
    with pytest.raises(ValueError):
        write_batches(df, batch_size=0)


def test_no_point_is_lost_in_a_payload(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.5, 1000, "m"), (2, "b", 2.5, None, "m"), (3, None, 1.0, 5, "m"), (4, "c", float("nan"), 5, "m"),
         (5, "d", float("inf"), 5, "m"), (6, "e", None, 5, "m"), (7, "f", 1.0, 5, "")],
        "id long, tag string, x double, t long, name string")
    args = (df, F.col("name"), ["x"])
    lines = points.encode_points(*args, tags=["tag"], time_col="t", keep=["id"])
    bad = {r["id"]: r["reason"] for r in points.invalid_points(*args, tags=["tag"], keep=["id"]).collect()}
    assert bad == {3: "null_tag", 4: "not_finite", 5: "not_finite", 6: "no_fields", 7: "empty_measurement"}
    got = {r["id"]: r["line"] for r in lines.collect()}
    assert got[1] == "m,tag=a x=1.5 1000" and set(got) == {1, 2}
    assert abs(int(got[2].split(" ")[2]) // 10**9 - dt.datetime.now(dt.timezone.utc).timestamp()) < 600
    keyed = lines.select(F.lit("db").alias("db"), F.lit("rp").alias("rp"), "id", "line")
    p = write_batches(keyed, 10).first()
    assert p["n_points"] == 2 == p["payload"].count("\n")
    broken = keyed.withColumn("line", F.when(F.col("id") == 1, F.col("line")))
    for cut in (write_batches, oversize_batches, lambda x, n: bucket_batches(x, n, 2)):
        with pytest.raises(Exception, match="a point has no line"):
            cut(broken, 10).collect()


def test_series_reader_keeps_every_document(spark):
    docs = spark.createDataFrame(
        [(1, "not json"), (2, '{"results":[{}]}'), (3, None), (4, '{"error":"down"}'),
         (5, '{"results":[{"series":[{"name":"s","columns":["a","b"],"values":[["1"],["1","2","3"],["1","2"]]}]}]}')],
        "doc_id long, body string")
    got = {(r["doc_id"], r["row_idx"]): (r["cells"], r["error"]) for r in series_rows(docs).collect()}
    assert got == {(1, None): (None, "unreadable document"), (2, None): (None, None), (3, None): (None, "unreadable document"),
                   (4, None): (None, "down"), (5, 0): ({"a": "1", "b": None}, None),
                   (5, 1): (None, "row longer than its header"), (5, 2): ({"a": "1", "b": "2"}, None)}
    errors = {(r["doc_id"], r["level"], r["error"]) for r in result_errors(docs).collect()}
    assert errors == {(1, "query", "unreadable document"), (3, "query", "unreadable document"), (4, "query", "down"),
                      (5, "result", "row longer than its header")}


def test_null_groups_and_order_keys_are_numbered(spark):
    rows = [(None, None, 1), (None, 3, 2), ("a", None, 3), ("a", 1, 4), (None, 3, 5)]
    df = spark.createDataFrame(rows, "g string, o long, id long")
    got = {r["id"]: r["ordinal"] for r in ordinal_within(df, ["g"], ["o", "id"], buckets=4).collect()}
    assert got == {1: 0, 2: 1, 5: 2, 3: 0, 4: 1}


def test_byte_batches_fit_the_datagram_limit(spark):
    from logengine.operators.batching import byte_batches

    n = 20000
    df = spark.range(n).select(F.lit("db").alias("db"), F.lit("autogen").alias("rp"), F.col("id"),
                               F.concat(F.lit("gauge,site=north level="), F.col("id").cast("string"), F.lit("i")).alias("line"))
    b = byte_batches(df, DATAGRAM_LIMIT).collect()
    assert sum(r["n_points"] for r in b) == n
    assert max(r["n_bytes"] for r in b) <= DATAGRAM_LIMIT
    total = sum(r["n_bytes"] for r in b)
    assert len(b) <= total // (DATAGRAM_LIMIT - 30) + 1  # close to the fewest payloads possible
    # one long line costs no more than its own payload
    one = spark.createDataFrame([("db", "autogen", 10_000, "x" * 60_000)], df.schema)
    assert len(byte_batches(df.unionByName(one)).collect()) <= len(b) + 2
    with pytest.raises(Exception, match="does not fit"):
        byte_batches(df.unionByName(one), 50_000).collect()


def test_byte_batches_encode_each_line_once(spark):
    from logengine.operators.batching import byte_batches

    n, made = 3000, spark.sparkContext.accumulator(0)

    @F.udf("string")
    def line(i):
        made.add(1)
        return "x" * (i % 97 + 1)

    df = spark.range(n).select(F.lit("db").alias("db"), F.lit("rp").alias("rp"), (F.col("id") % 50).alias("id"),
                               line("id").alias("line"))
    got = byte_batches(df, 1000).collect()
    assert sum(r["n_points"] for r in got) == n and max(r["n_bytes"] for r in got) <= 1000
    assert made.value == n


def plain_cut(sizes, limit):
    out, held = [], []
    for n in sizes:
        if held and sum(held) + n > limit:
            out.append((len(held), sum(held)))
            held = []
        held.append(n)
    return out + ([(len(held), sum(held))] if held else [])


@pytest.mark.parametrize("limit, cell_limits, fan", [(100, 1, 2), (64, 2, 3), (50, 5, 2), (1000, 64, 256)])
def test_greedy_cut_in_parallel(spark, limit, cell_limits, fan):
    """Cells, levels and handing down give what one loop over the lines gives, in every group."""
    rng = random.Random(limit)
    groups = {"a": 3000, "b": 1, "c": 40, None: 700}
    sizes = {g: [rng.choice([1, 2, 7, limit // 2, limit // 2 + 1, limit, rng.randint(1, limit)]) for _ in range(n)]
             for g, n in groups.items()}
    sizes["d"] = [limit] * 20 + [1] * (3 * limit * cell_limits + 1)
    rows = []
    for g, own in sizes.items():
        start = 0
        for n in own:
            rows.append((g, "rp", start, n))
            start += n
    placed = spark.createDataFrame(rows, "db string, rp string, start long, n long")
    got = {}
    for r in greedy_batches(placed, ["db", "rp"], limit, cell_limits, fan).orderBy("batch_no").collect():
        assert r.batch_no == len(got.setdefault(r.db, []))
        got[r.db].append((r.n_points, r.n_bytes))
    assert got == {g: plain_cut(own, limit) for g, own in sizes.items()}
    assert greedy_batches(placed.limit(0), ["db", "rp"], limit).collect() == []


def test_window_forms_agree_over_many_spans(spark, monkeypatch):
    """Counts and latest levels by events against one copy per window, with spans of a few panes,
    a hot host, null keys, gaps longer than the window and an empty table."""
    monkeypatch.setattr(windows, "SPAN_PANES", 7)
    monkeypatch.setattr(windows, "TICK_PIECE", 3)
    rng = random.Random(6)
    base = dt.datetime(2024, 5, 1)
    rows = []
    for i in range(600):
        host = rng.choice(["hot", "hot", "hot", "b", None])
        at = base + dt.timedelta(seconds=rng.choice([rng.randint(0, 300), rng.randint(0, 5000), 9000]), milliseconds=i)
        rows.append((i, at, host, rng.choice(["s", None]), rng.choice(["INFO", "WARN", None])))
    df = spark.createDataFrame(rows, "off long, record_ts timestamp, hostName string, serviceName string, logType string")
    for length, slide in ((100, 5), (5, 5), (300, 10)):
        for keys in (agg.LEVEL_KEYS, ["hostName"]):
            by_event = windows.sliding_count(df, keys, length, slide, method="events")
            direct = windows.sliding_count(df, keys, length, slide, method="window")
            assert by_event.exceptAll(direct).count() == 0 and direct.exceptAll(by_event).count() == 0
        latest = windows.sliding_latest_level(df, length, slide, method="events")
        direct = windows.sliding_latest_level(df, length, slide, method="window")
        assert latest.exceptAll(direct).count() == 0 and direct.exceptAll(latest).count() == 0
        gone = windows.empty_ticks(df, ["hostName"], length, slide)
        held = windows.sliding_count(df, ["hostName"], length, slide, count_col="off", method="window")
        want = set()
        for host in {r[2] for r in rows}:
            have = {r["tick"] for r in held.where(F.col("hostName").eqNullSafe(F.lit(host))).collect()}
            t = min(have)
            while t < max(have):
                if t not in have:
                    want.add((host, t))
                t += dt.timedelta(seconds=slide)
        assert {tuple(r) for r in gone.collect()} == want and want
    assert windows.sliding_count(df.limit(0), ["hostName"], 100, 5, method="events").collect() == []
    assert windows.sliding_latest_level(df.limit(0), 100, 5, method="events").collect() == []


def test_running_count_over_many_spans(spark, monkeypatch):
    monkeypatch.setattr(windows, "SPAN_PANES", 3)
    rows = log_frame(spark, [f"every tick {i % 7} {'rare' if i % 50 == 0 else ''}" for i in range(400)])
    got = {(r.word, r.tick): (r.cnt, r.total) for r in agg.running_count(rows).collect()}
    totals, want = {}, {}
    for r in rows.orderBy("off").collect():
        end = dt.datetime.fromtimestamp((int(r.record_ts.timestamp()) // 5 + 1) * 5, r.record_ts.tzinfo)
        for w in java_split_plain(r.value):
            totals[w] = totals.get(w, 0) + 1
            cnt = want[(w, end)][0] + 1 if (w, end) in want else 1
            want[(w, end)] = (cnt, totals[w])
    assert got == want


def java_split_plain(text):
    parts = text.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_variant_fields_keep_the_type_of_each_value(spark):
    docs = ['{"b": 1, "a": 1.0, "c": "1", "d": true, "e": null}', '{"x=y z": "q\\"uote \\\\ \\n", "n": -7}', '{"big": 12345678901234567890, "e": 1e3}',
            '{"only": null}', '{}', '{"in": {"a": 1}}', '{"in": [1]}', '[1]', '7', 'broken {', None, '{"é": false}']
    df = spark.createDataFrame(list(enumerate(docs)), "id long, j string").withColumn("v", F.try_parse_json("j"))
    lines = {r.id: r.line for r in points.encode_variant_points(df, "m", "v", keep=["id"], with_time=False).collect()}
    assert lines.pop(2).startswith("m big=1234567890123456") and set(lines) == {0, 1, 11}
    assert lines == {0: 'm a=1.0,b=1i,c="1",d=true', 1: 'm n=-7i,x\\=y\\ z="q\\"uote \\\\ \n"', 11: "m é=false"}
    reasons = {r.id: r.reason for r in points.invalid_variant_points(df, "m", "v", keep=["id"]).collect()}
    assert reasons == {3: "no_fields", 4: "no_fields", 5: "nested_field", 6: "nested_field", 7: "unreadable_fields",
                       8: "unreadable_fields", 9: "unreadable_fields", 10: "unreadable_fields"}
    assert points.encode_variant_points(df.limit(0), "m", "v").collect() == []


def test_typed_cells_tell_types_apart(spark):
    body = """{"results":[{"series":[{"name":"s","columns":["a","b"],
        "values":[[5,"5"],[5.0,null],[true],[1,2,3],[12345678901234567890,{"z":[1]}]]}]},{"error":"bad"},{}]}"""
    df = spark.createDataFrame([(1, body), (2, "oops"), (3, None), (4, '{"error":"late"}')], "doc_id long, body string")
    rows = series.typed_cells(df).collect()
    cells = {(r.row_idx, r.column): (r.kind, r.column_kind) for r in rows if r.column}
    assert cells == {
        (0, "a"): ("integer", "mixed"), (0, "b"): ("string", "mixed"), (1, "a"): ("number", "mixed"), (1, "b"): ("null", "mixed"),
        (2, "a"): ("boolean", "mixed"), (2, "b"): ("null", "mixed"), (4, "a"): ("number", "mixed"), (4, "b"): ("nested", "mixed"),
    }
    values = {(r.row_idx, r.column): [r.integer_value, r.number_value, r.boolean_value, r.string_value] for r in rows if r.column}
    assert values[0, "a"] == [5, 5.0, None, None] and values[0, "b"] == [None, None, None, "5"]
    assert values[1, "a"] == [None, 5.0, None, None] and values[1, "b"] == [None] * 4
    assert values[2, "a"] == [None, None, True, None] and values[4, "b"] == [None, None, None, '{"z":[1]}']
    errors = sorted((r.doc_id, str(r.result_idx), str(r.error)) for r in rows if not r.column)
    assert errors == [
        (1, "0", series.UNEVEN), (1, "1", "bad"), (1, "2", "None"), (2, "None", series.UNREADABLE), (3, "None", series.UNREADABLE),
        (4, "None", "late"),
    ]
    numbers = spark.createDataFrame([(1, '{"results":[{"series":[{"columns":["a","b"],"values":[[1,null],[2.5],[null]]}]}]}')], "doc_id long, body string")
    assert {(r.column, r.column_kind) for r in series.typed_cells(numbers).collect()} == {("a", "number"), ("b", "null")}
    assert series.typed_cells(df.limit(0)).collect() == []
