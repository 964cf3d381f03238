"""Point tables and query-result documents derived from the given tables.

* :func:`points_table` — stored points ``(measurement, point_id, tags,
  time_ns, value)`` from ``orders`` and ``lineitem``: what a series query
  runs over.
* :func:`series_documents` — query-result JSON documents
  ``(doc_id, body)``, one per block of ``DOC_SPAN`` order keys (bounded
  size at any scale), each with one series per order status, plus
  statement- and query-level errors, unreadable, empty and uneven
  documents on a fixed rule so error handling is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logengine.functions.time import ISO_MILLIS_FORMAT, epoch_us_ntz, int_div
from logengine.session import use_utc
from logengine.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the derived fixtures (shared with the DuckDB oracles)
# ---------------------------------------------------------------------------
DOC_SPAN = 100
SERIES_COLUMNS = ("time", "o_custkey", "o_totalprice", "o_orderpriority")
RESULT_ERROR_EVERY = 5      # doc_id % 5 == 0 → a failed statement result
QUERY_ERROR_REMAINDER = 3   # doc_id % 10 == 3 → a query-level error
# One more document, -1 - doc_id, by doc_id % ODD_EVERY: unreadable, a result
# without series, a series with a short and an overlong row.
ODD_EVERY = 20
ODD_TIME = "2000-01-01T00:00:00.000Z"
ODD_BODIES = {
    1: "not json",
    2: '{"results":[{}]}',
    4: '{"results":[{"series":[{"name":"short","columns":["time","o_custkey"],"values":[["' + ODD_TIME + '"],["'
       + ODD_TIME + '","5","extra"]]}]}]}',
}
# ---------------------------------------------------------------------------


def points_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice"])
    lineitem = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice"])
    o = orders.select(
        F.lit("orders").alias("measurement"),
        F.col("o_orderkey").alias("point_id"),
        F.create_map(F.lit("o_orderpriority"), F.col("o_orderpriority"), F.lit("o_orderstatus"), F.col("o_orderstatus")).alias("tags"),
        (epoch_us_ntz("o_orderdate") * 1000).alias("time_ns"),
        F.col("o_totalprice").alias("value"),
    )
    li = lineitem.select(
        F.lit("lineitem").alias("measurement"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("point_id"),
        F.create_map(F.lit("l_linestatus"), F.col("l_linestatus"), F.lit("l_returnflag"), F.col("l_returnflag")).alias("tags"),
        (epoch_us_ntz("l_shipdate") * 1000).alias("time_ns"),
        F.col("l_extendedprice").alias("value"),
    )
    return o.unionByName(li)


def series_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    row_json = F.format_string(
        '["%s",%d,%s,"%s"]',
        F.date_format("o_orderdate", ISO_MILLIS_FORMAT),
        F.col("o_custkey"),
        F.col("o_totalprice").cast("string"),
        F.col("o_orderpriority"),
    )
    rows = orders.select(
        int_div("o_orderkey", DOC_SPAN).alias("doc_id"),
        "o_orderstatus", "o_orderdate", "o_orderkey", row_json.alias("row_json"),
    )
    columns_json = "[" + ",".join(f'"{c}"' for c in SERIES_COLUMNS) + "]"
    doc = F.col("doc_id")
    result_err = F.when(
        F.pmod(doc, F.lit(RESULT_ERROR_EVERY)) == 0,
        F.concat(F.lit(',{"error":"partial failure in doc '), doc.cast("string"), F.lit('"}')),
    ).otherwise(F.lit(""))
    query_err = F.when(
        F.pmod(doc, F.lit(10)) == QUERY_ERROR_REMAINDER,
        F.concat(F.lit(',"error":"timeout in doc '), doc.cast("string"), F.lit('"')),
    ).otherwise(F.lit(""))
    # One shuffle: a document's rows (at most DOC_SPAN) are collected once,
    # sorted by (status, date, key), and split into one series per status
    # with array functions.
    by_doc = rows.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("o_orderstatus", "o_orderdate", "o_orderkey", "row_json"))).alias("_rows")
    )
    statuses = F.array_distinct(F.transform("_rows", lambda r: r["o_orderstatus"]))
    series_json = F.transform(
        statuses,
        lambda st: F.concat(
            F.lit('{"name":"orders","tags":{"o_orderstatus":"'), st,
            F.lit('"},"columns":' + columns_json + ',"values":['),
            F.array_join(F.transform(F.filter("_rows", lambda r: r["o_orderstatus"] == st), lambda r: r["row_json"]), ","),
            F.lit("]}"),
        ),
    )
    body = F.concat(
        F.lit('{"results":[{"series":['), F.array_join(series_json, ","),
        F.lit("]}"), result_err, F.lit("]"), query_err, F.lit("}"),
    )
    odd = F.lit(None).cast("string")
    for remainder, text in ODD_BODIES.items():
        odd = F.when(F.pmod(doc, F.lit(ODD_EVERY)) == remainder, F.lit(text)).otherwise(odd)
    both = F.array(F.struct(doc.alias("doc_id"), body.alias("body")), F.struct((-1 - doc).alias("doc_id"), odd.alias("body")))
    return by_doc.select(F.inline(F.filter(both, lambda d: d["body"].isNotNull())))
