"""Queries over the engine's own operators, and the SQL that gives the same rows.

Cells are made from the tables: an order is a row with fixed columns, and with a dynamic column set for each of its
line items; a user is a row whose columns are event types, with a version for each event.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Column, TargetSpec, parse_files, parse_sources
from .functions.codecs import delimited, encoded, iso_date, salt
from .operators import cdc, project, reshape, rowkey
from .operators.jsonflat import flatten_json
from .operators.recon import recon
from .plans import engine
from .sources import bookmarks, cells as scans

ORDERS = parse_sources('orders:orders->RK=|:st|ok->D.TOTAL:long::,D.PRIO:string::,D.QTY<X>:int::,D.PRICE<X>:long::,D.FLAG<X>:string::->X=|:ln|pk|sk;')[0]
EVENTS = parse_sources("events:events->RK=uid->D.click:string::,D.view:string::,D.purchase:string::,D.signup:string::;")[0]


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _cell(key, qualifier, value, ts=None, kind=None) -> list:
    return [key.alias("row_key"), F.lit("D").alias("family"), qualifier.alias("qualifier"), (F.lit(1) if ts is None else ts).cast("long").alias("ts"), (F.lit("put") if kind is None else kind).alias("cell_type"), value.cast("binary").alias("value")]


def _micros(c: str = "ts"):
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST({c} AS TIMESTAMP_NTZ))")


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


def order_cells(spark: SparkSession, d: str, drafts: bool = False) -> DataFrame:
    """Cells of all orders and line items; drafts adds a row of status D for each order, with fixed columns only."""
    orders, items = _read(spark, d, "orders"), _read(spark, d, "lineitem")
    key = F.encode(F.concat_ws("|", "o_orderstatus", F.col("o_orderkey").cast("string")), "UTF-8")
    fixed = F.array(F.struct(F.lit("TOTAL").alias("q"), encoded(_cents("o_totalprice").cast("string"), "long").alias("v")), F.struct(F.lit("PRIO").alias("q"), F.encode("o_orderpriority", "UTF-8").alias("v")))
    part = F.concat_ws("|", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    moving = F.array(
        F.struct(F.concat(F.lit("QTY"), part).alias("q"), encoded(F.col("l_quantity").cast("int").cast("string"), "int").alias("v")),
        F.struct(F.concat(F.lit("PRICE"), part).alias("q"), encoded(_cents("l_extendedprice").cast("string"), "long").alias("v")),
        F.struct(F.concat(F.lit("FLAG"), part).alias("q"), F.encode("l_returnflag", "UTF-8").alias("v")),
    )
    status = F.explode(F.array("o_orderstatus", F.lit("D"))) if drafts else F.col("o_orderstatus")
    a = orders.withColumn("o_orderstatus", status).select(key.alias("k"), F.explode(fixed).alias("c"))
    b = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(key.alias("k"), F.explode(moving).alias("c"))
    return a.unionByName(b).select(*_cell(F.col("k"), F.col("c.q"), F.col("c.v")))


def event_cells(spark: SparkSession, d: str, markers: bool = False) -> DataFrame:
    e = _read(spark, d, "events")
    error = F.col("event_type") == "error"
    key = F.encode(F.col("user_id").cast("string"), "UTF-8")
    value = F.encode(F.col("event_id").cast("string"), "UTF-8")
    kind = F.when(error, F.lit("delete_family")).otherwise(F.lit("put"))
    return e.select(*_cell(key, F.when(error, F.lit("")).otherwise(F.col("event_type")) if markers else F.col("event_type"), value, _micros(), kind if markers else None))


def order_json(spark: SparkSession, d: str, top_array: bool = False) -> DataFrame:
    """ok, J: an order as JSON with an array of objects and an array of scalars."""
    items = _read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"), F.col("l_returnflag").alias("flag"))).alias("items"))
    rows = _read(spark, d, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    doc = F.struct(F.struct(F.col("o_orderpriority").alias("prio")).alias("head"), F.col("items"), F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    return rows.select(F.col("o_orderkey").cast("string").alias("ok"), (F.to_json("items") if top_array else F.to_json(doc)).alias("J"))


def _orders(text: str, drafts: bool = False):
    return lambda spark, d: engine.run(order_cells(spark, d, drafts), ORDERS, text)


_BASE = """WITH o AS (SELECT o_orderstatus AS st, CAST(o_orderkey AS VARCHAR) AS ok, CAST(round(o_totalprice * 100) AS BIGINT) AS "TOTAL", o_orderpriority AS "PRIO" FROM {orders}),
l AS (SELECT CAST(l_orderkey AS VARCHAR) AS lok, CAST(l_linenumber AS VARCHAR) AS ln, CAST(l_partkey AS VARCHAR) AS pk, CAST(l_suppkey AS VARCHAR) AS sk,
      CAST(l_quantity AS INTEGER) AS "QTY", CAST(round(l_extendedprice * 100) AS BIGINT) AS "PRICE", l_returnflag AS "FLAG" FROM lineitem)
"""
_DRAFTS = "(SELECT * FROM orders UNION ALL SELECT * REPLACE ('D' AS o_orderstatus) FROM orders)"
_PART = "st, ok, ln, pk, sk"


def _sql(select: str, where: str, drafts: bool = False) -> str:
    """Line items joined to orders; drafts, which have none, are kept too if they are asked for."""
    join = "LEFT JOIN l ON ok = lok AND st <> 'D'" if drafts else "JOIN l ON ok = lok"
    return _BASE.format(orders=_DRAFTS if drafts else "orders") + f"SELECT {select} FROM o {join} WHERE {where}"


_SQL_EVENTS = """SELECT CAST(user_id AS VARCHAR) AS uid, event_type AS qualifier, epoch_us(ts) AS ts, CAST(event_id AS VARCHAR) AS value FROM ({}) t"""


def _newest(where: str = "true") -> str:
    return _SQL_EVENTS.format(f"SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events WHERE {where}") + " WHERE rn = 1"


def _plain_events(cells: DataFrame) -> DataFrame:
    return cells.select(F.decode("row_key", "UTF-8").alias("uid"), "qualifier", "ts", F.decode("value", "UTF-8").alias("value"))


def _bounds(spark: SparkSession, d: str) -> tuple[int, int]:
    """A bookmark two thirds into the events, and the end above them."""
    ends = _read(spark, d, "events").agg(F.min(_micros()).alias("a"), F.max(_micros()).alias("b")).first()
    return ends["a"] + (ends["b"] - ends["a"]) * 2 // 3, ends["b"] + 1


LOW, HIGH = "2024-01-05 00:00:00", "2024-01-20 00:00:00"


def time_range(spark: SparkSession, d: str) -> DataFrame:
    us = lambda s: _micros(f"'{s}'")
    return _plain_events(scans.latest(event_cells(spark, d).filter((F.col("ts") >= us(LOW)) & (F.col("ts") < us(HIGH)))))


EVENT_TARGET = parse_files("ev=uid:string:,click:string:,view:string:,purchase:string:,signup:string:;")[0]
_EVENT_QUERY = "select D.* from events"


def partial_with_deletes(spark: SparkSession, d: str) -> DataFrame:
    low, high = (int(datetime.fromisoformat(f"{x}+00:00").timestamp()) * 1_000_000 for x in (LOW, HIGH))
    return engine.run(event_cells(spark, d, True), EVENTS, _EVENT_QUERY, EVENT_TARGET, low, high)


def incremental(spark: SparkSession, d: str) -> DataFrame:
    cells, (mark, high) = event_cells(spark, d, True), _bounds(spark, d)
    before = engine.run(cells, EVENTS, _EVENT_QUERY, EVENT_TARGET, None, mark)
    return engine.run_incremental(cells, before, EVENTS, _EVENT_QUERY, EVENT_TARGET, mark, high)


_LIVE_SQL = """WITH m AS (SELECT user_id, max(ts) AS mark FROM events WHERE event_type = 'error' GROUP BY user_id),
p AS (SELECT e.user_id, e.event_type, e.event_id, row_number() OVER (PARTITION BY e.user_id, e.event_type ORDER BY e.ts DESC) AS rn
      FROM events e LEFT JOIN m USING (user_id) WHERE e.event_type IN ('click', 'view', 'purchase', 'signup') AND (m.mark IS NULL OR e.ts > m.mark))
SELECT CAST(user_id AS VARCHAR) AS uid, CAST(max(event_id) FILTER (event_type = 'click') AS VARCHAR) AS click, CAST(max(event_id) FILTER (event_type = 'view') AS VARCHAR) AS view,
       CAST(max(event_id) FILTER (event_type = 'purchase') AS VARCHAR) AS purchase, CAST(max(event_id) FILTER (event_type = 'signup') AS VARCHAR) AS signup
FROM p WHERE rn = 1 GROUP BY user_id"""


def _json(paths: list[str], top_array: bool = False, where=None):
    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = flatten_json(order_json(spark, d, top_array), "J", paths)
        rows = rows if where is None else rows.filter(where)
        return rows.select(*(F.col(f"`{c}`").alias(c.replace("#", "_")) for c in rows.columns))

    return query


def key_only(spark: SparkSession, d: str) -> DataFrame:
    return rowkey.with_key_fields(scans.keys_only(order_cells(spark, d)), ORDERS).select("st", "ok")


def column_pruned(spark: SparkSession, d: str) -> DataFrame:
    plan = engine.plan_of(ORDERS, 'select D.QTY<X> from orders where D.PRIO = "1-URGENT"')
    return scans.prune_columns(order_cells(spark, d), plan).groupBy(F.regexp_extract("qualifier", "^[A-Z]+", 0).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def defaults(spark: SparkSession, d: str) -> DataFrame:
    target = parse_files('dim=st:string:,ok:string:,TOTAL:long:,FLAG:string:"none";')[0]
    rows = engine.run(order_cells(spark, d, True), ORDERS, 'select D.TOTAL from orders where D.FLAG<X> = "null" or D.FLAG<X> = "R"')
    return project.to_target(rows, target)


def reconciled(spark: SparkSession, d: str) -> DataFrame:
    return recon(engine.run(order_cells(spark, d), ORDERS, "select D.QTY<X>,D.FLAG<X> from orders"), {"QTY": ["sum", "count"], "FLAG": ["count"]}, 0)


def _flat(spark: SparkSession, d: str) -> DataFrame:
    return engine.run(order_cells(spark, d), ORDERS, "select D.QTY<X> from orders")


def delete_all(spark: SparkSession, d: str) -> DataFrame:
    keys = _read(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderstatus").alias("st"), F.col("o_orderkey").cast("string").alias("ok"))
    return cdc.without(_flat(spark, d), keys, ["st", "ok"])


def delete_single(spark: SparkSession, d: str) -> DataFrame:
    keys = _read(spark, d, "lineitem").filter("l_returnflag = 'R'").join(_read(spark, d, "orders"), F.expr("l_orderkey = o_orderkey"))
    keys = keys.select(F.col("o_orderstatus").alias("st"), *(F.col(c).cast("string").alias(n) for c, n in (("o_orderkey", "ok"), ("l_linenumber", "ln"), ("l_partkey", "pk"), ("l_suppkey", "sk"))))
    return cdc.without(_flat(spark, d), keys, ["st", "ok", "ln", "pk", "sk"])


def high_water(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").select(_micros().alias("ts"), F.when(F.col("event_type") == "click", "DR").otherwise("DC").alias("data_source"), F.floor("value").cast("long").alias("count"))
    return bookmarks.high_water(e)


TALL = parse_sources('tall:tall->RK=#:kind="L"#ok#ln->F.QTY:string:"0":,F.NOTE:string:"none":;')[0]


def tall_rekey(spark: SparkSession, d: str) -> DataFrame:
    rows = _flat(spark, d).select("ok", F.concat_ws("-", "ln", "pk", "sk").alias("ln"), "QTY")
    made = reshape.to_cells(project.rekeyed(rows, TALL), {"QTY": "F", "NOTE": "F"}, F.col("row_key"), F.lit(7))
    return made.select(F.decode("row_key", "UTF-8").alias("row_key"), "family", "qualifier", "ts", F.decode("value", "UTF-8").alias("value"))


def delimited_record(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d).select(delimited([F.col(c) for c in ("st", "ok", "ln", "QTY")]).alias("record"))


def date_reformat(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "orders").select("o_orderkey", iso_date(F.date_format("o_orderdate", "dd-MM-yyyy")).alias("iso"))


def salt_bucket(spark: SparkSession, d: str) -> DataFrame:
    salted = _read(spark, d, "orders").select(salt(F.col("o_orderkey").cast("string"), 8).alias("b"))
    return salted.groupBy(F.hex("b").alias("salt")).agg(F.count(F.lit(1)).alias("n"))


def dynamic_match(spark: SparkSession, d: str) -> DataFrame:
    """Which column each qualifier belongs to where affixes overlap: the longest prefix, or a strictly longer suffix."""
    columns = tuple(Column("D", n, prefix=p, suffix=s, placeholder="X") for n, p, s in (("P", "P", ""), ("PRI", "PRI", ""), ("END", "", "|1")))
    cells = order_cells(spark, d).select("family", F.regexp_replace("qualifier", r"^(\w+)\|.*\|(\d)\d*$", "$1|$2").alias("qualifier"))
    return cells.withColumn("m", reshape.matched(columns)).groupBy(F.col("m.label").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def where_json(spark: SparkSession, d: str) -> DataFrame:
    """A whole query with a JSON column: flattened along the target's leaves, a leaf tested."""
    spec = parse_sources("oj:oj->RK=ok->D.J:json::;")[0]
    target = TargetSpec("fact", parse_files("t=ok:string:,PARENT=items>COLUMNS=JSON.ln:int:,JSON.flag:string:;")[0].columns)
    cells = order_json(spark, d).select(*_cell(F.encode("ok", "UTF-8"), F.lit("J"), F.encode("J", "UTF-8")))
    rows = engine.run(cells, spec, 'select D.J from oj where items#flag = "R" and items#ln < "3"', target)
    return rows.select("ok", F.col("`items#ln`").alias("ln"), F.col("`items#flag`").alias("flag"))


_REL = 'select D.QTY<X>,D.PRICE<X> from orders where D.QTY<X> >= "10" and D.QTY<X> < "20" and D.PRICE<X> > "1500000" and D.TOTAL <= "30000000" and D.FLAG<X> != "N"'
_LINES = f'{_PART}, "QTY"'

QUERIES = {
    "unpivot_dynamic": _orders('select D.QTY<X>,D.PRICE<X> from orders where st = "F" and D.FLAG<X> = "R"'),
    "unpivot_outer_static_only": _orders('select D.TOTAL from orders where D.FLAG<X> = "null"', True),
    "static_select_where_dynamic": _orders('select D.TOTAL from orders where D.FLAG<X> = "R"'),
    "static_select": lambda s, d: engine.run(scans.prune_columns(order_cells(s, d), engine.plan_of(ORDERS, "select D.TOTAL,D.PRIO from orders")), ORDERS, "select D.TOTAL,D.PRIO from orders").drop("ln", "pk", "sk"),
    "latest_version": lambda s, d: _plain_events(scans.latest(event_cells(s, d))),
    "live_cells": lambda s, d: engine.run(event_cells(s, d, True), EVENTS, _EVENT_QUERY, EVENT_TARGET),
    "time_range_partial": time_range,
    "partial_with_deletes": partial_with_deletes,
    "rowkey_prefix": lambda s, d: rowkey.with_key_fields(scans.keys_only(scans.with_prefix(order_cells(s, d), b"F|1")), ORDERS).select("st", "ok"),
    "rowkey_point": _orders('select D.QTY<X> from orders where st = "O" and ok = "7"'),
    "key_only_scan": key_only,
    "column_pruned_scan": column_pruned,
    "regex_filter": _orders('select D.QTY<X> from orders where D.PRIO REGEXP "[12]-.*" and pk REGEXP "1[0-9]*"'),
    "not_regex_filter": _orders('select D.QTY<X> from orders where D.PRIO NOT REGEXP "[1-4]-.*" and st != "F"'),
    "relational_ops": _orders(_REL),
    "null_checks": _orders('select D.TOTAL from orders where D.PRIO != "null" and D.QTY<X> = "null"', True),
    "bool_tree": _orders('select D.QTY<X> from orders where st = "F" and D.FLAG<X> = "R" or D.QTY<X> > "49"'),
    "bracket_tree": _orders('select D.QTY<X> from orders where (st = "F" and D.FLAG<X> = "R") or (D.QTY<X> > "49" and D.PRIO = "5-LOW")'),
    "dynamic_part_filter": _orders('select D.QTY<X> from orders where ln = "1" and sk REGEXP "[0-9]"'),
    "star_family": _orders('select D.* from orders where st = "P" and ln = "2"'),
    "regex_projection": _orders('select D.PRIO,TOT* from orders where D.FLAG<X> = "null"', True),
    "dynamic_match": dynamic_match,
    "json_flatten_object": _json(["head#prio"]),
    "json_explode_objects": _json(["items#ln", "items#pk"]),
    "json_explode_scalars": _json(["tags"]),
    "json_cross_product": _json(["head#prio", "items#ln", "items#flag", "tags"]),
    "json_top_array": _json(["ln", "flag"], True),
    "json_where": where_json,
    "defaults_projection": defaults,
    "recon_sum_count": reconciled,
    "delete_anti_join_all": delete_all,
    "delete_anti_join_single": delete_single,
    "incremental_upsert": incremental,
    "bookmark_high_water": high_water,
    "tall_rekey": tall_rekey,
    "delimited_record": delimited_record,
    "date_reformat": date_reformat,
    "salt_bucket": salt_bucket,
}

_OJ = "SELECT CAST(o_orderkey AS VARCHAR) AS ok, {} FROM orders {} {}"
_LJ = "LEFT JOIN lineitem ON l_orderkey = o_orderkey"

ORACLE_SQL = {
    "unpivot_dynamic": _sql(f'{_PART}, "QTY", "PRICE", "FLAG"', "st = 'F' AND \"FLAG\" = 'R'"),
    "unpivot_outer_static_only": _sql(f'{_PART}, "TOTAL", "FLAG"', "lok IS NULL", True),
    "static_select_where_dynamic": _sql(f'{_PART}, "TOTAL", "FLAG"', "\"FLAG\" = 'R'"),
    "static_select": _BASE.format(orders="orders") + 'SELECT st, ok, "TOTAL", "PRIO" FROM o',
    "latest_version": _newest(),
    "live_cells": _LIVE_SQL,
    "time_range_partial": _newest(f"ts >= TIMESTAMP '{LOW}' AND ts < TIMESTAMP '{HIGH}'"),
    "partial_with_deletes": _LIVE_SQL.replace("WITH m AS", f"WITH ev AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{LOW}' AND ts < TIMESTAMP '{HIGH}'), m AS").replace("FROM events", "FROM ev").replace("ev AS (SELECT * FROM ev", "ev AS (SELECT * FROM events"),
    "rowkey_prefix": _BASE.format(orders="orders") + "SELECT st, ok FROM o WHERE st || '|' || ok LIKE 'F|1%'",
    "rowkey_point": _sql(_LINES, "st = 'O' AND ok = '7'"),
    "key_only_scan": _BASE.format(orders="orders") + "SELECT st, ok FROM o",
    "column_pruned_scan": "SELECT 'QTY' AS kind, count(*) AS n FROM lineitem UNION ALL SELECT 'PRIO', count(*) FROM orders",
    "regex_filter": _sql(f'{_LINES}, "PRIO"', "regexp_full_match(\"PRIO\", '[12]-.*') AND regexp_full_match(pk, '1[0-9]*')"),
    "not_regex_filter": _sql(f'{_LINES}, "PRIO"', "NOT regexp_full_match(\"PRIO\", '[1-4]-.*') AND st <> 'F'"),
    "relational_ops": _sql(f'{_PART}, "QTY", "PRICE", "TOTAL", "FLAG"', '"QTY" >= 10 AND "QTY" < 20 AND "PRICE" > 1500000 AND "TOTAL" <= 30000000 AND "FLAG" <> \'N\''),
    "null_checks": _sql(f'{_PART}, "TOTAL", "PRIO", "QTY"', "lok IS NULL", True),
    "bool_tree": _sql(f'{_LINES}, "FLAG"', "st = 'F' AND (\"FLAG\" = 'R' OR \"QTY\" > 49)"),
    "bracket_tree": _sql(f'{_LINES}, "FLAG", "PRIO"', "(st = 'F' AND \"FLAG\" = 'R') OR (\"QTY\" > 49 AND \"PRIO\" = '5-LOW')"),
    "dynamic_part_filter": _sql(_LINES, "ln = '1' AND length(sk) = 1"),
    "star_family": _sql(f'{_PART}, "TOTAL", "PRIO", "QTY", "PRICE", "FLAG"', "st = 'P' AND ln = '2'"),
    "regex_projection": _sql(f'{_PART}, "TOTAL", "PRIO", "FLAG"', "lok IS NULL", True),
    "dynamic_match": "SELECT 'PRI' AS label, count(*) AS n FROM (SELECT 1 FROM orders UNION ALL SELECT 1 FROM lineitem)"
    " UNION ALL SELECT 'END', 2 * count(*) FROM lineitem WHERE CAST(l_suppkey AS VARCHAR) LIKE '1%'"
    " UNION ALL SELECT NULL, (SELECT count(*) FROM orders) + (SELECT 2 * count(*) FROM lineitem WHERE CAST(l_suppkey AS VARCHAR) NOT LIKE '1%')",
    "json_flatten_object": _OJ.format("o_orderpriority AS head_prio", "", ""),
    "json_explode_objects": _OJ.format("CAST(l_linenumber AS VARCHAR) AS items_ln, CAST(l_partkey AS VARCHAR) AS items_pk", _LJ, ""),
    "json_explode_scalars": _OJ.format("t AS tags", ", unnest([o_orderstatus, o_orderpriority]) AS u(t)", ""),
    "json_cross_product": _OJ.format("o_orderpriority AS head_prio, CAST(l_linenumber AS VARCHAR) AS items_ln, l_returnflag AS items_flag, t AS tags", _LJ, ", unnest([o_orderstatus, o_orderpriority]) AS u(t)"),
    "json_top_array": _OJ.format("CAST(l_linenumber AS VARCHAR) AS ln, l_returnflag AS flag", _LJ, ""),
    "json_where": _OJ.format("CAST(l_linenumber AS VARCHAR) AS ln, l_returnflag AS flag", "JOIN lineitem ON l_orderkey = o_orderkey", "WHERE l_returnflag = 'R' AND l_linenumber < 3"),
    "defaults_projection": _sql('st, ok, "TOTAL", coalesce("FLAG", \'none\') AS "FLAG"', "lok IS NULL OR \"FLAG\" = 'R'", True),
    "recon_sum_count": "SELECT count(*) AS rows, CAST(sum(CAST(l_quantity AS INTEGER)) AS DECIMAL(38,0)) AS \"sum_QTY\", count(l_quantity) AS \"count_QTY\", count(l_returnflag) AS \"count_FLAG\" FROM lineitem",
    "delete_anti_join_all": _sql(_LINES, "NOT EXISTS (SELECT 1 FROM o AS x WHERE x.ok = o.ok AND x.\"PRIO\" = '1-URGENT')"),
    "delete_anti_join_single": _sql(_LINES, "\"FLAG\" <> 'R'"),
    "incremental_upsert": _LIVE_SQL,
    "bookmark_high_water": "SELECT coalesce(max(epoch_us(ts)), 0) AS ts FROM events WHERE event_type = 'click' AND floor(value) >= 0",
    "tall_rekey": _BASE.format(orders="orders")
    + ", r AS (SELECT 'L#' || ok || '#' || ln || '-' || pk || '-' || sk AS row_key, CAST(\"QTY\" AS VARCHAR) AS q FROM o JOIN l ON ok = lok)"
    + " SELECT row_key, 'F' AS family, 'QTY' AS qualifier, CAST(7 AS BIGINT) AS ts, q AS value FROM r UNION ALL SELECT row_key, 'F', 'NOTE', CAST(7 AS BIGINT), 'none' FROM r",
    "delimited_record": _BASE.format(orders="orders") + 'SELECT concat_ws(chr(1), st, ok, ln, CAST("QTY" AS VARCHAR)) AS record FROM o JOIN l ON ok = lok',
    "date_reformat": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders",
}
