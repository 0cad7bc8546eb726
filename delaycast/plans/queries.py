"""Driver queries: each operator of the inventory run over the driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name]`` (DuckDB
SQL over the same Parquet tables) with identical output column names.
Mapping of the driver tables onto the reference's feeds: ``events`` plays the
feeds (``event_type`` = feed, ``user_id`` = vehicle/route, ``value`` =
delay, ``props`` = JSON payload); the TPC-H tables carry the nested-message,
grid and dimension operators.

Output conventions: timestamps leave as ``timestamp_ntz`` (UTC wall clock,
like DuckDB ``TIMESTAMP``); float aggregates are rounded to 6 decimals on
both sides so summation order cannot change the hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, ArrayType

from .. import session as S
from ..functions import flatten as P
from ..functions import scalars as C
from ..functions import timeops as T
from ..operators import dedup as D
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import stats as A
from ..sources import readers as R
from ..sources import sinks as K

DIGITS = 6
ROUTE_USER = 7            # route used by the single-route questions (F1)
KEY_RANGE = ("2024-01-10", "2024-01-12")   # S8 row-key range [start, stop)
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


# ---------------------------------------------------------------- loading

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    S.configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as session-TZ timestamp (UTC wall clock kept)."""
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", T.to_ts(F.col("ts")))


def ntz(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, DIGITS)


# SQL snippets mirroring the bucket rules (integer arithmetic, exact)
def sql_bucket(ts: str, width_s: int, mode: str, shift_s: int = 0, precision: str = "micro") -> str:
    if precision == "second":
        x, w, unit = f"(epoch_us({ts}) // 1000000)", width_s, 1000000
    else:
        x, w, unit = f"epoch_us({ts})", width_s * 1000000, 1
    if mode == "half_up":
        idx = f"(({x} + {w // 2}) // {w})"
    elif mode == "half_even":
        idx = (f"(CASE WHEN 2 * ({x} % {w}) > {w} OR (2 * ({x} % {w}) = {w} AND ({x} // {w}) % 2 = 1) "
               f"THEN {x} // {w} + 1 ELSE {x} // {w} END)")
    else:
        idx = f"({x} // {w})"
    return f"make_timestamp(({idx} * {w} * {unit}) + {shift_s * 1000000})"


SQL_NEXT_HOUR = sql_bucket("ts", 3600, "half_up", 3600, "second")
SQL_HOUR_EVEN = sql_bucket("ts", 3600, "half_even")


# ---------------------------------------------------------------- P: parse / flatten

def q_json_flatten(spark, d):
    ev = events(spark, d).select("event_id", "user_id", "event_type", "value", "props")
    payload = StructType([StructField("k", StringType(), True)])
    parsed = P.parse_json(ev.withColumn("props", P.bytes_to_text(F.encode("props", "UTF-8"))),
                          "props", payload, keep=["event_id", "user_id", "event_type", "value"],
                          corrupt_col="corrupt")
    return parsed.select("event_id", "user_id", "event_type", "value",
                         C.to_number("k", "int").alias("k"), "corrupt")


O_JSON_FLATTEN = """
SELECT event_id, user_id, event_type, value,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       (props IS NOT NULL AND NOT json_valid(props)) AS corrupt
FROM events"""


def _spoiled(spark, d):
    """Every seventh message cut short by its last character."""
    ev = events(spark, d)
    return ev.select("event_id", "event_type", F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)"))
                     .otherwise(F.col("props")).alias("props"))


def q_rejected_messages(spark, d):
    """Messages that are no JSON go to the rejects, the others are parsed; none is lost."""
    msgs = _spoiled(spark, d)
    good, bad = P.split_rejects(msgs, "props", StructType([StructField("k", StringType(), True)]),
                                keep=["event_id", "event_type"])
    return good.select("event_id", "event_type", C.to_number("k", "int").alias("k"), F.lit(False).alias("rejected")) \
        .unionByName(bad.select("event_id", "event_type", F.lit(None).cast("int").alias("k"), F.lit(True).alias("rejected")))


O_REJECTED_MESSAGES = """
WITH m AS (SELECT event_id, event_type,
                  CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1) ELSE props END AS t FROM events)
SELECT event_id, event_type,
       CASE WHEN json_valid(t) THEN TRY_CAST(json_extract_string(CASE WHEN json_valid(t) THEN t END, '$.k') AS INTEGER) END AS k,
       coalesce(NOT json_valid(t), false) AS rejected
FROM m"""


def q_route_box(spark, d):
    """Q9: the bounding box of one route's whole track."""
    ev = events(spark, d).withColumn("k", C.to_number(F.get_json_object("props", "$.k")))
    route = FL.equals(ev, "user_id", ROUTE_USER)
    return route.agg(*A.bounding_box(route, ["value", "k"]))


O_ROUTE_BOX = f"""
SELECT min(value) AS min_value, max(value) AS max_value, min(k) AS min_k, max(k) AS max_k
FROM (SELECT value, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events WHERE user_id = {ROUTE_USER})"""


# Declared schema of the packed order messages (numbers declared as text,
# like the vehicle feed).
ITEM_FIELDS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
ORDER_MESSAGE = StructType([
    StructField("orderKey", StringType(), True),
    StructField("lastUpdate", StringType(), True),
    StructField("vehicles", ArrayType(StructType([StructField(f, StringType(), True)
                                                  for f in ITEM_FIELDS])), True),
])


def order_messages(spark, d, outer: bool = False) -> DataFrame:
    """Feed producer stand-in: one JSON message per order chunk with an array
    of its line items. Chunks are (order, line number div 8), so an array
    holds at most 8 entries whatever the skew of the order key."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    packed = li.groupBy("l_orderkey", T.floor_div(F.col("l_linenumber").cast("bigint"), 8).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct(*ITEM_FIELDS))).alias("items"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = orders.join(packed, orders.o_orderkey == packed.l_orderkey, "left" if outer else "inner")
    msg = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("orderKey"),
                             F.date_format(F.col("o_orderdate").cast("timestamp"),
                                           "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lastUpdate"),
                             F.col("items").alias("vehicles")))
    return j.select(msg.alias("value"))


def q_nested_explode(spark, d):
    msgs = order_messages(spark, d)
    parsed = P.parse_json(msgs, "value", ORDER_MESSAGE, corrupt_col=None)
    rows = P.explode_rows(parsed, "vehicles", alias="v")
    flat = P.flatten(rows, depth=1, keep_parent_names=False)
    typed = P.typed(flat, {"orderKey": "bigint", "l_linenumber": "int", "l_quantity": "double",
                           "l_extendedprice": "double"})
    return typed.select(F.col("orderKey").alias("o_orderkey"),
                        ntz(T.to_ts("lastUpdate")).alias("last_update"),
                        "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")


O_NESTED_EXPLODE = """
SELECT o.o_orderkey, o.o_orderdate AS last_update, l.l_linenumber, l.l_quantity,
       l.l_extendedprice, l.l_returnflag
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey"""


def q_explode_outer_first(spark, d):
    msgs = order_messages(spark, d, outer=True)
    parsed = P.parse_json(msgs, "value", ORDER_MESSAGE, corrupt_col=None)
    returned = parsed.select("orderKey", F.filter("vehicles", lambda x: x["l_returnflag"] == "R").alias("r"))
    with_first = returned.select("orderKey", "r", P.first_element("r")["l_linenumber"].alias("first_linenumber"))
    rows = P.explode_rows(with_first, "r", alias="item", outer=True)
    return rows.select(F.col("orderKey").cast("bigint").alias("o_orderkey"),
                       C.to_number(F.col("item.l_linenumber"), "int").alias("l_linenumber"),
                       C.to_number(F.col("item.l_quantity")).alias("l_quantity"),
                       C.to_number("first_linenumber", "int").alias("first_linenumber"))


O_EXPLODE_OUTER_FIRST = """
SELECT o.o_orderkey, l.l_linenumber, l.l_quantity,
       min(l.l_linenumber) OVER (PARTITION BY o.o_orderkey, l.l_linenumber // 8) AS first_linenumber
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND l.l_returnflag = 'R'"""


# ---------------------------------------------------------------- C: scalars

def q_recode_and_class(spark, d):
    part = table(spark, d, "part")
    route = F.concat(F.upper(F.substring("p_name", 1, 1)), F.col("p_size").cast("string"))
    r = part.select("p_partkey", route.alias("route"), "p_brand")
    return r.select("p_partkey", "route", C.recode_night_route("route").alias("route_recoded"),
                    C.route_class("route").alias("route_class"),
                    C.split_first(F.concat_ws("-", "route", "p_brand")).alias("service_prefix"))


O_RECODE_AND_CLASS = """
WITH r AS (SELECT p_partkey, upper(substr(p_name, 1, 1)) || CAST(p_size AS VARCHAR) AS route, p_brand FROM part)
SELECT p_partkey, route,
  CASE WHEN starts_with(route, 'N') THEN '99' || CASE WHEN length(substr(route, 2)) < 2
       THEN lpad(substr(route, 2), 2, '0') ELSE substr(route, 2) END ELSE route END AS route_recoded,
  CASE WHEN contains(route, 'N') THEN 'night' WHEN length(route) <= 2 THEN 'short'
       WHEN route IS NOT NULL THEN 'regular' END AS route_class,
  split_part(route || '-' || p_brand, '-', 1) AS service_prefix
FROM r"""


def q_weekday_time_parse(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", T.to_ts("o_orderdate").alias("t"))
    txt = o.select("o_orderkey", T.format_weekday_time("t").alias("weekday_text"))
    parsed = txt.withColumn("parsed", T.parse_weekday_time("weekday_text"))
    return parsed.select("o_orderkey", "weekday_text", ntz("parsed").alias("parsed"),
                         T.format_compact("parsed").alias("compact"))


O_WEEKDAY_TIME_PARSE = """
SELECT o_orderkey, strftime(o_orderdate, '%a %b %d %H:%M:%S UTC %Y') AS weekday_text,
       o_orderdate AS parsed, strftime(o_orderdate, '%Y%m%d%H%M') AS compact
FROM orders"""


def q_bucket_next_hour(spark, d):
    ev = events(spark, d)
    return ev.select("event_id", ntz(T.next_hour_bucket("ts")).alias("bucket"))


O_BUCKET_NEXT_HOUR = f"SELECT event_id, {SQL_NEXT_HOUR} AS bucket FROM events"


def q_bucket_10min_even(spark, d):
    ev = events(spark, d)
    return ev.select("event_id", ntz(T.ten_minute_bin("ts")).alias("bin10"),
                     ntz(T.minute_bin("ts")).alias("bin1"),
                     ntz(T.hour_bin("ts")).alias("bin60"),
                     ntz(T.training_forecast_bin("ts")).alias("forecast_bin"))


O_BUCKET_10MIN_EVEN = f"""
SELECT event_id, {sql_bucket('ts', 600, 'half_even')} AS bin10,
       {sql_bucket('ts', 60, 'half_even')} AS bin1,
       {SQL_HOUR_EVEN} AS bin60,
       {sql_bucket('ts', 3600, 'half_even', 3600)} AS forecast_bin
FROM events"""


def q_midnight_features(spark, d):
    ev = events(spark, d)
    return ev.select("event_id", *T.time_parts("ts"),
                     T.minutes_left_to_midnight("ts").alias("minutes_left"),
                     T.minutes_to_nearest_midnight("ts").alias("minutes_to_midnight"))


O_MIDNIGHT_FEATURES = """
SELECT event_id, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(minute(ts) AS INTEGER) AS minute,
       CAST(1440 - (hour(ts) * 60 + minute(ts)) AS INTEGER) AS minutes_left,
       CAST(least((((86400000000 - epoch_us(ts) % 86400000000) // 1000000) % 86400) // 60,
                  (epoch_us(ts) % 86400000000) // 60000000) AS INTEGER) AS minutes_to_midnight
FROM events"""


# ---------------------------------------------------------------- S / F: selection

def _events_by_name(spark, d):
    """The exactly-once predicate on the path of the files, one file
    or a folder of part files."""
    df = FL.file_name_contains(table(spark, d, "events"), "/events.parquet", whole_path=True)
    return df.withColumn("ts", T.to_ts("ts"))


def q_lookback_hour(spark, d):

    ev = _events_by_name(spark, d)
    anchor = ev.select(F.max("ts")).scalar()
    return R.in_lookback_hour(ev, "ts", anchor, hours_back=2).select(
        "event_id", ntz("ts").alias("ts"), "value")


O_LOOKBACK_HOUR = """
SELECT event_id, ts, value FROM events
WHERE date_trunc('hour', ts) = date_trunc('hour', (SELECT max(ts) FROM events) - INTERVAL 2 HOUR)"""


def q_lookback_day(spark, d):

    ev = _events_by_name(spark, d)
    anchor = ev.select(F.max("ts")).scalar()
    return R.in_lookback_day(ev, "ts", anchor, days_back=1).select(
        "event_id", ntz("ts").alias("ts"), "value")


O_LOOKBACK_DAY = """
SELECT event_id, ts, value FROM events
WHERE CAST(ts AS DATE) = CAST((SELECT max(ts) FROM events) - INTERVAL 1 DAY AS DATE)"""


def q_key_range_scan(spark, d):

    ev = events(spark, d).select("event_id", "user_id", "ts", "value")
    keyed = ev.withColumn("row_key", P.row_key("ts", "user_id"))
    out = R.keyed_scan(keyed, "row_key", KEY_RANGE[0], KEY_RANGE[1], ts_col="ts")
    return out.select("row_key", "event_id", "user_id", "value")


def q_clustered_key_range(spark, d):
    """The events written in key order, then a range whose bounds are shorter than a date, so that only the
    files which can hold it are opened."""
    from ..sources import clustered as CL
    ev = events(spark, d).select("event_id", "user_id", "ts", "value").withColumn("row_key", P.row_key("ts", "user_id"))
    path = S.shared_dir(spark, "clustered")
    CL.write_clustered(ev, path, "row_key")
    out = CL.scan_clustered(spark, path, "row_key", CLUSTERED_RANGE[0], CLUSTERED_RANGE[1])
    return out.select("row_key", "event_id", "user_id", "value")


CLUSTERED_RANGE = ("2024-01-1", "2024-01-2")
O_CLUSTERED_KEY_RANGE = f"""
SELECT * FROM (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || '_' || CAST(user_id AS VARCHAR) AS row_key,
         event_id, user_id, value FROM events)
WHERE row_key >= '{CLUSTERED_RANGE[0]}' AND row_key < '{CLUSTERED_RANGE[1]}'"""


O_KEY_RANGE_SCAN = f"""
SELECT * FROM (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || '_' || CAST(user_id AS VARCHAR) AS row_key,
         event_id, user_id, value FROM events)
WHERE row_key >= '{KEY_RANGE[0]}' AND row_key < '{KEY_RANGE[1]}'"""


def q_recent_5h(spark, d):
    ev = events(spark, d)
    r = FL.recent(ev, "ts", 5 * 3600)
    return r.select("event_id", ntz(T.shift("ts", 3600)).alias("ts_local"), "value")


O_RECENT_5H = """
SELECT event_id, ts + INTERVAL 1 HOUR AS ts_local, value FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 5 HOUR"""


def q_any_null_drop(spark, d):
    ev = events(spark, d).withColumn("bucket", T.next_hour_bucket("ts"))
    clicks = ev.where(F.col("event_type") == "click").select("event_id", "bucket")
    errors = ev.where(F.col("event_type") == "error")
    j = J.bucket_enrich(clicks, errors, "bucket", "bucket", ["event_id", "value"], prefix="err_",
                        order=["ts", "event_id"])
    return FL.drop_any_null(j).select("event_id", ntz("bucket").alias("bucket"), "err_event_id",
                                      "err_value")


O_ANY_NULL_DROP = f"""
WITH b AS (SELECT *, {SQL_NEXT_HOUR} AS bucket FROM events),
e AS (SELECT bucket, event_id AS err_event_id, value AS err_value FROM (
        SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY ts DESC, event_id DESC) rn
        FROM b WHERE event_type = 'error') WHERE rn = 1)
SELECT c.event_id, c.bucket, e.err_event_id, e.err_value
FROM b c JOIN e ON c.bucket = e.bucket
WHERE c.event_type = 'click' AND e.err_event_id IS NOT NULL AND e.err_value IS NOT NULL"""


def q_epoch_key_decode(spark, d):
    """C23 (+C21): a store keyed by the 8-byte big-endian epoch-millisecond
    of the event time; the key bytes are decoded back to a timestamp."""
    ev = events(spark, d)
    key = F.unhex(F.lpad(F.hex(F.unix_millis("ts")), 16, "0"))
    keyed = ev.select("event_id", key.alias("row_key"))
    return keyed.select("event_id", F.hex("row_key").alias("row_key_hex"),
                        ntz(C.epoch_from_key("row_key")).alias("key_time"))


O_EPOCH_KEY_DECODE = """
SELECT event_id, lpad(hex(epoch_us(ts) // 1000), 16, '0') AS row_key_hex,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS key_time
FROM events"""


def q_column_families(spark, d):
    """K4 + K5: rows stored as text cells in two column families, with the
    text "None" for a missing value, read back into typed rows."""
    ev = events(spark, d)
    cells = ev.select(
        F.col("event_id").cast("string").alias("row_key"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c)
          for c in ["user_id", "event_type", "value", "props"]],
        F.coalesce(F.get_json_object("props", "$.missing"), F.lit("None")).alias("missing"))
    fam = K.to_families(cells, {"act_bus": ["user_id", "event_type", "value"],
                                "extra": ["props", "missing"]}, "row_key")
    back = K.cells_to_rows(K.from_families(fam, ["act_bus", "extra"]))
    return back.select(F.col("row_key").cast("bigint").alias("event_id"),
                       C.to_number("user_id", "bigint").alias("user_id"), "event_type",
                       C.to_number("value").alias("value"), "props", "missing")


O_COLUMN_FAMILIES = """
SELECT event_id, user_id, event_type, value, props,
       json_extract_string(props, '$.missing') AS missing
FROM events"""


def q_name_pattern_check(spark, d):
    """per-row, case-insensitive pattern built from the row's own fields
    (as the trip-id check builds ``{route}{start}.*_{service}``): does the
    name encode its own key, and (control) its neighbour's key?"""
    cu = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    own = F.concat(F.lit("customer#0*"), F.col("c_custkey").cast("string"), F.lit("$"))
    nxt = F.concat(F.lit("customer#0*"), (F.col("c_custkey") + 1).cast("string"), F.lit("$"))
    seg = F.concat(F.lit("^"), FL.quote_regex(F.lower("c_mktsegment")))
    return cu.select("c_custkey", FL.regex_contains_ci(F.col("c_name"), own).alias("key_match"),
                     FL.regex_contains_ci(F.col("c_name"), nxt).alias("neighbour_match"),
                     FL.regex_contains_ci(F.col("c_mktsegment"), seg).alias("segment_match"))


O_NAME_PATTERN_CHECK = """
SELECT c_custkey,
       regexp_matches(c_name, '(?i)customer#0*' || CAST(c_custkey AS VARCHAR) || '$') AS key_match,
       regexp_matches(c_name, '(?i)customer#0*' || CAST(c_custkey + 1 AS VARCHAR) || '$') AS neighbour_match,
       regexp_matches(c_mktsegment, '(?i)^' || lower(c_mktsegment)) AS segment_match
FROM customer"""


# ---------------------------------------------------------------- D: dedup / latest / union

def q_union_feeds(spark, d):
    ev = events(spark, d)
    view = ev.where(F.col("event_type") == "view").select("event_id", "ts", "user_id", F.col("value").alias("view_value"))
    click = ev.where(F.col("event_type") == "click").select("event_id", "ts", "user_id", F.col("props").alias("click_props"))
    error = ev.where(F.col("event_type") == "error").select("event_id", "ts", "user_id", F.col("value").alias("error_value"))
    frames = [f.withColumn("feed", F.lit(n)) for n, f in [("view", view), ("click", click), ("error", error)]]
    u = D.union_all(frames)
    return u.select("event_id", ntz("ts").alias("ts"), "user_id", "feed", "view_value", "click_props", "error_value")


O_UNION_FEEDS = """
SELECT event_id, ts, user_id, event_type AS feed,
       CASE WHEN event_type = 'view' THEN value END AS view_value,
       CASE WHEN event_type = 'click' THEN props END AS click_props,
       CASE WHEN event_type = 'error' THEN value END AS error_value
FROM events WHERE event_type IN ('view', 'click', 'error')"""


def q_dedup_rows(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    return D.dedup_rows(li)


O_DEDUP_ROWS = "SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem"


def q_dedup_first(spark, d):
    ev = events(spark, d).withColumn("hour_bin", T.hour_bin("ts")).select(
        "user_id", "hour_bin", "event_id", "ts", "value", "event_type")
    first = D.first_by_key(ev, ["user_id", "hour_bin"], ["ts", "event_id"])
    return first.select("user_id", ntz("hour_bin").alias("hour_bin"), "event_id", ntz("ts").alias("ts"),
                        "value", "event_type")


O_DEDUP_FIRST = f"""
SELECT user_id, hour_bin, event_id, ts, value, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, hour_bin ORDER BY ts, event_id) rn
  FROM (SELECT *, {SQL_HOUR_EVEN} AS hour_bin FROM events)) WHERE rn = 1"""


def q_keyed_upsert(spark, d):
    ev = events(spark, d).withColumn("day", F.to_date("ts")).select(
        "user_id", "day", "event_id", "ts", "value")
    latest = D.latest_by_key(ev, ["user_id", "day"], ["ts", "event_id"])
    keyed = latest.withColumn("row_key", F.concat_ws("_", F.date_format("day", "yyyy-MM-dd"),
                                                     F.col("user_id").cast("string")))
    return keyed.select("row_key", "user_id", F.date_format("day", "yyyy-MM-dd").alias("day"),
                        "event_id", ntz("ts").alias("ts"), "value")


O_KEYED_UPSERT = """
SELECT strftime(day, '%Y-%m-%d') || '_' || CAST(user_id AS VARCHAR) AS row_key,
       user_id, strftime(day, '%Y-%m-%d') AS day, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) rn
  FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)) WHERE rn = 1"""


def q_keyed_merge(spark, d):
    """K1/K2/K3: two overlapping loads (hours before 14, hours from 10) into one stored table."""
    ev = events(spark, d).withColumn("day", F.to_date("ts")).select(
        F.concat_ws("_", F.date_format("day", "yyyy-MM-dd"), F.col("user_id").cast("string")).alias("row_key"),
        "user_id", "day", "event_id", "ts", "value")
    path = S.shared_dir(spark, "keyed_merge")
    for part in (F.hour("ts") >= 10, F.hour("ts") < 14):
        K.write_keyed(ev.where(part), path, "row_key", ["ts", "event_id"], partition_by=["day"])
    out = spark.read.schema(ev.schema).parquet(path)
    return out.select("row_key", "user_id", F.date_format("day", "yyyy-MM-dd").alias("day"),
                      "event_id", ntz("ts").alias("ts"), "value")


def q_stream_upsert(spark, d):
    """Three files with overlapping hours, a stream batch each; every two batches are folded into
    the table by day, and table and waiting batches read as one row a key."""
    ev = events(spark, d).withColumn("day", F.to_date("ts")).select(
        F.concat_ws("_", F.date_format("day", "yyyy-MM-dd"), F.col("user_id").cast("string")).alias("row_key"),
        "user_id", "day", "event_id", "ts", "value")
    base = S.shared_dir(spark, "stream_upsert")
    for part in (F.hour("ts") >= 12, F.hour("ts").between(6, 16), F.hour("ts") < 10):
        ev.where(part).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = R.read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, ev.schema, f"{base}/in")
    keys = ("row_key", ["ts", "event_id"])
    write = K.folding_writer(f"{base}/batches", f"{base}/table", *keys, partition_by=["day"], every=2)
    K.start_stream(stream, f"{base}/_checkpoint", foreach_batch=write, trigger={"availableNow": True}).awaitTermination()
    out = K.current_rows(spark, f"{base}/batches", f"{base}/table", *keys)
    out = spark.createDataFrame([], ev.schema) if out is None else out
    return out.select("row_key", "user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_id", ntz("ts").alias("ts"), "value")


def q_stream_rejects(spark, d):
    """P2/S11 over a stream: the messages of two feeds that do not fit go to a table of their own."""
    from ..streaming import jobs
    base = S.shared_dir(spark, "stream_rejects")
    _spoiled(spark, d).select(F.col("props").alias("value"), "event_type").write.parquet(f"{base}/in")
    msgs = R.read_stream(spark, "parquet", None, StructType([StructField("value", StringType()), StructField("event_type", StringType())]), f"{base}/in")
    schema = StructType([StructField("k", StringType(), True)])
    clicks = F.col("event_type") == "click"
    bad = jobs.rejected_messages({"clicks": (msgs.where(clicks), schema), "others": (msgs.where(~clicks | F.col("event_type").isNull()), schema)})
    return jobs.run_to_table(bad, "rejects").groupBy("feed").agg(F.count("*").alias("n_rejected"), F.countDistinct("value").alias("n_texts"))


O_STREAM_REJECTS = """
WITH m AS (SELECT CASE WHEN event_type = 'click' THEN 'clicks' ELSE 'others' END AS feed,
                  CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1) ELSE props END AS t FROM events)
SELECT feed, count(*) AS n_rejected, count(DISTINCT t) AS n_texts FROM m WHERE t IS NOT NULL AND NOT json_valid(t) GROUP BY feed"""


def q_constant_corr(spark, d):
    """A8 with a factor that never changes: null, not a fault."""
    ev = events(spark, d).withColumn("one", F.lit(1.0))
    return A.factor_table(ev, {"constant": ("one", "value"), "itself": ("value", "value")})


O_CONSTANT_CORR = """
SELECT 'constant' AS factor, CAST(NULL AS DOUBLE) AS correlation
UNION ALL SELECT 'itself', round(corr(value, value), 6) FROM events"""


def q_partial_key_range(spark, d):
    """S8 with bounds that end inside a date or an hour."""
    keyed = events(spark, d).withColumn("row_key", P.row_key("ts", "event_id"))
    parts = []
    for lo, hi in PARTIAL_KEY_RANGES:
        got = R.keyed_scan(keyed, "row_key", lo, hi, ts_col="ts")
        parts.append(got.select(F.lit(f"{lo}..{hi}").alias("bounds"), "row_key", "value"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


PARTIAL_KEY_RANGES = [("2024-01-0", "2024-01-1"), ("2024-01-10", "2024-01-10 1"), ("2024-01-10 08", "2024-01-10 2")]
O_PARTIAL_KEY_RANGE = " UNION ALL ".join(f"""
SELECT '{lo}..{hi}' AS bounds, row_key, value FROM (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || '_' || CAST(event_id AS VARCHAR) AS row_key, value FROM events)
WHERE row_key >= '{lo}' AND row_key < '{hi}'""" for lo, hi in PARTIAL_KEY_RANGES)


def q_latest_overall(spark, d):
    ev = events(spark, d)
    top = D.latest_overall(ev, ["ts", "event_id"])
    return top.select("event_id", ntz("ts").alias("ts"), "user_id", "event_type", "value")


O_LATEST_OVERALL = """
SELECT event_id, ts, user_id, event_type, value FROM events
ORDER BY ts DESC, event_id DESC LIMIT 1"""


def q_latest_by_key(spark, d):
    ev = events(spark, d).select("user_id", "event_id", "ts", "event_type", "value")
    latest = D.latest_by_key(ev, ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", ntz("ts").alias("ts"), "event_type", "value")


O_LATEST_BY_KEY = """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
WHERE rn = 1"""


# ---------------------------------------------------------------- J: joins

def _weather_like(ev, cols, order=("ts", "event_id")):
    """error and view events play the observation and forecast feeds; both
    are reduced in one pass over the shared source."""
    is_ = lambda t: F.col("event_type") == t
    return {"err_": (is_("error"), cols, list(order)), "view_": (is_("view"), cols, list(order))}


def q_enrich_hour_latest(spark, d):
    ev = events(spark, d).withColumn("bucket", T.next_hour_bucket("ts"))
    left = ev.where(F.col("event_type") == "click").select("event_id", "bucket", "value")
    right = ev.where(F.col("event_type").isin("error", "view"))
    j2 = J.bucket_enrich_multi(left, right, "bucket", "bucket", _weather_like(ev, ["event_id", "value"]))
    return j2.select("event_id", ntz("bucket").alias("bucket"), "value", "err_event_id", "err_value",
                     "view_event_id", "view_value")


def _sql_latest(feed: str, prefix: str) -> str:
    return f"""(SELECT bucket, event_id AS {prefix}event_id, value AS {prefix}value FROM (
        SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY ts DESC, event_id DESC) rn
        FROM b WHERE event_type = '{feed}') WHERE rn = 1)"""


O_ENRICH_HOUR_LATEST = f"""
WITH b AS (SELECT *, {SQL_NEXT_HOUR} AS bucket FROM events)
SELECT c.event_id, c.bucket, c.value, e.err_event_id, e.err_value, v.view_event_id, v.view_value
FROM b c LEFT JOIN {_sql_latest('error', 'err_')} e ON c.bucket = e.bucket
         LEFT JOIN {_sql_latest('view', 'view_')} v ON c.bucket = v.bucket
WHERE c.event_type = 'click'"""


def q_enrich_hour_mean(spark, d):
    ev = events(spark, d).withColumn("bucket", T.next_hour_bucket("ts"))
    left = ev.where(F.col("event_type") == "click").select("event_id", "bucket", "value")
    right = ev.where(F.col("event_type").isin("error", "view"))
    j2 = J.bucket_enrich_multi(left, right, "bucket", "bucket", _weather_like(ev, ["value"]), mode="mean")
    return j2.select("event_id", ntz("bucket").alias("bucket"), "value",
                     F.coalesce("err_n", F.lit(0)).alias("err_n"), r6("err_value").alias("err_value"),
                     F.coalesce("view_n", F.lit(0)).alias("view_n"), r6("view_value").alias("view_value"))


O_ENRICH_HOUR_MEAN = f"""
WITH b AS (SELECT *, {SQL_NEXT_HOUR} AS bucket FROM events),
e AS (SELECT bucket, count(*) AS n, avg(value) AS v FROM b WHERE event_type = 'error' GROUP BY bucket),
w AS (SELECT bucket, count(*) AS n, avg(value) AS v FROM b WHERE event_type = 'view' GROUP BY bucket)
SELECT c.event_id, c.bucket, c.value, coalesce(e.n, 0) AS err_n, round(e.v, 6) AS err_value,
       coalesce(w.n, 0) AS view_n, round(w.v, 6) AS view_value
FROM b c LEFT JOIN e ON c.bucket = e.bucket LEFT JOIN w ON c.bucket = w.bucket
WHERE c.event_type = 'click'"""


def q_label_shift_day(spark, d):
    ev = events(spark, d).withColumn("day", T.time_bucket("ts", 86_400, "floor")).select(
        "user_id", "day", "ts", "event_id", "value")
    first = D.first_by_key(ev, ["user_id", "day"], ["ts", "event_id"])
    lab = J.shift_self_join(first, ["user_id"], "day", 86_400, ["value", "event_id"], suffix="_next")
    return lab.select("user_id", ntz("day").alias("day"), "event_id", "value",
                      "event_id_next", F.col("value_next").alias("label"))


O_LABEL_SHIFT_DAY = """
WITH f AS (SELECT user_id, day, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) rn
  FROM (SELECT *, date_trunc('day', ts) AS day FROM events)) WHERE rn = 1)
SELECT a.user_id, a.day, a.event_id, a.value, b.event_id AS event_id_next, b.value AS label
FROM f a JOIN f b ON a.user_id = b.user_id AND b.day = a.day + INTERVAL 1 DAY"""


def q_label_shift_15min(spark, d):
    ev = events(spark, d).withColumn("minute", T.minute_bin("ts")).select(
        "user_id", "minute", "ts", "event_id", "value")
    first = D.first_by_key(ev, ["user_id", "minute"], ["ts", "event_id"])
    lab = J.shift_self_join(first, ["user_id"], "minute", 900, ["value", "event_id"], suffix="_15min")
    return lab.select("user_id", ntz("minute").alias("minute"), "event_id", "value",
                      "event_id_15min", "value_15min")


O_LABEL_SHIFT_15MIN = f"""
WITH f AS (SELECT user_id, minute, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, minute ORDER BY ts, event_id) rn
  FROM (SELECT *, {sql_bucket('ts', 60, 'half_even')} AS minute FROM events)) WHERE rn = 1)
SELECT a.user_id, a.minute, a.event_id, a.value, b.event_id AS event_id_15min, b.value AS value_15min
FROM f a JOIN f b ON a.user_id = b.user_id AND b.minute = a.minute + INTERVAL 15 MINUTE"""


def q_next_stop_lookup(spark, d):
    ev = events(spark, d)
    left = ev.select("event_id", "user_id",
                     T.minus_delay(T.shift("ts", 900), "value").alias("threshold"))
    purchases = ev.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id", "value")
    out = J.asof_next(left, purchases, ["user_id"], "threshold", "ts", ["event_id", "value"],
                      tiebreak=["event_id"], prefix="next_")
    return out.select("event_id", "user_id", ntz("threshold").alias("threshold"),
                      ntz("next_ts").alias("next_ts"), "next_event_id", "next_value")


O_NEXT_STOP_LOOKUP = """
WITH l AS (SELECT event_id, user_id,
                  make_timestamp(epoch_us(ts) + 900000000 - CAST(round(value * 1000000) AS BIGINT)) AS threshold
           FROM events),
p AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase')
SELECT event_id, user_id, threshold, next_ts, next_event_id, next_value FROM (
  SELECT l.event_id, l.user_id, l.threshold, p.ts AS next_ts, p.event_id AS next_event_id,
         p.value AS next_value,
         row_number() OVER (PARTITION BY l.event_id ORDER BY p.ts, p.event_id) rn
  FROM l LEFT JOIN p ON p.user_id = l.user_id AND p.ts >= l.threshold) WHERE rn = 1"""


def q_dim_join(spark, d):
    """Fact x two dimensions, then revenue per (type, nation).

    Eager aggregation: the fact is first reduced to one row per (part,
    supplier) pair (map-side combined), so the dimension joins - shuffle
    joins once the dimensions outgrow the broadcast check - move pair
    totals, not line items."""
    li = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_extendedprice").alias("_rev"), F.count(F.lit(1)).alias("_n"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    supp = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    j = J.join_dimension(J.join_dimension(li, part, "l_partkey"), supp, "l_suppkey")
    return j.groupBy("p_type", "s_nationkey").agg(
        F.round(F.sum("_rev"), 2).alias("revenue"), F.sum("_n").alias("n_lines"))


O_DIM_JOIN = """
SELECT p.p_type, s.s_nationkey, round(sum(l.l_extendedprice), 2) AS revenue, count(*) AS n_lines
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY p.p_type, s.s_nationkey"""


def q_obs_forecast_corr(spark, d):
    ev = events(spark, d).withColumn("hb", T.hour_bin("ts")).withColumn(
        "k", C.to_number(F.get_json_object("props", "$.k")))
    obs = ev.where(F.col("event_type") == "view").select("hb", "ts", "event_id", "value", "k", "user_id",
                                                         F.col("props").alias("obs_cat"))
    fc = ev.where(F.col("event_type") == "error").select(
        "hb", "ts", "event_id", F.col("value").alias("fc_value"), F.col("k").alias("fc_k"),
        F.col("user_id").alias("fc_user"), F.col("props").alias("fc_cat"))
    fc1 = D.latest_by_key(fc, ["hb"], ["ts", "event_id"]).drop("ts", "event_id")
    j = obs.join(J.sized_broadcast(fc1), "hb", "inner")
    j = A.factorize(j, "obs_cat", ["ts", "event_id"], "obs_code")
    j = A.factorize(j, "fc_cat", ["ts", "event_id"], "fc_code")
    return A.factor_table(j, {"summary": ("obs_code", "fc_code"), "temperature": ("value", "fc_value"),
                              "cloud coverage": ("k", "fc_k"), "wind speed": ("user_id", "fc_user")})


O_OBS_FORECAST_CORR = f"""
WITH e AS (SELECT *, {SQL_HOUR_EVEN} AS hb,
                  TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
obs AS (SELECT hb, ts, event_id, value, k, user_id, props AS obs_cat FROM e WHERE event_type = 'view'),
fc AS (SELECT hb, value AS fc_value, k AS fc_k, user_id AS fc_user, props AS fc_cat FROM (
         SELECT *, row_number() OVER (PARTITION BY hb ORDER BY ts DESC, event_id DESC) rn
         FROM e WHERE event_type = 'error') WHERE rn = 1),
j AS (SELECT * FROM obs JOIN fc USING (hb)),
fo AS (SELECT obs_cat, dense_rank() OVER (ORDER BY fts, fid, obs_cat) - 1 AS obs_code FROM (
         SELECT obs_cat, ts AS fts, event_id AS fid, row_number() OVER (PARTITION BY obs_cat ORDER BY ts, event_id) rn
         FROM j) WHERE rn = 1),
ff AS (SELECT fc_cat, dense_rank() OVER (ORDER BY fts, fid, fc_cat) - 1 AS fc_code FROM (
         SELECT fc_cat, ts AS fts, event_id AS fid, row_number() OVER (PARTITION BY fc_cat ORDER BY ts, event_id) rn
         FROM j) WHERE rn = 1),
x AS (SELECT j.*, fo.obs_code, ff.fc_code FROM j JOIN fo USING (obs_cat) JOIN ff USING (fc_cat)),
c AS (SELECT round(corr(obs_code, fc_code), 6) AS c0, round(corr(value, fc_value), 6) AS c1,
             round(corr(k, fc_k), 6) AS c2, round(corr(user_id, fc_user), 6) AS c3 FROM x)
SELECT 'summary' AS factor, c0 AS correlation FROM c UNION ALL
SELECT 'temperature', c1 FROM c UNION ALL
SELECT 'cloud coverage', c2 FROM c UNION ALL
SELECT 'wind speed', c3 FROM c"""


# ---------------------------------------------------------------- A: aggregates

def q_avg_by_route(spark, d):
    ev = events(spark, d).withColumn("route", F.col("user_id").cast("string"))
    avg = A.mean_by(ev, ["route"], "value", "avg_delay", digits=DIGITS)
    return D.sort_by(avg.withColumn("route_class", C.route_class("route")), ["avg_delay"])


O_AVG_BY_ROUTE = """
SELECT CAST(user_id AS VARCHAR) AS route, round(avg(value), 6) AS avg_delay,
       CASE WHEN contains(CAST(user_id AS VARCHAR), 'N') THEN 'night'
            WHEN length(CAST(user_id AS VARCHAR)) <= 2 THEN 'short' ELSE 'regular' END AS route_class
FROM events WHERE user_id IS NOT NULL GROUP BY user_id ORDER BY avg_delay"""


def q_avg_by_hour(spark, d):
    ev = events(spark, d)
    return A.mean_by(ev, [F.hour("ts").alias("hour")], "value", "avg_delay", digits=DIGITS)


O_AVG_BY_HOUR = """
SELECT CAST(hour(ts) AS INTEGER) AS hour, round(avg(value), 6) AS avg_delay FROM events
WHERE ts IS NOT NULL GROUP BY hour(ts)"""


def _grid(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(C.round_coord(F.col("l_extendedprice") / 10000.0).alias("lat"),
                     C.round_coord(F.col("l_quantity") / 7.0).alias("lon"),
                     "l_discount", "l_tax")


def q_grid_avg(spark, d):
    g = _grid(spark, d)
    return g.groupBy("lat", "lon").agg(r6(F.avg("l_discount")).alias("avg_discount"),
                                       r6(F.avg("l_tax")).alias("avg_tax"),
                                       F.count(F.lit(1)).alias("n"))


O_GRID_AVG = """
SELECT lat, lon, round(avg(l_discount), 6) AS avg_discount, round(avg(l_tax), 6) AS avg_tax, count(*) AS n
FROM (SELECT round(l_extendedprice / 10000.0, 2) AS lat, round(l_quantity / 7.0, 2) AS lon,
             l_discount, l_tax FROM lineitem)
GROUP BY lat, lon"""


def q_grid_pivot(spark, d):
    ev = events(spark, d).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return A.pivot_mean(ev, "day", "event_type", "value", digits=DIGITS)


O_GRID_PIVOT = "SELECT strftime(ts, '%Y-%m-%d') AS day, " + ", ".join(
    f"round(avg(value) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in EVENT_TYPES
) + " FROM events GROUP BY strftime(ts, '%Y-%m-%d')"


def q_hist_linear(spark, d):
    ev = events(spark, d)
    return A.histogram(ev, "value", 5).unionByName(A.histogram(ev, "value", 50))


def _sql_hist(src: str, col: str, n: int) -> str:
    return f"""(WITH s AS (SELECT {col} AS x FROM {src} WHERE {col} IS NOT NULL AND NOT isnan({col})),
  mm AS (SELECT min(x) AS lo0, max(x) AS hi0 FROM s),
  b AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
               CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM mm),
  c AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * {n}), {n - 1}) AS INTEGER) AS bin, count(*) AS cnt
        FROM s, b GROUP BY 1),
  sp AS (SELECT CAST(range AS INTEGER) AS bin FROM range({n}))
  SELECT {n} AS n_bins, sp.bin, round(lo + (hi - lo) * sp.bin / {n}, 6) AS bin_lo,
         round(lo + (hi - lo) * (sp.bin + 1) / {n}, 6) AS bin_hi, CAST(coalesce(cnt, 0) AS BIGINT) AS cnt
  FROM sp CROSS JOIN b LEFT JOIN c ON sp.bin = c.bin)"""


O_HIST_LINEAR = f"SELECT * FROM {_sql_hist('events', 'value', 5)} UNION ALL SELECT * FROM {_sql_hist('events', 'value', 50)}"


def q_hist_log(spark, d):
    o = table(spark, d, "orders")
    return A.log_histogram(o, "o_totalprice", 29, 0.0, 6.0)


O_HIST_LOG = """
WITH s AS (SELECT o_totalprice AS x FROM orders WHERE o_totalprice >= 1.0 AND o_totalprice <= 1000000.0),
c AS (SELECT CAST(least(floor((log10(x) - 0.0) / (6.0 - 0.0) * 29), 28) AS INTEGER) AS bin, count(*) AS cnt
      FROM s GROUP BY 1),
sp AS (SELECT CAST(range AS INTEGER) AS bin FROM range(29))
SELECT 29 AS n_bins, sp.bin, round(pow(10.0, 0.0 + (6.0 - 0.0) * sp.bin / 29), 6) AS bin_lo,
       round(pow(10.0, 0.0 + (6.0 - 0.0) * (sp.bin + 1) / 29), 6) AS bin_hi,
       CAST(coalesce(cnt, 0) AS BIGINT) AS cnt
FROM sp LEFT JOIN c ON sp.bin = c.bin"""


def q_hist_recent(spark, d):
    ev = events(spark, d)
    return A.histogram(FL.recent(ev, "ts", 5 * 3600), "value", 5)


O_HIST_RECENT = "SELECT * FROM " + _sql_hist(
    "(SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 5 HOUR)", "value", 5)


def q_box_summary(spark, d):
    ev = events(spark, d)
    return A.box_summary(ev, ["event_type"], "value")


O_BOX_SUMMARY = """
WITH s AS (SELECT event_type, value AS v FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
q AS (SELECT event_type, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM s GROUP BY event_type),
f AS (SELECT event_type, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
w AS (SELECT s.event_type, min(v) FILTER (WHERE v >= lo AND v <= hi) AS whisker_lo,
             max(v) FILTER (WHERE v >= lo AND v <= hi) AS whisker_hi,
             CAST(sum(CASE WHEN v >= lo AND v <= hi THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
      FROM s JOIN f USING (event_type) GROUP BY s.event_type)
SELECT q.event_type, q.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(whisker_lo, 6) AS whisker_lo, round(whisker_hi, 6) AS whisker_hi, n_outliers
FROM q JOIN w USING (event_type)"""


def q_factorize(spark, d):
    ev = events(spark, d).select("event_id", "event_type", "ts")
    out = A.factorize(ev, "event_type", ["ts", "event_id"], "event_type_code")
    return out.select("event_id", "event_type", "event_type_code")


O_FACTORIZE = """
WITH f AS (SELECT event_type, ts AS fts, event_id AS fid FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) rn
  FROM events WHERE event_type IS NOT NULL) WHERE rn = 1),
c AS (SELECT event_type, dense_rank() OVER (ORDER BY fts, fid, event_type) - 1 AS code FROM f)
SELECT e.event_id, e.event_type, CAST(coalesce(c.code, -1) AS BIGINT) AS event_type_code
FROM events e LEFT JOIN c USING (event_type)"""


def q_one_hot(spark, d):
    ev = events(spark, d)
    return ev.select("event_id", *C.one_hot_columns("event_type", A.categories(ev, "event_type"), prefix="event_type"))


O_ONE_HOT = "SELECT event_id, " + ", ".join(
    f"CAST(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END AS INTEGER) AS event_type_{t}" for t in EVENT_TYPES
) + " FROM events"


def q_recent_track(spark, d):
    """Q8: recent points (last day of the route's own data) of one route,
    vehicle-coded by first appearance, with the route's bounding box."""
    ev = events(spark, d).withColumn("k", C.to_number(F.get_json_object("props", "$.k")))
    route = FL.equals(ev, "user_id", ROUTE_USER)
    pts = FL.recent(route, "ts", 86_400)
    pts = A.factorize(pts, "event_type", ["ts", "event_id"], "vehicle_code")
    box = route.select(F.struct(*A.bounding_box(route, ["value", "k"]))).scalar()   # one subquery
    lo_v, hi_v, lo_k, hi_k = [box[c] for c in ["min_value", "max_value", "min_k", "max_k"]]
    return pts.select("event_id", ntz("ts").alias("ts"), "value", "k", "vehicle_code",
                      lo_v.alias("min_value"), hi_v.alias("max_value"),
                      lo_k.alias("min_k"), hi_k.alias("max_k"))


O_RECENT_TRACK = f"""
WITH r AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events
           WHERE user_id = {ROUTE_USER}),
p AS (SELECT * FROM r WHERE ts >= (SELECT max(ts) FROM r) - INTERVAL 1 DAY),
f AS (SELECT event_type, ts AS fts, event_id AS fid FROM (
       SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) rn FROM p) WHERE rn = 1),
c AS (SELECT event_type, dense_rank() OVER (ORDER BY fts, fid, event_type) - 1 AS code FROM f)
SELECT p.event_id, p.ts, p.value, p.k, CAST(coalesce(c.code, -1) AS BIGINT) AS vehicle_code,
       (SELECT min(value) FROM r) AS min_value, (SELECT max(value) FROM r) AS max_value,
       (SELECT min(k) FROM r) AS min_k, (SELECT max(k) FROM r) AS max_k
FROM p LEFT JOIN c USING (event_type)"""


def q_route_track(spark, d):
    """Q9: the whole track of one route in time order."""
    ev = events(spark, d)
    route = FL.equals(ev, "user_id", ROUTE_USER).select("event_id", "ts", "value")
    return D.sort_by(route, ["ts", "event_id"]).select("event_id", ntz("ts").alias("ts"), "value")


O_ROUTE_TRACK = f"SELECT event_id, ts, value FROM events WHERE user_id = {ROUTE_USER} ORDER BY ts, event_id"


def q_distinct_routes(spark, d):
    return A.distinct_values(events(spark, d), "user_id")


O_DISTINCT_ROUTES = "SELECT DISTINCT user_id FROM events"


# ---------------------------------------------------------------- model (rows-only check)

def q_model_score(spark, d):
    """M6-M8 + A12: day-ahead label (J4 on the first event of each user-day),
    features from the same row (value, k, minutes to midnight, hour, type),
    random forest 100 trees / depth 1 fitted on 67 %, held-out 33 % scored.
    Iterative fit: no SQL form (rows-only check)."""
    from . import model as ML
    ev = events(spark, d).withColumn("day", T.time_bucket("ts", 86_400, "floor")).withColumn(
        "k", C.to_number(F.get_json_object("props", "$.k")))
    ev = ev.select("user_id", "day", "ts", "event_id", "value", "k", "event_type")
    first = D.first_by_key(ev, ["user_id", "day"], ["ts", "event_id"])
    lab = J.shift_self_join(first, ["user_id"], "day", 86_400, ["value"], suffix="_next")
    feats = lab.select("user_id", "day", "value", "k", "event_type",
                       T.minutes_to_nearest_midnight("ts").cast("double").alias("time"),
                       F.hour("ts").cast("double").alias("hour"),
                       F.col("value_next").alias("delay_15min"))
    # the fit scans its input once per stage and tree level: keep the
    # (small, per user-day) feature frame as a table instead of re-running
    # the dedup + self join each time
    feats = S.durable(feats, "model_score")
    model, pred, r2 = ML.train(feats, ["value", "k", "time", "hour"], ["event_type"], keys=["user_id", "day"])
    return pred.select("user_id", ntz("day").alias("day"), "delay_15min", "prediction",
                       F.lit(r2).alias("r2"))


def q_stump_forest(spark, d):
    """M6-M8 + A12: the day-ahead label and features of ``model_score``, the model as a table (100 trees of depth 1,
    ``plans.stumps``) fitted on 67 %, the other 33 % scored. Exact sums, so SQL has the same trees."""
    from . import stumps as ST
    ev = events(spark, d).withColumn("day", T.time_bucket("ts", 86_400, "floor")).withColumn(
        "k", C.to_number(F.get_json_object("props", "$.k")))
    first = D.first_by_key(ev.select("user_id", "day", "ts", "event_id", "value", "k", "event_type"),
                           ["user_id", "day"], ["ts", "event_id"])
    lab = J.shift_self_join(first, ["user_id"], "day", 86_400, ["value"], suffix="_next")
    rows = S.durable(lab.where(F.col("value_next").isNotNull()), "stump_rows")        # read by every pass of the fit
    features = {"value": F.col("value"), "k": F.col("k"), "time": T.minutes_to_nearest_midnight("ts"),
                "hour": F.hour("ts"), **{f"type_{t}": F.when(F.col("event_type") == t, 1).otherwise(0) for t in EVENT_TYPES}}
    key = F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("day", "yyyy-MM-dd"))
    tr, te = ST.split_by_key(rows, key)
    trees = S.durable(ST.fit(tr, features, F.col("value_next"), key), "stumps")
    pred = ST.predict(te, features, trees)
    r2 = pred.agg(ST.r2(F.col("value_next"), F.col("prediction")).alias("r2")).scalar()
    return pred.select("user_id", ntz("day").alias("day"), r6("value_next").alias("label"),
                       r6("prediction").alias("prediction"), F.round(r2, DIGITS).alias("r2"))


_TYPE_COLS = ", ".join(f"CASE WHEN a.event_type = '{t}' THEN 1 ELSE 0 END::DOUBLE AS type_{t}" for t in EVENT_TYPES)
_STUMP_FEATURES = ["value", "k", "time", "hour"] + [f"type_{t}" for t in EVENT_TYPES]
O_STUMP_FOREST = f"""
WITH f AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) rn
  FROM (SELECT *, date_trunc('day', ts) AS day FROM events)) WHERE rn = 1),
rows_ AS (SELECT a.user_id, a.day, b.value AS y, a.value::DOUBLE AS value,
    TRY_CAST(json_extract_string(a.props, '$.k') AS DOUBLE) AS k,
    least((((86400000000 - epoch_us(a.ts) % 86400000000) // 1000000) % 86400) // 60,
          (epoch_us(a.ts) % 86400000000) // 60000000)::DOUBLE AS time, hour(a.ts)::DOUBLE AS hour, {_TYPE_COLS},
    md5(concat_ws('|', a.user_id::VARCHAR, strftime(a.day, '%Y-%m-%d'))) AS h
  FROM f a JOIN f b ON a.user_id = b.user_id AND b.day = a.day + INTERVAL 1 DAY WHERE b.value IS NOT NULL),
tr AS (SELECT * FROM rows_ WHERE ('0x' || substr(h, 1, 8))::BIGINT % 100 < 67),
te AS (SELECT row_number() OVER () AS r, * FROM rows_ WHERE ('0x' || substr(h, 1, 8))::BIGINT % 100 >= 67),
names AS (SELECT unnest([{", ".join(f"'{f}'" for f in _STUMP_FEATURES)}]) AS feature),
melted AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, round(y * 1000000)::HUGEINT AS y, ('0x' || substr(h, 9, 4))::BIGINT % 64 AS block FROM tr" for f in _STUMP_FEATURES)}),
q AS (SELECT feature, quantile_cont(x, [{", ".join(f"{i}/32.0" for i in range(1, 32))}]) AS qs FROM melted WHERE x IS NOT NULL GROUP BY feature),
cuts AS (SELECT feature, round(qs[16], 6) AS median, list_sort(list_distinct(list_transform(qs, lambda v: round(v, 6)))) AS cuts FROM q),
sums AS (SELECT feature, coalesce(len(list_filter(cuts, lambda c: c < coalesce(x, median))), 0) AS cell, block,
    count(*) AS n, sum(y) AS s FROM melted LEFT JOIN cuts USING (feature) GROUP BY ALL),
looked AS (SELECT tree, feature FROM (SELECT tree, feature, row_number() OVER (PARTITION BY tree ORDER BY md5(tree || ':' || feature)) AS place
  FROM range(100) t(tree), names) WHERE place <= 3),
luck AS (SELECT tree, block, ('0x' || substr(md5(tree || '#' || block), 1, 4))::BIGINT AS l FROM range(100) t(tree), range(64) b(block)),
drawn AS (SELECT tree, block, (l >= 24109)::INT + (l >= 48218)::INT + (l >= 60273)::INT + (l >= 64291)::INT + (l >= 65296)::INT AS w FROM luck),
per AS (SELECT tree, feature, cell, sum(w * n) AS n, sum(w * s) AS s FROM looked JOIN drawn USING (tree) JOIN sums USING (feature, block)
  WHERE w > 0 GROUP BY ALL),
run AS (SELECT *, sum(n) OVER u AS nl, sum(s) OVER u AS sl, sum(n) OVER w AS nt, sum(s) OVER w AS st FROM per
  WINDOW w AS (PARTITION BY tree, feature), u AS (PARTITION BY tree, feature ORDER BY cell ROWS UNBOUNDED PRECEDING)),
cand AS (SELECT tree, feature, cuts[cell + 1] AS cut, median, nl, nt - nl AS nr, sl::DOUBLE AS sl, (st - sl)::DOUBLE AS sr
  FROM run JOIN cuts USING (feature) WHERE cuts[cell + 1] IS NOT NULL AND nt > nl),
best AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY sl * sl / nl + sr * sr / nr DESC, feature, cut) AS place FROM cand),
trees AS (SELECT a.tree, b.feature, b.cut, coalesce(b.median <= b.cut, true) AS null_left,
    coalesce(b.sl / b.nl / 1000000, a.mean) AS l, coalesce(b.sr / b.nr / 1000000, a.mean) AS r
  FROM (SELECT tree, max(st::DOUBLE / nt / 1000000) AS mean FROM run GROUP BY tree) a
  LEFT JOIN (SELECT * FROM best WHERE place = 1) b USING (tree)),
asked AS ({" UNION ALL ".join(f"SELECT r, '{f}' AS feature, {f} AS x FROM te" for f in _STUMP_FEATURES)}),
answers AS (SELECT te.r, avg(CASE WHEN coalesce(asked.x <= cut, null_left) THEN trees.l ELSE trees.r END) AS p
  FROM te CROSS JOIN trees LEFT JOIN asked ON asked.r = te.r AND asked.feature = trees.feature GROUP BY te.r),
scored AS (SELECT te.*, p FROM te LEFT JOIN answers USING (r))
SELECT user_id, day, round(y, 6) AS label, round(p, 6) AS prediction,
  (SELECT round(1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(y)), 6) FROM scored) AS r2 FROM scored"""


# ---------------------------------------------------------------- streaming

def q_stream_enrich(spark, d):
    """The enrichment as a stream (file source, availableNow),
    written by an idempotent foreachBatch sink and read back. Output: clicks
    whose bucket the final watermark has closed, with the latest error/view."""
    from ..streaming import jobs
    out = jobs.run_to_table(jobs.enrich_events_stream(spark, d), "stream_enrich")
    return out.select("event_id", ntz("bucket").alias("bucket"), "value", "err_event_id", "err_value",
                      "view_event_id", "view_value")


O_STREAM_ENRICH = O_ENRICH_HOUR_LATEST.replace(
    "WHERE c.event_type = 'click'",
    """WHERE c.event_type = 'click' AND c.bucket < (SELECT min(mb) FROM (
        SELECT max(bucket) AS mb FROM b WHERE event_type IN ('click', 'error', 'view') GROUP BY event_type))""")


def q_stream_replay(spark, d):
    """The events as they are stored, in any order, fed to the enrichment in four slices of time and a
    closing one: every click, with the latest error and view of its bucket."""
    from ..streaming import jobs
    out = jobs.replay_enrich_events(events(spark, d), S.shared_dir(spark, "stream_replay"), slices=4)
    return out.select("event_id", ntz("bucket").alias("bucket"), "value", "err_event_id", "err_value",
                      "view_event_id", "view_value")


def q_stream_dedup(spark, d):
    from ..streaming import jobs
    out = jobs.run_to_table(jobs.dedup_events_stream(spark, d), "stream_dedup")
    return out.select("event_id", "user_id", ntz("ts").alias("ts"), "value")


O_STREAM_DEDUP = "SELECT DISTINCT event_id, user_id, ts, value FROM events"


# ---------------------------------------------------------------- flagship

def flagship(spark, d):
    """events props JSON -> typed -> next-hour bucket -> latest error/view per
    bucket left-joined to clicks -> average by route with class."""
    ev = events(spark, d)
    parsed = P.parse_json(ev, "props", StructType([StructField("k", StringType(), True)]),
                          keep=["event_id", "user_id", "event_type", "ts", "value"], corrupt_col=None)
    typed = parsed.withColumn("k", C.to_number("k", "int")).withColumn("bucket", T.next_hour_bucket("ts"))
    left = typed.where(F.col("event_type") == "click").select("event_id", "user_id", "bucket", "value", "k")
    right = typed.where(F.col("event_type").isin("error", "view"))
    j = J.bucket_enrich_multi(left, right, "bucket", "bucket", _weather_like(typed, ["value"]))
    j = j.withColumn("route", F.col("user_id").cast("string"))
    out = j.groupBy("route").agg(
        F.count(F.lit(1)).alias("n_clicks"),
        r6(F.avg("value")).alias("avg_delay"),
        r6(F.avg("err_value")).alias("avg_err_value"),
        r6(F.avg("view_value")).alias("avg_view_value"),
        r6(F.avg("k")).alias("avg_k"))
    return out.withColumn("route_class", C.route_class("route"))


O_FLAGSHIP = f"""
WITH b AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                  {SQL_NEXT_HOUR} AS bucket FROM events),
j AS (SELECT c.user_id, c.value, c.k, e.err_value, v.view_value
      FROM b c LEFT JOIN {_sql_latest('error', 'err_')} e ON c.bucket = e.bucket
               LEFT JOIN {_sql_latest('view', 'view_')} v ON c.bucket = v.bucket
      WHERE c.event_type = 'click')
SELECT CAST(user_id AS VARCHAR) AS route, count(*) AS n_clicks, round(avg(value), 6) AS avg_delay,
       round(avg(err_value), 6) AS avg_err_value, round(avg(view_value), 6) AS avg_view_value,
       round(avg(k), 6) AS avg_k,
       CASE WHEN contains(CAST(user_id AS VARCHAR), 'N') THEN 'night'
            WHEN length(CAST(user_id AS VARCHAR)) <= 2 THEN 'short'
            WHEN user_id IS NOT NULL THEN 'regular' END AS route_class
FROM j GROUP BY user_id"""


# ---------------------------------------------------------------- registry

QUERIES = {
    "flagship_route_delay": flagship,
    "json_flatten": q_json_flatten,
    "rejected_messages": q_rejected_messages,
    "route_box": q_route_box,
    "nested_explode": q_nested_explode,
    "explode_outer_first": q_explode_outer_first,
    "recode_and_class": q_recode_and_class,
    "weekday_time_parse": q_weekday_time_parse,
    "bucket_next_hour": q_bucket_next_hour,
    "bucket_10min_even": q_bucket_10min_even,
    "midnight_features": q_midnight_features,
    "lookback_hour": q_lookback_hour,
    "lookback_day": q_lookback_day,
    "key_range_scan": q_key_range_scan,
    "epoch_key_decode": q_epoch_key_decode,
    "column_families": q_column_families,
    "name_pattern_check": q_name_pattern_check,
    "recent_5h": q_recent_5h,
    "any_null_drop": q_any_null_drop,
    "union_feeds": q_union_feeds,
    "dedup_rows": q_dedup_rows,
    "dedup_first": q_dedup_first,
    "keyed_upsert": q_keyed_upsert,
    "keyed_merge": q_keyed_merge,
    "stream_upsert": q_stream_upsert,
    "stream_rejects": q_stream_rejects,
    "constant_corr": q_constant_corr,
    "partial_key_range": q_partial_key_range,
    "clustered_key_range": q_clustered_key_range,
    "latest_overall": q_latest_overall,
    "latest_by_key": q_latest_by_key,
    "enrich_hour_latest": q_enrich_hour_latest,
    "enrich_hour_mean": q_enrich_hour_mean,
    "label_shift_day": q_label_shift_day,
    "label_shift_15min": q_label_shift_15min,
    "next_stop_lookup": q_next_stop_lookup,
    "dim_join": q_dim_join,
    "obs_forecast_corr": q_obs_forecast_corr,
    "avg_by_route": q_avg_by_route,
    "avg_by_hour": q_avg_by_hour,
    "grid_avg": q_grid_avg,
    "grid_pivot": q_grid_pivot,
    "hist_linear": q_hist_linear,
    "hist_log": q_hist_log,
    "hist_recent": q_hist_recent,
    "box_summary": q_box_summary,
    "factorize": q_factorize,
    "one_hot": q_one_hot,
    "recent_track": q_recent_track,
    "route_track": q_route_track,
    "distinct_routes": q_distinct_routes,
    "stream_enrich": q_stream_enrich,
    "stream_replay": q_stream_replay,
    "stream_dedup": q_stream_dedup,
    "model_score": q_model_score,
    "stump_forest": q_stump_forest,
}

ORACLES = {
    "flagship_route_delay": O_FLAGSHIP,
    "json_flatten": O_JSON_FLATTEN,
    "rejected_messages": O_REJECTED_MESSAGES,
    "route_box": O_ROUTE_BOX,
    "nested_explode": O_NESTED_EXPLODE,
    "explode_outer_first": O_EXPLODE_OUTER_FIRST,
    "recode_and_class": O_RECODE_AND_CLASS,
    "weekday_time_parse": O_WEEKDAY_TIME_PARSE,
    "bucket_next_hour": O_BUCKET_NEXT_HOUR,
    "bucket_10min_even": O_BUCKET_10MIN_EVEN,
    "midnight_features": O_MIDNIGHT_FEATURES,
    "lookback_hour": O_LOOKBACK_HOUR,
    "lookback_day": O_LOOKBACK_DAY,
    "key_range_scan": O_KEY_RANGE_SCAN,
    "epoch_key_decode": O_EPOCH_KEY_DECODE,
    "column_families": O_COLUMN_FAMILIES,
    "name_pattern_check": O_NAME_PATTERN_CHECK,
    "recent_5h": O_RECENT_5H,
    "any_null_drop": O_ANY_NULL_DROP,
    "union_feeds": O_UNION_FEEDS,
    "dedup_rows": O_DEDUP_ROWS,
    "dedup_first": O_DEDUP_FIRST,
    "keyed_upsert": O_KEYED_UPSERT,
    "keyed_merge": O_KEYED_UPSERT,
    "stream_upsert": O_KEYED_UPSERT,
    "stream_rejects": O_STREAM_REJECTS,
    "constant_corr": O_CONSTANT_CORR,
    "partial_key_range": O_PARTIAL_KEY_RANGE,
    "clustered_key_range": O_CLUSTERED_KEY_RANGE,
    "latest_overall": O_LATEST_OVERALL,
    "latest_by_key": O_LATEST_BY_KEY,
    "enrich_hour_latest": O_ENRICH_HOUR_LATEST,
    "enrich_hour_mean": O_ENRICH_HOUR_MEAN,
    "label_shift_day": O_LABEL_SHIFT_DAY,
    "stump_forest": O_STUMP_FOREST,
    "label_shift_15min": O_LABEL_SHIFT_15MIN,
    "next_stop_lookup": O_NEXT_STOP_LOOKUP,
    "dim_join": O_DIM_JOIN,
    "obs_forecast_corr": O_OBS_FORECAST_CORR,
    "avg_by_route": O_AVG_BY_ROUTE,
    "avg_by_hour": O_AVG_BY_HOUR,
    "grid_avg": O_GRID_AVG,
    "grid_pivot": O_GRID_PIVOT,
    "hist_linear": O_HIST_LINEAR,
    "hist_log": O_HIST_LOG,
    "hist_recent": O_HIST_RECENT,
    "box_summary": O_BOX_SUMMARY,
    "factorize": O_FACTORIZE,
    "one_hot": O_ONE_HOT,
    "recent_track": O_RECENT_TRACK,
    "route_track": O_ROUTE_TRACK,
    "distinct_routes": O_DISTINCT_ROUTES,
    "stream_enrich": O_STREAM_ENRICH,
    "stream_replay": O_ENRICH_HOUR_LATEST,
    "stream_dedup": O_STREAM_DEDUP,
}
