"""Queries over the sample tables, each with the SQL that must give the same rows.

The tables hold no NULLs and few placeholders, so `dirty_customer` derives some from the key, the same way on both
sides. Queries that write tables do so in a new scratch folder per call.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.functions.dates import business_date, load_stamp
from siltgate.functions.rules import Blank, CodeLength, Rule, SpecialChar, scrub, special_chars
from siltgate.operators.difference import key_difference, multiset_difference
from siltgate.operators.latest import key_cast_sort, latest_per_key, preview
from siltgate.operators.merge import append, measure_keys, scd1_bucketed, scd1_touched, scd1_window
from siltgate.operators.split import REASONS, special_char_split, split, split_counts
from siltgate.plans.contracts import Contract, declared_contract
from siltgate.plans.daily import Layout, read_loaded, run_load
from siltgate.sources.feed import as_text, scan_csv
from siltgate.sources.quarantine import read_quarantine, write_quarantine
from siltgate.sources.snapshot import (
    latest_prior_date,
    read_bucketed,
    read_history,
    read_snapshot,
    write_snapshot,
)
from siltgate.sources.storage import join_path, read_text, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name or query.__name__] = query
        SQL[name or query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- inputs -------------------------------------------------------------------------------------------------------


def _segment(key: Column, segment: Column) -> Column:
    return (
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 11 == 0, F.lit("-1"))
        .when(key % 13 == 0, F.lit(""))
        .when(key % 17 == 0, F.lit("\\N"))
        .when(key % 19 == 0, F.lit("none"))
        .otherwise(segment)
    )


def dirty_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with NULLs, placeholders, special characters and codes of two lengths."""
    key, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        key,
        F.when(key % 23 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 0, F.replace(name, F.lit("#"), F.lit("")))
        .otherwise(name)
        .alias("nm"),
        _segment(key, segment).alias("seg"),
        F.left(segment, F.when(key % 3 == 0, F.lit(3)).otherwise(F.lit(2))).alias("code2"),
    )


DIRTY_SQL = r"""
dirty AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN replace(c_name, '#', '')
              ELSE c_name END AS nm,
         CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '-1' WHEN c_custkey % 13 = 0 THEN ''
              WHEN c_custkey % 17 = 0 THEN '\N' WHEN c_custkey % 19 = 0 THEN 'none'
              ELSE c_mktsegment END AS seg,
         left(c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 2 END) AS code2
  FROM customer)
"""
STAMP = "2024-01-01 06:00:00"
STAMP_SQL = f"TIMESTAMP '{STAMP}'"
SPECIAL_SQL = r"coalesce(regexp_extract({0}, '([^A-Za-z0-9|*\s])', 1), '')"
BLANK_SQL = "(seg IS NULL OR seg IN ('', '-1'))"
LENGTH_SQL = "coalesce(length(code2) = 2, false)"


def stamp(text: str = STAMP) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _split(spark: SparkSession, sf_dir: str, *rules: Rule) -> tuple[DataFrame, DataFrame]:
    return split(dirty_customer(spark, sf_dir), rules, stamp())


SPECIAL = SpecialChar(("nm", "seg"))
BLANK = Blank(("seg",))
LENGTH = CodeLength({"code2": 2})


# ---- quality ------------------------------------------------------------------------------------------------------


@register(
    f"WITH {DIRTY_SQL} SELECT *, {STAMP_SQL} AS time_stamp FROM dirty"
    f" WHERE {SPECIAL_SQL.format('nm')} || {SPECIAL_SQL.format('seg')} = ''"
)
def special_char_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return special_char_split(dirty_customer(spark, sf_dir), ["nm", "seg"], stamp())[0]


@register(
    f"WITH {DIRTY_SQL} SELECT * FROM dirty"
    f" WHERE {SPECIAL_SQL.format('nm')} <> '' OR {SPECIAL_SQL.format('seg')} <> ''"
)
def special_char_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return special_char_split(dirty_customer(spark, sf_dir), ["nm", "seg"], stamp())[1].drop("special_char")


@register(
    f"WITH {DIRTY_SQL} SELECT * FROM ("
    f" SELECT *, {SPECIAL_SQL.format('nm')} || {SPECIAL_SQL.format('seg')} AS special_char FROM dirty)"
    " WHERE special_char <> ''"
)
def special_char_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return special_char_split(dirty_customer(spark, sf_dir), ["nm", "seg"], stamp())[1]


@register(
    f"SELECT doc_id, {SPECIAL_SQL.format('text')} || {SPECIAL_SQL.format('lang')} || {SPECIAL_SQL.format('source')}"
    " AS special_char FROM documents"
)
def special_char_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule on prose: whole texts of many lengths and languages."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", special_chars(["text", "lang", "source"]).alias("special_char")
    )


@register(f"WITH {DIRTY_SQL} SELECT *, {STAMP_SQL} AS time_stamp FROM dirty WHERE NOT {BLANK_SQL}")
def blank_reject_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, BLANK)[0]


@register(f"WITH {DIRTY_SQL} SELECT *, 'blank:seg' AS reject_reasons FROM dirty WHERE {BLANK_SQL}")
def blank_reject_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_split(spark, sf_dir, BLANK)[1])


@register(f"WITH {DIRTY_SQL} SELECT *, {STAMP_SQL} AS time_stamp FROM dirty WHERE {LENGTH_SQL}")
def code_length_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, LENGTH)[0]


@register(f"WITH {DIRTY_SQL} SELECT *, 'code_length:code2' AS reject_reasons FROM dirty WHERE NOT {LENGTH_SQL}")
def code_length_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_split(spark, sf_dir, LENGTH)[1])


ALL_REASONS_SQL = f"""
SELECT *, concat_ws('; ',
    CASE WHEN {SPECIAL_SQL.format('nm')} <> '' THEN 'special_char:nm:' || {SPECIAL_SQL.format('nm')} END,
    CASE WHEN {SPECIAL_SQL.format('seg')} <> '' THEN 'special_char:seg:' || {SPECIAL_SQL.format('seg')} END,
    CASE WHEN {BLANK_SQL} THEN 'blank:seg' END,
    CASE WHEN NOT {LENGTH_SQL} THEN 'code_length:code2' END) AS reject_reasons
FROM dirty
"""


@register(f"WITH {DIRTY_SQL} SELECT * FROM ({ALL_REASONS_SQL}) WHERE reject_reasons <> ''")
def reject_reasons_all_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules at once: every broken rule is named, in rule order."""
    return as_text(_split(spark, sf_dir, SPECIAL, BLANK, LENGTH)[1])


@register(f"WITH {DIRTY_SQL} SELECT * FROM dirty")
def split_conserves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows together are the input."""
    good, bad = _split(spark, sf_dir, SPECIAL, BLANK, LENGTH)
    return good.drop("time_stamp").unionByName(bad.drop(REASONS))


@register(
    f"WITH {DIRTY_SQL} SELECT c_custkey, nm,"
    r" CASE WHEN seg IS NULL OR seg IN ('\N', 'none') THEN '' ELSE seg END AS seg, code2 FROM dirty"
)
def scrub_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scrub(dirty_customer(spark, sf_dir), ["seg"])


@register(f"SELECT *, {STAMP_SQL} AS time_stamp FROM customer", "load_stamp")
def stamped_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_stamp(table(spark, sf_dir, "customer"), stamp())


@register(
    """
    SELECT l_returnflag, l_linestatus, l_shipdate FROM lineitem
    EXCEPT ALL
    SELECT l_returnflag, l_linestatus, l_shipdate FROM lineitem WHERE l_quantity >= 25
    """
)
def quarantine_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input minus accepted rows where many rows are equal."""
    lines = table(spark, sf_dir, "lineitem")
    columns = ["l_returnflag", "l_linestatus", "l_shipdate"]
    return multiset_difference(lines.select(*columns), lines.filter("l_quantity >= 25").select(*columns))


@register(
    f"""
    WITH {DIRTY_SQL}, accepted AS (SELECT * FROM dirty WHERE NOT {BLANK_SQL} AND {LENGTH_SQL})
    SELECT * FROM dirty d WHERE NOT EXISTS (SELECT 1 FROM accepted a WHERE a.c_custkey = d.c_custkey)
    """
)
def quarantine_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_difference(dirty_customer(spark, sf_dir), _split(spark, sf_dir, BLANK, LENGTH)[0], ["c_custkey"])


@register(
    f"""
    WITH {DIRTY_SQL}
    SELECT count(*) FILTER (WHERE reject_reasons = '') AS good_rows,
           count(*) FILTER (WHERE reject_reasons <> '') AS bad_rows
    FROM ({ALL_REASONS_SQL})
    """
)
def dq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_counts(dirty_customer(spark, sf_dir), [SPECIAL, BLANK, LENGTH])


# ---- newest row per key and merges --------------------------------------------------------------------------------

ORDERS_RANK_SQL = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)"
LATEST_ORDERS_SQL = f"SELECT * FROM orders QUALIFY {ORDERS_RANK_SQL} = 1"
DAY_ONE, DAY_TWO = "o_orderdate < '2000-01-01'", "o_orderdate >= '2000-01-01'"
LINE_KEY = ["l_orderkey", "l_linenumber"]
LATEST_LINES_SQL = """
SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
           l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1
"""


def _orders(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(day)


def _latest_orders(orders: DataFrame) -> DataFrame:
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


def _merge_orders(spark: SparkSession, sf_dir: str, old: str, new: str, **options) -> DataFrame:
    existing = _latest_orders(_orders(spark, sf_dir, old))
    day = _orders(spark, sf_dir, new)
    return scd1_touched(existing, day, ["o_custkey"], "o_orderdate", ["o_orderkey"], **options)


@register(LATEST_ORDERS_SQL, "latest_per_key")
def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_orders(table(spark, sf_dir, "orders"))


@register(LATEST_LINES_SQL)
def latest_per_key_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key of two columns, ties settled by all other columns."""
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, "l_shipdate")


@register(LATEST_ORDERS_SQL)
def scd1_merge_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _orders(spark, sf_dir, DAY_ONE), _orders(spark, sf_dir, DAY_TWO)
    return scd1_window(old, new, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@register(LATEST_ORDERS_SQL)
def scd1_merge_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_orders(spark, sf_dir, DAY_ONE, DAY_TWO)


@register(LATEST_ORDERS_SQL)
def scd1_merge_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No broadcast allowed: the day's keys are joined by shuffle and sort."""
    return _merge_orders(spark, sf_dir, DAY_ONE, DAY_TWO, broadcast_bytes=-1)


@register(LATEST_ORDERS_SQL)
def scd1_merge_full_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day whose keys by measure just exceed the bound, so that they are joined by shuffle."""
    existing = _latest_orders(_orders(spark, sf_dir, DAY_ONE))
    day = _orders(spark, sf_dir, DAY_TWO)
    day_bytes = measure_keys(day, ["o_custkey"], "o_orderdate").bytes
    return scd1_touched(
        existing, day, ["o_custkey"], "o_orderdate", ["o_orderkey"], broadcast_bytes=day_bytes - 1
    )


@register(LATEST_ORDERS_SQL)
def scd1_merge_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A late day: its rows are older than those of the snapshot."""
    return _merge_orders(spark, sf_dir, DAY_TWO, DAY_ONE)


@register(LATEST_ORDERS_SQL)
def scd1_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots laid out by hash of the key before and after the merge."""
    base, key = join_path(scratch_folder(spark), "orders"), ["o_custkey"]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    existing = _latest_orders(_orders(spark, sf_dir, DAY_ONE)).repartition(buckets, *key)
    write_snapshot(existing, base, 20240101, unique_on=key, buckets=buckets)
    merged = scd1_bucketed(
        read_bucketed(spark, base, 20240101),
        _orders(spark, sf_dir, DAY_TWO),
        key,
        buckets,
        "o_orderdate",
        ["o_orderkey"],
    )
    write_snapshot(merged, base, 20240102, unique_on=key, buckets=buckets)
    return read_bucketed(spark, base, 20240102)


REPEATED_SQL = f"""
SELECT o.* FROM orders o WHERE {DAY_ONE} AND o_orderpriority <> '5-LOW'
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE {DAY_TWO})
UNION ALL
SELECT * FROM (SELECT * FROM orders WHERE {DAY_TWO} OR o_orderpriority <> '5-LOW' QUALIFY {ORDERS_RANK_SQL} = 1)
WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE {DAY_TWO})
"""


@register(
    f"SELECT *, 'broadcast' AS way FROM ({REPEATED_SQL}) UNION ALL SELECT *, 'shuffle' AS way FROM ({REPEATED_SQL})"
)
def scd1_merge_repeated_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot that repeats keys: untouched ones stay repeated, whichever way the day's keys are joined."""
    existing = _orders(spark, sf_dir, f"{DAY_ONE} AND o_orderpriority <> '5-LOW'")
    day = _orders(spark, sf_dir, DAY_TWO)
    ways = [
        scd1_touched(existing, day, ["o_custkey"], "o_orderdate", ["o_orderkey"], broadcast_bytes=bound).withColumn(
            "way", F.lit(way)
        )
        for way, bound in (("broadcast", 1 << 40), ("shuffle", -1))
    ]
    return ways[0].unionByName(ways[1])


NULL_KEY_SQL = """
nulled AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS cust,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS status,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS stamp,
         o_orderdate < '2000-01-01' AS is_old
  FROM orders)
"""


def _null_merge_sql(key: str) -> str:
    newest = f"row_number() OVER (PARTITION BY {key} ORDER BY stamp DESC NULLS LAST, o_orderkey DESC)"
    picked = f"SELECT o_orderkey, coalesce(cust, -1) AS cust, coalesce(status, '?') AS status FROM nulled QUALIFY {newest} = 1"
    ways = [f"SELECT *, '{way}' AS way FROM ({picked})" for way in ("window", "touched", "shuffled", "bucketed")]
    return f"WITH {NULL_KEY_SQL} " + " UNION ALL ".join(ways)


def _null_merge(spark: SparkSession, sf_dir: str, key: list[str]) -> DataFrame:
    """One merge with NULL among keys and stamps, by each of the ways."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("cust"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("stamp"),
        (F.col("o_orderdate") < "2000-01-01").alias("is_old"),
    )
    rest = (key, "stamp", ["o_orderkey"])
    old = latest_per_key(rows.filter("is_old").drop("is_old"), *rest)
    new = rows.filter("not is_old").drop("is_old")
    base, buckets = join_path(scratch_folder(spark), "orders"), 4
    write_snapshot(old.repartition(buckets, *key), base, 20240101, unique_on=key, buckets=buckets)
    ways = {
        "window": scd1_window(old, new, *rest),
        "touched": scd1_touched(read_snapshot(spark, base, 20240101), new, *rest),
        "shuffled": scd1_touched(read_snapshot(spark, base, 20240101), new, *rest, broadcast_bytes=-1),
        "bucketed": scd1_bucketed(read_bucketed(spark, base, 20240101), new, key, buckets, "stamp", ["o_orderkey"]),
    }
    shown = [
        df.select(
            "o_orderkey",
            F.coalesce("cust", F.lit(-1)).alias("cust"),
            F.coalesce("status", F.lit("?")).alias("status"),
            F.lit(way).alias("way"),
        )
        for way, df in ways.items()
    ]
    return reduce(DataFrame.unionByName, shown)


@register(_null_merge_sql("cust"))
def scd1_merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_merge(spark, sf_dir, ["cust"])


@register(_null_merge_sql("cust, status"))
def scd1_merge_null_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_merge(spark, sf_dir, ["cust", "status"])


@register(LATEST_LINES_SQL)
def scd1_merge_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    existing = latest_per_key(lines.filter("l_shipdate < '2000-01-01'"), LINE_KEY, "l_shipdate")
    return scd1_touched(existing, lines.filter("l_shipdate >= '2000-01-01'"), LINE_KEY, "l_shipdate")


ORDER_TEXT_SQL = "CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END"


@register(
    f"SELECT coalesce(TRY_CAST({ORDER_TEXT_SQL} AS INTEGER), -1) AS order_no, o_custkey, o_orderdate FROM orders"
    " ORDER BY order_no, o_custkey, o_orderdate",
    "key_cast_sort",
)
def orders_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_orderkey").cast("string"))
    orders = table(spark, sf_dir, "orders").select(text.alias("order_no"), "o_custkey", "o_orderdate")
    ordered = key_cast_sort(orders, "order_no", ["o_custkey", "o_orderdate"])
    return ordered.withColumn("order_no", F.coalesce("order_no", F.lit(-1)))


@register(f"SELECT * FROM ({LATEST_ORDERS_SQL}) ORDER BY o_custkey NULLS FIRST LIMIT 1000")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(_latest_orders(table(spark, sf_dir, "orders")), ["o_custkey"])


@register(
    f"""
    SELECT count(*) FILTER (WHERE {DAY_ONE}) AS existing_rows, count(*) FILTER (WHERE {DAY_TWO}) AS new_rows,
           count(DISTINCT o_custkey) AS merged_rows
    FROM orders
    """
)
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on both sides and after the merge, which are the distinct keys: one aggregate per key over one scan."""
    sides = table(spark, sf_dir, "orders").select("o_custkey", F.expr(DAY_ONE).alias("is_old"))
    per_key = sides.groupBy("o_custkey").agg(
        F.count_if(F.col("is_old")).alias("old"), F.count_if(~F.col("is_old")).alias("new")
    )
    return per_key.agg(
        F.coalesce(F.sum("old"), F.lit(0)).alias("existing_rows"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("new_rows"),
        F.count(F.lit(1)).alias("merged_rows"),
    )


# ---- sources and sinks --------------------------------------------------------------------------------------------


@register("SELECT * FROM customer")
def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    folder = join_path(scratch_folder(spark), "feed")
    customers.write.csv(folder)
    return scan_csv(spark, folder, customers.schema)


@register(
    "SELECT p_partkey AS part, p_name AS name, p_brand AS brand, p_type AS type, p_size AS size,"
    " CAST(CAST(p_retailprice AS DECIMAL(18,9)) AS DOUBLE) AS price FROM part"
)
def csv_scan_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header is skipped, not matched: columns take the declared names by position."""
    folder = join_path(scratch_folder(spark), "feed")
    table(spark, sf_dir, "part").write.csv(folder, header=True)
    ddl = "part bigint, name string, brand string, type string, size int, price decimal(18,9)"
    rows = scan_csv(spark, folder, ddl, header=True)
    return rows.withColumn("price", F.col("price").cast("double"))


BROKEN_KEY_SQL = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'x' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END"


@register(
    f"""
    SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN -1 ELSE c_custkey END AS id, c_name AS name,
           c_mktsegment AS segment,
           CASE WHEN c_mktsegment = 'BUILDING' THEN {BROKEN_KEY_SQL} || ',' || c_name || ',' || c_mktsegment
                END AS corrupt
    FROM customer
    """
)
def csv_scan_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that do not fit the schema keep their raw text."""
    key = F.col("c_custkey").cast("string")
    broken = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("x"), key)).otherwise(key)
    folder = join_path(scratch_folder(spark), "feed")
    table(spark, sf_dir, "customer").select(broken, "c_name", "c_mktsegment").write.csv(folder)
    rows = scan_csv(spark, folder, "id bigint, name string, segment string", keep_corrupt=True)
    return rows.withColumnRenamed("corrupt_line", "corrupt").withColumn("id", F.coalesce("id", F.lit(-1)))


DIRTY_SCHEMA = "c_custkey bigint, nm string, seg string, code2 string"


@register(f"WITH {DIRTY_SQL} SELECT * FROM ({ALL_REASONS_SQL}) WHERE reject_reasons <> ''")
def quarantine_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = join_path(scratch_folder(spark), "bad_data")
    dirty = dirty_customer(spark, sf_dir)
    write_quarantine(split(dirty, [BLANK], stamp())[1], folder, header=True, mode="overwrite")
    write_quarantine(split(dirty, [SPECIAL, BLANK, LENGTH], stamp())[1], folder, header=True, mode="overwrite")
    return read_quarantine(spark, folder, f"{DIRTY_SCHEMA}, {REASONS} string", header=True)


@register(f"WITH {DIRTY_SQL} SELECT *, 'blank:seg' AS reject_reasons FROM dirty WHERE {BLANK_SQL}")
def quarantine_csv_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write finds the folder taken and leaves it alone."""
    folder = join_path(scratch_folder(spark), "bad_data")
    dirty = dirty_customer(spark, sf_dir)
    write_quarantine(split(dirty, [BLANK], stamp())[1], folder)
    write_quarantine(split(dirty, [SPECIAL, BLANK, LENGTH], stamp())[1], folder)
    return read_quarantine(spark, folder, f"{DIRTY_SCHEMA}, {REASONS} string")


ERAS = {
    19961231: "o_orderdate < '1997-01-01'",
    19991231: "o_orderdate >= '1997-01-01' AND o_orderdate < '2000-01-01'",
    20021231: "o_orderdate >= '2000-01-01'",
}


def _snapshots_by_era(spark: SparkSession, sf_dir: str) -> str:
    base = join_path(scratch_folder(spark), "orders")
    for date, era in ERAS.items():
        write_snapshot(_orders(spark, sf_dir, era), base, date)
    return base


@register("SELECT * FROM orders")
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwriting a date replaces it."""
    base = join_path(scratch_folder(spark), "orders")
    write_snapshot(_orders(spark, sf_dir, DAY_ONE), base, 20240101)
    write_snapshot(table(spark, sf_dir, "orders"), base, 20240101)
    return read_snapshot(spark, base, 20240101)


@register("SELECT * FROM orders")
def snapshot_write_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A guarded write refuses a date that is there and leaves it as it was."""
    base = join_path(scratch_folder(spark), "orders")
    orders = table(spark, sf_dir, "orders")
    write_snapshot(orders, base, 20240101, mode="errorifexists")
    try:
        write_snapshot(orders, base, 20240101, mode="errorifexists")
    except AnalysisException as refused:
        if refused.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    else:
        raise AssertionError("a snapshot was overwritten despite the guard")
    return read_snapshot(spark, base, 20240101)


@register(f"SELECT *, 19991231 AS load_date FROM orders WHERE {ERAS[19991231]}")
def snapshot_read_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_history(spark, _snapshots_by_era(spark, sf_dir)).filter("load_date = 19991231")


@register(f"SELECT *, 19991231 AS prior_date FROM orders WHERE {ERAS[19991231]}")
def latest_prior_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run date has gaps before it and a later snapshot after it."""
    base = _snapshots_by_era(spark, sf_dir)
    prior = latest_prior_date(spark, base, 20021231)
    return read_snapshot(spark, base, prior).withColumn("prior_date", F.lit(prior))


@register(f"SELECT *, {STAMP_SQL} AS time_stamp FROM orders")
def full_load_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = join_path(scratch_folder(spark), "orders")
    write_snapshot(load_stamp(table(spark, sf_dir, "orders"), stamp()), base, 20240101)
    return read_snapshot(spark, base, 20240101)


@register(f"SELECT * FROM orders WHERE {DAY_ONE} UNION ALL SELECT * FROM orders")
def append_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous snapshot plus a day that brings some of its rows again: they are kept twice."""
    base = join_path(scratch_folder(spark), "orders")
    write_snapshot(_orders(spark, sf_dir, DAY_ONE), base, 20240101)
    both = append(read_snapshot(spark, base, 20240101), table(spark, sf_dir, "orders"))
    write_snapshot(both, base, 20240102, mode="errorifexists")
    return read_snapshot(spark, base, 20240102)


@register(
    """
    SELECT event_id, CAST(strftime(ts - INTERVAL 2 DAY, '%Y%m%d') AS INTEGER) AS run_date,
           CAST(strftime(ts - INTERVAL 3 DAY, '%Y%m%d') AS INTEGER) AS previous_date
    FROM events
    """
)
def business_date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        business_date(F.col("ts")).alias("run_date"),
        business_date(F.col("ts"), 3).alias("previous_date"),
    )


# ---- daily loads --------------------------------------------------------------------------------------------------

DAYS = (20240101, 20240102, 20240103)
STAMPS = {day: f"2024-01-0{i} 06:00:00" for i, day in enumerate(DAYS, start=1)}


def _daily(spark: SparkSession, sf_dir: str, contract: Contract, days: tuple[int, ...]) -> DataFrame:
    """Load a feed per day, each day's customers numbered 40 higher than the day before, and read the result."""
    folder = scratch_folder(spark)
    layout = Layout(join_path(folder, "feed"), join_path(folder, "out"), join_path(folder, "bad"))
    for nth, day in enumerate(days):
        feed = dirty_customer(spark, sf_dir).withColumn("c_custkey", F.col("c_custkey") + 40 * nth)
        feed.write.csv(layout.feed(contract.source, day), header=contract.header)
        run_load(spark, contract, layout, day, stamp(STAMPS[day]))
    return read_loaded(spark, contract, layout, days[-1])


def _days_sql(days: tuple[int, ...]) -> str:
    """The feeds as read from CSV, where an empty text is NULL."""
    return " UNION ALL ".join(
        f"SELECT c_custkey + {40 * nth} AS c_custkey, nm, nullif(seg, '') AS seg, code2,"
        f" TIMESTAMP '{STAMPS[day]}' AS time_stamp FROM dirty"
        for nth, day in enumerate(days)
    )


NEWEST_SQL = "QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY time_stamp DESC) = 1"


@register(
    f"WITH {DIRTY_SQL}, days AS ({_days_sql(DAYS)}) SELECT * FROM days"
    f" WHERE {SPECIAL_SQL.format('nm')} = '' {NEWEST_SQL}"
)
def daily_special_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load, merge with a snapshot not yet known to be unique, merge with one that is."""
    contract = Contract(
        "customer",
        DIRTY_SCHEMA,
        quality="special_char",
        check_columns=("nm",),
        merge_mode="scd1",
        key=("c_custkey",),
    )
    return _daily(spark, sf_dir, contract, DAYS)


@register(
    f"WITH {DIRTY_SQL}, days AS ({_days_sql(DAYS)}) SELECT * FROM days"
    f" WHERE NOT {BLANK_SQL} AND {LENGTH_SQL} {NEWEST_SQL}"
)
def daily_blank_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = Contract(
        "customer",
        DIRTY_SCHEMA,
        quality="blank",
        check_columns=("seg",),
        code_lengths={"code2": 2},
        merge_mode="scd1",
        key=("c_custkey",),
        header=True,
        quarantine_header=True,
        quarantine_mode="overwrite",
    )
    return _daily(spark, sf_dir, contract, DAYS)


@register(
    f"WITH {DIRTY_SQL}, days AS ({_days_sql(DAYS[:2])}) SELECT c_custkey, nm,"
    r" CASE WHEN seg IS NULL OR seg IN ('\N', 'none') THEN '' ELSE seg END AS seg, code2, time_stamp FROM days"
)
def daily_scrub_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = Contract(
        "customer", DIRTY_SCHEMA, quality="scrub", check_columns=("seg",), merge_mode="append"
    )
    return _daily(spark, sf_dir, contract, DAYS[:2])


@register(
    f"WITH {DIRTY_SQL}, days AS ({_days_sql(DAYS[:2])}) SELECT * FROM days"
    f" WHERE time_stamp = TIMESTAMP '{STAMPS[DAYS[1]]}'"
)
def daily_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is checked and each load replaces the table."""
    return _daily(spark, sf_dir, Contract("customer", DIRTY_SCHEMA), DAYS[:2])


CUSTOMER_KEY = dict(merge_mode="scd1", key=("c_custkey",))


def _place(spark: SparkSession) -> Layout:
    folder = scratch_folder(spark)
    return Layout(join_path(folder, "feed"), join_path(folder, "out"), join_path(folder, "bad"))


@register(f"WITH {DIRTY_SQL}, days AS ({_days_sql(DAYS)}) SELECT * FROM days WHERE TRUE {NEWEST_SQL}")
def daily_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source in buckets from its first load on."""
    return _daily(spark, sf_dir, Contract("customer", DIRTY_SCHEMA, buckets=4, **CUSTOMER_KEY), DAYS)


@register(
    f"""
    SELECT 'table' AS place, CAST(c_custkey AS VARCHAR) AS id, count(*) AS lines FROM customer
    WHERE c_mktsegment <> 'BUILDING' GROUP BY ALL
    UNION ALL
    SELECT 'quarantine', {BROKEN_KEY_SQL}, count(*) FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY ALL
    """
)
def daily_corrupt_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with an unreadable key are neither merged into one row nor lost: table and quarantine are all lines."""
    contract = Contract("customer", "c_custkey bigint, nm string", merge_mode="scd1", key=("c_custkey",))
    layout = _place(spark)
    key = F.col("c_custkey").cast("string")
    broken = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("x"), key)).otherwise(key)
    lines = table(spark, sf_dir, "customer").select(broken, "c_name")
    lines.write.csv(layout.feed("customer", DAYS[0]))
    run_load(spark, contract, layout, DAYS[0], stamp(STAMPS[DAYS[0]]))
    loaded = read_loaded(spark, contract, layout, DAYS[0]).select(F.lit("table").alias("place"), key.alias("id"))
    schema = f"{contract.schema}, corrupt_line string, {REASONS} string"
    bad = read_quarantine(spark, layout.quarantine("customer", DAYS[0]), schema).select(
        F.lit("quarantine").alias("place"), F.split_part("corrupt_line", F.lit(","), F.lit(1)).alias("id")
    )
    return loaded.unionByName(bad).groupBy("place", "id").agg(F.count(F.lit(1)).alias("lines"))


@register(
    f"""
    WITH {DIRTY_SQL}
    SELECT 'table' AS place, c_custkey FROM dirty WHERE NOT {BLANK_SQL} AND c_custkey % 2 = 0
    UNION ALL
    SELECT 'quarantine', c_custkey FROM dirty WHERE {BLANK_SQL} AND c_custkey % 2 = 0
    """
)
def daily_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day loaded twice with different feeds: snapshot and quarantine are both those of the second run."""
    contract = Contract("customer", DIRTY_SCHEMA, quality="blank", check_columns=("seg",), quarantine_mode="ignore")
    layout, day = _place(spark), DAYS[0]
    for rest in ("c_custkey % 2 = 1", "c_custkey % 2 = 0"):
        dirty_customer(spark, sf_dir).filter(rest).write.mode("overwrite").csv(layout.feed("customer", day))
        report = run_load(spark, contract, layout, day, stamp(STAMPS[day]))
    bad = read_quarantine(spark, layout.quarantine("customer", day), f"{DIRTY_SCHEMA}, {REASONS} string")
    if bad.count() != report.bad_rows:
        raise AssertionError(f"{report.bad_rows} rejected rows reported, {bad.count()} there")
    sides = {"table": read_loaded(spark, contract, layout, day), "quarantine": bad}
    return reduce(
        DataFrame.unionByName, [df.select(F.lit(place).alias("place"), "c_custkey") for place, df in sides.items()]
    )


@register(
    f"""
    SELECT c_custkey, c_name AS nm, '-' AS seg, TIMESTAMP '{STAMPS[DAYS[0]]}' AS time_stamp FROM customer
    UNION ALL
    SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '{STAMPS[DAYS[1]]}' FROM customer
    """
)
def append_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the second day on the source has one more column: NULL in older rows, kept in newer ones."""
    layout, customers = _place(spark), table(spark, sf_dir, "customer")
    columns = ["c_custkey bigint", "nm string", "seg string"]
    for day, width in ((DAYS[0], 2), (DAYS[1], 3)):
        contract = Contract("customer", ", ".join(columns[:width]), merge_mode="append")
        customers.select(*["c_custkey", "c_name", "c_mktsegment"][:width]).write.csv(layout.feed("customer", day))
        run_load(spark, contract, layout, day, stamp(STAMPS[day]))
    return read_loaded(spark, contract, layout, DAYS[1]).withColumn("seg", F.coalesce("seg", F.lit("-")))


DECLARATION = "c_custkey string\nnm string col\nseg string, col\nbalance decimal(18,9)\n"


@register(
    f"""
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name AS nm, c_mktsegment AS seg,
           CAST(CAST(c_acctbal AS DECIMAL(18,9)) AS DOUBLE) AS balance, TIMESTAMP '{STAMPS[DAYS[1]]}' AS time_stamp
    FROM customer WHERE c_mktsegment <> 'BUILDING'
    """
)
def declared_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema and checked columns from a declaration in a text file; the key, declared as text, is cast by the load."""
    layout = _place(spark)
    folder = join_path(scratch_folder(spark), "schema")
    spark.createDataFrame([(DECLARATION,)], "value string").coalesce(1).write.text(folder)
    contract = declared_contract(
        "customer", read_text(spark, folder), quality="blank", key_type="int", blank_values=("BUILDING",), **CUSTOMER_KEY
    )
    for day in DAYS[:2]:
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal").write.csv(
            layout.feed("customer", day)
        )
        run_load(spark, contract, layout, day, stamp(STAMPS[day]))
    return read_loaded(spark, contract, layout, DAYS[1]).withColumn("balance", F.col("balance").cast("double"))


@register(f"SELECT *, {STAMP_SQL} AS time_stamp FROM customer")
def passthrough_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No rule: every row is accepted as it is."""
    return split(table(spark, sf_dir, "customer"), [], stamp())[0]
