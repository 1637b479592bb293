"""

Every query reads whole tables. A merge needs existing rows and a batch: the
existing rows are a table as it is, the batch is the whole table again with the
keys doubled, so that half of its keys are known and half are new.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from importlib.util import find_spec
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablesync as ts

TESTDATA = "/root/testdata"
MONEY = (12, 2)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ts.parquet_scan(spark, f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.decimal_typed(_table(spark, sf_dir, "orders"), {"o_totalprice": MONEY})


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = {"l_discount": (4, 2), "l_tax": (4, 2)}
    return ts.decimal_typed(
        _table(spark, sf_dir, "lineitem"), {"l_quantity": MONEY, "l_extendedprice": MONEY, **rates}
    )


def _raised(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, (F.col(col) + 1).cast("decimal(12,2)"))


def _orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raised(_orders(spark, sf_dir), "o_totalprice").withColumn("o_orderkey", F.col("o_orderkey") * 2)


def _lineitem_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raised(_lineitem(spark, sf_dir), "l_extendedprice").withColumn("l_orderkey", F.col("l_orderkey") * 2)


# --- SQL building blocks -------------------------------------------------------------------

ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders"""
ORDERS_BATCH_SQL = """SELECT o_orderkey * 2 AS o_orderkey, o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)) AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders"""
ORDERS_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
LINEITEM_REST = """l_linenumber, CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity, {price} AS l_extendedprice,
       CAST(l_discount AS DECIMAL(4,2)) AS l_discount, CAST(l_tax AS DECIMAL(4,2)) AS l_tax,
       l_returnflag, l_linestatus, l_shipdate"""
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
LINEITEM_SQL = f"SELECT l_orderkey, l_partkey, l_suppkey, {LINEITEM_REST.format(price=PRICE)} FROM lineitem"
LINEITEM_BATCH_SQL = (
    "SELECT l_orderkey * 2 AS l_orderkey, l_partkey, l_suppkey, "
    f"{LINEITEM_REST.format(price=f'CAST({PRICE} + 1 AS DECIMAL(12,2))')} FROM lineitem"
)
LINEITEM_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate"""
LINEITEM_ORDER = """l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_quantity DESC,
       l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC"""

MERGED_ORDERS_SQL = f"""
WITH old_rows AS ({ORDERS_SQL}), new_rows AS ({ORDERS_BATCH_SQL}),
u AS (SELECT *, 0 AS is_new FROM old_rows UNION ALL SELECT *, 1 AS is_new FROM new_rows),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY is_new DESC) AS rn FROM u)
SELECT {ORDERS_COLUMNS} FROM r WHERE rn = 1"""
MERGED_LINEITEM_SQL = f"""
WITH old_rows AS ({LINEITEM_SQL}), new_rows AS ({LINEITEM_BATCH_SQL}),
u AS (SELECT *, 0 AS is_new FROM old_rows UNION ALL SELECT *, 1 AS is_new FROM new_rows),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY is_new DESC, {LINEITEM_ORDER}) AS rn FROM u)
SELECT {LINEITEM_COLUMNS} FROM r WHERE rn = 1"""
CHANGED_ORDERS_SQL = f"""
WITH old_rows AS ({ORDERS_SQL}),
new_rows AS (SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(o_totalprice + 1 AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority
  FROM old_rows WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-09-01')
SELECT {ORDERS_COLUMNS} FROM old_rows WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new_rows)
UNION ALL SELECT {ORDERS_COLUMNS} FROM new_rows"""

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _query(sql: str | None = None):
    def register(fn):
        REGISTRY[fn.__name__] = (fn, sql)
        return fn

    return register


# --- scans ---------------------------------------------------------------------------------


@_query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def scan_table(spark, sf_dir):
    return ts.scan_table(
        spark,
        f"{sf_dir}/orders.parquet",
        "o_orderkey, o_custkey, o_totalprice",
        "o_orderstatus = 'F' AND o_totalprice > 100000",
    )


@_query("""SELECT o.o_orderkey, o.o_orderdate, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE (c.c_acctbal > 0) AND o.o_orderpriority <> '5-LOW'""")
def scan_query(spark, sf_dir):
    text = """SELECT o.o_orderkey, o.o_orderdate, c.c_name, c.c_mktsegment
              FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
              WHERE $CONDITIONS AND o.o_orderpriority <> '5-LOW'"""
    tables = {name: _table(spark, sf_dir, name) for name in ("orders", "customer")}
    return ts.scan_query(spark, None, text, "c.c_acctbal > 0", tables)


@_query("""
WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem)
SELECT lineitem.*, CAST((l_orderkey - lo) // ((hi - lo + 8) // 8) AS BIGINT) AS split_id FROM lineitem, b""")
def split_scan(spark, sf_dir):
    rows = ts.split_scan(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey", 8)
    return ts.with_split_id(rows, "l_orderkey", 8)


@_query("SELECT * FROM lineitem")
def split_scan_clustered(spark, sf_dir):
    return ts.split_scan(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey", 8, clustered=True)


@_query("SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders")
def split_bounds(spark, sf_dir):
    return ts.split_bounds(_table(spark, sf_dir, "orders"), "o_orderkey")


_SPLIT_PLAN_SQL = """
WITH b AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {table}),
w AS (SELECT lo, hi, {width} AS width FROM b),
s AS (SELECT lo, hi, width, unnest(range(0, (hi - lo) // width + 1)) AS split_id FROM w),
c AS (SELECT CAST(({col} - lo) // width AS BIGINT) AS split_id, count(*) AS n FROM {table}, w GROUP BY 1)
SELECT CAST(s.split_id AS BIGINT) AS split_id, lo + s.split_id * width AS low,
       least(lo + (s.split_id + 1) * width - 1, hi) AS high, coalesce(n, 0) AS rows
FROM s LEFT JOIN c ON s.split_id = c.split_id"""


@_query(_SPLIT_PLAN_SQL.format(table="orders", col="o_orderkey", width="(hi - lo + 4) // 4"))
def split_plan(spark, sf_dir):
    return ts.split_plan(_table(spark, sf_dir, "orders"), "o_orderkey", 4)


@_query(_SPLIT_PLAN_SQL.format(table="lineitem", col="l_partkey", width="least((hi - lo + 4) // 4, 150)"))
def split_plan_limited(spark, sf_dir):
    return ts.split_plan(_table(spark, sf_dir, "lineitem"), "l_partkey", 4, split_limit=150)


# cuts are the values at the ranks ceil(i * rows / 8); a stretch and the cut that ends it are one range, if that is no heavy one
_SKEWED_SQL = "SELECT CASE WHEN l_linenumber = 1 THEN 7 ELSE l_partkey * l_partkey END AS v FROM lineitem"


@_query(f"""
WITH t AS (SELECT v, row_number() OVER (ORDER BY v) AS place, count(*) OVER () AS n FROM ({_SKEWED_SQL}) x),
cuts AS (SELECT DISTINCT v AS c FROM t WHERE place IN (SELECT (i * n + 7) // 8 FROM range(1, 8) r(i))),
q AS (SELECT list(c ORDER BY c) AS cs FROM cuts),
p AS (SELECT 2 * len(list_filter(cs, lambda c: c < v)) + list_contains(cs, v)::INT AS piece, v, n FROM t, q),
s AS (SELECT piece, min(v) AS low, max(v) AS high, count(*) AS rows, any_value(n) AS n FROM p GROUP BY piece),
m AS (SELECT *, CASE WHEN piece % 2 = 1 AND lag(piece) OVER w = piece - 1 AND lag(rows) OVER w + rows <= 2 * n / 8
  THEN piece - 1 ELSE piece END AS run FROM s WINDOW w AS (ORDER BY piece)),
r AS (SELECT run, min(low) AS low, max(high) AS high, sum(rows)::BIGINT AS rows FROM m GROUP BY run)
SELECT row_number() OVER (ORDER BY run) - 1 AS split_id, low, high, rows FROM r""")
def split_balanced(spark, sf_dir):
    """A column of which one value holds a quarter; the cuts are exact, of tables with more rows than the accuracy, too."""
    skewed = F.when(F.col("l_linenumber") == 1, 7).otherwise(F.col("l_partkey") * F.col("l_partkey")).alias("v")
    rows = _table(spark, sf_dir, "lineitem").select(skewed)
    return ts.balanced_split_plan(rows, "v", 8, accuracy=1_000_000)


@_query("""
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders),
b AS (SELECT min(d) AS lo, max(d) AS hi, CAST(ceil((max(d) - min(d) + 1) / 6) AS BIGINT) AS width FROM t),
s AS (SELECT lo, hi, width, unnest(range(0, (hi - lo) // width + 1)) AS split_id FROM b),
c AS (SELECT (d - lo) // width AS split_id, count(*) AS n FROM t, b GROUP BY 1)
SELECT s.split_id, CAST(lo + CAST(s.split_id * width AS INT) AS DATE) AS low,
  least(hi, CAST(lo + CAST((s.split_id + 1) * width - 1 AS INT) AS DATE)) AS high, coalesce(n, 0) AS rows
FROM s LEFT JOIN c ON s.split_id = c.split_id""")
def split_plan_by_date(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    return ts.typed_split_plan(rows, "d", 6)


# texts as numbers of base 1114113, by the code points of six characters after what all texts begin with
@_query("""
WITH b AS (SELECT min(p_name) AS lo, max(p_name) AS hi FROM part),
f AS (SELECT lo, hi, coalesce(list_max(list_filter(range(0, least(length(lo), length(hi)) + 1), lambda k: left(lo, k) = left(hi, k))), 0) AS k FROM b),
d AS (SELECT *, list_transform(range(1, 7), lambda i: CASE WHEN length(lo) >= k + i THEN unicode(substr(lo, k + i, 1)) + 1 ELSE 0 END) AS a,
  list_transform(range(1, 7), lambda i: CASE WHEN length(hi) >= k + i THEN unicode(substr(hi, k + i, 1)) + 1 ELSE 0 END) AS z FROM f),
n AS (SELECT *, list_reduce(list_transform(a, lambda x: x::HUGEINT), lambda x, y: x * 1114113 + y) AS first,
  list_reduce(list_transform(z, lambda x: x::HUGEINT), lambda x, y: x * 1114113 + y) AS last FROM d),
w AS (SELECT *, (last - first + 1 + 4) // 5 AS width FROM n),
c AS (SELECT lo, hi, k, first + i * width AS cut, i FROM w, range(1, 5) r(i) WHERE first + i * width <= last),
e AS (SELECT lo, hi, k, i, list_transform(range(1, 7), lambda j: (cut // (1114113::HUGEINT ** (6 - j))::HUGEINT % 1114113)::INT) AS ds FROM c),
x AS (SELECT lo, hi, i, left(lo, k) || array_to_string(list_transform(list_slice(ds, 1, coalesce(nullif(list_position(ds, 0), 0), 7) - 1),
  lambda p: chr(CASE WHEN p - 1 BETWEEN 55296 AND 57343 THEN 57344 ELSE p - 1 END)), '') AS low FROM e),
u AS (SELECT DISTINCT low FROM x WHERE low > lo AND low <= hi UNION SELECT lo FROM b),
r AS (SELECT row_number() OVER (ORDER BY low) - 1 AS split_id, low, lead(low) OVER (ORDER BY low) AS next FROM u)
SELECT split_id, low, coalesce(next, (SELECT hi FROM b)) AS high,
  (SELECT count(*) FROM part WHERE p_name >= low AND (next IS NULL OR p_name < next)) AS rows FROM r""")
def split_plan_by_text(spark, sf_dir):
    return ts.typed_split_plan(_table(spark, sf_dir, "part"), "p_name", 5)


@_query("""SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS c_comment FROM customer""")
def parquet_scan(spark, sf_dir):
    schema = "c_custkey bigint, c_name string, c_acctbal double, c_comment string"
    return ts.parquet_scan(spark, f"{sf_dir}/customer.parquet", schema)


# --- columns -------------------------------------------------------------------------------


@_query('SELECT o_orderkey AS "O_ORDERKEY", o_totalprice AS "o_TotalPrice", o_orderdate FROM orders')
def select_columns(spark, sf_dir):
    return ts.select_columns(_table(spark, sf_dir, "orders"), '"O_ORDERKEY", o_TotalPrice , o_orderdate')


@_query("""SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
AND (o_orderstatus = 'O' OR o_totalprice < 50000)""")
def where_filter(spark, sf_dir):
    since = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return ts.where_filter(_table(spark, sf_dir, "orders"), "o_orderstatus = 'O' OR o_totalprice < 50000", since)


@_query("""SELECT c_custkey AS "AVRO_1st_key", c_name AS "full_name", c_nationkey AS "_nation",
CAST(c_acctbal AS DECIMAL(12,2)) AS "a__b", c_mktsegment AS "ü_1" FROM customer""")
def sanitize_columns(spark, sf_dir):
    rows = ts.decimal_typed(_table(spark, sf_dir, "customer"), {"c_acctbal": MONEY})
    return ts.sanitize_columns(rows.toDF("1st key", "full  name", "-nation", "a-_b", "ü$%1"))


@_query("""SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def cast_overrides(spark, sf_dir):
    overrides = {"O_ORDERKEY": "Integer", "o_custkey": "STRING", "o_totalprice": "double"}
    return ts.cast_overrides(_orders(spark, sf_dir), overrides)


@_query("""SELECT o_orderkey, CAST(year(o_orderdate) AS SMALLINT) AS order_year FROM orders""")
def year_as_smallint(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("order_year"))
    return ts.year_as_smallint(rows, ["order_year"])


# --- conversions ---------------------------------------------------------------------------


@_query(LINEITEM_SQL)
def decimal_typed(spark, sf_dir):
    return _lineitem(spark, sf_dir)


def _layout_sql(name, precision, scale, storage, length, expression):
    return f"""SELECT '{name}' AS column_name, {precision} AS "precision", {scale} AS scale, '{storage}' AS storage,
CAST({length} AS INTEGER) AS byte_length, count(*) AS rows, count(*) - count(l_orderkey) AS nulls,
CAST(max(length(CAST(abs({expression}) AS VARCHAR))) AS INTEGER) AS digits_used FROM lineitem"""


def _hundredths(col):
    return f"CAST(CAST({col} AS DECIMAL(12,2)) * 100 AS BIGINT)"


@_query(
    "\nUNION ALL\n".join(
        [
            _layout_sql("l_quantity", 12, 2, "FIXED", 6, _hundredths("l_quantity")),
            _layout_sql("l_extendedprice", 12, 2, "FIXED", 6, _hundredths("l_extendedprice")),
            _layout_sql("l_discount", 4, 2, "FIXED", 2, _hundredths("l_discount")),
            _layout_sql("l_tax", 4, 2, "FIXED", 2, _hundredths("l_tax")),
            _layout_sql("price_wide", 30, 10, "BYTES", "NULL", _hundredths("l_extendedprice") + " * 100000000"),
        ]
    )
)
def decimal_layout(spark, sf_dir):
    rows = _lineitem(spark, sf_dir)
    return ts.decimal_layout(rows.withColumn("price_wide", F.col("l_extendedprice").cast("decimal(30,10)")))


@_query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(20,10)) AS wider,
CAST(o_totalprice AS DECIMAL(12,2)) AS back FROM orders""")
def decimal_rescale_exact(spark, sf_dir):
    price = F.col("o_totalprice")
    rows = _orders(spark, sf_dir).select(
        "o_orderkey", price.alias("wider"), price.cast("decimal(20,10)").alias("back")
    )
    return ts.decimal_rescale_exact(rows, {"wider": (20, 10), "back": MONEY})


@_query("""SELECT c_custkey, c_name, c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal,
c_mktsegment FROM customer""")
def decimal_to_plain_string(spark, sf_dir):
    rows = ts.decimal_typed(_table(spark, sf_dir, "customer"), {"c_acctbal": MONEY})
    return ts.decimal_to_plain_string(rows)


# the numbers are u * 1E-10 for whole u, so their digits are those of u
@_query("""
WITH t AS (SELECT l_orderkey, l_partkey, l_linenumber, l_partkey * l_linenumber AS u FROM lineitem),
d AS (SELECT *, CAST(u AS VARCHAR) AS digits, length(CAST(u AS VARCHAR)) - 11 AS e FROM t)
SELECT l_orderkey, l_partkey, l_linenumber,
  CASE WHEN e >= -6 THEN CAST(CAST(CAST(u AS DECIMAL(20,0)) * CAST(0.0000000001 AS DECIMAL(10,10)) AS DECIMAL(30,10)) AS VARCHAR)
       WHEN length(digits) = 1 THEN digits || 'E' || CAST(e AS VARCHAR)
       ELSE digits[1:1] || '.' || digits[2:] || 'E' || CAST(e AS VARCHAR) END AS amount
FROM d""")
def decimal_to_java_string(spark, sf_dir):
    tiny = F.lit(Decimal("0.0000000001")).cast("decimal(10,10)")
    amount = (F.col("l_partkey") * F.col("l_linenumber")).cast("decimal(20,0)") * tiny
    rows = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", amount.cast("decimal(30,10)").alias("amount")
    )
    return ts.decimal_to_java_string(rows)


@_query(f"""SELECT c_custkey, right(lpad(to_hex({_hundredths('c_acctbal')}), 16, '0'), 12) AS c_acctbal FROM customer""")
def decimal_to_fixed(spark, sf_dir):
    rows = ts.decimal_typed(_table(spark, sf_dir, "customer"), {"c_acctbal": MONEY})
    return ts.decimal_to_fixed(rows).select("c_custkey", F.hex("c_acctbal").alias("c_acctbal"))


@_query("""SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal FROM customer""")
def fixed_to_decimal(spark, sf_dir):
    rows = ts.decimal_typed(_table(spark, sf_dir, "customer"), {"c_acctbal": MONEY})
    stored = ts.decimal_to_fixed(rows).select("c_custkey", "c_acctbal")
    return ts.fixed_to_decimal(stored, {"c_acctbal": MONEY})


_WIDE_SQL = """SELECT l_orderkey, l_linenumber, l_partkey,
  CAST((l_partkey % 2 * 2 - 1) * CAST(l_orderkey + 1 AS DECIMAL(20,0)) * (l_suppkey + 1) * 1000000000000 + l_partkey AS DECIMAL(38,0)) AS u
FROM lineitem"""


def _wide(spark, sf_dir):
    """Numbers of about 20 digits, every other one below zero."""
    number = F.expr(
        """CAST((l_partkey % 2 * 2 - 1) * CAST(l_orderkey + 1 AS DECIMAL(20,0)) * (l_suppkey + 1) * 1000000000000 + l_partkey
        AS DECIMAL(38,0))"""
    )
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", number.alias("u"))


@_query(f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN u < 0 THEN '-' ELSE '' END || (abs(u)::HUGEINT // 10000000000)::VARCHAR || '.' ||
  lpad((abs(u)::HUGEINT % 10000000000)::VARCHAR, 10, '0') AS DECIMAL(38,10)) AS amount, u AS unscaled FROM ({_WIDE_SQL}) w""")
def fixed_to_decimal_wide(spark, sf_dir):
    """9 to 16 bytes of two's complement, as long as the line number says."""
    stored = ts.decimal_to_fixed(_wide(spark, sf_dir)).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.expr("right(hex(u), 2 * (9 + l_linenumber % 8))").alias("digits"),
    )
    raw = F.unhex("digits")
    bytes_of = stored.select("l_orderkey", "l_linenumber", "l_partkey", raw.alias("amount"), raw.alias("unscaled"))
    return ts.fixed_to_decimal(bytes_of, {"amount": (38, 10), "unscaled": (38, 0)})


@_query("""SELECT o_orderkey, CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS DECIMAL(12,2)) AS o_totalprice
FROM orders""")
def string_to_decimal(spark, sf_dir):
    text = ts.decimal_to_plain_string(_orders(spark, sf_dir)).select("o_orderkey", "o_totalprice")
    return ts.string_to_decimal(text, {"o_totalprice": MONEY})


@_query("""SELECT event_id, epoch_ms(date_trunc('milliseconds', ts)) AS ts, user_id, event_type FROM events""")
def datetime_to_millis(spark, sf_dir):
    return ts.datetime_to_millis(_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))


@_query("""SELECT event_id, date_trunc('milliseconds', ts) AS at_time, CAST(ts AS DATE) AS at_date,
epoch_ms(date_trunc('milliseconds', ts)) % 86400000 AS time_of_day FROM events""")
def millis_to_datetime(spark, sf_dir):
    millis = ts.datetime_to_millis(_table(spark, sf_dir, "events").select("event_id", "ts"))
    copies = [F.col("ts").alias(c) for c in ("at_time", "at_date", "time_of_day")]
    return ts.millis_to_datetime(
        millis.select("event_id", *copies),
        {"at_time": "timestamp_ntz", "at_date": "date", "time_of_day": "time"},
    )


@_query("""SELECT event_id, CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS at_time, CAST(CAST(ts AS VARCHAR) AS DATE) AS at_date
FROM events""")
def string_to_datetime(spark, sf_dir):
    text = F.col("ts").cast("string")
    rows = _table(spark, sf_dir, "events").select("event_id", text.alias("at_time"), text.alias("at_date"))
    return ts.string_to_datetime(rows, {"at_time": "timestamp_ntz", "at_date": "date"})


@_query("""SELECT doc_id, CASE WHEN octet_length(encode(text)) > 1000
THEN 'lob:documents/text/' || CAST(doc_id AS VARCHAR) ELSE text END AS text, lang, source, n_chars FROM documents""")
def lob_inline(spark, sf_dir):
    return ts.lob_inline(_table(spark, sf_dir, "documents"), "doc_id", "text", 1000, "documents")[0]


@_query("""SELECT 'lob:documents/text/' || CAST(doc_id AS VARCHAR) AS reference, text AS payload
FROM documents WHERE octet_length(encode(text)) > 1000""")
def lob_inline_side(spark, sf_dir):
    return ts.lob_inline(_table(spark, sf_dir, "documents"), "doc_id", "text", 1000, "documents")[1]


@_query("""SELECT doc_id, regexp_replace(text, '[\\n\\r\\x01]', '', 'g') AS text,
regexp_replace(lang, '[\\n\\r\\x01]', '', 'g') AS lang,
regexp_replace(source, '[\\n\\r\\x01]', '', 'g') AS source, n_chars FROM documents""")
def drop_delims(spark, sf_dir):
    return ts.drop_delims(_table(spark, sf_dir, "documents"))


# --- checks --------------------------------------------------------------------------------


@_query("SELECT max(o_orderkey) AS max_value FROM orders WHERE o_orderstatus = 'F'")
def max_check_value(spark, sf_dir):
    return ts.max_check_value(_table(spark, sf_dir, "orders"), "o_orderkey", "o_orderstatus = 'F'")


@_query("""SELECT (SELECT count(*) FROM lineitem) AS source_rows, (SELECT count(*) FROM lineitem) AS target_rows,
(SELECT count(*) FROM lineitem) = (SELECT count(*) FROM lineitem) AS ok""")
def validate_counts(spark, sf_dir):
    source, path = _lineitem(spark, sf_dir), ts.shared_dir(spark, "validate-counts")
    ts.write_parquet(source, path)
    return ts.validate_counts(source, ts.parquet_scan(spark, path))


# the amounts are texts of up to 55 digits; their order is that of whole and fractional parts as numbers
@_query("""SELECT max_by(amount, o_totalprice) AS max_value FROM (SELECT CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || repeat('3', 45) AS amount FROM orders WHERE o_orderstatus = 'F') t""")
def max_check_value_wide(spark, sf_dir):
    rows = _wide_amounts(_orders(spark, sf_dir), "o_totalprice", "o_orderkey", "o_orderstatus")
    return ts.max_wide_value(rows, "amount", "o_orderstatus = 'F'")


def _wide_amounts(rows, price, *others):
    text = ts.decimal_to_plain_string(rows.select(*others, price))
    return text.select(*others, F.concat(price, F.lit("3" * 45)).alias("amount"))


_KEY_PROFILE_SQL = """
WITH k AS (SELECT {key} AS k, count(*) AS n FROM {table} GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS rows, count(k) AS distinct_keys,
       CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
       count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS duplicate_keys FROM k"""


@_query(_KEY_PROFILE_SQL.format(key="o_orderkey", table="orders"))
def key_profile(spark, sf_dir):
    return ts.key_profile(_table(spark, sf_dir, "orders"), "o_orderkey")


@_query(_KEY_PROFILE_SQL.format(key="l_orderkey", table="lineitem"))
def key_profile_duplicates(spark, sf_dir):
    return ts.key_profile(_table(spark, sf_dir, "lineitem"), "l_orderkey")


@_query(_KEY_PROFILE_SQL.format(key="nullif(o_custkey, 7)", table="orders"))
def key_profile_nulls(spark, sf_dir):
    key = F.nullif("o_custkey", F.lit(7)).alias("o_custkey")
    return ts.key_profile(_table(spark, sf_dir, "orders").select(key), "o_custkey")


# --- incremental reads ---------------------------------------------------------------------


@_query("SELECT * FROM orders WHERE o_orderkey > 5000 AND o_orderkey <= (SELECT max(o_orderkey) FROM orders)")
def incremental_append(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders")
    upper = ts.max_check_value(rows, "o_orderkey").first()["max_value"]
    return ts.incremental_append(rows, "o_orderkey", 5000, upper)


@_query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-10'")
def incremental_lastmodified(spark, sf_dir):
    return ts.incremental_lastmodified(_table(spark, sf_dir, "events"), "ts", "2024-01-05", datetime(2024, 1, 10))


_CHECKED_SQL = "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS chk FROM orders"


@_query(f"SELECT * FROM ({_CHECKED_SQL}) t WHERE chk IS NULL")
def incremental_null_bound(spark, sf_dir):
    check = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("chk")
    return ts.incremental_null_bound(_table(spark, sf_dir, "orders").select("o_orderkey", check), "chk")


@_query("SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders)")
def incremental_noop(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders")
    upper = ts.max_check_value(rows, "o_orderkey").first()["max_value"]
    nothing = ts.incremental_noop(rows, "o_orderkey", str(upper), upper)
    return ts.incremental_append(rows, "o_orderkey", str(upper), upper) if nothing is None else nothing


@_query("""SELECT event_type AS job, arg_max(event_id, ts) AS last_value, max(ts) AS run_at FROM events GROUP BY 1""")
def incremental_state(spark, sf_dir):
    log = _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job"), F.col("event_id").alias("last_value"), F.col("ts").alias("run_at")
    )
    return ts.latest_state(log)


# --- merges --------------------------------------------------------------------------------


@_query(MERGED_ORDERS_SQL)
def merge_latest(spark, sf_dir):
    return ts.merge_latest(_orders(spark, sf_dir), _orders_batch(spark, sf_dir), "o_orderkey")


@_query(MERGED_LINEITEM_SQL)
def merge_latest_duplicates(spark, sf_dir):
    return ts.merge_latest(
        _lineitem(spark, sf_dir), _lineitem_batch(spark, sf_dir), "l_orderkey", "l_extendedprice"
    )


@_query(MERGED_ORDERS_SQL)
def merge_latest_text_key(spark, sf_dir):
    return ts.merge_latest(
        _orders(spark, sf_dir), _orders_batch(spark, sf_dir), "o_orderkey", key_as_text=True
    )


@_query(f"""
WITH old_rows AS ({ORDERS_SQL}),
n AS (SELECT l_orderkey * 2 AS o_orderkey, l_partkey AS o_custkey, l_linestatus AS o_orderstatus,
        {PRICE} AS o_totalprice, l_shipdate AS o_orderdate, l_returnflag AS o_orderpriority FROM lineitem),
new_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC,
        o_custkey DESC, o_orderstatus DESC, o_totalprice DESC, o_orderpriority DESC) AS rn FROM n) t WHERE rn = 1)
SELECT {ORDERS_COLUMNS} FROM old_rows WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new_rows)
UNION ALL SELECT {ORDERS_COLUMNS} FROM new_rows""")
def merge_latest_old_unique(spark, sf_dir):
    batch = _lineitem(spark, sf_dir).select(
        (F.col("l_orderkey") * 2).alias("o_orderkey"),
        F.col("l_partkey").alias("o_custkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
        F.col("l_returnflag").alias("o_orderpriority"),
    )
    return ts.merge_latest(_orders(spark, sf_dir), batch, "o_orderkey", "o_orderdate", old_is_unique=True)


@_query(MERGED_ORDERS_SQL)
def merge_unique(spark, sf_dir):
    return ts.merge_unique(_orders(spark, sf_dir), _orders_batch(spark, sf_dir), "o_orderkey")


def _changed_orders(spark, sf_dir):
    return _raised(
        ts.incremental_lastmodified(_orders(spark, sf_dir), "o_orderdate", "2001-07-01", "2001-09-01"),
        "o_totalprice",
    )


@_query(CHANGED_ORDERS_SQL)
def merge_unique_changed(spark, sf_dir):
    return ts.merge_unique(_orders(spark, sf_dir), _changed_orders(spark, sf_dir), "o_orderkey")


@_query("SELECT * FROM orders")
def merge_null_key(spark, sf_dir):
    return ts.merge_null_key(_table(spark, sf_dir, "orders"), "o_orderkey")


_WITHOUT_STATUS_SQL = ORDERS_BATCH_SQL.replace("o_orderstatus", "CAST(NULL AS VARCHAR) AS o_orderstatus", 1)


def _batch_without_status(spark, sf_dir):
    batch = _orders_batch(spark, sf_dir).withColumn("clerk", F.col("o_orderpriority"))
    return batch.drop("o_orderstatus").withColumnRenamed("o_custkey", "O_CustKey")


@_query(_WITHOUT_STATUS_SQL)
def merge_to_old_schema(spark, sf_dir):
    return ts.merge_to_old_schema(_batch_without_status(spark, sf_dir), _orders(spark, sf_dir).schema)


@_query(MERGED_ORDERS_SQL.replace(ORDERS_BATCH_SQL, _WITHOUT_STATUS_SQL))
def merge_schema_check(spark, sf_dir):
    old, new = _orders(spark, sf_dir), _batch_without_status(spark, sf_dir)
    ts.merge_schema_check(old.schema, new.schema)
    return ts.merge_latest(old, new, "o_orderkey")


@_query(f"SELECT *, false AS is_new FROM ({ORDERS_SQL}) o UNION ALL SELECT *, true AS is_new FROM ({ORDERS_BATCH_SQL}) n")
def tag_origin(spark, sf_dir):
    return ts.tag_origin(_orders(spark, sf_dir), _orders_batch(spark, sf_dir))


@_query(f"SELECT *, false AS is_new FROM ({ORDERS_SQL}) o UNION ALL SELECT *, true AS is_new FROM ({ORDERS_BATCH_SQL}) n")
def tag_origin_by_path(spark, sf_dir):
    base = ts.shared_dir(spark, "tag-origin")
    ts.write_parquet(_orders(spark, sf_dir), f"{base}/orders_old")
    ts.write_parquet(_orders_batch(spark, sf_dir), f"{base}/orders")
    both = spark.read.parquet(f"{base}/orders_old", f"{base}/orders")
    return ts.tag_origin_by_path(both, f"{base}/orders_old", f"{base}/orders")


@_query(f"{ORDERS_SQL} UNION ALL {ORDERS_BATCH_SQL}")
def append_rows(spark, sf_dir):
    return ts.append_rows(_orders(spark, sf_dir), _orders_batch(spark, sf_dir))


_UPSERT_SQL = """
WITH t AS (SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal FROM customer),
b AS (SELECT c_custkey * 2 AS c_custkey, CAST(c_acctbal + 1 AS DECIMAL(12,2)) AS c_acctbal FROM t)
SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey, t.c_name,
       CASE WHEN b.c_custkey IS NOT NULL THEN b.c_acctbal ELSE t.c_acctbal END AS c_acctbal
FROM t FULL OUTER JOIN b ON t.c_custkey = b.c_custkey"""


def _upsert_sides(spark, sf_dir):
    target = ts.decimal_typed(_table(spark, sf_dir, "customer"), {"c_acctbal": MONEY}).select(
        "c_custkey", "c_name", "c_acctbal"
    )
    return target, _raised(target, "c_acctbal").select((F.col("c_custkey") * 2).alias("c_custkey"), "c_acctbal")


@_query(_UPSERT_SQL)
def upsert_rows(spark, sf_dir):
    return ts.upsert_rows(*_upsert_sides(spark, sf_dir), "c_custkey")


@_query(_UPSERT_SQL)
def upsert_rows_small_batch(spark, sf_dir):
    return ts.upsert_rows(*_upsert_sides(spark, sf_dir), "c_custkey", small_batch=True)


# the batch repeats keys (line items per order) and has other columns than the target
@_query(f"""
WITH t AS ({ORDERS_SQL}),
r AS (SELECT l_orderkey * 2 AS k, {PRICE} AS price, l_shipdate AS shipped,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, {PRICE} DESC) AS rn FROM lineitem),
b AS (SELECT * FROM r WHERE rn = 1)
SELECT coalesce(o_orderkey, k) AS o_orderkey, o_custkey, o_orderstatus, coalesce(price, o_totalprice) AS o_totalprice,
       coalesce(shipped, o_orderdate) AS o_orderdate, o_orderpriority
FROM t FULL OUTER JOIN b ON o_orderkey = k""")
def upsert_rows_duplicates(spark, sf_dir):
    batch = _lineitem(spark, sf_dir).select(
        (F.col("l_orderkey") * 2).alias("o_orderkey"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
    )
    return ts.upsert_rows(_orders(spark, sf_dir), batch, "o_orderkey", "o_orderdate")


# a key's rows are told apart by a number in text alone: 9.5 is less than 10.5
@_query(f"""
WITH w AS (SELECT l_orderkey, l_linenumber, {PRICE} AS price, CAST({PRICE} AS VARCHAR) || repeat('3', 45) AS amount FROM lineitem),
u AS (SELECT *, 0 AS is_new FROM w UNION ALL SELECT l_orderkey * 2, l_linenumber, price, amount, 1 FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY is_new DESC, price DESC, l_linenumber DESC) AS rn FROM u)
SELECT l_orderkey, l_linenumber, amount FROM r WHERE rn = 1""")
def merge_latest_wide_decimal(spark, sf_dir):
    old = _wide_amounts(_lineitem(spark, sf_dir), "l_extendedprice", "l_orderkey", "l_linenumber")
    new = old.withColumn("l_orderkey", F.col("l_orderkey") * 2)
    return ts.merge_latest(old, new, "l_orderkey", "amount", wide_decimals=["amount"])


@_query(CHANGED_ORDERS_SQL)
def merge_touched_files(spark, sf_dir):
    """Orders laid out by date and key; a batch of two months rewrites the files that hold them."""
    path = ts.shared_dir(spark, "touched-files")
    ts.write_parquet(_orders(spark, sf_dir).repartitionByRange(32, "o_orderdate", "o_orderkey"), path)
    ts.merge_touched(spark, path, _changed_orders(spark, sf_dir), "o_orderkey")
    return ts.parquet_scan(spark, path)


# every key doubled: half the batch replaces rows, and most of these move to the status of another order
@_query(MERGED_ORDERS_SQL)
def merge_partitioned(spark, sf_dir):
    path = ts.shared_dir(spark, "merge-partitioned")
    ts.write_parquet(_orders(spark, sf_dir).repartitionByRange(8, "o_orderkey"), path, partition_by=["o_orderstatus"])
    ts.merge_touched(spark, path, _orders_batch(spark, sf_dir), "o_orderkey")
    return ts.parquet_scan(spark, path)


@_query(MERGED_ORDERS_SQL)
def merge_catalog_bucketed(spark, sf_dir):
    name, path = f"merged_{uuid4().hex}", ts.shared_dir(spark, "merge-catalog")
    ts.write_table(_orders(spark, sf_dir), name, path=path, bucket_by=(8, ["o_orderkey"]))
    ts.merge_table(spark, name, _orders_batch(spark, sf_dir), "o_orderkey")
    return spark.table(name)


# --- sinks ---------------------------------------------------------------------------------


@_query(LINEITEM_SQL)
def write_parquet(spark, sf_dir):
    path = ts.shared_dir(spark, "write-parquet")
    ts.write_parquet(_lineitem(spark, sf_dir), path, codec="zstd", fixed_layout=True)
    return ts.parquet_scan(spark, path)


@_query("SELECT doc_id, text, lang, source, n_chars, CAST(n_chars / 100 AS DECIMAL(20,10)) AS share FROM documents")
def write_text(spark, sf_dir):
    share = (F.col("n_chars").cast("decimal(20,2)") / 100).cast("decimal(20,10)")
    rows = _table(spark, sf_dir, "documents").withColumn("share", share)
    path = ts.shared_dir(spark, "write-text")
    ts.write_text(rows, path, codec="gzip")
    return ts.read_text(spark, path, rows.schema)


@_query(ORDERS_SQL)
def write_table(spark, sf_dir):
    name = f"orders_{uuid4().hex}"
    path = ts.shared_dir(spark, "write-table")
    ts.write_table(_orders(spark, sf_dir), name, path=path, bucket_by=(8, ["o_orderkey"]))
    return spark.table(name)


@_query(ORDERS_BATCH_SQL)
def write_overwrite(spark, sf_dir):
    path = ts.shared_dir(spark, "write-overwrite")
    ts.write_overwrite(_orders(spark, sf_dir), path)
    ts.write_overwrite(_orders_batch(spark, sf_dir), path)
    return ts.parquet_scan(spark, path)


@_query(MERGED_ORDERS_SQL)
def swap_into_place(spark, sf_dir):
    base = ts.shared_dir(spark, "swap")
    ts.write_parquet(_orders(spark, sf_dir), f"{base}/orders")
    ts.write_parquet(_orders_batch(spark, sf_dir), f"{base}/batch")
    ts.merge_paths(spark, f"{base}/orders", f"{base}/batch", "o_orderkey")
    return ts.parquet_scan(spark, f"{base}/orders")


@_query(MERGED_ORDERS_SQL)
def merge_text_files(spark, sf_dir):
    base, rows = ts.shared_dir(spark, "merge-text"), _orders(spark, sf_dir)
    ts.write_text(rows, f"{base}/orders")
    ts.write_text(_orders_batch(spark, sf_dir), f"{base}/batch")
    ts.merge_paths(spark, f"{base}/orders", f"{base}/batch", "o_orderkey", "text", schema=rows.schema)
    return ts.read_text(spark, f"{base}/orders", rows.schema)


@_query(f"{ORDERS_SQL} UNION ALL {ORDERS_BATCH_SQL}")
def export_table(spark, sf_dir):
    target, path = f"exported_{uuid4().hex}", ts.shared_dir(spark, "export-table")
    ts.write_table(_orders(spark, sf_dir), target, path=path)
    ts.export_table(_orders_batch(spark, sf_dir), target, f"{target}_staging")
    return spark.table(target)


# --- whole imports -------------------------------------------------------------------------


@_query(LINEITEM_SQL)
def import_table(spark, sf_dir):
    target = ts.shared_dir(spark, "import-table")
    rates = {"l_discount": (4, 2), "l_tax": (4, 2)}
    job = ts.ImportJob(
        source=f"{sf_dir}/lineitem.parquet",
        target_dir=target,
        layout="parquet",
        decimals={"l_quantity": MONEY, "l_extendedprice": MONEY, **rates},
        validate=True,
    )
    ts.run_import(spark, job)
    return ts.parquet_scan(spark, target)


@_query("""SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, c_name AS "AVRO_1st_name"
FROM orders JOIN customer ON o_custkey = c_custkey""")
def import_query(spark, sf_dir):
    target = ts.shared_dir(spark, "import-query")
    job = ts.ImportJob(
        query="""SELECT o.o_orderkey, o.o_totalprice, c.c_name AS `1st name`
                 FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey WHERE $CONDITIONS""",
        tables={name: _table(spark, sf_dir, name) for name in ("orders", "customer")},
        target_dir=target,
        layout="parquet",
        decimals={"o_totalprice": MONEY},
        overwrite=True,
    )
    ts.run_import(spark, job)
    return ts.parquet_scan(spark, target)


@_query(f"""{ORDERS_SQL} UNION ALL
SELECT * FROM ({ORDERS_BATCH_SQL}) b WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders)""")
def import_append(spark, sf_dir):
    """Two runs; the second starts where the first one's saved state ends."""
    base = ts.shared_dir(spark, "import-append")
    rows = _orders(spark, sf_dir)
    job = ts.ImportJob(
        source=rows,
        target_dir=f"{base}/orders",
        layout="parquet",
        incremental="append",
        check_column="o_orderkey",
        job="orders",
        state_path=f"{base}/state",
    )
    ts.run_import(spark, job)
    ts.run_import(spark, replace(job, source=ts.append_rows(rows, _orders_batch(spark, sf_dir))))
    return ts.parquet_scan(spark, f"{base}/orders")


@_query(CHANGED_ORDERS_SQL)
def import_lastmodified(spark, sf_dir):
    target = ts.shared_dir(spark, "import-lastmodified")
    ts.write_parquet(_orders(spark, sf_dir), target)
    job = ts.ImportJob(
        source=_raised(_orders(spark, sf_dir), "o_totalprice"),
        target_dir=target,
        layout="parquet",
        incremental="lastmodified",
        check_column="o_orderdate",
        last_value="2001-07-01",
        now=datetime(2001, 9, 1),
        merge_key="o_orderkey",
        old_is_unique=True,
    )
    ts.run_import(spark, job)
    return ts.parquet_scan(spark, target)


def _import_documents(spark, sf_dir):
    target = ts.shared_dir(spark, "import-lob")
    job = ts.ImportJob(
        source=f"{sf_dir}/documents.parquet",
        name="documents",
        target_dir=target,
        layout="parquet",
        lobs={"text": 1000},
        lob_key="doc_id",
    )
    ts.run_import(spark, job)
    return target


@_query("""SELECT doc_id, CASE WHEN octet_length(encode(text)) > 1000
THEN 'lob:documents/text/' || CAST(doc_id AS VARCHAR) ELSE text END AS text, lang, source, n_chars FROM documents""")
def import_lob(spark, sf_dir):
    return ts.parquet_scan(spark, _import_documents(spark, sf_dir))


@_query("""SELECT 'lob:documents/text/' || CAST(doc_id AS VARCHAR) AS reference, text AS payload
FROM documents WHERE octet_length(encode(text)) > 1000""")
def import_lob_side(spark, sf_dir):
    return ts.read_lobs(spark, _import_documents(spark, sf_dir), "doc_id", "text", "documents")


@_query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice, o_orderstatus FROM orders""")
def import_decimal_text(spark, sf_dir):
    target = ts.shared_dir(spark, "import-decimal-text")
    job = ts.ImportJob(
        source=f"{sf_dir}/orders.parquet",
        columns="o_orderkey, o_totalprice, o_orderstatus",
        target_dir=target,
        layout="parquet",
        decimals={"o_totalprice": MONEY},
        decimals_as_text="plain",
    )
    ts.run_import(spark, job)
    return ts.parquet_scan(spark, target)


@_query("""SELECT event_id, epoch_ms(date_trunc('milliseconds', ts)) AS ts, user_id FROM events""")
def import_millis(spark, sf_dir):
    target = ts.shared_dir(spark, "import-millis")
    job = ts.ImportJob(
        source=f"{sf_dir}/events.parquet",
        columns="event_id, ts, user_id",
        target_dir=target,
        layout="parquet",
        dates_as_millis=True,
    )
    ts.run_import(spark, job)
    return ts.parquet_scan(spark, target)


# --- driver contract -----------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Merge a batch into the orders table: one row per key, new rows win."""
    return merge_latest(spark, f"{TESTDATA}/sf0.001")


def _llm() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    """The queries of the ``llm`` subpackage and its pipeline, where they are installed."""
    names = ("corpus_pipeline", "tablesync.llm", "tablesync.llm.queries")
    if not all(find_spec(name) for name in names):  # in this order: a name is looked up inside the one before
        return {}
    import corpus_pipeline
    from tablesync.llm.queries import QUERIES

    return {**QUERIES, "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in {**REGISTRY, **_llm()}.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in {**REGISTRY, **_llm()}.items() if sql is not None}
