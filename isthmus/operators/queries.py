"""Every query of the bridge by name: a function of (spark, folder of tables), and its SQL."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isthmus.functions import numeric, temporal
from isthmus.operators import checks
from isthmus.plans import predicates as P
from isthmus.plans import units as U
from isthmus.plans.scan import scan
from isthmus.sources.catalog import Catalog
from isthmus.sources.datasource import NAME, register
from isthmus.sources.names import unique_names
from isthmus.sources.scratch import new_folder
from isthmus.sources.tables import ParquetSide
from isthmus.sources.types import RemoteColumn
from isthmus.sources.writer import create, load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return put


def rows(spark: SparkSession, d: str, table: str, columns: list[str] | None = None, where: P.Term | None = None, **options) -> DataFrame:
    return scan(ParquetSide(spark, d), f'"{table}"', columns, where, **options)[0]


def filters(name: str, table: str, columns: str, where: P.Term, condition: str) -> None:
    """A query of one filter."""
    cols = columns.split(", ")
    QUERIES[name] = lambda spark, d: rows(spark, d, table, cols, where)
    SQL[name] = f"SELECT {columns} FROM {table} WHERE {condition}"


C, LI = P.Compare, "l_orderkey, l_linenumber, l_quantity"
filters("filter_eq", "orders", "o_orderkey, o_orderstatus", C("o_orderstatus", "=", "F"), "o_orderstatus = 'F'")
filters("filter_ne", "orders", "o_orderkey, o_orderstatus", C("o_orderstatus", "<>", "F"), "o_orderstatus <> 'F'")
filters("filter_range", "lineitem", LI, C("l_quantity", ">", 30.0) & C("l_quantity", "<=", 40.0), "l_quantity > 30 AND l_quantity <= 40")
filters("filter_between", "lineitem", LI, P.between("l_orderkey", 100, 900), "l_orderkey BETWEEN 100 AND 900")
filters("filter_in", "lineitem", LI, P.In("l_linenumber", (1, 3, 5)), "l_linenumber IN (1, 3, 5)")
filters("filter_flip", "lineitem", LI, C.flipped(10.0, ">=", "l_quantity"), "10 >= l_quantity")
filters("filter_and_or", "orders", "o_orderkey, o_totalprice", (C("o_orderstatus", "=", "O") | C("o_orderstatus", "=", "P")) & C("o_orderkey", "<", 5000), "(o_orderstatus = 'O' OR o_orderstatus = 'P') AND o_orderkey < 5000")
filters("filter_partial", "orders", "o_orderkey, o_orderpriority", C("o_orderkey", ">=", 1000) & P.Local("o_orderpriority LIKE '%1%'"), "o_orderkey >= 1000 AND o_orderpriority LIKE '%1%'")
filters("filter_date_eq", "events", "event_id, event_type", P.OnDate("ts", date(2024, 1, 5)), "CAST(ts AS DATE) = DATE '2024-01-05'")
filters("filter_timestamp_us", "events", "event_id, event_type", C("ts", ">=", datetime(2024, 1, 10, 1, 2, 3, 456789)), "ts >= TIMESTAMP '2024-01-10 01:02:03.456789'")
filters("filter_string_range", "customer", "c_custkey, c_name", C("c_mktsegment", ">", "B") & C("c_mktsegment", "<=", "H"), "c_mktsegment > 'B' AND c_mktsegment <= 'H'")
filters("filter_trailing_blank", "nation", "n_nationkey, n_name", C("n_name", "<>", "NATION_1 "), "n_name <> 'NATION_1 '")
filters("filter_empty_string", "documents", "doc_id, lang", C("lang", "<>", ""), "lang <> ''")
filters("filter_like", "part", "p_partkey, p_type", P.Local("p_type LIKE '%A%'"), "p_type LIKE '%A%'")
filters("filter_not_in", "part", "p_partkey, p_size", P.Local("p_size NOT IN (1, 2, 3)"), "p_size NOT IN (1, 2, 3)")
filters("filter_distinct_from", "part", "p_partkey, p_size", P.Local("NOT (p_size <=> 7)"), "p_size IS DISTINCT FROM 7")
filters("filter_function", "part", "p_partkey, p_name", P.Local("length(p_name) % 2 = 0"), "length(p_name) % 2 = 0")
filters("filter_is_not_null", "orders", "o_orderkey, o_custkey", P.IsNull("o_custkey", True), "o_custkey IS NOT NULL")


def named(spark: SparkSession, d: str, table: str, columns: str, **options: str) -> DataFrame:
    """A table through the format that Spark can name."""
    register(spark)
    return spark.read.format(NAME).options(folder=d, table=f'"{table}"', columns=columns, **options).load()


@query("SELECT event_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-07' AND event_type = 'click'")
def partition_prune(spark: SparkSession, d: str) -> DataFrame:
    """From a copy whose folders are days: the plan reads one of them."""
    place = new_folder(spark, "days")
    rows(spark, d, "events", ["event_id", "value", "event_type", "ts"]).withColumn("day", F.to_date("ts")).drop("ts").repartition("day").write.partitionBy("day").parquet(f"{place}/events.parquet")
    where = P.Local("day = DATE '2024-01-07'") & C("event_type", "=", "click")
    return rows(spark, place, "events", ["event_id", "value"], where)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_projection(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])


@query("SELECT count(*) AS n FROM lineitem")
def scan_count_star(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "lineitem", []).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 11 = 0")
def filter_is_null(spark: SparkSession, d: str) -> DataFrame:
    """From a copy that has nulls, as the tables have none."""
    place = new_folder(spark, "nulls")
    df = rows(spark, d, "lineitem", ["l_orderkey", "l_linenumber"])
    df.withColumn("x", F.when(F.col("l_orderkey") % 11 != 0, F.col("l_linenumber"))).write.parquet(f"{place}/t.parquet")
    return rows(spark, place, "t", ["l_orderkey", "l_linenumber"], P.IsNull("x"))


DISCOUNT = {(None, "lineitem"): (RemoteColumn("l_discount", "NUMBER", 22, 4, 2), RemoteColumn("l_extendedprice", "NUMBER"), RemoteColumn("l_tax", "NUMBER"))}


@query("SELECT l_orderkey, l_linenumber, CAST(l_discount AS DECIMAL(4,2)) AS discount FROM lineitem WHERE CAST(l_discount AS DECIMAL(4,2)) >= 0.05")
def filter_decimal(spark: SparkSession, d: str) -> DataFrame:
    """A column declared NUMBER(4,2), compared with a decimal."""
    df = scan(ParquetSide(spark, d, declared=DISCOUNT), '"lineitem"', ["l_orderkey", "l_linenumber", "l_discount"], C("l_discount", ">=", Decimal("0.05")))[0]
    return df.withColumnRenamed("l_discount", "discount")


@query("SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(20,1)) AS p FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice FROM lineitem)")
def types_unconstrained_decimal(spark: SparkSession, d: str) -> DataFrame:
    """A NUMBER without precision as DECIMAL(20,1), half away from zero."""
    df = scan(ParquetSide(spark, d, declared=DISCOUNT), '"lineitem"', ["l_orderkey", "l_linenumber", "l_extendedprice"], unconstrained_number="DECIMAL(20,1)")[0]
    return df.withColumnRenamed("l_extendedprice", "p")


@query("SELECT o_orderkey FROM orders WHERE o_custkey = 7 OR o_custkey = 70")
def filter_param(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "orders", ["o_orderkey", "o_custkey"])
    run = lambda v: spark.sql("SELECT o_orderkey FROM {t} WHERE o_custkey = :v", {"v": v}, t=df)
    return run(7).unionAll(run(70))


@query("SELECT event_id FROM events WHERE event_type = 'view' AND value > 50")
def view_pushdown(spark: SparkSession, d: str) -> DataFrame:
    rows(spark, d, "events", ["event_id", "event_type", "value"]).createOrReplaceTempView("isthmus_events")
    return spark.sql("SELECT event_id FROM isthmus_events WHERE event_type = 'view' AND value > 50")


def _split(split: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        if split == "hash":  # files are read once, and their rows dealt
            return rows(spark, d, "lineitem", LI.split(", "), n_sessions=4, split=split)
        return named(spark, d, "lineitem", LI, sessions="4", split=split)

    return run


for _s in ("none", "hash", "extents"):
    QUERIES[f"split_{_s}"], SQL[f"split_{_s}"] = _split(_s), f"SELECT {LI} FROM lineitem"


@query("SELECT count(*) AS n, count(DISTINCT l_orderkey) AS keys, 4 AS units FROM lineitem")
def split_bucket(spark: SparkSession, d: str) -> DataFrame:
    """The four buckets of the hash split hold every row once."""
    df = rows(spark, d, "lineitem", ["l_orderkey"])
    unit = F.coalesce(*(F.when(U.bucket(["l_orderkey"], k, 4), F.lit(k)) for k in range(4)))
    each = df.groupBy(unit.alias("k")).agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("keys"))
    return each.agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"), F.count("*").cast("int").alias("units"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def source_filter(spark: SparkSession, d: str) -> DataFrame:
    """Filters that Spark pushes to the named format."""
    return named(spark, d, "orders", "o_orderkey, o_totalprice, o_orderstatus").filter("o_orderstatus = 'F' AND o_totalprice > 100000").drop("o_orderstatus")


@query("SELECT event_id FROM events WHERE event_type = 'view' OR value < 5")
def source_where(spark: SparkSession, d: str) -> DataFrame:
    """OR is not offered to a Python source, so it is given as an option."""
    return named(spark, d, "events", "event_id", where="event_type = 'view' OR value < 5")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def source_sql(spark: SparkSession, d: str) -> DataFrame:
    """The format in SQL, as a view."""
    register(spark)
    named(spark, d, "events", "event_type").createOrReplaceTempView("isthmus_source")
    return spark.sql("SELECT event_type, count(*) AS n FROM isthmus_source GROUP BY 1")


@query("SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS SMALLINT) AS s, CAST(l_quantity AS INTEGER) AS i FROM lineitem")
def types_integer(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    return df.select("l_orderkey", "l_linenumber", F.col("l_linenumber").cast("smallint").alias("s"), F.col("l_quantity").cast("int").alias("i"))


@query("SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(15,2)) AS p, CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)), 1) AS DECIMAL(15,1)) AS r FROM lineitem")
def types_decimal(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice"])
    p = F.col("l_extendedprice").cast("decimal(15,2)")
    return df.select("l_orderkey", "l_linenumber", p.alias("p"), numeric.half_away(p, 15, 1).alias("r"))


@query("SELECT l_orderkey, l_linenumber, regexp_replace(regexp_replace(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR), '0+$', ''), '\\.$', '') AS t FROM lineitem")
def types_unconstrained_text(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice"])
    return df.select("l_orderkey", "l_linenumber", numeric.canonical_text(F.col("l_extendedprice").cast("decimal(15,2)")).alias("t"))


@query("SELECT event_id, date_trunc('second', ts) AS s FROM events")
def types_date_trunc(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "events", ["event_id", "ts"]).select("event_id", temporal.whole_seconds(F.col("ts")).alias("s"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t FROM events")
def types_timestamp_text(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "events", ["event_id", "ts"]).select("event_id", temporal.text_of(F.col("ts")).alias("t"))


@query("SELECT event_id, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS days FROM events")
def types_unix_days(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "events", ["event_id", "ts"]).select("event_id", temporal.days(F.col("ts")).alias("days"))


@query("SELECT n_nationkey, rpad(n_name, 20, ' ') AS padded FROM nation")
def types_char_pad(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "nation", ["n_nationkey", "n_name"]).select("n_nationkey", F.rpad("n_name", 20, " ").alias("padded"))


@query("SELECT doc_id, upper(md5(text)) AS h FROM documents")
def types_binary_hex(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "documents", ["doc_id", "text"]).select("doc_id", F.hex(F.unhex(F.md5("text"))).alias("h"))


@query("SELECT c_custkey, n_name, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_inner(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "customer").join(rows(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "c_acctbal")


@query("SELECT k, o_totalprice, c_name FROM (SELECT o_custkey AS k, o_totalprice FROM orders) JOIN (SELECT c_custkey AS k, c_name FROM customer) USING (k)")
def join_using(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_totalprice").join(rows(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name"), ["k"])


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 12)")
def join_semi(spark: SparkSession, d: str) -> DataFrame:
    busy = rows(spark, d, "orders", ["o_custkey"]).groupBy("o_custkey").count().filter("count > 12")
    return rows(spark, d, "customer", ["c_custkey"]).join(busy, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def join_anti(spark: SparkSession, d: str) -> DataFrame:
    dear = rows(spark, d, "orders", ["o_custkey"], C("o_totalprice", ">", 400000.0))
    return rows(spark, d, "customer", ["c_custkey"]).join(dear, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def join_left(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "customer", ["c_custkey"]).join(rows(spark, d, "orders", ["o_custkey", "o_orderkey"]), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query("SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def join_self(spark: SparkSession, d: str) -> DataFrame:
    a, b = rows(spark, d, "nation").alias("a"), rows(spark, d, "nation").alias("b")
    return a.join(b, F.expr("a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey")).select(F.col("a.n_name").alias("a"), F.col("b.n_name").alias("b"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS s, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1, 2")
def agg_basic(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_extendedprice", "l_quantity"])
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast("decimal(38,2)").alias("s"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))


@query("SELECT l_returnflag, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1")
def agg_distinct(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "lineitem", ["l_returnflag", "l_suppkey"]).groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("n"))


@query("SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 100000) AS n FROM orders GROUP BY 1")
def agg_filter(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", ["o_orderstatus", "o_totalprice"]).groupBy("o_orderstatus").agg(F.count_if(F.col("o_totalprice") > 100000).alias("n"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10")
def agg_having(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", ["o_custkey"]).groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 10")


@query("SELECT p_brand, bool_and(p_size > 1) AS b FROM part GROUP BY 1")
def agg_bool(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "part", ["p_brand", "p_size"]).groupBy("p_brand").agg(F.bool_and(F.col("p_size") > 1).alias("b"))


@query("SELECT n_regionkey, array_to_string(list(n_name ORDER BY n_name), ',') AS names FROM nation GROUP BY 1")
def agg_list_sorted(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "nation", ["n_regionkey", "n_name"]).groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey IS NULL) AS o_orderkey_nulls, CAST(sum(o_orderkey) AS DECIMAL(38,4)) AS o_orderkey_sum, count(*) FILTER (o_orderdate IS NULL) AS o_orderdate_nulls, CAST(sum(epoch_us(o_orderdate)) AS DECIMAL(38,0)) AS o_orderdate_sum, count(*) FILTER (o_orderpriority IS NULL) AS o_orderpriority_nulls, CAST(sum(length(o_orderpriority)) AS BIGINT) AS o_orderpriority_sum FROM orders")
def agg_checksum(spark: SparkSession, d: str) -> DataFrame:
    return checks.checksum(rows(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"]))


@query("SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS n FROM events")
def window_partition_count(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "events", ["event_id", "event_type"]).withColumn("n", F.count("*").over(Window.partitionBy("event_type")))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topn(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", ["o_orderkey", "o_totalprice"]).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT n_name AS x FROM nation UNION ALL SELECT r_name FROM region")
def set_union_all(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "nation").select(F.col("n_name").alias("x")).unionAll(rows(spark, d, "region").select("r_name"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(rows(spark, d, "orders", ["o_custkey"], C("o_totalprice", ">", 400000.0)))


@query("SELECT k FROM ((SELECT n_nationkey AS k FROM nation EXCEPT SELECT r_regionkey FROM region) UNION ALL (SELECT r_regionkey FROM region EXCEPT SELECT n_nationkey FROM nation))")
def set_symmetric_difference(spark: SparkSession, d: str) -> DataFrame:
    return checks.difference(rows(spark, d, "nation").select(F.col("n_nationkey").alias("k")), rows(spark, d, "region").select(F.col("r_regionkey").alias("k")), duplicates=False)


@query("SELECT event_id FROM events WHERE value > (SELECT max(value) * 0.9 FROM events WHERE event_type = 'view')")
def subquery_scalar(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql("SELECT event_id FROM {e} WHERE value > (SELECT max(value) * 0.9D FROM {e} WHERE event_type = 'view')", e=rows(spark, d, "events", ["event_id", "event_type", "value"]))


@query("WITH e AS (SELECT user_id, event_type FROM events) SELECT user_id, 'v' AS w FROM e WHERE event_type = 'view' UNION ALL SELECT user_id, 'c' FROM e WHERE event_type = 'click'")
def cte_reuse(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql("WITH e AS (SELECT user_id, event_type FROM {t}) SELECT user_id, 'v' AS w FROM e WHERE event_type = 'view' UNION ALL SELECT user_id, 'c' FROM e WHERE event_type = 'click'", t=rows(spark, d, "events", ["user_id", "event_type"]))


@query("SELECT n_name, r_name FROM region LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 7) ON n_regionkey = r_regionkey")
def join_right(spark: SparkSession, d: str) -> DataFrame:
    few = rows(spark, d, "nation", where=C("n_nationkey", "<", 7))
    return few.join(rows(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "right").select("n_name", "r_name")


@query("SELECT n_nationkey, r_regionkey FROM (SELECT * FROM nation WHERE n_nationkey BETWEEN 3 AND 9) FULL JOIN region ON n_nationkey = r_regionkey")
def join_full(spark: SparkSession, d: str) -> DataFrame:
    some = rows(spark, d, "nation", ["n_nationkey"], P.between("n_nationkey", 3, 9))
    return some.join(rows(spark, d, "region", ["r_regionkey"]), F.col("n_nationkey") == F.col("r_regionkey"), "full")


@query("SELECT a.r_name AS a, b.r_name AS b FROM region a CROSS JOIN region b")
def join_cross(spark: SparkSession, d: str) -> DataFrame:
    """Of a table whose size is checked: twenty rows at most are multiplied."""
    few = rows(spark, d, "region", ["r_name"]).limit(20)
    return few.select(F.col("r_name").alias("a")).crossJoin(few.select(F.col("r_name").alias("b")))


@query("SELECT event_id, b.k FROM events JOIN (SELECT range AS k, range * 10.0 AS low, range * 10.0 + 10 AS high FROM range(10)) b ON value >= low AND value < high")
def join_range(spark: SparkSession, d: str) -> DataFrame:
    """Bands are met by their number, so the range condition is an equality and a check: no pair outside a band is made."""
    bands = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 10.0).alias("low"), (F.col("id") * 10.0 + 10).alias("high"))
    df = rows(spark, d, "events", ["event_id", "value"]).withColumn("k", F.floor(F.col("value") / 10).cast("long"))
    return df.join(bands, "k").filter("value >= low AND value < high").select("event_id", "k")


@query("SELECT a.event_id, b.event_id AS before FROM (SELECT * FROM events WHERE event_type = 'click') a ASOF LEFT JOIN (SELECT user_id, ts, min(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) b ON a.user_id = b.user_id AND a.ts >= b.ts")
def join_asof(spark: SparkSession, d: str) -> DataFrame:
    """Each click with the user's latest view up to it: one window over the union of both, partitioned by the user."""
    e = rows(spark, d, "events", ["event_id", "user_id", "ts", "event_type"])
    views = e.filter("event_type = 'view'").groupBy("user_id", "ts").agg(F.min("event_id").alias("event_id"))
    both = views.select("user_id", "ts", F.lit(0).alias("kind"), "event_id").unionAll(e.filter("event_type = 'click'").select("user_id", "ts", F.lit(1).alias("kind"), "event_id"))
    order = Window.partitionBy("user_id").orderBy("ts", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("kind") == 0, F.col("event_id")), ignorenulls=True).over(order)
    return both.withColumn("before", last).filter("kind = 1").select("event_id", "before")


@query("SELECT c_custkey, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY 1")
def join_two_catalogs(spark: SparkSession, d: str) -> DataFrame:
    """Tables of two attached catalogs, each with its own side and options."""
    one, two = Catalog(ParquetSide(spark, d)), Catalog(ParquetSide(spark, d), n_sessions=4, split="extents")
    orders = two.table('"orders"', ["o_custkey"], C("o_orderstatus", "=", "F"))
    return one.table('"customer"', ["c_custkey"]).join(orders, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag)::int AS g1, grouping(l_linestatus)::int AS g2 FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())")
def agg_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag) AS INT) AS g1, CAST(grouping(l_linestatus) AS INT) AS g2 FROM {t} GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())", t=rows(spark, d, "lineitem", ["l_returnflag", "l_linestatus"]))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def agg_cube(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", ["o_orderstatus", "o_orderpriority"]).cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, max(o_totalprice) AS top FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def agg_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", ["o_orderstatus", "o_orderpriority", "o_totalprice"]).rollup("o_orderstatus", "o_orderpriority").agg(F.max("o_totalprice").alias("top"))


@query("SELECT l_returnflag, abs(approx_count_distinct(l_orderkey) - count(DISTINCT l_orderkey)) <= 0.15 * count(DISTINCT l_orderkey) AS near FROM lineitem GROUP BY 1")
def agg_approximate(spark: SparkSession, d: str) -> DataFrame:
    """Approximate counts lie by the exact ones; both sides tell that, not their own estimates."""
    exact = F.count_distinct("l_orderkey")
    return rows(spark, d, "lineitem", ["l_returnflag", "l_orderkey"]).groupBy("l_returnflag").agg((F.abs(F.approx_count_distinct("l_orderkey", 0.02) - exact) <= F.lit(0.15) * exact).alias("near"))


@query("SELECT o_orderstatus, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities FROM orders GROUP BY 1")
def agg_list_distinct(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", ["o_orderstatus", "o_orderpriority"]).groupBy("o_orderstatus").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))


@query("SELECT count(*) AS n, bool_and(o_orderstatus = 'F' AND o_totalprice > 1000) AS ok FROM (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000 LIMIT 50)")
def limit_stable(spark: SparkSession, d: str) -> DataFrame:
    """A limit without an order: which rows may differ, how many and that the filter holds may not."""
    df = rows(spark, d, "orders", ["o_orderstatus", "o_totalprice"], C("o_orderstatus", "=", "F") & C("o_totalprice", ">", 1000.0))
    return df.limit(50).agg(F.count("*").alias("n"), F.bool_and((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000)).alias("ok"))


@query("WITH c AS NOT MATERIALIZED (SELECT * FROM events) SELECT (SELECT count(*) FROM c WHERE event_type = 'view') AS x, (SELECT max(event_id) FROM c WHERE event_type = 'click') AS y")
def cte_not_materialized(spark: SparkSession, d: str) -> DataFrame:
    """Spark puts a common table where it is used, so each use keeps its own filter."""
    return spark.sql("WITH c AS (SELECT * FROM {t}) SELECT (SELECT count(*) FROM c WHERE event_type = 'view') AS x, (SELECT max(event_id) FROM c WHERE event_type = 'click') AS y", t=rows(spark, d, "events", ["event_id", "event_type"]))


@query("WITH c AS (SELECT * FROM orders) (SELECT o_orderkey AS k FROM c WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 3) UNION ALL (SELECT o_orderkey FROM c WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 3)")
def cte_limit_union(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql("WITH c AS (SELECT * FROM {t}) (SELECT o_orderkey AS k FROM c WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 3) UNION ALL (SELECT o_orderkey FROM c WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 3)", t=rows(spark, d, "orders", ["o_orderkey", "o_orderstatus"]))


@query("WITH a AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT x.event_type, x.n, y.n AS most FROM a x, (SELECT max(n) AS n FROM a) y")
def agg_reuse(spark: SparkSession, d: str) -> DataFrame:
    """One aggregate used twice: equal scans share their exchange."""
    return spark.sql("WITH a AS (SELECT event_type, count(*) AS n FROM {t} GROUP BY 1) SELECT x.event_type, x.n, y.n AS most FROM a x, (SELECT max(n) AS n FROM a) y", t=rows(spark, d, "events", ["event_type"]))


@query("SELECT event_id, make_timestamp(epoch_us(ts)) AS t, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day, CAST(epoch_us(ts) % 86400000000 AS BIGINT) AS us FROM events")
def types_make_timestamp(spark: SparkSession, d: str) -> DataFrame:
    us = temporal.as_micros(F.col("ts"))
    day, rest = temporal.split_micros(us)
    return rows(spark, d, "events", ["event_id", "ts"]).select("event_id", temporal.from_micros(us).alias("t"), day.alias("day"), rest.alias("us"))


@query("SELECT p_partkey, TRY_CAST(right(p_brand, 1) AS INTEGER) AS ok, TRY_CAST(p_name AS INTEGER) AS bad, typeof(p_size) = 'INTEGER' AS whole FROM part")
def types_try_cast(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "part", ["p_partkey", "p_brand", "p_name", "p_size"]).select("p_partkey", F.right(F.col("p_brand"), F.lit(1)).try_cast("int").alias("ok"), F.col("p_name").try_cast("int").alias("bad"), (F.typeof("p_size") == "int").alias("whole"))


@query("SELECT event_id, CAST(octet_length(encode(event_type)) AS INTEGER) AS bytes, hex(encode(event_type)) AS h, repeat(event_type, 2) || '!' AS twice FROM events")
def types_octets(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "events", ["event_id", "event_type"]).select("event_id", F.octet_length("event_type").alias("bytes"), F.hex(F.encode("event_type", "UTF-8")).alias("h"), F.concat(F.repeat("event_type", 2), F.lit("!")).alias("twice"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS due, CASE WHEN o_totalprice > 200000 THEN 'dear' END AS kind, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, 'none') AS p FROM orders")
def types_date_case(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    return df.select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 30).alias("due"), F.when(F.col("o_totalprice") > 200000, "dear").alias("kind"), F.coalesce(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")), F.lit("none")).alias("p"))


@query("SELECT range AS n, range % 7 AS m, 'v' || range AS s FROM range(1000)")
def range_values(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(1000).select(F.col("id").alias("n"), (F.col("id") % 7).alias("m"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("s"))


@query('SELECT r_regionkey AS "Id", r_regionkey + 1 AS "ID_2", r_name AS "Id_1" FROM region')
def name_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Names that differ by case only, made unique as a scan does."""
    df = rows(spark, d, "region", ["r_regionkey", "r_name"])
    a, b, c = unique_names(["Id", "ID", "Id_1"])
    return df.select(F.col("r_regionkey").alias(a), (F.col("r_regionkey") + 1).alias(b), F.col("r_name").alias(c))


@query("SELECT o_orderkey, o_orderdate, o_totalprice, nullif(o_orderpriority, '') AS o_orderpriority FROM orders")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """To text files and back by a stated schema."""
    place, df = new_folder(spark, "csv"), rows(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    stamp = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    df.write.options(**stamp).csv(place, header=True)
    return spark.read.schema(df.schema).options(**stamp).csv(place, header=True)


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def copy_full_width(spark: SparkSession, d: str) -> DataFrame:
    """CREATE TABLE AS of a whole table, every value checked, and its rows read back."""
    side = ParquetSide(spark, d)
    df, place = scan(side, '"lineitem"', n_sessions=8)[0], new_folder(spark, "copy")
    create(df, place, list(side.describe("lineitem").columns))
    return spark.read.schema(df.schema).parquet(place)


def written(spark: SparkSession, df: DataFrame, target: list[RemoteColumn]) -> DataFrame:
    """df loaded in two halves into a new table, and read back."""
    place = new_folder(spark, "load")
    half = F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0
    create(df.filter(half), place, target)
    load(df.filter(~half), place, target)
    return spark.read.parquet(place)


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice, date_trunc('second', o_orderdate) AS o_orderdate, o_orderpriority FROM orders")
def write_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "orders", ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    target = [RemoteColumn("O_ORDERKEY", "NUMBER", 22, 18, 0, nullable=False), RemoteColumn("O_TOTALPRICE", "NUMBER", 22, 15, 2), RemoteColumn("O_ORDERDATE", "DATE"), RemoteColumn("O_ORDERPRIORITY", "VARCHAR2", 40)]
    return written(spark, df.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)")), target).toDF(*df.columns)


@query("SELECT doc_id, nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END, '') AS lang FROM documents")
def write_empty_string_null(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "documents", ["doc_id", "lang"]).select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("lang")).alias("lang"))
    return written(spark, df, [RemoteColumn("doc_id", "NUMBER", 22, 18, 0), RemoteColumn("lang", "VARCHAR2", 40)])


@query("SELECT doc_id, CAST(doc_id % 2 = 0 AS SMALLINT) AS even FROM documents")
def write_bool_number(spark: SparkSession, d: str) -> DataFrame:
    df = rows(spark, d, "documents", ["doc_id"]).withColumn("even", F.col("doc_id") % 2 == 0)
    return written(spark, df, [RemoteColumn("doc_id", "NUMBER", 22, 18, 0), RemoteColumn("even", "NUMBER", 22, 1, 0)])


@query("SELECT n_nationkey, rpad(n_name, 12, ' ') AS n_name FROM nation")
def write_char_pad(spark: SparkSession, d: str) -> DataFrame:
    """Through the named format's writer, into a table that is there."""
    register(spark)
    place, df = new_folder(spark, "char"), rows(spark, d, "nation", ["n_nationkey", "n_name"])
    target = [RemoteColumn("n_nationkey", "NUMBER", 22, 9, 0), RemoteColumn("n_name", "CHAR", 12)]
    create(df, f"{place}/t.parquet", target)
    return spark.read.parquet(f"{place}/t.parquet")


@query("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey + 100, n_name FROM nation")
def source_write(spark: SparkSession, d: str) -> DataFrame:
    """An append through df.write.format()."""
    register(spark)
    place, df = new_folder(spark, "append"), rows(spark, d, "nation", ["n_nationkey", "n_name"])
    df.write.parquet(f"{place}/t.parquet")
    df.withColumn("n_nationkey", F.col("n_nationkey") + 100).write.format(NAME).options(folder=place, table='"t"').mode("append").save()
    return spark.read.format(NAME).options(folder=place, table='"t"').load()


@query("SELECT doc_id, nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END, '') AS lang, CAST(doc_id % 2 = 0 AS SMALLINT) AS even FROM documents")
def write_values(spark: SparkSession, d: str) -> DataFrame:
    """All of it at once, through a load."""
    df = rows(spark, d, "documents", ["doc_id", "lang"]).select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("lang")).alias("lang"), (F.col("doc_id") % 2 == 0).alias("even"))
    return written(spark, df, [RemoteColumn("doc_id", "NUMBER", 22, 18, 0), RemoteColumn("lang", "VARCHAR2", 40), RemoteColumn("even", "NUMBER", 22, 1, 0)])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AND l_returnflag IN ('A', 'R') GROUP BY 1, 2")
def flagship(spark: SparkSession, d: str) -> DataFrame:
    where = C("l_shipdate", ">=", datetime(1996, 1, 1)) & C("l_shipdate", "<", datetime(1999, 1, 1)) & P.In("l_returnflag", ("A", "R"))
    df = rows(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity"], where)
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(15,2)")).cast("decimal(38,2)").alias("quantity"))
