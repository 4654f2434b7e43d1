"""SURVEY 2.1: scans, sources, sinks and generated columns.

Round-trip queries write to a fresh folder below the shared checkpoint
folder and read the result back, so the check covers writer and reader."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarry import sources as src
from quarry.catalog import query

S = "2.1"


@query("scan_table", section=S, sql="select * from orders")
def scan_table(t):
    return t.orders


@query("scan_parquet", section=S, sql="select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def scan_parquet(t):
    """Column pruning and filter pushdown reach the parquet scan."""
    return src.read_parquet(t.spark, f"{t.sf_dir}/orders.parquet").where(F.col("o_orderstatus") == "F") \
        .select("o_orderkey", "o_totalprice")


@query("sink_parquet", section=S, sql="""
select o_orderkey, o_custkey, o_totalprice, cast(year(o_orderdate) as integer) as yr from orders
where o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '2000-01-01'
""")
def sink_parquet(t):
    """Write partitioned by year, read back with partition pruning."""
    path = src.scratch_dir(t.spark, "orders_by_year")
    src.write_parquet(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("yr")),
                      path, partition_by=["yr"])
    back = src.read_parquet(t.spark, path)
    return back.where(F.col("yr").isin(1998, 1999)).select("o_orderkey", "o_custkey", "o_totalprice", "yr")


@query("scan_csv", section=S, sql="select * from orders")
def scan_csv(t):
    """Typed CSV read (explicit schema, header, encoding) of a CSV copy of orders."""
    path = src.scratch_dir(t.spark, "orders_csv")
    src.write_csv(t.orders, path)
    return src.read_csv(t.spark, path, t.orders.schema, encoding="UTF-8")


@query("sink_csv", section=S, sql="""
select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate from lineitem
""")
def sink_csv(t):
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
    df = t.lineitem.select(*cols)
    path = src.scratch_dir(t.spark, "lineitem_csv")
    src.write_csv(df, path)
    return src.read_csv(t.spark, path, df.schema)


# The accepted date formats of the dirty input, in order.
DIRTY_FORMATS = ["yyyy-MM-dd", "dd.MM.yyyy", "yyyy/MM/dd"]


def render_dirty_orders(orders):
    """Orders as dirty text: blank ids, three date formats, NA tokens."""
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    date_txt = (F.when(k % 3 == 0, F.date_format(d, DIRTY_FORMATS[0]))
                .when(k % 3 == 1, F.date_format(d, DIRTY_FORMATS[1])).otherwise(F.date_format(d, DIRTY_FORMATS[2])))
    return orders.select(
        F.when(k % 97 == 0, F.lit(" ")).otherwise(k.cast("string")).alias("order_id"),
        date_txt.alias("order_date"),
        F.when(k % 89 == 0, F.lit("NA")).when(k % 89 == 1, F.lit(" n/a "))
        .otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.col("o_orderstatus").alias("status"))


@query("scan_csv_dirty", section=S, sql="""
select case when o_orderkey % 97 = 0 then null else o_orderkey end as order_id,
       cast(o_orderdate as date) as order_date,
       case when o_orderkey % 89 in (0, 1) then null else o_totalprice end as amount,
       o_orderstatus as status
from orders
""")
def scan_csv_dirty(t):
    """Dirty CSV: NA tokens -> NULL, blank ids -> NULL, an ordered list of
    date formats, try_cast for numbers.  Rows stay whole (no row is dropped);
    ``read_csv_dirty(required=...)`` splits rejects off when asked."""
    path = src.scratch_dir(t.spark, "dirty_csv")
    src.write_csv(render_dirty_orders(t.orders), path)
    clean, _rejects = src.read_csv_dirty(
        t.spark, path, ["order_id", "order_date", "amount", "status"],
        types={"order_id": "bigint", "order_date": "date", "amount": "double"},
        date_formats={"order_date": DIRTY_FORMATS})
    return clean




@query("scan_json", section=S, sql="""
select event_id, user_id, event_type, cast(json_extract(props, '$.k') as integer) as k from events
""")
def scan_json(t):
    """JSON lines written and read back with a schema; the nested document
    in ``props`` is parsed with from_json."""
    path = src.scratch_dir(t.spark, "events_json")
    ev = t.events.select("event_id", "user_id", "event_type", "props")
    src.write_json(ev, path)
    back = src.read_json(t.spark, path, ev.schema)
    return back.select("event_id", "user_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))


@query("sink_json", section=S, sql="""
select o_orderkey, o_orderstatus, o_totalprice from orders
""")
def sink_json(t):
    path = src.scratch_dir(t.spark, "orders_json")
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    src.write_json(df, path)
    return src.read_json(t.spark, path, df.schema)


@query("scan_json_array", section=S, sql="""
select o_orderkey, unnest([{'id': o_custkey, 'score': 90}, {'id': o_custkey + 1, 'score': 85}], recursive := true)
from orders
""")
def scan_json_array(t):
    """A JSON array of objects per row -> rows (json.loads + DataFrame)."""
    doc = F.format_string('[{"id":%d,"score":90},{"id":%d,"score":85}]', F.col("o_custkey"), F.col("o_custkey") + 1)
    return t.orders.select("o_orderkey", src.json_array_rows(doc, "struct<id:bigint,score:int>"))


@query("inline_table", section=S, sql="""
select c.c_custkey, coalesce(m.discount, 0e0) as discount
from customer c left join (values ('BUILDING', 0.1e0), ('AUTOMOBILE', 0.05e0)) m(segment, discount)
  on m.segment = c.c_mktsegment
""")
def inline_table(t):
    """A literal lookup table (createDataFrame) joined to a base table; the
    literal has a fixed size, so it is broadcast."""
    m = t.spark.createDataFrame([("BUILDING", 0.1), ("AUTOMOBILE", 0.05)],
                                StructType([StructField("segment", StringType()), StructField("discount", DoubleType())]))
    j = t.customer.join(F.broadcast(m), F.col("segment") == F.col("c_mktsegment"), "left")
    return j.select("c_custkey", F.coalesce("discount", F.lit(0.0)).alias("discount"))


@query("gen_dates", section=S, sql="""
select unnest(generate_series(min(o_orderdate)::date, max(o_orderdate)::date, interval 1 day))::date as day from orders
""")
def gen_dates(t):
    """Calendar between the first and last order date (sequence + explode,
    not a recursive CTE)."""
    b = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))


@query("gen_numbers", section=S, sql="""
with b as (select min(c_acctbal) as lo, max(c_acctbal) as hi from customer)
select i, round(lo + i * (hi - lo) / 10, 6) as x from b, range(0, 11) r(i)
""")
def gen_numbers(t):
    """linspace(min, max, 11) of account balances."""
    b = t.customer.agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    s = b.select("lo", "hi", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(10).cast("bigint"))).alias("i"))
    return s.select("i", F.round(F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / 10, 6).alias("x"))


def _u(seed: int, draw: str | int) -> str:
    """The uniform number of quarry.functions.random in SQL, keyed by the order."""
    text = f"'{seed}:' || o_orderkey || ':' || ({draw})"
    return f"((('0x' || substr(md5({text}), 1, 13))::bigint::double + 0.5) / 4503599627370496.0)"


def _n(seed: int, draw: str | int) -> str:
    return f"(sqrt(-2.0 * ln({_u(seed, f'({draw}) * 2')})) * cos(2.0 * pi() * {_u(seed, f'({draw}) * 2 + 1')}))"


_D, _C = 2.2 - 1.0 / 3.0, 1.0 / (9.0 * (2.2 - 1.0 / 3.0)) ** 0.5


@query("gen_random", section=S, sql=f"""
with tries as (
  select o_orderkey, i, sqrt(-2.0 * ln({_u(3, 'i * 3 + 4096')})) * cos(2.0 * pi() * {_u(3, 'i * 3 + 4097')}) as x, {_u(3, 'i * 3 + 4098')} as u
  from orders, range(0, 64) r(i)),
cubes as (select *, pow(1.0 + {_C!r} * x, 3.0) as v from tries),
gammas as (
  select o_orderkey, arg_min({_D!r} * v, i) * 30.0 as amount from cubes
  where v > 0 and ln(u) < 0.5 * x * x + {_D!r} - {_D!r} * v + {_D!r} * ln(v) group by o_orderkey)
select o.o_orderkey, round({_u(3, 0)}, 9) as uniform, round(120.0 + 40.0 * {_n(3, 1)}, 6) as normal, 1 + floor({_u(3, 4)} * 5)::bigint as team,
       case when {_u(3, 5)} < 0.6 then 'visit' when {_u(3, 5)} < 0.85 then 'signup' else 'purchase' end as event,
       case when {_u(3, 6)} < 0.5 then 'A' else 'B' end as variant, round(g.amount, 6) as amount
from orders o join gammas g using (o_orderkey)
""")
def gen_random(t):
    """Seeded synthetic columns for every order, each a function of seed, key and draw number: uniform, normal, whole
    numbers, weighted and even choice, and gamma amounts (shape 2.2, scale 30)."""
    from quarry.functions import random as R
    k = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", F.round(R.uniform(3, k, 0), 9).alias("uniform"), F.round(R.normal(3, k, 1, 120.0, 40.0), 6).alias("normal"),
        R.integers(3, k, 4, 1, 6).alias("team"), R.choice(3, k, 5, ["visit", "signup", "purchase"], [0.6, 0.25, 0.15]).alias("event"),
        R.choice(3, k, 6, ["A", "B"]).alias("variant"), F.round(R.gamma(3, k, 4, 2.2, 30.0), 6).alias("amount"))


@query("sample_rows", section=S)
def sample_rows(t):
    """Seeded 70 % sample (the sampling operator itself)."""
    return t.orders.sample(False, 0.7, seed=7)


@query("sample_rows_hash", section=S, sql="""
select * from orders where ('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8))::bigint % 10 < 7
""")
def sample_rows_hash(t):
    """Reproducible 70 % sample independent of partitioning: md5 of the key."""
    digest = F.md5(F.col("o_orderkey").cast("string").cast("binary"))
    return t.orders.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10 < 7)
