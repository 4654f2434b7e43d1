"""SURVEY 2.2: projection, filters, predicates, conditional columns."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions import columns as C

S = "2.2"


@query("select_cols", section=S, sql="select o_orderkey, o_totalprice from orders")
def select_cols(t):
    return t.orders.select("o_orderkey", "o_totalprice")


@query("alias_table_col", section=S, sql="""
select o.o_orderkey as order_id, c.c_name as customer from orders as o join customer as c on c.c_custkey = o.o_custkey
""")
def alias_table_col(t):
    o, c = t.orders.alias("o"), t.customer.alias("c")
    return o.join(c, F.col("c.c_custkey") == F.col("o.o_custkey")).select(
        F.col("o.o_orderkey").alias("order_id"), F.col("c.c_name").alias("customer"))


@query("filter_cmp", section=S, sql="select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '2000-01-01'")
def filter_cmp(t):
    return t.orders.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_orderdate")


@query("filter_col_vs_col", section=S, sql="""
select l_orderkey, l_linenumber, l_shipdate from lineitem l join orders o on o.o_orderkey = l.l_orderkey
where l.l_shipdate <> o.o_orderdate
""")
def filter_col_vs_col(t):
    return (t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
            .where(F.col("l_shipdate") != F.col("o_orderdate")).select("l_orderkey", "l_linenumber", "l_shipdate"))


@query("filter_query_expr", section=S, sql="select o_orderkey from orders where o_totalprice >= 100000 and o_custkey = 1")
def filter_query_expr(t):
    return t.orders.where("o_totalprice >= 100000 and o_custkey == 1").select("o_orderkey")


@query("filter_and_or", section=S, sql="""
select o_orderkey, o_custkey, o_totalprice from orders
where (o_orderstatus = 'O' and o_orderdate >= timestamp '2000-01-01') or o_orderpriority = '1-URGENT'
""")
def filter_and_or(t):
    o = t.orders
    return o.where(((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))
                   | (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_custkey", "o_totalprice")


@query("filter_in", section=S, sql="select c_custkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def filter_in(t):
    return t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query("filter_between", section=S, sql="""
select o_orderkey from orders where o_orderdate between timestamp '1997-01-01' and timestamp '1997-06-30'
""")
def filter_between(t):
    """Inclusive on both ends (H32: a date upper bound drops later times of that day)."""
    return t.orders.where(F.col("o_orderdate").between(F.lit("1997-01-01").cast("timestamp_ntz"),
                                                       F.lit("1997-06-30").cast("timestamp_ntz"))).select("o_orderkey")


@query("filter_like", section=S, sql="select doc_id from documents where text like '%les%'")
def filter_like(t):
    return t.documents.where(F.col("text").contains("les")).select("doc_id")


@query("filter_like_ci_ai", section=S, sql="""
select doc_id from documents where contains(lower(strip_accents(text)), 'elle')
""")
def filter_like_ci_ai(t):
    """Case- and accent-insensitive substring match through a collation."""
    return t.documents.select("doc_id", "text").where(F.contains(F.collate("text", "UNICODE_CI_AI"), F.lit("elle"))).select("doc_id")


@query("filter_null", section=S, sql="""
select o.o_orderkey from orders o left join lineitem l on l.l_orderkey = o.o_orderkey where l.l_linenumber is null
""")
def filter_null(t):
    """IS NULL on the output of an outer join: orders without lines."""
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return j.where(F.col("l_linenumber").isNull()).select("o_orderkey")


@query("filter_sargable_range", section=S, sql="""
select o_orderkey, o_orderdate from orders
where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01'
""")
def filter_sargable_range(t):
    """Half-open range (pushed to the parquet scan) instead of year(col) = 1997."""
    return t.orders.where((F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                          & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))) \
        .select("o_orderkey", "o_orderdate")


@query("filter_scalar_subquery", section=S, sql="""
select o_orderkey, o_totalprice from orders where o_totalprice > (select avg(o_totalprice) from orders)
""")
def filter_scalar_subquery(t):
    mu = t.orders.agg(F.avg("o_totalprice")).scalar()  # runs once, pushed to the scan
    return t.orders.where(F.col("o_totalprice") > mu).select("o_orderkey", "o_totalprice")


@query("filter_above_group_mean", section=S, sql="""
with tot as (select o_custkey, sum(o_totalprice) as total from orders group by o_custkey),
m as (select avg(total) as mean_total from tot)
select o_custkey, round(total, 4) as total from tot cross join m where total > mean_total
""")
def filter_above_group_mean(t):
    tot = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    mean_total = tot.agg(F.avg("total")).scalar()
    return tot.where(F.col("total") > mean_total).select("o_custkey", F.round("total", 4).alias("total"))


@query("case_bucket", section=S, sql="""
select o_orderkey, case when o_totalprice >= 300000 then 'High' when o_totalprice >= 100000 then 'Medium'
                        else 'Low' end as bucket from orders
""")
def case_bucket(t):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.when(p >= 300000, "High").when(p >= 100000, "Medium")
                           .otherwise("Low").alias("bucket"))


@query("case_flag", section=S, sql="""
select o_orderkey, cast(o_totalprice >= 200000 as integer) as is_big from orders
""")
def case_flag(t):
    return t.orders.select("o_orderkey", C.flag(F.col("o_totalprice") >= 200000).alias("is_big"))


@query("bin_cut", section=S, sql="""
select c_custkey, case when c_acctbal > 0 and c_acctbal <= 1000 then 'low'
                       when c_acctbal > 1000 and c_acctbal <= 5000 then 'mid'
                       when c_acctbal > 5000 and c_acctbal <= 10000 then 'high' end as band
from customer
""")
def bin_cut(t):
    """pandas.cut: right-closed bins, outside (incl. the left edge) -> NULL."""
    return t.customer.select("c_custkey", C.bin_right_closed(
        F.col("c_acctbal"), [0, 1000, 5000, 10000], ["low", "mid", "high"]).alias("band"))


@query("ordered_category", section=S, sql="""
select o_orderkey, o_orderpriority, cast(substr(o_orderpriority, 1, 1) as integer) as priority_rank from orders
""")
def ordered_category(t):
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return t.orders.select("o_orderkey", "o_orderpriority",
                           C.ordered_category(F.col("o_orderpriority"), levels).alias("priority_rank"))


@query("map_values", section=S, sql="""
select c_custkey, coalesce(case c_mktsegment when 'BUILDING' then 0.1e0 when 'AUTOMOBILE' then 0.05e0 end, 0e0)
       as discount from customer
""")
def map_values(t):
    """Dictionary lookup with default 0 (``map(d).fillna(0)``)."""
    m = F.create_map(F.lit("BUILDING"), F.lit(0.1), F.lit("AUTOMOBILE"), F.lit(0.05))
    return t.customer.select("c_custkey", F.coalesce(m[F.col("c_mktsegment")], F.lit(0.0)).alias("discount"))


@query("derive_arith", section=S, sql="""
select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as net,
       floor(l_quantity / 7) as qdiv, cast(l_quantity as bigint) % 7 as qmod, power(l_discount, 2) as dsq
from lineitem
""")
def derive_arith(t):
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
                             F.floor(q / 7).alias("qdiv"), F.pmod(q.cast("bigint"), F.lit(7)).alias("qmod"),
                             F.pow("l_discount", 2).alias("dsq"))


@query("safe_div", section=S, sql="""
select l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) as price_per_disc from lineitem
""")
def safe_div(t):
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             C.safe_div(F.col("l_extendedprice"), F.col("l_discount")).alias("price_per_disc"))


@query("cast_types", section=S, sql="""
select o_orderkey, cast(o_orderkey as varchar) as key_text, cast(o_orderdate as date) as d,
       try_cast(o_orderpriority as integer) as bad_int, cast(floor(o_totalprice) as bigint) as whole
from orders
""")
def cast_types(t):
    return t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("key_text"),
                           F.to_date("o_orderdate").alias("d"),
                           F.col("o_orderpriority").try_cast("int").alias("bad_int"),
                           F.floor("o_totalprice").cast("bigint").alias("whole"))


_NARROW = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


def _narrow_sql(c: str) -> str:
    return f"""case when min({c}) >= -128 and max({c}) <= 127 then 'tinyint' when min({c}) >= -32768 and max({c}) <= 32767 then 'smallint'
  when min({c}) >= -2147483648 and max({c}) <= 2147483647 then 'int' else 'bigint' end"""


@query("downcast_numeric", section=S, sql="""
with types as (select """ + ",\n".join(f"{_narrow_sql(c)} as t_{c}" for c in _NARROW) + """ from lineitem)
select l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity::bigint as l_quantity, """
       + ", ".join(f"t.t_{c}" for c in _NARROW) + """, dense_rank() over (order by l_returnflag) - 1 as l_returnflag, 'tinyint' as t_l_returnflag
from lineitem l, types t
""")
def downcast_numeric(t):
    """Narrowest integer type per column from one min/max aggregate over all columns (the bounds come back as one row
    and drive the casts), a text column as category codes, and the types that came out."""
    from quarry.operators.reshape import compact
    out, _ = compact(t.lineitem.select(*_NARROW, "l_returnflag"), categories=["l_returnflag"], lossy=True)
    return out.select("*", *[F.typeof(c).alias(f"t_{c}") for c in out.columns])


@query("category_codes", section=S, sql="""
select o_orderkey, dense_rank() over (order by o_orderpriority) - 1 as code, o_orderpriority as decoded from orders
""")
def category_codes(t):
    """Categorical column: dense codes in the order of the values, and the values back through the dictionary."""
    from quarry.operators.reshape import decode, dictionary, encode
    found = dictionary(t.orders, "o_orderpriority")
    coded = encode(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", found, "code").drop("o_orderpriority")
    return decode(coded, "code", found, "decoded")


@query("compact_sizes", section=S, sql="""
select 'lineitem' as tab, count(*) as n_rows, true as smaller from lineitem
""")
def compact_sizes(t):
    """Files of the line items before and after narrowing and coding: fewer bytes, as many rows."""
    from quarry.operators.reshape import compact, parquet_bytes
    df = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    out, _ = compact(df, categories=["l_returnflag", "l_linestatus"])
    before, after = parquet_bytes(df), parquet_bytes(out)
    return out.agg(F.lit("lineitem").alias("tab"), F.count(F.lit(1)).alias("n_rows"), F.lit(after < before).alias("smaller"))


@query("rename_drop", section=S, sql="""
select o_orderkey as order_id, o_custkey as customer_id from orders
""")
def rename_drop(t):
    return t.orders.withColumnsRenamed({"o_orderkey": "order_id", "o_custkey": "customer_id"}) \
        .drop("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("null_replace", section=S, sql="""
select c.c_custkey, coalesce(o.o_orderstatus, 'none') as status, coalesce(o.o_totalprice, 0e0) as amount
from customer c left join orders o on o.o_custkey = c.c_custkey
""")
def null_replace(t):
    j = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.select("c_custkey", "o_orderstatus", "o_totalprice").fillna(
        {"o_orderstatus": "none", "o_totalprice": 0.0}).withColumnsRenamed(
        {"o_orderstatus": "status", "o_totalprice": "amount"})


@query("null_drop", section=S, sql="""
select c.c_custkey, o.o_orderkey
from customer c left join orders o on o.o_custkey = c.c_custkey
where o.o_orderkey is not null
""")
def null_drop(t):
    j = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.select("c_custkey", "o_orderkey").dropna(subset=["o_orderkey"])


@query("null_profile", section=S, sql="""
select col, n_missing from (
  select 'c_custkey' as col, count(*) filter (where c_custkey is null) as n_missing from customer
  union all select 'c_name', count(*) filter (where c_name is null) from customer
  union all select 'c_nationkey', count(*) filter (where c_nationkey is null) from customer
  union all select 'c_acctbal', count(*) filter (where c_acctbal is null) from customer
  union all select 'c_mktsegment', count(*) filter (where c_mktsegment is null) from customer)
""")
def null_profile(t):
    """Missing count per column: one aggregate over all columns, then unpivot."""
    df = t.customer
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "col", "n_missing")


@query("nan_inf_clean", section=S, sql="""
select l_orderkey, l_linenumber,
       case when isnan(x) then 0e0 when x = 'Infinity'::double then 9999e0
            when x = '-Infinity'::double then -9999e0 else x end as clean
from (select l_orderkey, l_linenumber,
             case when l_discount = 0 then 'NaN'::double else l_tax / l_discount end as x from lineitem)
""")
def nan_inf_clean(t):
    """NaN -> 0, +inf -> 9999, -inf -> -9999 (numpy nan_to_num with posinf)."""
    x = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax") / F.col("l_discount"))
    from quarry.functions.columns import nan_to_num
    return t.lineitem.select("l_orderkey", "l_linenumber", nan_to_num(x, 0.0, 9999.0, -9999.0).alias("clean"))


@query("positional_slice", section=S, sql="""
select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 3
""")
def positional_slice(t):
    """iloc[0:3, 0:3]: first rows by an explicit order, first columns."""
    return t.orders.orderBy("o_orderkey").limit(3).select("o_orderkey", "o_custkey", "o_totalprice")


@query("positional_last", section=S, sql="""
select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey desc limit 3
""")
def positional_last(t):
    """The last three rows by an explicit order."""
    return t.orders.orderBy(F.desc("o_orderkey")).limit(3).select("o_orderkey", "o_custkey", "o_totalprice")


@query("positional_list", section=S, sql="""
select o_orderkey, o_custkey from (select *, row_number() over (order by o_orderkey) - 1 as place from orders)
where place in (0, 2, 5, 700)
""")
def positional_list(t):
    """Rows at listed positions of an explicit order, counted from 0."""
    from quarry.operators.windows import global_row_number
    numbered = global_row_number(t.orders.select("o_orderkey", "o_custkey"), [("o_orderkey", True)], "__place")
    return numbered.where((F.col("__place") - 1).isin(0, 2, 5, 700)).drop("__place")


@query("label_binary", views=("matches",), section=S, sql="""
select match_id, case when home_score > away_score then 1 else 0 end as y_home_win from matches
""")
def label_binary(t):
    return t.matches.select("match_id", (F.col("home_score") > F.col("away_score")).cast("int").alias("y_home_win"))


@query("label_multiclass", views=("matches",), section=S, sql="""
select match_id, case when home_score > away_score then 'HOME' when home_score < away_score then 'AWAY'
                      else 'DRAW' end as outcome from matches
""")
def label_multiclass(t):
    h, a = F.col("home_score"), F.col("away_score")
    return t.matches.select("match_id", F.when(h > a, "HOME").when(h < a, "AWAY").otherwise("DRAW").alias("outcome"))


@query("odds_normalise", views=("odds",), section=S, sql="""
with chances as (
  select match_id, bookmaker, odds_id, 1e0 / home_win as h, 1e0 / draw as d, 1e0 / away_win as a from odds),
summed as (select *, h + d + a as book from chances)
select match_id, bookmaker, odds_id, h / book as p_home, d / book as p_draw, a / book as p_away, book - 1e0 as margin
from summed
""")
def odds_normalise(t):
    """Implied probabilities normalised to 1; margin = inverse sum - 1 (H2)."""
    ph, pd_, pa, margin = C.odds_probabilities(F.col("home_win"), F.col("draw"), F.col("away_win"))
    return t.odds.select("match_id", "bookmaker", "odds_id", ph.alias("p_home"), pd_.alias("p_draw"),
                         pa.alias("p_away"), margin.alias("margin"))
