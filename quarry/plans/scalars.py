"""SURVEY 2.8: scalar string, date, math, array, map and JSON functions."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions import columns as C

S = "2.8"
# Fixed value: which strings count as an address depends on every character of this pattern.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query("str_len", section=S, sql="select doc_id, length(rtrim(text)) as len from documents")
def str_len(t):
    return t.documents.select("doc_id", C.len_trimmed(F.col("text")).alias("len"))


@query("str_position", section=S, sql="select doc_id, instr(text, 'the') as pos from documents")
def str_position(t):
    """1-based position, 0 when absent (CHARINDEX)."""
    return t.documents.select("doc_id", F.instr("text", "the").alias("pos"))


@query("str_case", section=S, sql="select c_custkey, lower(c_name) as lo, upper(c_mktsegment) as up from customer")
def str_case(t):
    return t.customer.select("c_custkey", F.lower("c_name").alias("lo"), F.upper("c_mktsegment").alias("up"))


@query("str_split_count", section=S, sql="""
select doc_id, case when trim(text) = '' then 0 else len(regexp_split_to_array(trim(text), '\\s+')) end as n_words
from documents
""")
def str_split_count(t):
    return t.documents.select("doc_id", "text").select("doc_id", C.word_count(F.col("text")).alias("n_words"))


@query("str_join", section=S, sql="select c_custkey, concat_ws('-', c_name, c_mktsegment) as label from customer")
def str_join(t):
    return t.customer.select("c_custkey", F.concat_ws("-", "c_name", "c_mktsegment").alias("label"))


@query("str_reverse", section=S, sql="select c_custkey, reverse(c_name) as rev from customer")
def str_reverse(t):
    return t.customer.select("c_custkey", F.reverse("c_name").alias("rev"))


@query("str_replace", section=S, sql="select c_custkey, replace(c_name, 'Customer#', '') as short_name from customer")
def str_replace(t):
    return t.customer.select("c_custkey", F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("short_name"))


@query("str_format", section=S, sql="select c_custkey, printf('%s has %.2f', c_name, c_acctbal) as line from customer")
def str_format(t):
    return t.customer.select("c_custkey", F.format_string("%s has %.2f", "c_name", "c_acctbal").alias("line"))


@query("regex_extract", section=S, sql="""
select page_id, nullif(regexp_extract(url, '://([^/?#]+)', 1), '') as host from pages
""")
def regex_extract(t):
    """First group or NULL when there is no match."""
    return t.pages.select("page_id", F.nullif(F.regexp_extract("url", r"://([^/?#]+)", 1), F.lit("")).alias("host"))


@query("regex_findall", section=S, sql=f"""
select doc_id, unnest(regexp_extract_all(text, '{EMAIL}')) as email from documents
""")
def regex_findall(t):
    return t.documents.select("doc_id", "text").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(EMAIL), 0)).alias("email"))


@query("str_char_counts", section=S, sql="""
select ch, count(*) as n from (select unnest(string_split(lower(text), '')) as ch from benchmark) group by ch
""")
def str_char_counts(t):
    """Counter over characters: explode + group count (partial aggregation)."""
    return (t.benchmark.select(F.explode(F.split(F.lower("text"), "")).alias("ch"))
            .groupBy("ch").agg(F.count(F.lit(1)).alias("n")))


@query("dt_now", section=S)
def dt_now(t):
    """Age of each order against the current date (non-deterministic; queries
    that need reproducibility take an explicit as-of date instead)."""
    return t.orders.select("o_orderkey", F.datediff(F.current_date(), F.to_date("o_orderdate")).alias("age_days"))


@query("dt_add", section=S, sql="""
select o_orderkey, o_orderdate + interval 30 day as due, cast(o_orderdate as date) + 7 as week_later from orders
""")
def dt_add(t):
    return t.orders.select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("due"),
                           F.date_add(F.to_date("o_orderdate"), 7).alias("week_later"))


@query("dt_diff", section=S, sql="""
select l.l_orderkey, l.l_linenumber, l.l_partkey,
       date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date)) as midnights,
       floor((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 86400000000.0) as elapsed_days,
       date_diff('minute', o.o_orderdate, l.l_shipdate) as minutes
from lineitem l join orders o on o.o_orderkey = l.l_orderkey
""")
def dt_diff(t):
    """DATEDIFF(DAY) counts midnights; pandas .dt.days counts whole 24 h."""
    j = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return j.select("l_orderkey", "l_linenumber", "l_partkey",
                    C.midnights_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("midnights"),
                    C.elapsed_days(F.col("o_orderdate"), F.col("l_shipdate")).alias("elapsed_days"),
                    F.timestamp_diff("MINUTE", F.col("o_orderdate"), F.col("l_shipdate")).alias("minutes"))


@query("dt_eomonth", section=S, sql="select o_orderkey, cast(last_day(o_orderdate) as date) as eom from orders")
def dt_eomonth(t):
    return t.orders.select("o_orderkey", F.last_day("o_orderdate").alias("eom"))


@query("dt_parts", section=S, sql="""
select o_orderkey, cast(year(o_orderdate) as integer) as yr, cast(month(o_orderdate) as integer) as mon,
       cast(quarter(o_orderdate) as integer) as qtr, cast(o_orderdate as date) as d,
       cast(date_trunc('month', o_orderdate) as date) as month_start from orders
""")
def dt_parts(t):
    o = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.year(o).alias("yr"), F.month(o).alias("mon"), F.quarter(o).alias("qtr"),
                           F.to_date(o).alias("d"), F.to_date(F.date_trunc("month", o)).alias("month_start"))


@query("dt_format", section=S, sql="""
select o_orderkey, strftime(o_orderdate, '%Y-%m') as ym, strftime(o_orderdate, '%Y-%m-%d') as ymd from orders
""")
def dt_format(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("ym"),
                           F.date_format("o_orderdate", "yyyy-MM-dd").alias("ymd"))


@query("dt_parse", section=S, sql="""
select o_orderkey, cast(strftime(o_orderdate, '%Y-%m-%d') as date) as d,
       try_strptime(o_orderpriority, '%Y-%m-%d') as bad from orders
""")
def dt_parse(t):
    """Text to date; unparseable text becomes NULL (try_to_timestamp)."""
    return t.orders.select("o_orderkey", F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"),
                           F.try_to_timestamp("o_orderpriority", F.lit("yyyy-MM-dd")).cast("timestamp_ntz").alias("bad"))


@query("math_ops", section=S, sql="""
select l_orderkey, l_linenumber, l_partkey, power(l_quantity, 2) as sq, round(l_extendedprice / 3, 2) as r2,
       greatest(l_quantity, 5e0) as clipped, sqrt(l_quantity) as root, abs(l_discount - 0.05) as dev
from lineitem
""")
def math_ops(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.pow("l_quantity", 2).alias("sq"),
                             F.round(F.col("l_extendedprice") / 3, 2).alias("r2"),
                             F.greatest("l_quantity", F.lit(5.0)).alias("clipped"),
                             F.sqrt("l_quantity").alias("root"), F.abs(F.col("l_discount") - 0.05).alias("dev"))


@query("arr_map_filter", section=S, sql="""
select vec_id, list_transform(embedding, lambda x: x::double * 2) as doubled, len(list_filter(embedding, lambda x: x > 0)) as n_pos
from embeddings
""")
def arr_map_filter(t):
    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.transform(e, lambda x: x.cast("double") * 2).alias("doubled"),
                               F.size(F.filter(e, lambda x: x > 0)).alias("n_pos"))


@query("arr_accumulate", section=S, sql="""
select vec_id, list_transform(range(1, len(embedding) + 1), lambda i: round(list_sum(list_transform(embedding[1:i], lambda x: x::double)), 4) + 0.0) as prefix
from embeddings
""")
def arr_accumulate(t):
    """Prefix sums over the whole vector, built by ``aggregate`` inside the row."""
    acc = F.aggregate("embedding", F.array().cast("array<double>"),
                      lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0.0)) + x.cast("double"))))
    return t.embeddings.select("vec_id", F.transform(acc, lambda v: F.round(v, 4)).alias("prefix"))


@query("arr_flatten", section=S, sql="""
select vec_id, len(list_transform(range(0, (len(embedding) + 6) // 7), lambda i: embedding[i * 7 + 1:i * 7 + 7])) as n_rows, embedding as flat
from embeddings
""")
def arr_flatten(t):
    """The vector as rows of 7 (the last one shorter), however long it is, and the rows end to end again."""
    grid = C.rows_of(F.col("embedding"), 7)
    return t.embeddings.select("vec_id", F.size(grid).cast("long").alias("n_rows"), F.flatten(grid).alias("flat"))


@query("arr_slice_index", section=S, sql="""
select vec_id, embedding[1:3] as first3, embedding[-2:] as last2, embedding[1] as first, embedding[-1] as last
from embeddings
""")
def arr_slice_index(t):
    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.slice(e, 1, 3).alias("first3"), F.slice(e, -2, 2).alias("last2"),
                               F.element_at(e, 1).alias("first"), F.element_at(e, -1).alias("last"))


@query("arr_sort_distinct_contains", section=S, sql="""
with w as (select conv_id, turn, string_split(lower(role || ' ' || text), ' ') as words from conversations)
select conv_id, turn, len(list_distinct(words)) as n_distinct, list_contains(words, 'the') as has_the,
       list_sort(list_distinct(words))[1] as first_word, len(list_append(words, 'end')) as n_appended
from w
""")
def arr_sort_distinct_contains(t):
    w = F.split(F.lower(F.concat_ws(" ", "role", "text")), " ")
    c = t.conversations.select("conv_id", "turn", w.alias("words"))
    return c.select("conv_id", "turn", F.size(F.array_distinct("words")).alias("n_distinct"),
                    F.array_contains("words", "the").alias("has_the"),
                    F.element_at(F.array_sort(F.array_distinct("words")), 1).alias("first_word"),
                    F.size(F.array_append("words", F.lit("end"))).alias("n_appended"))


@query("arr_zip_enumerate", section=S, sql="""
select vec_id, unnest(range(0, len(embedding))) as pos, unnest(embedding) as v from embeddings
""")
def arr_zip_enumerate(t):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "v"))


@query("arr_broadcast_vec", section=S, sql="""
select vec_id, list_transform(range(1, len(embedding) + 1), lambda i: round(embedding[i] + (i - 1) / 64.0, 6)) as shifted
from embeddings
""")
def arr_broadcast_vec(t):
    """Add a fixed vector v_i = i / 64 to every row (X + v)."""
    vec = F.array(*[F.lit(i / 64.0) for i in range(64)])
    return t.embeddings.select("vec_id", F.transform(F.zip_with("embedding", vec, lambda x, y: x.cast("double") + y),
                                                     lambda z: F.round(z, 6)).alias("shifted"))


@query("arr_transpose_stack_reshape", section=S, sql="""
select vec_id, list_transform(range(0, 8), lambda r: embedding[r * 8 + 1 : r * 8 + 8]) as grid from embeddings
""")
def arr_transpose_stack_reshape(t):
    """reshape(8, 8) of each 64-vector, row-major."""
    return t.embeddings.select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(7)),
                                                     lambda r: F.slice("embedding", r * 8 + 1, 8)).alias("grid"))


@query("arr_transpose_long", section=S, sql="""
select (i - 1) % 8 as r, (i - 1) // 8 as c, vec_id, v
from (select vec_id, unnest(embedding) as v, unnest(range(1, len(embedding) + 1)) as i from embeddings)
""")
def arr_transpose_long(t):
    """Transpose in long form: position p of the 8x8 grid (row p div 8,
    column p mod 8) moves to (p mod 8, p div 8)."""
    p = t.embeddings.select("vec_id", F.posexplode("embedding").alias("p", "v"))
    return p.select((F.col("p") % 8).alias("r"), F.floor(F.col("p") / 8).alias("c"), "vec_id", "v")


@query("arr_fill", section=S, sql="""
select vec_id, list_transform(range(0, 10), lambda i: case when i = label then 1 else 0 end) as one_hot,
       list_transform(range(0, 4), lambda i: 0e0) as zeros from embeddings
""")
def arr_fill(t):
    """Identity row (one-hot of the label) and a zero vector."""
    return t.embeddings.select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(9)),
                                                     lambda i: F.when(i == F.col("label"), 1).otherwise(0)).alias("one_hot"),
                               F.array_repeat(F.lit(0.0), 4).alias("zeros"))


@query("map_build_get", section=S, sql="""
select event_id, cast(json_extract(props, '$.k') as integer) as k, 0 as z_or_default, 2 as n_keys from events
""")
def map_build_get(t):
    """Build a map, read with default, add a key (dict get / set)."""
    m = F.from_json("props", "map<string,int>")
    return t.events.select("event_id", F.element_at(m, F.lit("k")).alias("k"),
                           F.coalesce(F.try_element_at(m, F.lit("z")), F.lit(0)).alias("z_or_default"),
                           F.size(F.map_concat(m, F.create_map(F.lit("grade"), F.lit(90)))).alias("n_keys"))


@query("map_invert", section=S, sql="""
select conv_id, role, max(turn) as turn from conversations group by conv_id, role
""")
def map_invert(t):
    """A map turn -> role for each conversation, with keys and values swapped: of the turns of a role the last one stays."""
    roles = t.conversations.groupBy("conv_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("turn", "role")))).alias("m"))
    return roles.select("conv_id", F.explode(C.inverted("m")).alias("role", "turn"))


@query("json_value", section=S, sql="""
with j as (select event_id, user_id, json_extract_string(props, '$.k') as k from events)
select event_id, user_id, k from j where cast(k as integer) >= 90
""")
def json_value(t):
    """JSON_VALUE in a CTE so the document is parsed once; objects -> NULL."""
    j = t.events.select("event_id", "user_id", C.json_scalar(F.col("props"), "$.k").alias("k"))
    return j.where(F.col("k").cast("int") >= 90)
