"""SURVEY 2.13: plain-Python tasks re-aimed as table jobs over whole texts."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.plans.scalars import EMAIL

S = "2.13"


@query("word_count", section=S, sql="""
with w as (select lang, unnest(regexp_split_to_array(lower(text), '\\s+')) as word from documents)
select lang, word, count(*) as n from w where word <> '' group by lang, word
""")
def word_count(t):
    """Word frequencies over whole documents: every (lang, word).  The explode
    feeds a partial aggregation, so frequent words shrink before the shuffle."""
    w = t.documents.select("lang", F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).where(F.col("word") != "")
    return w.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


@query("char_count", section=S, sql="""
select ch, count(*) as n from (select unnest(string_split(text, '')) as ch from conversations) group by ch
""")
def char_count(t):
    return (t.conversations.select("text").select(F.explode(F.split("text", "")).alias("ch"))
            .groupBy("ch").agg(F.count(F.lit(1)).alias("n")))


@query("email_scan", section=S, sql=f"""
with e as (select source, doc_id, unnest(regexp_extract_all(text, '{EMAIL}')) as email from documents)
select source, lower(split_part(email, '@', 2)) as domain, count(*) as n_emails, count(distinct doc_id) as n_docs
from e group by 1, 2
""")
def email_scan(t):
    """PII scan: every e-mail address in every document, totals per source and domain."""
    e = t.documents.where(F.contains("text", F.lit("@"))).select("source", "doc_id", F.explode(F.regexp_extract_all("text", F.lit(EMAIL), 0)).alias("email"))
    return e.groupBy("source", F.lower(F.split_part("email", F.lit("@"), F.lit(2))).alias("domain")).agg(
        F.count(F.lit(1)).alias("n_emails"), F.countDistinct("doc_id").alias("n_docs"))


@query("brackets_unbalanced", section=S, sql="""
with b as (select doc_id, source, regexp_extract_all(text, '[()]') as br from documents),
u as (select doc_id, source, unnest(br) as c, generate_subscripts(br, 1) as pos from b),
d as (select doc_id, source, sum(case when c = '(' then 1 else -1 end)
             over (partition by doc_id order by pos rows between unbounded preceding and current row) as depth from u),
per_doc as (select doc_id, source, min(depth) as min_depth from d group by 1, 2),
fin as (select doc_id, source, sum(case when c = '(' then 1 else -1 end) as final_depth from u group by 1, 2)
select p.source, count(*) filter (where p.min_depth < 0 or f.final_depth <> 0) as n_unbalanced,
       count(*) as n_with_brackets
from per_doc p join fin f on f.doc_id = p.doc_id group by p.source
""")
def brackets_unbalanced(t):
    """Documents whose parentheses do not balance (the stack check): fold over
    the bracket characters of each whole text tracking (depth, minimum)."""
    br = F.regexp_extract_all("text", F.lit("[()]"), 0)
    st = F.aggregate(br, F.struct(F.lit(0).alias("d"), F.lit(0).alias("m")),
                     lambda acc, c: F.struct((acc["d"] + F.when(c == "(", 1).otherwise(-1)).alias("d"),
                                             F.least(acc["m"], acc["d"] + F.when(c == "(", 1).otherwise(-1)).alias("m")))
    d = t.documents.select("source", "text").select("source", br.alias("br"), st.alias("s")).where(F.size("br") > 0)
    return d.groupBy("source").agg(F.count_if((F.col("s.m") < 0) | (F.col("s.d") != 0)).alias("n_unbalanced"),
                                   F.count(F.lit(1)).alias("n_with_brackets"))


@query("order_totals", section=S, sql="""
select o_custkey, round(sum(o_totalprice), 4) as total, count(*) as n from orders group by 1
""")
def order_totals(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 4).alias("total"),
                                             F.count(F.lit(1)).alias("n"))


@query("group_counter", section=S, sql="select event_type, count(*) as n from events group by 1")
def group_counter(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("sum_varargs", section=S, sql="""
select l_orderkey, l_linenumber, l_partkey, l_quantity + l_extendedprice + l_discount + l_tax as row_sum from lineitem
""")
def sum_varargs(t):
    from functools import reduce
    from operator import add
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", reduce(add, [F.col(c) for c in cols]).alias("row_sum"))


@query("avg_nullsafe", section=S, sql="""
select c.c_custkey, sum(o.o_totalprice::decimal(18, 2))::double / count(o.o_totalprice) as avg_amount from customer c
left join orders o on o.o_custkey = c.c_custkey group by 1
""")
def avg_nullsafe(t):
    """Mean of a possibly empty group is NULL, not an error; summed exactly, so the order of the rows does not show."""
    return (t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
            .groupBy("c_custkey").agg(F.try_divide(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), F.count("o_totalprice")).alias("avg_amount")))
