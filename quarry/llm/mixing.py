"""Mixing sources to target weights by hash-threshold histograms.

DataFrame functions only.  Every document gets a 60-bit hash of its id and text.  Per source, words are summed by hash
bucket; the running sum over the (at most 4,096) buckets shows the bucket in which the source's word budget ends.
Only the documents of that one bucket are summed again by the next 12 bits, and so on until the boundary bucket
holds a single hash.  The documents taken are then those whose hash lies below the source's threshold: a filter, no
sort, and a smaller budget takes a subset of what a larger one takes.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import forget, free_name, merged, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)          # by the sources' order, repeating
MOST_COPIES = 3              # a source's target and a document's copies stop here
BITS, LEVELS = 12, 5         # 5 x 12 bits of hash
SMALL_TABLE = 20_000         # sources up to which the table of thresholds is broadcast


def word_count(text: Column) -> Column:
    """Number of words (runs of other than ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of id, colon and text as a non-negative long; null counts as an empty string."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Targets per source from rows (source, source_size): adds ``target`` (double).

    The sources in order of code points, null last, weigh ``weights``, repeating, and share all words; a target stops
    at ``most`` times its source's size and the excess goes to the others by weight until none is above.  This is the
    level L with sum(min(cap, weight * L)) = total: with the sources in order of cap / weight, those in front of the
    first that holds the level within its cap are full.  The windows run over one row a source.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1,
                             F.lit(len(weights))) + 1).cast("int"))
    t = sizes.select("source", "source_size", w.alias("w")).withColumn("cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    t = (t.withColumn("total", F.sum("source_size").over(every))
         .withColumn("level", F.try_divide(F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
                                           F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
         .withColumn("open", F.col("w") * F.col("level") <= F.col("cap")))
    # the level is the one of the first source that is not full
    t = t.withColumn("final", F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("w")).alias("r"), "level"))).over(every))
    return t.select("source", "source_size",
                    F.when(F.col("final").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("w") * F.col("final.level"))).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per document (doc_id, source, h, size, source_size, target, copies, taken): how often the mix takes it.

    A source whose target is r times its size takes every document floor(r) times and those below the hash threshold
    once more; of the two thresholds around the budget the nearer one counts (the lower on a tie).  Documents are
    taken whole.  Null text: size 0.  Null source: a source of its own, last in order.  Rows that repeat id and text
    share their hash, so they are taken or left together; equal or null ids of different texts are not.  A source without words has target 0 and no copies.
    An empty table gives no rows.  The result depends on ids, sources and sizes alone, so reruns agree.
    """
    i, t, s = (F.col(f"`{c}`") for c in (doc_id, text, source))
    facts = written(docs.select(i.alias("doc_id"), s.cast("string").alias("source"), word_count(t).alias("size"),
                                row_hash(i, t).alias("h")), "mix")
    sizes = facts.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights), "mix")
    ratio = F.col("target") / F.col("source_size")
    # rounding must not turn a full third copy into two and all of a third
    whole = F.floor(F.round(ratio, 12))
    targets = targets.withColumn("base", F.when(F.col("source_size") > 0, whole).otherwise(F.lit(0)).cast("long"))
    budget = F.greatest(F.lit(0.0), F.col("target") - F.col("base") * F.col("source_size"))
    few = targets.count() <= SMALL_TABLE

    def per_source(df: DataFrame, table: DataFrame) -> DataFrame:
        """``df`` with the columns of ``table`` for its source; the broadcast is for a counted table only."""
        return df.join(F.broadcast(table) if few else table, F.col("source").eqNullSafe(F.col("s")))

    # edge: of each source the bucket (prefix) in which its budget ends, and the words of the buckets before (below)
    edge = targets.select(F.col("source").alias("s"), budget.alias("budget"),
                          F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    for level in range(1, LEVELS + 1):
        up, down = BITS * (LEVELS - level + 1), BITS * (LEVELS - level)
        sums = (per_source(facts, edge).where(F.shiftright("h", up) == F.col("prefix"))
                .groupBy("s", "budget", "below", F.shiftright("h", down).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("h").alias("h0"), F.max("h").alias("h1")))
        run = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        new = written(sums.withColumn("upto", F.col("below") + F.sum("words").over(run))
                      .where(F.col("upto") > F.col("budget"))
                      .groupBy("s", "budget").agg(F.min(F.struct("bucket", "upto", "words", "h0", "h1")).alias("e"))
                      .select("s", "budget", F.col("e.bucket").alias("prefix"),
                              (F.col("e.upto") - F.col("e.words")).alias("below"), "e.upto", "e.h0", "e.h1"), "mix")
        if level > 1:
            forget(edge)
        edge = new
        if edge.where("h0 < h1").isEmpty():      # single hashes: nothing left to refine
            break
    nearer = F.col("upto") - F.col("budget") < F.col("budget") - F.col("below")
    plan = targets.join(edge.select(F.col("s"), F.when(nearer, F.col("h1") + 1).otherwise(F.col("h0")).alias("stop")),
                        F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), "source_size", "target", "base", "stop")
    copies = F.col("base") + F.coalesce((F.col("h") < F.col("stop")).cast("long"), F.lit(0))
    return (per_source(facts, plan)
            .select("doc_id", "source", "h", "size", "source_size", "target", copies.alias("copies"),
                    (F.col("size") * copies).alias("taken")))


def sample_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept, whatever their names."""
    n, h, origin, place = (free_name(docs, x) for x in ("mix copies", "mix hash", "mix source", "mix place"))
    # copies depend on source and hash alone, so one row of each is enough
    plan = (mix(docs, doc_id, text, source).where("copies > 0")
            .groupBy(F.col("source").alias(origin), F.col("h").alias(h)).agg(F.max("copies").alias(n)))
    joined = docs.join(merged(plan), F.col(f"`{source}`").cast("string").eqNullSafe(F.col(f"`{origin}`"))
                       & (row_hash(F.col(f"`{doc_id}`"), F.col(f"`{text}`")) == F.col(f"`{h}`")))
    every = joined.select(*[F.col(f"`{c}`") for c in docs.columns],
                          F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"`{n}`"))).alias(place))
    return every.select(*[F.col(f"`{c}`") for c in docs.columns])
