"""SimHash near-duplicates with pivot distance tables.

A text's fingerprint has, for every bit, the majority of that bit over the hashes of its word shingles.  Equal
fingerprints are one class.  Classes meet where two of the six blocks of their 64 bits agree, which any two within
four bits do (four differing bits spoil at most four blocks).  Each class carries its precomputed distances to
``PIVOTS`` reference fingerprints; by the triangle inequality a pair whose distances to some reference differ by
more than the limit is discarded, and the survivors are verified on the fingerprints themselves.

A large group of near copies would give a square number of pairs, so links are first sought only between the members
of a bucket and a few of its members (its smallest and largest fingerprints in several orders).  Two classes that
hang on the same one of these need no link of their own; the pair search covers the others, and only the links
between such stars leave it.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import connected_components, free_name, merged, with_text_columns, written

SEED = 42
BLOCKS = (11, 11, 11, 11, 10, 10)
PIVOTS, LANES = 21, 7                     # seven distances of nine bits fill a long
STARS = 4                                 # members of a bucket that the others are first compared with


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the lower-cased (A-Z) words, unsigned; 0 without a word."""
    words = text.encode().lower().split() if text else []      # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = len(words) - shingle + 1
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):          # bounded scratch space for very long texts
        bits = np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text: str, keep: list[str], shingle: int = 4, name: str = "fp") -> DataFrame:
    """The columns ``keep`` and the fingerprint as a (signed) long."""
    def make() -> Callable[[pa.Array], list]:
        def run(texts: pa.Array) -> list:
            f = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
            return [pa.array(f.view(np.int64))]
        return run
    return with_text_columns(docs, text, [T.StructField(name, T.LongType())], keep, make)


def references(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, as signed longs: hashes of the numbers from 0."""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(n)], np.uint64).view(np.int64).tolist()


def pivot_columns(fp: Column) -> list[Column]:
    """Distances to the references, seven to a long."""
    d = [F.bit_count(fp.bitwiseXOR(F.lit(r))).cast("long") for r in references()]
    return [reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(c, 9 * k) for k, c in enumerate(d[i:i + LANES])])
            for i in range(0, PIVOTS, LANES)]


def within(a: str, b: str, most: int) -> Column:
    """Whether the largest difference of the packed distances of ``a`` and ``b`` is at most ``most``.

    Each lane gets a guard bit; after the subtraction it is still set where a - b + most >= 0, all lanes at once.
    """
    guard = sum(256 << 9 * k for k in range(LANES))
    slack = F.lit(sum(most << 9 * k for k in range(LANES)))
    tests = []
    for i in range(PIVOTS // LANES):
        x, y = F.col(f"{a}.p{i}"), F.col(f"{b}.p{i}")
        tests += [(u.bitwiseOR(F.lit(guard)) - v + slack).bitwiseAND(F.lit(guard)) == F.lit(guard) for u, v in ((x, y), (y, x))]
    return reduce(lambda p, q: p & q, tests)


def buckets(fp: Column) -> Column:
    """For each of the 15 pairs of blocks: its number and the bits of the two blocks, as one long."""
    at = np.cumsum([0, *BLOCKS]).tolist()
    bits = [F.shiftrightunsigned(fp, at[i]).bitwiseAND(F.lit((1 << n) - 1)) for i, n in enumerate(BLOCKS)]
    return F.array(*[F.lit(k << 32).cast("long").bitwiseOR(F.shiftleft(bits[i], 16)).bitwiseOR(bits[j])
                     for k, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))])


def links_between(classes: DataFrame, most: int = 4) -> DataFrame:
    """From distinct fingerprints (fp) with their names (node) links (a, b) of nodes that connect just what all links
    within ``most`` bits connect."""
    if not 0 <= most <= 4:
        raise ValueError("two of six blocks agree for at most four differing bits")
    p = pivot_columns(F.col("fp"))

    def dealt(df: DataFrame, *more: str) -> DataFrame:
        return df.select("fp", "node", *more, *[c.alias(f"p{i}") for i, c in enumerate(p)],
                         F.explode(buckets(F.col("fp"))).alias("bucket"))
    close = within("x", "y", most) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= most)
    # a few members of each bucket that holds several: the ends of the orders by the fingerprint and by its hashes
    member = F.struct("fp", "node")
    orders = [F.col("fp"), *[F.xxhash64(F.col("fp"), F.lit(i)) for i in range(1, STARS // 2)]]
    stars = (dealt(classes).groupBy("bucket").agg(
        F.count("*").alias("n"), F.array_distinct(F.array(*[f(member, o) for o in orders for f in (F.min_by, F.max_by)])).alias("star"))
        .where("n > 1").select("bucket", F.explode("star").alias("s")).select("bucket", "s.fp", "s.node"))
    stars = stars.select("bucket", "fp", "node", *[c.alias(f"p{i}") for i, c in enumerate(p)])
    near = written(
        merged(dealt(classes).alias("x")).join(merged(stars.alias("y")), F.col("x.bucket") == F.col("y.bucket"))
        .where((F.col("x.fp") != F.col("y.fp")) & close)
        .groupBy(F.col("x.fp").alias("fp"), F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count("*").alias("n")),
        "simhash")
    # the rest: pairs that do not hang on the same star already
    label = near.groupBy("fp").agg(F.min("b").alias("star"))
    marked = dealt(classes.join(merged(label.withColumnRenamed("fp", "near_fp")), F.col("fp") == F.col("near_fp"), "left")
                   .select("fp", "node", F.least("star", "node").alias("label")), "label")
    x, y = merged(marked.alias("x")), merged(marked.alias("y"))
    rest = (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.fp") < F.col("y.fp"))
                   & (F.col("x.label") != F.col("y.label")) & close)
            .groupBy(F.col("x.label").alias("a"), F.col("y.label").alias("b")).agg(F.count("*").alias("n")))
    return near.select("a", "b").union(rest.select("a", "b"))


def labelled(docs: DataFrame, doc_id: str, text: str, shingle: int, most: int) -> tuple[DataFrame, DataFrame]:
    """A row a document (doc_id, text_hash, fp), and the component's node of each fingerprint (fp, c)."""
    key = "doc_id"
    named = F.col(f"`{doc_id}`")
    if not isinstance(docs.schema[doc_id].dataType, (T.IntegralType, T.StringType)):
        named = named.cast("string")
    facts = written(with_fingerprints(docs.select(named.alias(key), F.col(f"`{text}`").alias("t"),
                                                  F.xxhash64(F.col(f"`{text}`")).alias("text_hash")), "t", [key, "text_hash"], shingle),
                    "simhash")
    whole = isinstance(facts.schema[key].dataType, T.IntegralType)
    other = F.col("fp") if whole else F.col("fp").cast("string")
    # a class is named by its smallest id; one without any comes behind all others and is named by its fingerprint;
    # the fingerprint is part of the node, so an id that repeats under unrelated texts joins nothing
    classes = written(facts.groupBy("fp").agg(F.min(key).alias("first")).select(
        "fp", F.struct(F.col("first").isNull().alias("unnamed"), F.coalesce("first", other).alias("id"), "fp").alias("node")), "simhash")
    found = connected_components(links_between(classes, most)).withColumnRenamed("node", "member")
    return facts, classes.join(merged(found), classes.node == found.member, "left").select("fp", F.coalesce("component", "node").alias("c"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, most: int = 4
                    ) -> DataFrame:
    """One row a document: doc_id, fp (long), component_id, the smallest id that links lead to (its own included).

    Null and empty texts and texts without a word have fingerprint 0, which links like any other.  Repeated rows are
    equal fingerprints.  Null ids are kept, but never name a component that has another id.  An empty table gives no
    rows.  Ids that are neither whole numbers nor texts count as texts.  Links of equal fingerprints and of fingerprints ``most`` or fewer bits apart are complete.
    """
    facts, labels = labelled(docs, doc_id, text, shingle, most)
    labels = labels.select("fp", F.when(~F.col("c.unnamed"), F.col("c.id")).alias("component_id"))
    return merged(facts).join(labels, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, most: int = 4) -> DataFrame:
    """One document of each component, all columns: of the rows with its smallest id the one with the smallest text.

    A row with a null id stays if no other id is in its component; of several such rows of a component one stays.
    """
    facts, labels = labelled(docs, doc_id, text, shingle, most)
    name = F.when(~F.col("c.unnamed"), F.col("c.id"))
    held = written(merged(facts).join(labels, "fp").where(F.col("doc_id").eqNullSafe(name)).groupBy("c", "doc_id", "text_hash")
                   .agg(F.count("*").alias("n")), "simhash")
    total = held.groupBy("c").agg(F.sum("n").alias("rows"))
    key, hashed, c, n = (free_name(docs, x) for x in ("kept_id", "kept_hash", "kept_c", "kept_n"))
    kept = held.join(merged(total), "c").select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed), F.col("c").alias(c),
                                        F.col("rows").alias(n))
    match = docs.join(merged(kept), F.col(f"`{doc_id}`").cast(held.schema["doc_id"].dataType).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(hashed)))
    cols = [F.col(f"`{x}`") for x in docs.columns]
    single = match.where(F.col(n) == 1).select(*cols)
    # only rows of a component that has several are compared with each other, with map-side minima
    again = (match.where(F.col(n) > 1).groupBy(F.col(c))
             .agg(F.min(F.struct(F.col(f"`{text}`").alias("t"), F.struct(*cols).alias("row"))).alias("m"))
             .select(*[F.col(f"m.row.`{x}`") for x in docs.columns]))
    return single.union(again)
