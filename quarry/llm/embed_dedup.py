"""Embedding near-duplicates by collision-counting projections.

Vectors are projected on many random lines.  In each of several tables, a few groups of lines deal the vectors into
buckets by the line of each group on which they lie farthest out, and to which side, so that only vectors that agree
there meet.  Rows that are dealt carry an id and one byte a counted line, never the vector: in a bucket each counted
line is sorted, every vector opens a window around its own value, and the windows' hits are counted for each pair.
Members without a pair of enough hits, nearly all of unrelated vectors, end there; only for the others the vectors are
joined, and pairs with enough hits are verified by their cosine in double precision.  The windows' width, the count and
the number of tables follow from the wanted recall for a pair at the limit.

All arithmetic that decides where vectors meet is done on integers, so every task agrees on it.  A pair that shares
several buckets is handled in the first of them only, so links are counted where they are found: no pair is emitted.
Large buckets are cut into tiles of bounded size.  Buckets are computed twice, once to find the large ones: a written
copy of all dealt rows would take as much disk as their shuffle.
"""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.llm.common import connected_components, written

LINES = 40               # projections whose window hits are counted, a byte each
WINDOW = 2.0             # half a window's width, in standard deviations of a limit pair's difference
STEP = 1 / 32            # of a counted projection; values beyond 4 standard deviations are cut to these
WIDEST = 128             # lines of a group at most
BUCKET = 256             # vectors a bucket should hold
TILE = 1024              # members of one side of a tile
SMALL_TABLE = 100_000    # large buckets up to which their table is broadcast
SCALE = 1 << 20


@dataclass(frozen=True)
class Plan:
    """Numbers that the wanted recall asks for."""
    limit: float
    tables: int
    groups: int          # of lines, that make a table's bucket
    width: int           # lines of a group
    half_width: int      # of a window, in steps
    least_hits: int


@lru_cache(maxsize=64)
def agreement(width: int, limit: float) -> float:
    """Chance that a pair with cosine ``limit`` lies farthest out on the same of ``width`` lines, on the same side.

    The pair's values on a line are normal with correlation ``limit``, whatever the number of dimensions: simulated.
    """
    rng, met, draws = np.random.Generator(np.random.PCG64(width)), 0, 1 << 15
    for _ in range(draws >> 11):
        a = rng.standard_normal((1 << 11, width))
        b = limit * a + math.sqrt(1 - limit * limit) * rng.standard_normal(a.shape)
        met += int((farthest(a[:, None, :]) == farthest(b[:, None, :])).sum())
    return met / draws


def calibrate(n: int, limit: float, recall: float) -> Plan:
    """For ``n`` vectors: a pair with cosine ``limit`` meets in a table and has enough hits with chance ``recall``."""
    miss, best = (1 - recall) / 2, None
    cells = max(4, n / BUCKET)
    for groups in range(1, 63):
        width = max(1, math.ceil(cells ** (1 / groups) / 2))
        if width <= WIDEST:
            tables = math.ceil(math.log(miss) / math.log(1 - agreement(width, limit) ** groups))
            best = min(best or (tables, groups, width), (tables, groups, width))
        if width == 1:
            break
    tables, groups, width = best
    p = math.erf(WINDOW / math.sqrt(2))                # a line's difference is normal for Gaussian lines
    below, hits = 0.0, 0
    while (below := below + math.comb(LINES, hits) * p ** hits * (1 - p) ** (LINES - hits)) <= miss:
        hits += 1
    half = math.ceil(WINDOW * math.sqrt(2 - 2 * limit) / STEP) + 1     # rounding widens a difference by a step at most
    return Plan(limit, tables, groups, width, half, hits)


@lru_cache(maxsize=8)
def lines(dims: int, n: int, seed: int) -> np.ndarray:
    """``n`` Gaussian directions with integer components (in 1/64)."""
    return np.rint(np.random.Generator(np.random.PCG64(seed)).standard_normal((n, dims)) * 64).T


def units(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that tiny and huge vectors neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def farthest(y: np.ndarray) -> np.ndarray:
    """Place of the largest absolute value along the last axis and its sign, as one number."""
    at = np.abs(y).argmax(axis=-1)
    return 2 * at + (np.take_along_axis(y, at[..., None], -1)[..., 0] > 0)


def table_keys(x: np.ndarray, plan: Plan, tables: int) -> np.ndarray:
    """Bucket of each unit vector in each of the first tables; sums of integers below 2**53, so exact in any order."""
    ints, own = np.rint(x * SCALE), lines(x.shape[1], plan.tables * plan.groups * plan.width, 1)
    keys = np.empty((len(x), tables), np.int64)
    powers, lot = (2 * plan.width) ** np.arange(plan.groups), plan.groups * plan.width
    for t in range(tables):
        y = (ints @ own[:, t * lot:(t + 1) * lot]).reshape(len(x), plan.groups, plan.width)
        keys[:, t] = farthest(y) @ powers
    return keys


def stepped(x: np.ndarray) -> np.ndarray:
    """Unit vectors on the counted lines, in steps."""
    y = np.rint(np.rint(x * SCALE) @ lines(x.shape[1], LINES, 2) / (SCALE * 64 * STEP))
    return np.clip(y, -127, 127).astype(np.int8)


def stacked(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def deal(classes: DataFrame, plan: Plan, carry: tuple[str, ...]) -> DataFrame:
    """A row for each class and table: the bucket where it meets others, the columns ``carry`` and, with these, its
    counted projections."""
    schema = T.StructType([T.StructField("dims", T.IntegerType()), T.StructField("table_no", T.IntegerType()),
                           T.StructField("bucket", T.LongType()), *[classes.schema[c] for c in carry],
                           *[T.StructField("code", T.BinaryType())] * bool(carry)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                sizes = pc.list_value_length(b.column("vec")).to_numpy(zero_copy_only=False)
                for dims in np.unique(sizes).tolist():
                    part = b.filter(pa.array(sizes == dims))
                    x = units(stacked(part.column("vec"), dims))
                    keys, n = table_keys(x, plan, plan.tables), len(x)
                    held = [part.column(c) for c in carry]
                    if carry:
                        ends = pa.array(np.arange(0, (n + 1) * LINES, LINES, dtype=np.int32))
                        held.append(pa.Array.from_buffers(pa.binary(), n, [None, ends.buffers()[1], pa.py_buffer(stepped(x).tobytes())]))
                    for t in range(plan.tables):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, dims, np.int32)), pa.array(np.full(n, t, np.int32)), pa.array(keys[:, t].copy()), *held],
                            names=schema.names)
    return classes.select("vec", *carry).mapInArrow(run, schema)


def window_hits(p: np.ndarray, half: int) -> np.ndarray:
    """For values (vectors x lines): on how many lines each vector's window holds each other vector.

    A line is sorted; a window is a range of its ranks, and a vector lies in it if its rank does.
    """
    n = len(p)
    hits, rank = np.zeros((n, n), np.int8), np.empty(n, np.uint16)
    for line in p.T.astype(np.int16):
        order = np.argsort(line, kind="stable")
        rank[order] = np.arange(n, dtype=np.uint16)
        first = np.searchsorted(line[order], line - half, "left")
        held = np.searchsorted(line[order], line + half, "right") - first
        hits += (rank[None, :] - first.astype(np.uint16)[:, None] < held.astype(np.uint16)[:, None]).view(np.int8)
    return hits


def counted(p: np.ndarray, side: np.ndarray | None, plan: Plan) -> np.ndarray:
    """Pairs (symmetric, boolean) with enough hits; with ``side`` only those across."""
    near = window_hits(p, plan.half_width) >= plan.least_hits
    if side is not None:
        near &= side[:, None] != side[None, :]
    np.fill_diagonal(near, False)
    return near


def links_in(x: np.ndarray, table_no: int, side: np.ndarray | None, plan: Plan) -> np.ndarray:
    """Links (symmetric, boolean) between members of a bucket that meet here first; with ``side`` only those across."""
    near = counted(stepped(x), side, plan)
    for key in table_keys(x, plan, table_no).T:
        near &= key[:, None] != key[None, :]
    out = np.zeros_like(near)
    a, b = np.nonzero(np.triu(near))
    for i in range(0, len(a), 1 << 16):
        u, v = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
        ok = np.einsum("ij,ij->i", x[u], x[v]) >= plan.limit
        out[u[ok], v[ok]] = out[v[ok], u[ok]] = True
    return out


def roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index of each member's component."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", limit: float = 0.9,
                 recall: float = 0.999) -> DataFrame:
    """One row a vector: vec_id, n_links (other rows linked directly), component_id (smallest id that links lead to).

    No link is below the limit; a pair at the limit is found with chance ``recall`` and closer ones almost surely.
    Equal vectors are one class, counted as often as they occur, so copies need no pairs.  Vectors that are null,
    empty or zero, or hold null or non-finite components, link with nothing, as do vectors of different lengths.  Null
    ids are kept and never name a component that has another id.  Whole-number ids give a long component_id, ids of
    other types a string, smallest by its bytes.  An empty table gives no rows.
    """
    e = F.col("vec")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("vec"))
    kind = T.LongType() if isinstance(rows.schema["vec_id"].dataType, T.IntegralType) else T.StringType()
    sound = F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("class", F.when(sound, F.sha2(F.to_json(F.struct("vec")).cast("binary"), 256)))
    classes = (rows.where(F.col("class").isNotNull()).groupBy("class")
               .agg(F.min(F.col("vec_id").cast(kind)).alias("first"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
               .select("class", F.col("first").isNull().alias("unnamed"),
                       F.coalesce("first", F.xxhash64("class").cast(kind)).alias("id"), "copies", "vec"))
    classes = written(classes, "vectors")
    plan = calibrate(classes.count(), limit, recall)
    place = ["dims", "table_no", "bucket"]
    large = written(deal(classes, plan, ()).groupBy(*place).agg(F.count("*").alias("members"))
                    .where(F.col("members") > TILE), "vectors")
    parts = F.ceil(F.coalesce("members", F.lit(1)) / TILE).cast("int")
    few = large.count() <= SMALL_TABLE
    dealt = (deal(classes, plan, ("unnamed", "id")).join(F.broadcast(large) if few else large, place, "left")
             .withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("unnamed", "id"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other")).drop("members", "parts", "other"))
    place += ["lo", "hi"]
    members = dealt.drop("code").schema

    def meet(group: pa.Table) -> pa.Table:
        code = group.column("code").combine_chunks()
        side = group.column("part").to_numpy() if group.column("lo")[0] != group.column("hi")[0] else None
        p = np.frombuffer(b"".join(code.to_pylist()), np.int8).reshape(-1, LINES)
        return group.select(members.names).filter(pa.array(counted(p, side, plan).any(axis=1)))
    # members with a counted pair, and then their vectors
    met = written(dealt.groupBy(*place).applyInArrow(meet, members), "vectors")
    held = classes.select(F.col("unnamed").alias("u"), F.col("id").alias("i"), "copies", "vec")
    tiles = met.join(held, (F.col("unnamed") == F.col("u")) & (F.col("id") == F.col("i"))).drop("u", "i")
    result = T.StructType([T.StructField("unnamed", T.BooleanType()), T.StructField("id", kind),
                           T.StructField("links", T.LongType()), T.StructField("root_unnamed", T.BooleanType()),
                           T.StructField("root_id", kind)])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in result])

    def tile(group: pa.Table) -> pa.Table:
        group = group.sort_by([("unnamed", "ascending"), ("id", "ascending")])
        first = {c: group.column(c)[0].as_py() for c in ("dims", "table_no", "lo", "hi")}
        x = units(stacked(group.column("vec").combine_chunks(), first["dims"]))
        side = group.column("part").to_numpy() if first["lo"] != first["hi"] else None
        linked = links_in(x, first["table_no"], side, plan)
        at = np.flatnonzero(linked.any(axis=1))
        own, root = (group.select(["unnamed", "id"]).take(pa.array(i)) for i in (at, roots(linked)[at]))
        links = pa.array((linked[at] @ group.column("copies").to_numpy()).astype(np.int64))
        return pa.table([*own.columns, links, *root.columns], names=result.names).cast(arrow)
    found = written(tiles.groupBy(*place).applyInArrow(tile, result), "vectors")
    node, root = F.struct("unnamed", "id"), F.struct(F.col("root_unnamed").alias("unnamed"), F.col("root_id").alias("id"))
    names = connected_components(found.select(node.alias("a"), root.alias("b"))).select(F.col("node").alias("member"), "component")
    counts = found.groupBy("unnamed", "id").agg(F.sum("links").alias("links")).select(node.alias("counted"), "links")
    named = (classes.select("class", "copies", node.alias("me"))
             .join(names, F.col("me") == F.col("member"), "left").join(counts, F.col("me") == F.col("counted"), "left")
             .select(F.col("class").alias("of"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "me").alias("c")))
    named = named.select("of", "n_links", F.when(~F.col("c.unnamed"), F.col("c.id")).alias("component_id"))
    joined = rows.where(F.col("class").isNotNull()).select("vec_id", "class").join(named, F.col("class") == F.col("of")).select(
        "vec_id", "n_links", "component_id")
    alone = rows.where(F.col("class").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                       F.col("vec_id").cast(kind).alias("component_id"))
    return joined.union(alone)
