"""Conversation prefix trie, built as burst tries.

A conversation is the sequence of its turns' ids (128 bits of SHA-256 of role and text).  Equal conversations become one
sequence with a count.  All sequences start in one container under the root.  A container of more than ``MOST``
sequences bursts: what all its sequences share becomes a chain of trie heads (the common prefix of a set is that of its
smallest and its largest sequence), and behind it the sequences are dealt to one container for each next turn id, until
no container is oversized.  Each round moves only the rows of containers that burst.  The containers left are small, lie
on shards by their head, and each is sorted and swept into nodes with a stack of open nodes.  Leaves and saved tokens of
a head are sums over the containers and chains beneath it, which carry the list of their heads.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.llm.common import forget, written

MOST = 256                    # sequences a container holds
MOST_SHARED, GROUP = 6, 100   # a conversation takes up to crc32(id) % 6 turns from the first of its group of ids
BLOCK_BITS = 10               # ids of copies are joined into text in blocks of 1,024
NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv_id and ``seq``, its turns in order as array of (id, chars).  Texts stay where they are:
    24 bytes a turn are shuffled."""
    who, said = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    # the length in front keeps role and text apart
    digest = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said).cast("binary"), 256))
    rows = df.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), F.substring(digest, 1, 16).alias("id"), F.length(said).alias("chars")).alias("t"))
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
            .select("conv_id", F.transform("ts", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("seq")))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Every conversation c: the first h turns of conversation c - c % 100, then its own behind its first h; h = crc32(c) % 6."""
    heads = seqs.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, MOST_SHARED - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    own = seqs.select("conv_id", "seq", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(seqs.schema["seq"].dataType))
    # slice() takes a length of 0 but no negative one
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(first, rest).alias("seq"))


def path_id(seq: Column, depth: Column | None = None) -> Column:
    """A digest of the first ``depth`` turns (all by default)."""
    part = seq if depth is None else F.slice(seq, F.lit(1), depth)
    return F.sha2(F.array_join(F.transform(part, lambda t: F.hex(t["id"])), "").cast("binary"), 256)


def id_digests(convs: DataFrame) -> DataFrame:
    """Per ``key`` of ``convs`` (key, conv_id): copies, smallest conv_id, SHA-256 of the ids, ascending, comma-joined.

    A digest runs through its ids one after the other, so the ids of a group are joined into text first, in blocks of
    neighbouring ids (at most 1,024 each) on many tasks, and one pass over the sorted blocks feeds them to the digest; it
    holds one block of rows at a time."""
    ids = F.sort_array(F.collect_list("conv_id"))
    blocks = (convs.groupBy("key", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(ids.alias("ids"))
              .select("key", "block", F.array_min("ids").alias("conv"), F.size("ids").cast("long").alias("n"),
                      F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("part")))
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("conv", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("ends", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, conv, n, state = None, 0, 0, hashlib.sha256()
        for batch in batches:
            out = []
            for k, c, m, part in zip(*(batch.column(x).to_pylist() for x in ("key", "conv", "n", "part"))):
                if k != key:
                    if key is not None:
                        out.append((key, conv, n, state.hexdigest()))
                    key, conv, n, state = k, c, 0, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(part.encode())
                n += m
            yield record(out, schema)
        if key is not None:
            yield record([(key, conv, n, state.hexdigest())], schema)
    return blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(run, schema)


def record(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    kind = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kind)], schema=kind)


NODE = T.StructType([T.StructField(c, T.LongType()) for c in
                     ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
                    + [T.StructField("ends", T.StringType()), T.StructField("heads", T.ArrayType(T.StringType())),
                       T.StructField("top", T.BooleanType())])


class Open:
    """A node whose subtree is not swept yet; its finished children wait for its smallest conversation."""
    __slots__ = ("id", "depth", "chars", "conv", "n", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, turn: dict | None):
        self.id, self.chars = (turn["id"], turn["chars"]) if turn else (None, 0)
        self.depth, self.conv, self.n, self.leaves, self.saved, self.ends, self.waiting = depth, None, 0, 0, 0, None, []


def sweep(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Nodes of containers from rows (cid, depth, up, heads, seq, conv, n, ends) sorted by container and sequence.

    A container's own node is the path of ``depth`` turns that its sequences share; its parent is ``up``."""
    stack: list[Open] = []
    cid = up = heads = None

    def close() -> Iterator[tuple]:
        x = stack.pop()
        x.saved += (x.n - 1) * x.chars
        x.leaves = x.leaves or 1
        for y in x.waiting:
            yield y[0], y[1], x.conv, *y[2:]
        row = (x.conv, x.depth, x.n, len(x.waiting), x.leaves, x.saved, x.ends or NOTHING)
        if stack:
            p = stack[-1]
            p.conv = x.conv if p.conv is None else min(p.conv, x.conv)
            p.n, p.leaves, p.saved = p.n + x.n, p.leaves + x.leaves, p.saved + x.saved
            p.waiting.append((*row, None, False))
        else:
            yield row[0], row[1], up, *row[2:], heads, True

    for c, depth, u, hs, seq, conv, n, ends in rows:
        if c != cid:
            while stack:
                yield from close()
            cid, up, heads = c, u, hs
            stack.append(Open(depth, seq[depth - 1] if depth else None))
        same = depth
        while same < len(seq) and same - depth + 1 < len(stack) and stack[same - depth + 1].id == seq[same]["id"]:
            same += 1
        while len(stack) > same - depth + 1:
            yield from close()
        for d in range(same, len(seq)):
            stack.append(Open(d + 1, seq[d]))
        end = stack[-1]
        end.ends, end.n = ends, end.n + n
        end.conv = conv if end.conv is None else min(end.conv, conv)
    while stack:
        yield from close()


def swept(containers: DataFrame) -> DataFrame:
    names = ("cid", "depth", "up", "heads", "seq", "conv", "n", "ends")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(0, batch.num_rows, 512):
                    yield from zip(*(batch.column(c).slice(i, 512).to_pylist() for c in names))
        out = []
        for node in sweep(rows()):
            out.append(node)
            if len(out) == 4096:
                yield record(out, NODE)
                out = []
        yield record(out, NODE)
    return containers.select(*names).repartition("cid").sortWithinPartitions("cid", "seq").mapInArrow(run, NODE)


def burst(containers: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """The containers left (rows of sequences), a table of the containers that burst for each round, and the tables that
    the first is read from.

    A burst container: cid, depth (of its own node), deep (turns that its sequences share), up, heads, conv, n, lo (its
    smallest sequence)."""
    done, bursts, made = [], [], [containers]
    while True:
        lo, hi = F.col("lo"), F.col("hi")
        # two sequences differ first at the place behind their common turns, or where the shorter one ends
        short = F.least(F.size(lo), F.size(hi))
        places = F.when(short > F.col("depth"), F.sequence(F.col("depth") + 1, short)).otherwise(F.array().cast("array<int>"))
        differ = F.array_min(F.filter(places, lambda i: F.element_at(lo, i)["id"] != F.element_at(hi, i)["id"]))
        big = written(containers.groupBy("cid").agg(
            F.count(F.lit(1)).alias("rows"), F.first("depth").alias("depth"), F.first("up").alias("up"), F.first("heads").alias("heads"),
            F.min("conv").alias("conv"), F.sum("n").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"))
            .where(F.col("rows") > most)
            .withColumn("deep", F.coalesce(differ - 1, short))
            .select("cid", "depth", "deep", "up", "heads", "conv", "n", "lo"), "bursts")
        if big.isEmpty():
            forget(big)
            return reduce(DataFrame.unionByName, [*done, containers]), bursts, made
        bursts.append(big)
        done.append(containers.join(big.select("cid"), "cid", "left_anti"))
        # the sequence that ends where the common prefix ends belongs to the head itself
        over = big.select("cid", "deep", F.col("conv").alias("first"))
        dealt = containers.drop("up").join(over, "cid").where(F.size("seq") > F.col("deep"))
        containers = written(dealt.select(
            path_id(F.col("seq"), F.col("deep") + 1).alias("cid"), (F.col("deep") + 1).alias("depth"), F.col("first").alias("up"),
            F.array_append("heads", F.col("cid")).alias("heads"), "seq", "conv", "n", "ends"), "containers")
        made.append(containers)


def head_nodes(bursts: list[DataFrame], tops: DataFrame, ends: DataFrame) -> DataFrame:
    """The nodes above the containers: one for each turn of a burst container's chain."""
    big = reduce(DataFrame.unionByName, bursts)
    # the chain's turns that are tokens of its own, the last first: (depth, chars of that turn)
    chain = F.transform(F.sequence(F.col("deep"), F.col("depth"), F.lit(-1)), lambda d: F.struct(
        d.alias("depth"), F.when(d > 0, F.element_at("lo", F.when(d > 0, d).otherwise(1))["chars"]).otherwise(0).alias("chars")))
    big = big.withColumn("chain", chain).withColumn("chain_saved", (F.col("n") - 1) * F.aggregate(
        "chain", F.lit(0).cast("long"), lambda a, x: a + x["chars"]))
    below = (tops.select("heads", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
             .union(big.select("heads", F.lit(0).cast("long"), "chain_saved"))
             .select(F.posexplode("heads").alias("i", "cid"), F.size("heads").alias("m"), "leaves", "saved")
             .groupBy("cid").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
                                 F.sum((F.col("i") == F.col("m") - 1).cast("long")).alias("children")))
    key = path_id(F.col("lo"), F.col("deep"))
    found = (big.join(below, "cid").withColumn("key", key)
             .join(ends.select("key", "ends"), "key", "left"))
    # saved tokens of a chain's node: those below, and those of the chain from its end up to it
    run = F.aggregate("chain", F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all")), lambda a, x: F.struct(
        (a["sum"] + x["chars"]).alias("sum"), F.array_append(a["all"], a["sum"] + x["chars"]).alias("all")))["all"]
    each = F.explode(F.arrays_zip(F.col("chain"), run.alias("upto")))
    last = F.col("x.chain.depth") == F.col("deep")
    return found.withColumn("x", each).select(
        F.col("conv").alias("conv_id"), F.col("x.chain.depth").cast("long").alias("depth"),
        F.when(F.col("x.chain.depth") == F.col("depth"), F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") + (F.col("n") - 1) * F.col("x.upto")).alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(NOTHING))).otherwise(NOTHING).alias("ends_sha256"))


def prefix_trie(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                most: int = MOST) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Turns stand by turn number, null first; rows of equal number by the digest of role and text, and repeated rows are
    repeated turns.  Null role or text: empty.  Conversation ids are whole numbers; rows with a null id belong to no
    conversation.  A conversation without turns is a member of the root alone.  No conversation, no node, not even the
    root.  Other columns play no part.  A task holds one conversation's turn ids and one container at a time.
    """
    raw = written(sequences(df, conv_id, turn, role, text), "sequences")
    convs = written(rebuilt(raw).withColumn("key", path_id(F.col("seq"))), "rebuilt")
    forget(raw)
    ends = written(id_digests(convs.select("key", "conv_id")), "ends")
    # equal conversations once, by the smallest of their ids
    distinct = ends.join(convs.select(F.col("conv_id").alias("conv"), "seq"), "conv")
    start = written(distinct.select(
        F.lit("").alias("cid"), F.lit(0).alias("depth"), F.lit(None).cast("long").alias("up"),
        F.array().cast("array<string>").alias("heads"), "seq", "conv", "n", "ends"), "containers")
    forget(convs)
    left, bursts, made = burst(start, most)
    nodes = written(swept(left), "nodes")
    for table in made:
        forget(table)
    plain = nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                         F.col("ends").alias("ends_sha256"))
    return plain.unionByName(head_nodes(bursts, nodes.where("top"), ends)) if bursts else plain
