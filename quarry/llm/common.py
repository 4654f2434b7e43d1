"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.session import ensure_checkpoint_dir

EDGES_A_FILE = 1_000_000


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder name below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, and a lost executor loses no part of it."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files of a table made by :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = hadoop.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def merged(df: DataFrame) -> DataFrame:
    """``df``, for joins by a merge: Spark sizes a table by the compressed files it comes from, and what an explode makes of a
    row as one row, so it might broadcast many times its limit."""
    return df.hint("merge")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces whose text takes about ``most_bytes`` (one row at least), so long texts do not add up."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if held and held + (n or 0) > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def with_text_columns(df: DataFrame, text: str, fields: list[T.StructField], keep: list[str],
                      make: Callable[[], Callable[[pa.Array], list]]) -> DataFrame:
    """The columns ``keep`` of ``df`` and ``fields``, computed from the whole texts with ``mapInArrow``.

    ``make`` runs once a task; its result gets the texts of a bounded piece (an Arrow array with nulls) and returns
    one Arrow array a field.  A field replaces a kept column of the same name.
    """
    new = [f.name for f in fields]
    plain = isinstance(df.schema[text].dataType, T.StringType)
    carry = text if plain and text in keep and text not in new else "quarry text"
    keep = [c for c in keep if c not in new]
    cols = [F.col(f"`{c}`") for c in keep]
    if carry not in keep:
        cols.append(F.col(f"`{text}`").cast("string").alias(carry))
    schema = T.StructType([*[df.schema[c] for c in keep], *fields])
    arrow = [to_arrow_type(f.dataType) for f in fields]
    at = keep.index(carry) if carry in keep else len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for piece in slices(batch, at):
                made = f(piece.column(at))
                made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, arrow)]
                yield pa.RecordBatch.from_arrays([*piece.columns[:len(keep)], *made], names=[*keep, *new])
    return df.select(*cols).mapInArrow(run, schema)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label the nodes of undirected ``edges`` with the smallest node of their component: rows (node, component).

    Alternates the large-star and small-star steps: every node hands its larger (then its other) neighbours over to
    its smallest one, until each node hangs on just one root.  A step is one grouped minimum with map-side combining
    and one join on the node, which AQE may split at a hub; the edges of each round are a written table, so no lineage
    builds up.  Rows with a null end are ignored.
    """
    state = written(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                    .where(f"`{a}` is not null and `{b}` is not null and lo <> hi").distinct(), "edges")
    parts = state.count() // EDGES_A_FILE + 1          # rounds only shrink the edges to one a node
    while True:
        ends = state.selectExpr("hi n", "1L up", "0L down").union(state.selectExpr("lo n", "0L up", "1L down"))
        if ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty():
            break
        # large star: the larger neighbours of u go to the smallest neighbour of u (or u)
        both = state.selectExpr("lo u", "hi v").union(state.selectExpr("hi u", "lo v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").selectExpr("m lo", "v hi")
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")),
            F.struct(F.col("m").alias("lo"), F.col("hi").alias("hi")))).alias("e"))
            .select("e.lo", "e.hi").where("lo <> hi").distinct())
        new = written(small.coalesce(parts), "edges")
        forget(state)
        state = new
    return (state.selectExpr("hi node", "lo component")
            .union(state.selectExpr("lo node", "lo component").distinct()))
