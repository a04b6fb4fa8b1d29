"""What the operators share: the shared folder, byte-bounded Arrow slices, schema helpers, components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a Python worker holds at once.
SLICE_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset and all run on one machine (tests)."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    current = context._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not named and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="webloom-"))
        current = context._jsc.sc().getCheckpointDir()
    return named or current.get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/webloom-{name}-{uuid.uuid4().hex}"


#: Rows of a file of what is stored on the way, where a bound of the rows is known.
ROWS = 20_000


def checkpointed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df with its lineage cut through reliable storage; the files go when nothing refers to them.

    rows: a bound of their number, for no more files than they need, however many partitions a shuffle has."""
    shared_dir(df.sparkSession)
    return (df if rows is None else df.coalesce(max(1, -(-rows // ROWS)))).checkpoint(eager=True)


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """schema without any column of that name, then the column."""
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind, True)])


def unused(name: str, columns: list[str]) -> str:
    """The name, or one made from it that no column has."""
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in ``column`` each; a longer value stands alone, whole."""
    array = batch.column(batch.schema.get_field_index(column))
    if array.nbytes <= most or len(array) < 2:
        yield batch
        return
    sizes = np.diff(np.frombuffer(array.buffers()[1], dtype=np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32)[array.offset : array.offset + len(array) + 1])
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)


def replaced(batch: pa.RecordBatch, name: str, array: pa.Array) -> pa.RecordBatch:
    """The batch with ``array`` as its last column ``name``, instead of any column of that name."""
    keep = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [array], [batch.schema.names[i] for i in keep] + [name])


def utf8(column) -> list[bytes]:
    """Text values as UTF-8; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def release() -> None:
    """Gives a worker's free memory back to the system: the JVM's heap and the next stage's workers stand beside it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(run):
    """run(batches) for an Arrow worker, whose Arrow memory comes from the system's allocator and goes back at the end."""

    def wrapped(batches):
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


class TwoGenerations:
    """A bounded table of what was computed for a key: when the young half is full, the old half goes."""

    def __init__(self, half: int):
        self.half, self.young, self.old = half, {}, {}

    def missing(self, keys) -> list:
        out = []
        for key in keys:
            if key not in self.young:
                if key in self.old:
                    self.young[key] = self.old[key]
                else:
                    out.append(key)
        return out

    def rotate(self) -> None:
        """Call between slices, so that the keys of a slice stay together in the young half."""
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}


def stable_sample(df: DataFrame, key: str, most: int, by: str) -> DataFrame:
    """About ``most`` rows of each value of ``by``, all where there are fewer: those whose key's hash lies in the lowest ``most``/n.

    One rule at every size; the values are counted by partial sums, and no value's rows are gathered. The counts are broadcast: a
    fitted model holds as many entries as there are values in any case."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("__rows")).withColumnRenamed(by, "__by")
    place = F.pmod(F.xxhash64(F.lit(7), F.col(key).cast("string")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return df.join(F.broadcast(counts), F.col(by) == F.col("__by")).where(place * F.col("__rows") < most).drop("__by", "__rows")


def components(edges: DataFrame, a: str, b: str, rounds: int = 60, most: int | None = None) -> DataFrame:
    """Connected components as (node, root), root the smallest node that can be reached; only nodes with edges.

    Alternates large-star and small-star steps until nothing changes. Each step moves a number of edges that doesn't exceed
    the input's; a node of very high degree is handled by a pre-aggregated minimum and a join, never collected. most: a bound of
    the edges' number, if one is known.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = checkpointed(links, most)
    before = None
    most = links.count()
    for _ in range(rounds):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        links = checkpointed(small, most)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def logistic(design: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights of a logistic regression by Newton's steps, each shortened until the loss falls."""
    w = np.zeros(design.shape[1])

    def loss(w):
        z = design @ w
        return float((np.logaddexp(0, z) - labels * z).sum() + ridge * (w**2).sum() / 2)

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -50, 50)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w)), design.T @ (labels - p) - ridge * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        before, now = now, loss(w)
        if before - now < 1e-9 * max(1.0, before):
            break
    return w
