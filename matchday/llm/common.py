"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder (any path Spark can read)."""
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch.  A batch is held in memory whole, by the executor and
#: by its Python worker, and Spark's default of 10,000 is for rows of numbers.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> SparkSession:
    """Ready a session for these operators.

    Sends this package to the executors, once, so that their Python workers can
    import it wherever the driver was started from; and makes Arrow batches of
    1000 rows, for long texts, unless the session has a number of its own.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(), os.path.basename(package))
        context.addPyFile(
            shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
        )
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as Parquet in the session's shared checkpoint folder.

    Cuts the lineage at the price of one write: the rows outlive any executor,
    and several readers do not compute them again.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batch: pa.RecordBatch, name: str, max_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of a batch with about ``max_bytes`` of text in column
    ``name`` each, one row at least, so that work space does not depend on the
    batch size."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        floor = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, floor + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_text(
    df: DataFrame,
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[pa.RecordBatch], list]],
    text: str = "text",
    drop: Sequence[str] = (),
) -> DataFrame:
    """Append columns computed from each slice of rows.

    ``make()`` runs once per task and returns the function that turns a slice
    into one Arrow-convertible column per field.  Columns of ``df`` that carry
    a name of ``fields`` are replaced; those in ``drop`` are left out.
    """
    ship(df.sparkSession)
    names = [f.name for f in fields]
    gone = {n.lower() for n in (*names, *drop)}
    kept = [c for c in df.columns if c.lower() not in gone]
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        types = [_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            for part in text_slices(batch, text):
                made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(compute(part), types)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], [*kept, *names])

    return df.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow_type(f.dataType)) for f in kind.fields])
    return {
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
        T.DoubleType: pa.float64(),
        T.StringType: pa.string(),
        T.BinaryType: pa.binary(),
        T.BooleanType: pa.bool_(),
    }[type(kind)]


def field(name: str, kind: str) -> T.StructField:
    """A nullable field from a DDL type."""
    return T.StructField(name, T._parse_datatype_string(kind) if "<" in kind else _DDL[kind])


_DDL = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
}


def rank_in_cells(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: Column, cells: Column, name: str = "rank"
) -> DataFrame:
    """Number the rows of every key from 0, without one task per key.

    ``cells`` says into how many cells the rows of a key are dealt (a function
    of the key alone, about its row count / rows per cell) and ``spread`` is a
    hash of the row.  Rows are numbered by a window inside a cell; the cells
    of a key get their starts from a running sum over the cell counts.  A hot
    key is thus numbered by as many tasks as it has cells.
    """
    dealt = df.withColumn("__cell", F.pmod(spread, cells))
    inside = Window.partitionBy(*keys, "__cell").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "__cell")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*keys, "__cell")]
    numbered = dealt.withColumn("__row", F.row_number().over(inside) - 1)
    joined = numbered.alias("a").join(starts.alias("b"), on=same)
    return joined.select("a.*", (F.col("a.__row") + F.col("b.__start")).cast("long").alias(name)).drop("__cell", "__row")
