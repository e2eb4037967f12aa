"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import foulee
from foulee.session import scratch_path

#: Rows and text bytes that a Python task holds at a time.
SLICE_ROWS = 2000
SLICE_BYTES = 4 << 20


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each application, whatever their search path is."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root, packed = Path(foulee.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}.zip")
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(packed.getvalue())
    finally:
        stream.close()
    context.addPyFile(target.toString())
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that one holds few rows and, unless a single value is larger, a
    bounded number of bytes of the text column at position ``at``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        start = 0
        while start < batch.num_rows:
            end, held = start, 0
            while end < batch.num_rows and end - start < SLICE_ROWS and (end == start or held + sizes[end] <= SLICE_BYTES):
                held += sizes[end]
                end += 1
            yield batch.slice(start, end - start)
            start = end


def annotate(
    docs: DataFrame,
    text_col: str,
    keep: Sequence[str],
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
) -> DataFrame:
    """Columns ``keep`` of ``docs``, then ``fields`` computed from the whole text, in bounded slices.

    ``make`` is called once in each task and returns the function from texts (UTF-8) to one array per
    field. Inside, columns go by position, so that no name of ``docs`` can clash; the fields' names must
    differ from those of ``keep``.
    """
    names = [*keep] if text_col in keep else [*keep, text_col]
    at = names.index(text_col)
    narrow = docs.select(*[col(name).alias(f"c{i}") for i, name in enumerate(names)])
    given = [T.StructField(f"c{i}", docs.schema[name].dataType) for i, name in enumerate(keep)]
    made = [T.StructField(f"r{i}", field.dataType) for i, field in enumerate(fields)]
    labels = [field.name for field in [*given, *made]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in slices(batches, at):
            work = work or make()
            results = work(batch.column(at).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(given)], *results], labels)

    out = map_arrow(narrow, run, T.StructType([*given, *made]))
    return out.select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(keep)],
        *[F.col(f"r{i}").alias(field.name) for i, field in enumerate(fields)],
    )


def fresh(names: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name in any case."""
    taken = {name.lower() for name in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def row_hashes(columns: Sequence[Column]) -> list[Column]:
    """Two independent hashes of a row, 128 bits together: what tells rows apart, and equal rows not."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]
