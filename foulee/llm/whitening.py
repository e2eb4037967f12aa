"""Whitening of embeddings by an incremental eigendecomposition that is refined over all rows.

Vectors are fixed-point (arrays of longs), so counts and sums are exact integers and every deviation from the mean is
formed from integers before anything is multiplied.

* Each partition keeps a ``Spectrum``: one centred rank-one update for each vector (secular equation, deflation).
* Spectra are combined ``FAN`` at a time, round by round, each pair of one as a further rank-one update. A spectrum has
  the square of the dimension in numbers, whatever the number of rows, and only the last one reaches the driver.
* Rayleigh-Ritz: all rows are projected on the combined basis, their products are summed, and the small eigenproblem of
  these sums turns the basis into the eigenvectors of the exact covariance. What rounding the updates left is gone.

Rows are never shuffled: the table is read for the sums and spectra, for the refinement, for the covariance of the
whitened rows, and for the result. Between tasks go squares of the dimension only.

Cases: a row goes if its vector is null or holds a null, NaN or infinite entry, or one of 2**34 or more in size, whose
squares leave the exact range. So does a vector whose length is not the commonest (of equally common ones the largest)
or zero: it has no place in the space. Repeated rows and null ids are rows like others. A component without variance has
no scale: its ``whitened`` is null. An empty table gives an empty result. ``deviation`` is exact; beyond 38 digits, and
as a long in the query beyond 63 bits, it is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee.llm.frames import col, map_arrow, read
from foulee.llm.spectrum import Spectrum
from foulee.session import staged

COMPONENTS = 32
#: Spectra that one task combines.
FAN = 8
LARGEST = float(1 << 34)
_EXACT = float(1 << 62)
_NO_VARIANCE = 1e-14

_SPECTRUM = "slot long, n long, sums array<decimal(38,0)>, mean array<double>, values array<double>, vectors array<double>"


def fixed_point(vector: Column, scale: int = 1, shift: int = 0) -> Column:
    """``floor(scale * entry) + shift`` of each entry; null if the vector has an entry that is no number in range."""
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _spectra(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, sums = Spectrum(size), [0] * size
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(0))
                # Of 2**41 at most, so that a batch of rows stays within 64 bits.
                for part in np.array_split(rows, -(-len(rows) // (1 << 20))):
                    sums = [a + b for a, b in zip(sums, part.sum(axis=0).tolist())]
                for row in rows.astype(float):
                    spectrum.add(row)
        if spectrum.n:
            yield _row(TaskContext.get().partitionId(), spectrum, sums)

    return run


def _row(slot: int, spectrum: Spectrum, sums: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([slot], pa.int64()),
            pa.array([spectrum.n], pa.int64()),
            pa.array([[Decimal(s) for s in sums]], pa.list_(pa.decimal128(38, 0))),
            *(pa.array([x.ravel()], pa.list_(pa.float64())) for x in (spectrum.mean, spectrum.values, spectrum.vectors)),
        ],
        ["slot", "n", "sums", "mean", "values", "vectors"],
    )


def _load(row: dict) -> tuple[Spectrum, list[int]]:
    found = Spectrum(len(row["mean"]))
    found.n, found.mean, found.values = row["n"], np.array(row["mean"]), np.array(row["values"])
    found.vectors = np.array(row["vectors"]).reshape(len(found.mean), -1)
    return found, [int(s) for s in row["sums"]]


def _combine(table: pa.Table) -> pa.Table:
    """The spectra of a group, ``FAN`` at most, in order of their slots."""
    rows = sorted(table.to_pylist(), key=lambda row: row["slot"])
    whole, sums = _load(rows[0])
    for row in rows[1:]:
        other, own = _load(row)
        whole.merge(other)
        sums = [a + b for a, b in zip(sums, own)]
    return pa.Table.from_batches([_row(rows[0]["slot"] // FAN, whole, sums)])


@dataclass(frozen=True)
class Whitening:
    """Mean (as sums over n) and principal directions of a table of vectors."""

    n: int
    sums: tuple[int, ...]
    variances: np.ndarray
    #: One direction in each column, by falling variance.
    directions: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        total = self.variances.sum()
        return self.variances / total if total > 0 else np.zeros(len(self.variances))

    @property
    def known(self) -> np.ndarray:
        """Components that have variance."""
        return self.variances > _NO_VARIANCE * max(self.variances.max(initial=0.0), 0.0)

    def offsets(self, rows: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit numbers where they suffice, else Python's."""
        sums = np.array(self.sums, object)
        if self.n * (float(np.abs(rows).max(initial=0)) + 1) + float(max(map(abs, self.sums))) < _EXACT:
            return rows * np.int64(self.n) - sums.astype(np.int64)
        return rows.astype(object) * self.n - sums

    def deviations(self, offsets: np.ndarray) -> pa.Array:
        kind = pa.decimal128(38, 0)
        if float(np.abs(offsets).max(initial=0)) ** 2 * offsets.shape[1] < _EXACT:
            return pa.array((offsets * offsets).sum(axis=1).astype(np.int64)).cast(kind)
        squares = (offsets.astype(object) ** 2).sum(axis=1)
        return pa.array([Decimal(int(s)) if s < 10**38 else None for s in squares], kind)

    def centred(self, offsets: np.ndarray) -> np.ndarray:
        return offsets.astype(float) / self.n

    def whitened(self, offsets: np.ndarray, components: int) -> np.ndarray:
        """Rows by component; NaN for one without variance."""
        scale = np.where(self.known, np.sqrt(np.where(self.known, self.variances, 1)), np.nan)[:components]
        return self.centred(offsets) @ self.directions[:, :components] / scale


def _products(vectors: DataFrame, project, size: int) -> np.ndarray:
    """Sum over all rows of the products of each two of ``size`` projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                y = project(_matrix(batch.column(0)))
                total += y.T @ y
        i, j = np.indices((size, size)).reshape(2, -1)
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "product"])

    sums = map_arrow(vectors, run, "i int, j int, product double").groupBy("i", "j").agg(F.sum("product").alias("product"))
    found = sums.toArrow()
    out = np.zeros((size, size))
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["product"].to_numpy()
    return (out + out.T) / 2


def usable(df: DataFrame, vector: Column, keep: list[Column]) -> tuple[DataFrame, int]:
    """Columns ``keep`` and ``x`` of the rows whose vector has a place in the space, and the dimension."""
    rows = df.select(*keep, vector.alias("x")).filter("x is not null and size(x) > 0")
    sizes = rows.groupBy(F.size("x").alias("size")).count()
    commonest = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = commonest["size"] if commonest else 0
    return rows.filter(F.size("x") == size), size


def fit(vectors: DataFrame, size: int) -> Whitening | None:
    """Fits all rows of ``vectors``, a column ``x`` of arrays of ``size`` longs; None if there is no row."""
    vectors = vectors.select("x")
    spectra = staged(map_arrow(vectors, _spectra(size), _SPECTRUM), "spectra")
    while spectra.count() > 1:
        groups = spectra.groupBy(F.floor(F.col("slot") / FAN))
        spectra = staged(groups.applyInArrow(_combine, _SPECTRUM), "spectra")
    row = spectra.first()
    if row is None:
        return None
    combined, sums = _load(row.asDict())
    start = Whitening(row["n"], tuple(sums), combined.values, combined.vectors)
    basis = np.linalg.qr(combined.vectors)[0]
    sums_of_products = _products(vectors, lambda rows: start.centred(start.offsets(rows)) @ basis, size)
    values, turns = np.linalg.eigh(sums_of_products / start.n)
    order = np.argsort(-values, kind="stable")
    return Whitening(start.n, start.sums, np.maximum(values[order], 0), (basis @ turns)[:, order])


def identity_error(vectors: DataFrame, fitted: Whitening, components: int) -> float:
    """Largest entry of the whitened rows' covariance less the identity. The offsets sum to zero exactly, so the
    whitened rows are centred."""
    chosen = np.flatnonzero(fitted.known[:components])
    if not len(chosen):
        return 0.0
    covariance = _products(
        vectors.select("x"), lambda rows: fitted.whitened(fitted.offsets(rows), components)[:, chosen], len(chosen)
    )
    return float(np.abs(covariance / fitted.n - np.eye(len(chosen))).max())


def transform(vectors: DataFrame, fitted: Whitening, components: int) -> DataFrame:
    """The columns of ``vectors`` but the last, x, with deviation and whitened, an array of the first components."""
    names = vectors.columns[:-1]
    schema = T.StructType([vectors.schema[name] for name in names])
    schema = schema.add("deviation", "decimal(38,0)").add("whitened", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                offsets = fitted.offsets(_matrix(batch.column(len(names))))
                made = fitted.whitened(offsets, components)
                ends = pa.array(np.arange(len(made) + 1, dtype=np.int32) * made.shape[1])
                lists = pa.ListArray.from_arrays(ends, pa.array(made.ravel(), from_pandas=True))
                columns = [*batch.columns[: len(names)], fitted.deviations(offsets), lists]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_arrow(vectors, run, schema)


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = 1, shift: int = 0
) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    vectors, size = usable(df, fixed_point(col(vector_col), scale, shift), [col(id_col).alias("vec_id")])
    fitted = fit(vectors, size) if size else None
    if fitted is None:
        kind = df.select(col(id_col)).schema[0].dataType.simpleString()
        empty = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], empty)
    components = min(components, size)
    rows = transform(vectors, fitted, components)
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(share)) for share in fitted.explained[:components]])
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(identity_error(vectors, fitted, components)).alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(read(spark, sf_dir, "embeddings"), scale=64, shift=1_000_000)
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))
