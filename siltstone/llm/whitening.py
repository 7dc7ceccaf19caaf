"""Embedding whitening: the Gramian of exactly centred rows, its eigenvectors, and the rows projected on them.

Entries become whole numbers, so sums and centring are exact: with n vectors of sum S in the fit list, a row is
n * x - S in whole numbers, and only its division by n is rounded, once. MLlib's RowMatrix adds up the Gramian of
those rows on the executors; the driver gets one matrix of d x d and nothing that grows with the rows. Its
eigenvectors go back by broadcast (d x d as well), and whitening is one pass over the rows.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.scratch import Scratch

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this size count as this size.
LARGEST = float(1 << 40)
EMPTY = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all are finite numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)), F.lit(False))


def whole(vector: Column) -> Column:
    """floor(64 * c) + 1,000,000 for each entry c."""
    inside = lambda c: F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST))
    return F.transform(vector, lambda c: F.floor(inside(c) * SCALE) + F.lit(SHIFT).cast("long"))


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows of the fit list and the sum of each dimension, exact."""

    def part(batches):
        n, total = 0, None
        for b in batches:
            if len(b):
                x = np.stack(b["x"].to_numpy())
                n += len(x)
                s = x.sum(0).tolist()  # at most 10,000 rows of less than 2**47
                total = s if total is None else [a + c for a, c in zip(total, s)]
        if total is not None:
            yield pd.DataFrame({"at": range(-1, len(total)), "s": [Decimal(n), *map(Decimal, total)]})

    rows = fit.select("x").mapInPandas(part, "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").alias("s")).collect()  # d + 1 rows
    found = {r.at: int(r.s) for r in rows}
    return found.pop(-1), [found[k] for k in range(len(found))]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S in whole numbers: of 64 bits, or of any size where these would overflow."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if most < 1 << 62:
        return x.astype(np.int64) * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(z: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, exact; None beyond a long."""
    if z.dtype != object and int(np.abs(z).max(initial=0)) ** 2 * z.shape[1] < 1 << 63:
        return (z * z).sum(1).tolist()
    return [s if s < 1 << 63 else None for s in (sum(int(v) * int(v) for v in row) for row in z.tolist())]


def _gramian(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Gramian of the centred rows, in doubles, added up by MLlib."""
    d = len(sums)

    def rows(batches):
        for b in batches:
            if len(b):
                z = centred(np.stack(b["x"].to_numpy()), n, sums)
                yield pd.DataFrame({"z": list((z / n).astype(np.float64))})

    table = fit.select("x").mapInPandas(rows, "z array<double>").select(array_to_vector("z").alias("z"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(table, "z"), n, d).computeGramianMatrix().toArray()


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a covariance, largest first; the largest entry of each is positive.

    Values that rounding alone explains are 0.
    """
    e, w = np.linalg.eigh((v + v.T) / 2)
    e, w = e[::-1][:most], w[:, ::-1][:, :most]
    w = w * np.where(w[np.abs(w).argmax(0), np.arange(w.shape[1])] < 0, -1.0, 1.0)
    floor = len(v) * np.finfo(float).eps * max(float(e[0]) if len(e) else 0.0, 0.0)
    return np.where(e > floor, e, 0.0), w


def whiten(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), for each usable row and component.

    Null and empty vectors and those with a null or non-finite entry are dropped. Vectors have one length,
    the one that most usable rows have (ties: the longer); others have no place in the space and are dropped
    too. The fit list is each distinct whole-number vector once, so copies do not weigh more. Null and repeated
    vec_id and repeated rows: rows each. Equal eigenvalues: components in any order. A component without
    variance has a null ``whitened`` and explains 0 (null where nothing varies). ``deviation`` is null beyond a
    long. Entries beyond 2**40 in size count as that. Other columns are ignored. No usable row: empty result.

    identity_error is measured: the whitened fit list goes through MLlib once more.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    good = vectors.select("vec_id", F.col(column).alias("v")).where(usable(F.col("v")))
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).take(1)
    if not lengths:
        return spark.createDataFrame([], EMPTY.format(kind))
    x = good.where(F.size("v") == lengths[0].d).select("vec_id", whole(F.col("v")).alias("x"))
    fit = scratch.save(x.select("x").distinct(), "fit")
    n, sums = _sums(fit)
    v = _gramian(fit, n, sums) / n
    e, w = components(v, most)
    trace = float(np.trace(v))
    live = e > 0
    scaled = np.where(live, w / np.sqrt(np.where(live, e, 1.0)), 0.0)  # columns without variance project to 0
    shared = spark.sparkContext.broadcast((n, sums, scaled))

    def project(batches):
        n, sums, scaled = shared.value
        for b in batches:
            if len(b):
                z = centred(np.stack(b["x"].to_numpy()), n, sums)
                yield b, z, (z / n).astype(np.float64) @ scaled

    def fitted(batches):
        for _, _, y in project(batches):
            yield pd.DataFrame({"y": list(y)})

    table = fit.mapInPandas(fitted, "y array<double>").select(array_to_vector("y").alias("y"))
    again = RowMatrix(MLUtils.convertVectorColumnsFromML(table, "y"), n, len(e)).computeGramianMatrix().toArray() / n
    error = float(np.abs(again - np.eye(len(e)))[np.ix_(live, live)].max(initial=0.0))
    explained = [float(a / trace) if trace > 0 else None for a in e]

    def run(batches):
        for b, z, y in project(batches):
            k = len(scaled[0])
            which = np.tile(np.arange(k), len(b))
            values = pd.Series(y.ravel(), dtype=object).where(pd.Series(live[which]), None) if not live.all() else y.ravel()
            yield pd.DataFrame({
                "vec_id": b["vec_id"].repeat(k).reset_index(drop=True),
                "component": which + 1,
                "n": n,
                "deviation": pd.array(_squares(z), dtype="Int64").repeat(k),
                "whitened": values,
                "explained": [explained[j] for j in which],
                "identity_error": error,
            })

    return x.mapInPandas(run, EMPTY.format(kind))
