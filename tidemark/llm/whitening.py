"""Embedding whitening from a covariance weighted by multiplicity.

Vectors are put on an integer grid, x = floor(1024 * c) + 100000, and identical
x vectors are grouped: a vector that a third of the rows share is one class
with a large weight. Sums are exact integers; the covariance is a weighted,
centred matrix product per partition, added up by Spark; each distinct vector
is whitened once and joined back to its rows. Only the d sums, the d x d
covariance and the components, whose size is that of one vector squared, reach
the driver.

General interface: :func:`classes` and :func:`fit` give a :class:`Whitening`,
:func:`transform` the whitened rows of any table of vectors seen in the fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import stage

SCALE = 1024
OFFSET = 100_000
#: Entries from here on do not fit the grid's exact arithmetic.
LARGEST = 2.0**30
COMPONENTS = 8
#: A class with more than this share of the rows is joined by broadcast: there are fewer than 1 / HOT_SHARE.
HOT_SHARE = 0.001
#: An eigenvalue below this share of the largest is a direction without variance.
FLAT = 1e-13


def _usable(vector: Column) -> Column:
    fit = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fit, F.lit(False))


def grid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id`` and ``x`` of the rows whose vector is not null, not empty and holds only finite numbers.

    An entry of 2**30 or more in size raises: the grid's sums would not be exact.
    """

    def cell(c: Column) -> Column:
        c = c.cast("double")
        small = F.when(F.abs(c) < LARGEST, c).otherwise(F.raise_error(F.lit("vector entry beyond the grid")).cast("double"))
        return F.floor(small * SCALE) + F.lit(OFFSET)

    usable = vectors.filter(_usable(F.col(vec_col)))
    return usable.select(F.col(id_col).alias("id"), F.transform(vec_col, cell).cast("array<long>").alias("x"))


def classes(rows: DataFrame) -> DataFrame:
    """Distinct ``x`` with their count ``w``: those of the commonest size (of ties, the larger size).

    Vectors of another size cannot share a covariance with these and take no part.
    """
    distinct = stage(rows.groupBy("x").agg(F.count(F.lit(1)).alias("w")), "whitening-classes")
    sizes = distinct.groupBy(F.size("x").alias("d")).agg(F.sum("w").alias("n"))
    d = sizes.agg(F.max_by("d", F.struct("n", "d"))).first()[0]
    return distinct.filter(F.size("x") == F.lit(d)) if d is not None else distinct


@dataclass
class Whitening:
    """A fit: ``n`` rows with exact ``sums``; ``axes`` (columns) and ``values`` of the components."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x - S/n as floats; also the exact parts x - S//n and S mod n it is made of."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    a = x - whole
    return a - rest / n, a, rest


def fit(distinct: DataFrame, components: int = COMPONENTS, weighted: bool = True) -> Whitening | None:
    """Eigenvectors of the covariance (divisor: rows of the fit list) of ``classes``.

    ``weighted``: every row counts; otherwise each distinct vector counts once.
    Components are numbered by falling eigenvalue; directions without variance
    are left out. The sign makes a component's largest entry positive. ``None``
    without rows.
    """
    if not weighted:
        distinct = distinct.withColumn("w", F.lit(1).cast("long"))
    n = distinct.agg(F.sum("w")).first()[0]
    if n is None:
        return None
    each = distinct.select("w", F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("w") * F.col("v")).alias("s"))
    sums = [r["s"] for r in each.orderBy("i").collect()]
    d = len(sums)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d))
        for batch in batches:
            if len(batch):
                c, _, _ = _centred(np.vstack(batch["x"].to_numpy()), n, sums)
                total += (c * batch["w"].to_numpy(dtype=np.float64)[:, None]).T @ c
        yield pd.DataFrame({"i": np.arange(d), "row": list(total)})

    parts = distinct.select("x", "w").mapInPandas(products, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    cov = np.zeros((d, d))
    for r in cells.collect():
        cov[r["i"], r["j"]] = r["v"] / n
    values, axes = np.linalg.eigh((cov + cov.T) / 2)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    trace = float(np.trace(cov))
    kept = values > max(FLAT * max(values[0], 0.0), 0.0)
    values, axes = values[kept], axes[:, kept]
    signs = np.sign(axes[np.argmax(np.abs(axes), axis=0), np.arange(axes.shape[1])])
    return Whitening(int(n), sums, axes * signs, values, trace)


def whiten_classes(distinct: DataFrame, model: Whitening) -> DataFrame:
    """Each distinct vector once: ``x``, ``w``, ``deviation`` (exact), ``whitened`` (one number per component)."""
    n, sums = model.n, model.sums
    scale = model.axes / np.sqrt(model.values)

    def whiten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            c, a, rest = _centred(np.vstack(batch["x"].to_numpy()), n, sums)
            # (n x - S) is n a - rest: its squares are summed from exact parts, in long
            # arithmetic where these fit and in Python's integers where they do not.
            if float(np.abs(a).max()) * n * a.shape[1] >= 2**62 or float(np.abs(a).max()) ** 2 * a.shape[1] >= 2**62:
                a = a.astype(object)
            squares, cross = (a * a).sum(axis=1), (a * rest).sum(axis=1)
            tail = sum(int(r) ** 2 for r in rest)
            deviation = [str(n * n * int(q) - 2 * n * int(p) + tail) for q, p in zip(squares, cross)]
            yield pd.DataFrame({"x": batch["x"], "w": batch["w"], "deviation": deviation, "whitened": list(c @ scale)})

    made = distinct.select("x", "w").mapInPandas(whiten, "x array<long>, w long, deviation string, whitened array<double>")
    return made.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on all of them."""
    k = len(model.values)
    if not k:
        return None
    w = F.col("w").cast("double")
    z = [F.get("whitened", i) for i in range(k)]
    means = whitened.agg(*[(F.sum(w * z[i]) / model.n).alias(f"m{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = whitened.agg(
        *[(F.sum(w * (z[i] - means[i]) * (z[j] - means[j])) / model.n).alias(f"c{i}_{j}") for i, j in pairs]
    ).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def join_back(rows: DataFrame, whitened: DataFrame, n: int) -> DataFrame:
    """``rows`` with the columns of their class. Classes above ``HOT_SHARE`` of the rows,
    fewer than its inverse in number, are broadcast, so no task gathers such a class's rows."""
    hot = whitened.filter(F.col("w") > F.lit(HOT_SHARE * n))
    if hot.isEmpty():
        return rows.join(whitened, "x")
    cold = rows.join(F.broadcast(hot.select("x")), "x", "left_anti").join(whitened.filter(F.col("w") <= F.lit(HOT_SHARE * n)), "x")
    return rows.join(F.broadcast(hot), "x").unionByName(cold)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: id, component (from 1), n, deviation
    (decimal, exact), whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries are
    dropped, as are vectors of another size than the commonest. Repeated rows
    and ids stay, each with its own result rows; a null id is kept. Components
    without variance are left out, so equal vectors alone give no rows; nor
    does an empty table. Other columns are not read.
    """
    rows = grid(vectors, id_col, vec_col)
    distinct = classes(rows)
    model = fit(distinct, components)
    if model is None:
        model = Whitening(0, [0], np.zeros((1, 0)), np.zeros(0), 0.0)
        made, error = whiten_classes(distinct.limit(0), model), None
    else:
        made = stage(whiten_classes(distinct, model), "whitening-classes")
        error = identity_error(made, model)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    out = join_back(rows, made, model.n).select(
        F.col("id").alias(id_col), "deviation", F.posexplode(F.arrays_zip(F.col("whitened").alias("z"), explained.alias("e"))).alias("i", "c")
    )
    return out.select(
        id_col,
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("c.z").alias("whitened"),
        F.col("c.e").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
