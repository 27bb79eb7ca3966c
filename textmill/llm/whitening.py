"""Whitening of embeddings by a covariance over distinct vectors.

Entries become integers, ``x = floor(64 * c) + 1000000``.  Identical x vectors are grouped;
each distinct one enters the fit with weight one, or with the number of its copies
(``weights="copies"``).  Sums are exact, the covariance is a centred product summed from one
small matrix a batch, each distinct vector is whitened once, and rows get its values back by
a join.  Only matrices of the vectors' dimension leave the tasks.

Defined results: rows whose vector is null, or holds null, NaN, infinite or (beyond 2**55)
unrepresentable entries are left out; empty vectors have no component and give no rows.
Vectors of another length are a fit of their own, with an ``n`` of their own.  Rows with equal
vectors get equal values, also where keys repeat or are null; an empty table gives no rows.
A component whose eigenvalue is below ``RANK_TOLERANCE`` of the largest has no
``whitened`` value (null) and takes no part in ``identity_error``, which is 0 without
components.  ``deviation`` is null where it does not fit into a long.  Only the named key
and vector columns are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.session import cut_lineage

# --- fixed values -----------------------------------------------------------
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
LARGEST = 2.0**55
# ----------------------------------------------------------------------------

RANK_TOLERANCE = 1e-12
#: A vector with more than this share of all rows is joined by broadcast: there are at most 1000 of them.
HOT_SHARE = 1000


@dataclass(frozen=True)
class Fit:
    """One dimension's sums and components; its size depends on the dimension alone."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    scales: np.ndarray
    explained: np.ndarray


def integer_entries(vector: Column) -> Column:
    """The x vector; null where an entry is missing or not finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= LARGEST))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, x)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """Rows of equal length as a matrix."""
    lists = batch.column(name)
    return np.asarray(lists.flatten()).reshape(len(lists), -1)


def _lengths(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Parts of a batch whose vectors have one length."""
    lengths = np.asarray(batch.column("x").value_lengths())
    for d in np.unique(lengths):
        yield int(d), batch.filter(pa.array(lengths == d))


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - sums`` exactly: 64-bit integers where they suffice, Python's own else."""
    kind = np.int64 if int(np.abs(x).max(initial=0)) * n < 1 << 61 else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def _product_rows(d: int, kind: int, total: np.ndarray) -> dict[str, list]:
    upper = [(i, [float(v) for v in row]) for i, row in enumerate(total)]
    return {"d": [d] * len(upper), "kind": [kind] * len(upper), "i": [i for i, _ in upper], "row": [r for _, r in upper]}


PRODUCT_SCHEMA = "d int, kind int, i int, row array<double>"


def _sum_products(parts: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Matrices by dimension and kind; each task hands over one of every kind."""
    cells = parts.select("d", "kind", "i", F.posexplode("row").alias("j", "v"))
    rows = cells.groupBy("d", "kind", "i", "j").agg(F.sum("v").alias("v")).collect()
    found: dict[tuple[int, int], np.ndarray] = {}
    sides: dict[tuple[int, int], list[int]] = {}
    for r in rows:
        side = sides.setdefault((r["d"], r["kind"]), [0, 0])
        side[0], side[1] = max(side[0], r["i"] + 1), max(side[1], r["j"] + 1)
    for key, (high, wide) in sides.items():
        found[key] = np.zeros((high, wide))
    for r in rows:
        found[r["d"], r["kind"]][r["i"], r["j"]] = r["v"]
    return found


def _collect_matrices(totals: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (d, kind), total in totals.items():
        yield pa.RecordBatch.from_pydict(
            _product_rows(d, kind, np.atleast_2d(total)),
            schema=pa.schema([("d", pa.int32()), ("kind", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))]),
        )


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``x, copies`` of the rows' x vectors."""
    return rows.groupBy("x").agg(F.count("*").alias("copies"))


def exact_sums(vectors: DataFrame, weight: Column) -> dict[int, tuple[int, tuple[int, ...]]]:
    """Weight and per-entry sums by vector length."""
    counted = vectors.select(weight.cast("decimal(20,0)").alias("w"), F.size("x").alias("d"), "x")
    cells = counted.select("d", "w", F.posexplode("x").alias("j", "v"))
    sums = cells.groupBy("d", "j").agg(F.sum(F.col("w") * F.col("v")).alias("s"), F.sum("w").alias("n")).collect()
    found: dict[int, tuple[int, dict[int, int]]] = {}
    for r in sums:
        n, entries = found.setdefault(r["d"], (int(r["n"]), {}))
        entries[r["j"]] = int(r["s"])
    return {d: (n, tuple(entries[j] for j in range(d))) for d, (n, entries) in found.items()}


def fit(vectors: DataFrame, weights: str = "one") -> dict[int, Fit]:
    """Sums, then the centred covariance and its components, by vector length."""
    if weights not in ("one", "copies"):
        raise ValueError(f"weights must be 'one' or 'copies', not {weights!r}")
    by_copies = weights == "copies"
    sums = exact_sums(vectors, F.col("copies") if by_copies else F.lit(1))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, part in _lengths(batch):
                n, s = sums[d]
                c = (centred(_matrix(part, "x"), n, s) / n).astype(float)
                w = np.asarray(part.column("copies"), dtype=float)[:, None] if by_copies else 1.0
                totals[d, 0] = totals.get((d, 0), 0.0) + (c * w).T @ c
        yield from _collect_matrices(totals)

    covariances = _sum_products(vectors.mapInArrow(products, PRODUCT_SCHEMA))
    fits = {}
    for (d, _), total in covariances.items():
        n, s = sums[d]
        values, columns = np.linalg.eigh((total + total.T) / (2 * n))
        order = np.argsort(-values, kind="stable")[:COMPONENTS]
        values, columns, trace = values[order], columns[:, order], float(np.trace(total) / n)
        alive = values > max(float(values[0]), 0.0) * RANK_TOLERANCE
        scales = np.where(alive, np.sqrt(np.where(alive, values, 1.0)), np.nan)
        explained = np.clip(values, 0.0, None) / trace if trace > 0 else np.zeros(len(values))
        fits[d] = Fit(n, s, columns, scales, explained)
    return fits


WHITE_SCHEMA = "x array<bigint>, copies bigint, n bigint, deviation bigint, white array<double>"


def whiten_distinct(vectors: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """``x, copies, n, deviation, white`` of every distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in _lengths(batch):
                f = fits[d]
                exact = centred(_matrix(part, "x"), f.n, f.sums)
                white = (exact / f.n).astype(float) @ f.vectors / f.scales
                small = int(np.abs(exact).max(initial=0)) ** 2 * d < 1 << 62
                squares = exact.astype(np.int64 if small else object) ** 2
                sums = [int(v) if v < 1 << 63 else None for v in squares.sum(axis=1).tolist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "x": part.column("x"),
                        "copies": part.column("copies"),
                        "n": pa.array([f.n] * len(part), pa.int64()),
                        "deviation": pa.array(sums, pa.int64()),
                        "white": pa.array([[None if v != v else v for v in row] for row in white.tolist()], pa.list_(pa.float64())),
                    }
                )

    return vectors.mapInArrow(run, WHITE_SCHEMA)


def identity_errors(white: DataFrame, fits: dict[int, Fit], weights: str = "one") -> dict[int, float]:
    """Largest entry of the whitened covariance minus the identity, by vector length."""
    by_copies = weights == "copies"

    def values_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray | float]]:
        for d, part in _lengths(batch):
            alive = ~np.isnan(fits[d].scales)
            w = np.asarray(part.column("copies"), dtype=float)[:, None] if by_copies else 1.0
            values = np.asarray(part.column("white").flatten().to_numpy(zero_copy_only=False), dtype=float)
            yield d, values.reshape(len(part), -1)[:, alive], w

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, values, w in values_of(batch):
                totals[d, 0] = totals.get((d, 0), 0.0) + (values * w).sum(axis=0)
        yield from _collect_matrices({k: v for k, v in totals.items() if v.size})

    centre = {d: total[0] / fits[d].n for (d, _), total in _sum_products(white.mapInArrow(means, PRODUCT_SCHEMA)).items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, values, w in values_of(batch):
                if d in centre:
                    c = values - centre[d]
                    totals[d, 0] = totals.get((d, 0), 0.0) + (c * w).T @ c
        yield from _collect_matrices(totals)

    found = _sum_products(white.mapInArrow(products, PRODUCT_SCHEMA))
    errors = {d: 0.0 for d in fits}
    for (d, _), total in found.items():
        errors[d] = float(np.abs(total / fits[d].n - np.eye(len(total))).max())
    return errors


def whiten(df: DataFrame, key: str, vector: str, weights: str = "one") -> DataFrame:
    """One row for each row with a usable vector and each of its first ``COMPONENTS`` components.

    Columns: the key, ``component`` (from 1 by falling eigenvalue), ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.
    """
    rows = df.select(F.col(key).alias("key"), integer_entries(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    vectors = cut_lineage(distinct_vectors(rows), "vectors")
    fits = fit(vectors, weights)
    white = cut_lineage(whiten_distinct(vectors, fits), "white")
    errors = identity_errors(white, fits, weights)

    total = vectors.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") > max(total // HOT_SHARE, 1)
    values = white.select("x", "n", "deviation", "white", hot.alias("hot"))
    by_broadcast = rows.join(F.broadcast(values.filter("hot")), "x", "left")
    known = by_broadcast.filter("hot").drop("hot")
    rest = by_broadcast.filter("hot IS NULL").select("key", "x").join(values.filter("NOT hot").drop("hot"), "x")
    joined = known.unionByName(rest)

    shares = [(d, i, float(e), errors[d]) for d, f in fits.items() for i, e in enumerate(f.explained)]
    share_table = df.sparkSession.createDataFrame(shares, "d int, i int, explained double, identity_error double")
    spread = joined.select("key", "n", "deviation", F.size("x").alias("d"), F.posexplode("white").alias("i", "whitened"))
    # One row for each length and component: bounded by the lengths there are.
    named = spread.join(F.broadcast(share_table), ["d", "i"])
    return named.select(
        F.col("key").alias(key), (F.col("i") + 1).alias("component"), "n", "deviation", "whitened", "explained", "identity_error"
    )
