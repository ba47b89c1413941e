"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the n x d matrix of centred rows, the steps build orthonormal right vectors v and left vectors u with
X V = U B, B upper bidiagonal. A step is one pass over the rows: every task forms w = X h and, from it, the sums
w'w, U'w and X'w over its own rows. A left vector has n entries and is never stored: u = X g holds for all of them,
so a d-vector g names each, and a pass forms the earlier ones again from their g. Both sides are
reorthogonalised against all earlier vectors: the right ones directly, the left ones by the sums U'w, with
a further pass wherever the correction was not small.

The singular value decomposition of B, of at most d x d numbers, gives components (V times its right vectors) and
deviations (its values over the square root of n). Rows move only inside tasks; the driver holds d x d numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Bytes of one block of rows, which a task holds at a time.
BLOCK_BYTES = 1 << 21
#: Singular values under this share of the largest one count as zero.
RANK_SHARE = 1e-12
#: A left correction above this share of w calls for a further pass.
_SMALL = 1e-9


@dataclass
class Blocks:
    """Integer rows in blocks (``ids``, ``rows`` as bytes of longs), their number, and the exact sums per dimension."""

    table: DataFrame | None
    n: int
    sums: list[int]

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, rows: bytes) -> np.ndarray:
        """Centred rows of one block: n x - S is exact in integers, so centring cancels nothing."""
        return self.spread(rows).astype(np.float64) / self.n

    def spread(self, rows: bytes) -> np.ndarray:
        """n x - S as integers; longs where they fit, Python integers beyond."""
        x = np.frombuffer(rows, np.int64).reshape(-1, self.dim)
        most = int(max(abs(int(x.max())), abs(int(x.min()))))
        if self.n * most < 1 << 61:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)


def integer_blocks(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 64, offset: int = 1_000_000) -> Blocks:
    """Stage x = floor(``scale`` c) + ``offset`` of all usable rows in blocks of ``BLOCK_BYTES``.

    Usable is a vector that is not null or empty, holds finite entries only, and has the length that most
    such vectors have (ties: the greater length). Scaled entries beyond 2^62 are cut there.
    """
    spark = vectors.sparkSession
    clean = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    clean = clean.filter(F.expr("size(v) > 0 AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))"))
    lengths = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    id_type = vectors.schema[id_col].dataType.simpleString()
    if not lengths:
        return Blocks(spark.createDataFrame([], f"ids array<{id_type}>, rows binary"), 0, [])
    d = int(lengths[0]["d"])
    per_block = max(1, BLOCK_BYTES // (8 * d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, per_block):
                part = batch.slice(low, per_block)
                c = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(scale * c), -(2.0**62), 2.0**62).astype(np.int64) + offset
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], names=["ids", "rows"])

    rows = clean.filter(F.size("v") == d)
    table = stage(rows.mapInArrow(run, f"ids array<{id_type}>, rows binary"), "vectors")
    n = lengths[0]["count"]

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                x = np.frombuffer(rows.as_py(), np.int64).reshape(-1, d)
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d), pa.int32()), pa.array(high), pa.array(low)], names=["at", "high", "low"])

    parts = table.select("rows").mapInArrow(total, "at int, high long, low long")
    sums = parts.groupBy("at").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]).collect()
    by_place = {r["at"]: (int(r["high"]) << 32) + int(r["low"]) for r in sums}
    return Blocks(table, int(n), [by_place[i] for i in range(d)])


def _summed(blocks: Blocks, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``f`` (an array of fixed size) over the centred blocks: summed per task, then by Spark per place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for rows in batch.column(0):
                part = f(blocks.centred(rows.as_py()))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.float64())], names=["at", "part"])

    table, blocks = blocks.table.select("rows"), Blocks(None, blocks.n, blocks.sums)  # tasks get the sums, not the table
    got = table.mapInArrow(run, "at int, part double").groupBy("at").agg(F.sum("part").alias("part")).collect()
    return np.array([r["part"] for r in sorted(got, key=lambda r: r["at"])])


@dataclass
class Bidiagonal:
    """X V = U B with U = X ``left``: right vectors in columns, B upper bidiagonal, and the sum of squares of X."""

    right: np.ndarray
    left: np.ndarray
    b: np.ndarray
    trace: float


def bidiagonalise(blocks: Blocks, steps: int | None = None, seed: int = 7) -> Bidiagonal:
    """``steps`` steps (default: the dimension, which makes the decomposition complete).

    Where a vector vanishes against the earlier ones (rank reached, or equal singular values), the next right
    vector is a random one orthogonal to all, so that equal values are all found.
    """
    d = blocks.dim
    steps = min(d, steps or d)
    random = np.random.default_rng(seed)
    trace = float(_summed(blocks, lambda x: np.array([np.square(x).sum()]))[0])
    scale = np.sqrt(trace)
    right, left, images = np.zeros((d, steps)), np.zeros((d, steps)), np.zeros((d, steps))
    b = np.zeros((steps, steps))

    def orthogonal(v: np.ndarray, j: int) -> np.ndarray:
        for _ in range(2):
            v = v - right[:, :j] @ (right[:, :j].T @ v)
        return v

    def products(h: np.ndarray, known: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """One pass with w = X h: w'w, U'w against the left vectors so far, and X'w."""
        def of(x: np.ndarray) -> np.ndarray:
            w = x @ h
            return np.concatenate(([w @ w], (x @ known).T @ w, x.T @ w))

        sums = _summed(blocks, of)
        return sums[0], sums[1:1 + known.shape[1]], sums[1 + known.shape[1]:]

    def fresh(j: int) -> np.ndarray:
        v = orthogonal(random.standard_normal(d), j)
        return v / np.linalg.norm(v)

    v, beta = fresh(0), 0.0
    for j in range(steps):
        right[:, j] = v
        h = v - beta * left[:, j - 1] if j else v
        for _ in range(4):  # until w is orthogonal to the earlier left vectors
            square, along, image = products(h, left[:, :j])
            if np.linalg.norm(along) <= max(_SMALL * np.sqrt(square), RANK_SHARE * scale):
                break
            h = h - left[:, :j] @ along
        h, image = h - left[:, :j] @ along, image - images[:, :j] @ along
        alpha = np.sqrt(max(square - along @ along, 0.0))
        if j:
            b[j - 1, j] = beta
        if alpha <= RANK_SHARE * scale:  # v adds nothing to the range: no left vector
            alpha, rest = 0.0, np.zeros(d)
        else:
            left[:, j], images[:, j] = h / alpha, image / alpha
            rest = orthogonal(images[:, j] - alpha * v, j + 1)
        b[j, j] = alpha
        if j + 1 == steps:
            break
        beta = float(np.linalg.norm(rest))
        if beta <= RANK_SHARE * scale:
            v, beta = fresh(j + 1), 0.0
        else:
            v = orthogonal(rest / beta, j + 1)
            v /= np.linalg.norm(v)
    return Bidiagonal(right, left, b, trace)


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scale: int = 64,
    offset: int = 1_000_000,
) -> DataFrame:
    """A row per usable vector and component: ``<id_col>, component int, n long, deviation long, whitened double,
    explained double, identity_error double``.

    x = floor(``scale`` c) + ``offset``; components are those of the covariance of all usable x (divisor n), by falling
    eigenvalue; ``whitened`` is the centred x along the component over its deviation, ``explained`` the component's
    share of the total variance, ``deviation`` the exact sum of (n x - S)^2 (null where it does not fit a long), and
    ``identity_error`` the largest absolute entry of whitened's covariance less the identity, by one more pass.

    Vectors that are null, empty, of another length than most (ties: the greater length) or hold null or
    non-finite entries take no part; entries beyond 2^62 after scaling are cut there. Components without variance
    (equal rows, rank under ``components``) have no whitened values and no rows, so one row or equal rows alone give
    an empty result, as does an empty table. Repeated rows each count and return. The number of passes is about the dimension, whatever the number of rows.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    out = (f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")
    blocks = integer_blocks(vectors, id_col, vector_col, scale, offset)
    found = bidiagonalise(blocks) if blocks.n else None
    if found is None or found.trace == 0:
        return spark.createDataFrame([], out)
    _, values, axes = np.linalg.svd(found.b)
    k = min(components, int((values > RANK_SHARE * values[0]).sum()))
    values, axes = values[:k], found.right @ axes[:k].T
    project = axes * (np.sqrt(blocks.n) / values)
    gram = _summed(blocks, lambda x: ((y := x @ project).T @ y).ravel()).reshape(k, k)
    error = float(np.abs(gram / blocks.n - np.eye(k)).max())
    explained = values**2 / found.trace
    table, n = blocks.table, blocks.n
    blocks = Blocks(None, n, blocks.sums)  # tasks get the sums, not the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_of, rows_of = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                ids, rows = ids_of[i].values, rows_of[i].as_py()
                spread = blocks.spread(rows)
                most = int(np.abs(spread).max())
                if most * most * blocks.dim >= 1 << 63:
                    exact = [s if s < 1 << 63 else None for s in (int(s) for s in np.square(spread.astype(object)).sum(axis=1))]
                else:
                    exact = np.square(spread).sum(axis=1).astype(np.int64)
                white = (spread.astype(np.float64) / n) @ project
                rows_n = len(ids)
                take = pa.array(np.repeat(np.arange(rows_n), k))
                yield pa.RecordBatch.from_arrays([
                    ids.take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_n)),
                    pa.array(np.full(rows_n * k, n, np.int64)), pa.array(exact, pa.int64()).take(take), pa.array(white.ravel()),
                    pa.array(np.tile(explained, rows_n)), pa.array(np.full(rows_n * k, error)),
                ], names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.select("ids", "rows").mapInArrow(run, out)
