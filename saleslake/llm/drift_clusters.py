"""Operator 11: exact centroid clustering (Lloyd's rounds) with geometric drift tightening.

Every vector carries its cluster, an upper bound of the distance to that cluster's centroid and a lower bound of the distance to
all others.  When centroids move, the upper bound grows by its own centroid's drift.  The lower bound
need not shrink by the largest drift: the members of cluster i lie in a sphere around its old centroid, and for a centroid that moved by p
from c to c', every x has |x - c| - |x - c'| <= p cos(t), where t is the angle at the middle of c and c' between
the move and x.  In the plane of the three centroids, the smallest such angle over the sphere is the angle of the sphere's centre
less arcsin(radius / distance from the middle), so the lower bound of cluster i shrinks by the largest of
p max(0, cos(that angle)) over the other centroids: nothing for centroids that moved away, little for far ones.  Vectors whose bounds
are apart stay; for the others the upper bound is made exact, and those still ambiguous are compared with all centroids.

All decisions are exact: components become integers floor(256 x), squared distances are integers, and bounds, which are
floating point, are widened before they decide.  Each round reads and writes the vectors' state as a table; sums of
the vectors that changed cluster are added per task before anything is shuffled, so cluster sizes don't matter.
Only centroids (k x d) reach the driver and the tasks.

Defined results: vectors that are null, of another length or hold a null or non-finite component are left out; repeated rows are vectors
of their own; ids that are null come last in the choice of first centroids, ties there go by the vector; fewer vectors than
``k`` give fewer centroids; an empty table gives no rows; distance and inertia that a long can't hold are null; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import written

#: Vectors that are compared together.
ROWS = 4096
#: Up to this magnitude, sums of d products are exact in float64 (d up to 512).
SMALL = 1 << 21
#: Relative and absolute slack of floating-point bounds.
SLACK, LEAST = 1e-9, 1e-6
LIMB = 60
LONG_MAX = (1 << 63) - 1

STATE = "vec_id {id}, vec binary, was int, cluster int, moved boolean, upper double, lower double, distance long"


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 x) of finite doubles: float64 where exact, else Python integers."""
    if np.abs(values).max(initial=0) <= SMALL / 512:
        return np.floor(256 * values)
    whole = [[int(x) * 256 if abs(x) > 2.0 ** 53 else math.floor(x * 256) for x in row] for row in values.tolist()]
    return np.array(whole, object).reshape(values.shape)


def pack(row: np.ndarray) -> bytes:
    """A vector of float64 or Python integers: int16 or int32 components where they fit, else decimal text."""
    most = max(map(abs, row.tolist()), default=0)
    if most < 1 << 15:
        return b"2" + row.astype("<i2").tobytes()
    if most < SMALL:
        return b"4" + row.astype("<i4").tobytes()
    return b"t" + ",".join(str(int(x)) for x in row.tolist()).encode()


def unpack(raw: bytes) -> np.ndarray:
    if raw[:1] == b"t":
        return np.array([int(x) for x in raw[1:].split(b",")], object)
    return np.frombuffer(raw, "<i2" if raw[:1] == b"2" else "<i4", offset=1).astype(np.float64)


def stacked(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of vectors with small components and their matrix (float64); the other places."""
    small = np.array([r[:1] != b"t" for r in raws], bool)
    at = np.flatnonzero(small)
    return at, np.array([unpack(raws[i]) for i in at]) if len(at) else np.zeros((0, 0)), np.flatnonzero(~small)


def squares(x: np.ndarray, centres: list[list[int]]) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to all centres (float64 holding integers, or Python integers)."""
    if x.dtype != object and max((abs(v) for c in centres for v in c), default=0) < SMALL:
        c = np.array(centres, np.float64)
        return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    c = np.array(centres, object)
    whole = x if x.dtype == object else np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape)
    return ((whole[:, None, :] - c[None, :, :]) ** 2).sum(2)


def root(square) -> np.ndarray:
    """Distances as floats; of integers beyond floats, infinity."""
    def one(v) -> float:
        try:
            return math.sqrt(v)
        except OverflowError:
            return math.inf
    return np.sqrt(square) if square.dtype != object else np.array([one(v) for v in square.ravel()]).reshape(square.shape)


def shrinkage(old: list[list[int]], new: list[list[int]], radius: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """(drift of each centroid, for each cluster the most that the distance of a member to another centroid can have shrunk)."""
    if max((abs(v) for c in (*old, *new) for v in c), default=0) > 1 << 200:         # beyond floats: no bounds
        return np.full(len(old), np.inf), np.full(len(old), np.inf)
    a, b = np.array(old, float), np.array(new, float)
    drift = np.sqrt(((b - a) ** 2).sum(1))
    middle, most = (a + b) / 2, np.zeros(len(a))
    for i in radius:
        to = a[i] - middle                                   # from the middle of each move to the sphere's centre
        far = np.sqrt((to ** 2).sum(1))
        size = far * drift
        cos = np.divide(((b - a) * to).sum(1), size, out=np.ones(len(a)), where=size > 0)
        reach = np.divide(radius[i] * (1 + SLACK) + LEAST, far, out=np.full(len(a), np.inf), where=far > 0)
        angle = np.arccos(np.clip(cos, -1, 1)) - np.arcsin(np.minimum(reach, 1))
        share = np.where(reach >= 1, 1.0, np.cos(np.clip(angle - 1e-7, 0, math.pi / 2)))
        loss = drift * np.maximum(share, 0) * (1 + SLACK)
        loss[i] = 0
        most[i] = loss.max()
    return drift * (1 + SLACK), most


def nearest(x: np.ndarray, centres: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster (ties: the smaller number), squared distance and lower bound of the distance to the others."""
    d = squares(x, centres)
    own = d.argmin(1) if d.dtype != object else np.array([min(range(len(centres)), key=r.__getitem__) for r in d])
    at = np.arange(len(d))
    best = d[at, own]
    rest = root(d)
    rest[at, own] = np.inf
    return own, best, rest.min(1) * (1 - SLACK) - LEAST


def _assign(centres: list[list[int]], drift: np.ndarray | None, loss: np.ndarray | None):
    """One round over state rows; without drift every vector is compared with all centroids."""
    def one(x: np.ndarray, was: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple:
        if drift is None:
            own, best, low = nearest(x, centres)
            return own, best, low
        upper, lower = upper + drift[was], lower - loss[was] - LEAST
        own, best = was.copy(), np.zeros(len(x), squares(x[:1], centres).dtype)
        # the distance to the own centroid is a result, so the upper bound is exact for all
        for c in np.unique(was):
            mine = np.flatnonzero(was == c)
            best[mine] = squares(x[mine], [centres[c]])[:, 0]
        upper = np.minimum(upper, root(best) * (1 + SLACK) + LEAST)
        unclear = np.flatnonzero(~(upper < lower))
        if len(unclear):
            own[unclear], best[unclear], lower[unclear] = nearest(x[unclear], centres)
        return own, best, lower

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                n = batch.num_rows
                raws = batch.column("vec").to_pylist()
                was, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "upper", "lower"))
                own, low, up, best = np.zeros(n, np.int64), np.zeros(n), np.zeros(n), [None] * n
                at, matrix, large = stacked(raws)
                groups = [(at, matrix)] if len(at) else []
                groups += [(np.array([i]), unpack(raws[i])[None, :]) for i in large]
                for at, x in groups:
                    own[at], square, low[at] = one(x, was[at], upper[at], lower[at])
                    up[at] = root(square) * (1 + SLACK) + LEAST
                    for i, s in zip(at.tolist(), square.tolist()):
                        best[i] = int(s) if s <= LONG_MAX else None
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vec"), pa.array(was, pa.int32()), pa.array(own, pa.int32()),
                     pa.array(own != was), pa.array(up), pa.array(low), pa.array(best, pa.int64())],
                    names=["vec_id", "vec", "was", "cluster", "moved", "upper", "lower", "distance"])
    return assign


def _change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums per task of the vectors that changed cluster: added where they went, taken off where they were.

    Rows (cluster, at, limb, value): component ``at`` has value * 2 ** (60 limb) more; ``at`` -1 counts members.
    """
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        raws = batch.column("vec").to_pylist()
        moves = [(batch.column("cluster").to_numpy(), 1), (batch.column("was").to_numpy(), -1)]
        at, matrix, large = stacked(raws)
        for clusters, sign in moves:
            for c in np.unique(clusters[clusters >= 0]).tolist():
                mine = np.flatnonzero(clusters[at] == c)
                parts = [np.array([1, *unpack(raws[i]).tolist()], object) for i in large if clusters[i] == c]
                if len(mine):
                    parts.append(np.array([len(mine), *map(int, matrix[mine].sum(0).tolist())], object))
                total[c] = total.get(c, 0) + sign * sum(parts)
    out = [(c, at - 1, limb, part) for c, sums in total.items() for at, v in enumerate(sums.tolist()) for limb, part in _limbs(int(v))]
    cols = list(zip(*out)) or [(), (), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                     names=["cluster", "at", "limb", "value"])


def _limbs(v: int) -> Iterator[tuple[int, int]]:
    sign, v, limb = (-1, -v, 0) if v < 0 else (1, v, 0)
    while v:
        if v & ((1 << LIMB) - 1):
            yield limb, sign * (v & ((1 << LIMB) - 1))
        v, limb = v >> LIMB, limb + 1


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [np.array(v, np.float64) for v in batch.column("values").to_pylist()]
        vecs = [pack(quantised(v[None, :])[0]) for v in values]
        n = len(vecs)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(vecs, pa.binary()), pa.array([-1] * n, pa.int32()), pa.array([-1] * n, pa.int32()),
             pa.array([False] * n), pa.array([0.0] * n), pa.array([0.0] * n), pa.array([None] * n, pa.int64())],
            names=["vec_id", "vec", "was", "cluster", "moved", "upper", "lower", "distance"])


def cluster(vectors: DataFrame, k: int, rounds: int, seed: int, dim: int = 64, id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """State rows (vec_id, cluster, distance, ...) after ``rounds`` rounds and a last assignment; the final centroids.

    The first centroids are the ``k`` vectors with the smallest sha256 of ``seed:id``, in that order.
    """
    given = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("values"))
    finite = F.forall("values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    kept = given.where(F.col("values").isNotNull() & (F.size("values") == dim) & finite)
    schema = STATE.format(id=dict(kept.dtypes)["vec_id"])
    state = written(kept.mapInArrow(_packed, schema), "clusters-vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = state.select(digest.alias("digest"), "vec").orderBy(F.asc_nulls_last("digest"), "vec").limit(k).collect()
    centres = [[int(x) for x in unpack(bytes(r["vec"])).tolist()] for r in first]
    if not centres:
        return state, centres
    sums = [[0] * (dim + 1) for _ in centres]
    drift = loss = None
    for turn in range(rounds + 1):
        state = written(state.mapInArrow(_assign(centres, drift, loss), schema), "clusters-state")
        if turn == rounds:
            return state, centres
        changed = state.where("moved").select("vec", "was", "cluster").mapInArrow(_change, "cluster int, at int, limb int, value long")
        for r in changed.groupBy("cluster", "at", "limb").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("v")).collect():
            sums[r["cluster"]][r["at"] + 1] += int(r["v"]) << (LIMB * r["limb"])
        radius = {r["cluster"]: r["r"] for r in state.groupBy("cluster").agg(F.max("upper").alias("r")).collect()}
        moved = [[v // s[0] for v in s[1:]] if s[0] else c for s, c in zip(sums, centres)]
        drift, loss = shrinkage(centres, moved, radius)
        centres = moved


def centroid_clusters(vectors: DataFrame, k: int, rounds: int, seed: int, dim: int = 64, id_col: str = "vec_id",
                      vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector that counts."""
    state, centres = cluster(vectors, k, rounds, seed, dim, id_col, vector_col)
    spark = vectors.sparkSession
    each = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own"),
                                        F.max(F.col("distance").isNull()).alias("too_large"))
    found = {r["cluster"]: None if r["too_large"] else int(r["own"]) for r in each.collect()}      # k rows
    total = None if None in found.values() else sum(found.values())
    fit = lambda v: v if v is not None and v <= LONG_MAX else None
    known = [(c, fit(found[c]), fit(total), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for c in sorted(found)
             if c >= 0]
    table = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
