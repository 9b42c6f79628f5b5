"""Lloyd clustering with equal-average equal-variance nearest-centroid search.

Vectors become integers ``floor(1024 * x)``; distances, sums and centroids are
integers throughout, so a rerun, another partitioning or a lost executor gives
the same clusters.  Valid vectors are staged once as integers in the shared
folder; each round is one pass over them that returns, per task and cluster, a
count and component sums (then summed by Spark, a row per cluster).  The
driver sees the centroids only: ``clusters * dims`` numbers, whatever the
table holds.

The search (``nearest``): with S the component sum and V the distance of a
vector from its own mean, ``dims * d^2 >= (S_x - S_c)^2 + dims * (V_x - V_c)^2``.
Centroids lie sorted by S.  A vector starts at the centroid whose S is nearest
to its own and looks outward on both sides, the nearer side first; a side ends
where the first term alone exceeds the best distance found, a centroid is
passed over where both terms do, and the others get their exact integer
distance.  All vectors of a batch take a step together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave.llm.common import tidied
from tagwave.operators.stage import stage

SCALE = 1024
#: Largest component (scaled) for which distances and bounds are exact in 64 bits.
MAX_COMPONENT = 1 << 24
_STEP_ROWS = 8192


def _valid(vector: str, dims: int) -> Column:
    """Exactly ``dims`` components, none null, NaN or infinite."""
    def finite(x: Column) -> Column:
        d = x.cast("double")
        return x.isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf"))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False))),
                      F.lit(False))


def integer_vectors(df: DataFrame, dims: int = 64, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v array<long>`` of the valid vectors: ``floor(1024 * x)`` of
    each component as a double (exact: a power of two)."""
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("long"))
    return df.where(_valid(vector, dims)).select(F.col(vec_id).alias("vec_id"), ints.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hex SHA-256 of ``<seed>:<vec_id>``, in
    that order (of equal ids the smaller vector first; a null id hashes as
    an empty one): a top-k of ``clusters`` rows."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(digest.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], dtype=np.int64)


class Search:
    """Centroids sorted by component sum, with what the inequalities need."""

    def __init__(self, centroids: np.ndarray):
        s = centroids.sum(axis=1)
        self.number = np.lexsort((np.arange(len(s)), s))  # position -> centroid
        self.c = centroids[self.number]
        self.s = s[self.number]
        self.v = _spread(self.c, self.s)
        self.dims = centroids.shape[1]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid of every row (ties: the smaller
        number), the squared distance, and how many distances were computed."""
        n, k = len(x), len(self.c)
        s = x.sum(axis=1)
        v = _spread(x, s)
        best = np.full(n, np.iinfo(np.int64).max)
        which = np.full(n, k)
        # The next centroid to look at below and above; -1 and k end a side.
        up = np.searchsorted(self.s, s)
        low = up - 1
        rows, computed = np.arange(n), 0
        far = np.iinfo(np.int64).max
        while len(rows):
            lo, hi, sr = low[rows], up[rows], s[rows]
            gap_lo = np.where(lo >= 0, sr - self.s[lo], far)
            gap_hi = np.where(hi < k, self.s[np.minimum(hi, k - 1)] - sr, far)
            down = gap_lo <= gap_hi
            at, gap = np.where(down, lo, hi), np.where(down, gap_lo, gap_hi)
            # The nearer side decides: when it is too far off, so is the other.
            limit = np.where(best[rows] <= far // self.dims, best[rows] * self.dims, far)
            alive = (gap < far) & (np.minimum(gap, 1 << 31) ** 2 <= limit)
            rows, at, gap, down, limit = rows[alive], at[alive], gap[alive], down[alive], limit[alive]
            low[rows[down]] -= 1
            up[rows[~down]] += 1
            # Spreads are square roots: a thousandth covers their rounding.
            apart = np.maximum(np.abs(v[rows] - self.v[at]) - 1e-3, 0.0)
            near = gap.astype(np.float64) ** 2 + apart * apart <= limit.astype(np.float64) * (1 + 1e-9)
            r, a = rows[near], at[near]
            diff = x[r] - self.c[a]
            d = np.einsum("ij,ij->i", diff, diff)
            computed += len(r)
            number = self.number[a]
            better = (d < best[r]) | ((d == best[r]) & (number < which[r]))
            best[r[better]], which[r[better]] = d[better], number[better]
        return which, best, computed


def _spread(x: np.ndarray, s: np.ndarray) -> np.ndarray:
    """sqrt(dims * sum of squares - s^2): sqrt(dims) times the distance from
    the vector's own mean; exact integers under the root."""
    return np.sqrt((x.shape[1] * np.einsum("ij,ij->i", x, x) - s * s).astype(np.float64))


def _matrices(batch: pa.RecordBatch, column: int, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integer matrix) of parts of a batch."""
    for at in range(0, batch.num_rows, _STEP_ROWS):
        part = batch.column(column).slice(at, _STEP_ROWS)
        x = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dims)
        if len(x) and (x.max() > MAX_COMPONENT or x.min() < -MAX_COMPONENT):
            raise OverflowError(f"a component beyond +-{MAX_COMPONENT // SCALE}: its distances do not fit 64 bits")
        yield at, x


def _move(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: centroids after assigning every vector and taking each
    non-empty cluster's ``floor(sum / count)``."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            for _, x in _matrices(batch, 0, dims):
                which, _, _ = search.nearest(x)
                counts += np.bincount(which, minlength=k)
                for c in range(k):
                    sums[c] += x[which == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k)), pa.array(counts), pa.array(list(sums), pa.list_(pa.int64()))], ["c", "n", "s"])

    parts = vectors.select("v").mapInArrow(tidied(run), "c long, n long, s array<long>")
    total = parts.groupBy("c").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i].cast("decimal(20,0)")) for i in range(dims)]).alias("s"))
    moved = centroids.copy()
    for row in total.collect():
        if row.n:
            moved[row.c] = [int(v) // int(row.n) for v in row.s]
    return moved


def lloyd(vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Centroids (a row each) after ``rounds`` rounds over ``integer_vectors``."""
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _move(vectors, centroids)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            for at, x in _matrices(batch, 1, dims):
                which, distance, _ = search.nearest(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(x)), pa.array(which.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(tidied(run), f"vec_id {id_type}, cluster int, distance long")


def cluster_vectors(embeddings: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3,
                    dims: int = 64) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``
    of every valid vector.

    Vectors that are null, of another length, or hold a null or non-finite
    component have no row.  A null ``vec_id`` is kept (and hashes as an empty
    id); repeated ids and vectors give a row each.  With fewer valid vectors
    than ``clusters`` each starts a centroid; an empty table gives no rows.
    Equal distances go to the smaller cluster number; an empty cluster keeps
    its centroid.  Components beyond +-16384 stop the job, as their distances
    do not fit the ``long`` the result holds.  Other columns are ignored.
    """
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    vectors = stage(integer_vectors(embeddings, dims), "vectors")
    centroids = lloyd(vectors, clusters, rounds, seed)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, "
                "centroid_sha256 string")
    assigned = stage(assign(vectors, centroids), "assigned")
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()
    inertia = {r.cluster: int(r.d) for r in per}  # a row per cluster
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def by_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return assigned.select(
        "vec_id", "cluster", "distance",
        by_cluster([inertia.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), by_cluster(digest, "string").alias("centroid_sha256"))


def oracle_sql(clusters: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64) -> str:
    """DuckDB SQL of ``cluster_vectors``: each round assigns by plain distances
    to all centroids and takes floored means."""
    def assigned(centroids: str) -> str:
        return f"""select vec_id, v, arg_min(c, d * {clusters} + c) as c, min(d) as d from (
          select e.vec_id, e.r, e.v, k.c,
            list_sum(list_transform(list_zip(e.v, k.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
          from e, {centroids} k) group by vec_id, r, v"""
    parts = [f"""e as materialized (select vec_id, row_number() over () as r,
        list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
      from embeddings where len(embedding) = {dims}
        and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), false))""",
             f"""c0 as materialized (select row_number() over (order by h, v) - 1 as c, v from (
        select sha256('{seed}:' || coalesce(cast(vec_id as varchar), '')) as h, v from e
        order by h, v limit {clusters}))"""]
    for i in range(1, rounds + 1):
        parts.append(f"a{i} as materialized ({assigned(f'c{i - 1}')})")
        parts.append(f"""m{i} as materialized (select c, list((s - ((s % n) + n) % n) // n order by i) as v from (
          select c, i, sum(v[i])::bigint as s, count(*) as n from a{i}, range(1, {dims + 1}) t(i) group by c, i)
          group by c)""")
        parts.append(f"""c{i} as materialized (select p.c, coalesce(m{i}.v, p.v) as v
          from c{i - 1} p left join m{i} on m{i}.c = p.c)""")
    return "with " + ",\n".join([*parts, f"f as materialized ({assigned(f'c{rounds}')})"]) + f"""
      select f.vec_id, f.c::int as cluster, f.d as distance,
        sum(f.d) over (partition by f.c)::bigint as cluster_inertia, sum(f.d) over ()::bigint as inertia,
        sha256(array_to_string(k.v, ',')) as centroid_sha256
      from f join c{rounds} k on k.c = f.c"""


ORACLE_SQL = oracle_sql()
