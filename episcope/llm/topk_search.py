"""Exact top-k inner products: a Voronoi kNN join.

Pivots are drawn from the data (a bounded sample; their number is a parameter).  Queries and
data are grouped by their nearest pivot.  Each data group has a summary: the distances and ids
of its members nearest to the pivot, as many as leave k whichever one id is left out (a query
does not count rows of its own id).  For a query group with centre c and radius rho, and a data
group with pivot p,

    q.v <= c.p + rho |p| + |q|max dist(v, p)      q.v >= c.p - rho |p| - |q|max dist(v, p)

so the summaries alone give a floor under the k-th best score of every query of the group
and a ceiling over each row's score.  A row is replicated to exactly the query groups whose
floor its ceiling ``c.v + rho |v|`` reaches, and each (query group, slice) is solved locally
by a matrix product.  Query groups are cut into pieces of at most ``query_rows`` queries and
the rows for a piece into hashed slices, so neither a hot cell nor a weak bound makes a large
task; the slices' best lists are merged by query.

Components become ``floor(scale * x)`` (doubles).  Vectors that are null or hold null, NaN or
infinite components take no part; an empty vector scores 0; only vectors of one length meet.
Ties go to the smaller id (null ids take no part); repeated rows of one id are rows of their
own, save that a query never meets rows of its own id.  Scores are exact integers (products
beyond 2^53 use Python integers, those beyond long are held at its limits).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episcope.llm.common import cut

ROW = "id long, dim int, vec binary"
SLACK = 1e-9         # relative room for rounding in the bounds


def quantise(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, dim, vec): vec packs floor(scale * x) as 16-bit integers, or as doubles where
    a component is too large for that; bad vectors are left out."""
    ok = F.col(vector).isNotNull() & F.col(key).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))

    def packed(v) -> bytes:
        x = np.floor(scale * np.asarray(v, dtype=np.float64))
        return x.astype("<i2" if np.abs(x).max(initial=0.0) < 2 ** 15 else "<f8").tobytes()

    @F.pandas_udf("binary")
    def pack(col):
        return pd.Series([packed(v) for v in col], dtype=object)

    return df.filter(ok).select(F.col(key).cast("long").alias("id"), F.size(vector).alias("dim"), pack(F.col(vector)).alias("vec"))


def _matrix(vecs, dim: int) -> np.ndarray:
    if all(len(v) == 2 * dim for v in vecs):
        return np.frombuffer(b"".join(vecs), dtype="<i2").reshape(len(vecs), dim).astype(np.float64)
    return np.array([np.frombuffer(v, dtype="<i2" if len(v) == 2 * dim else "<f8").astype(np.float64) for v in vecs]).reshape(len(vecs), dim)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d2 = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ pivots.T) + (pivots * pivots).sum(axis=1)[None, :]
    at = d2.argmin(axis=1)
    return at, np.sqrt(((x - pivots[at]) ** 2).sum(axis=1))


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products as long."""
    most = (np.abs(q).max(initial=0.0) * np.abs(v).max(initial=0.0)) * q.shape[1]
    if most < 2.0 ** 53:
        return (q @ v.T).astype(np.int64)
    a, b = ([[int(x) for x in row] for row in m] for m in (q, v))
    lo, hi = -2 ** 63, 2 ** 63 - 1
    return np.array([[min(hi, max(lo, sum(x * y for x, y in zip(r, s)))) for s in b] for r in a], dtype=np.int64)


def best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of each query, own id left out, in blocks of bounded size."""
    out, step = [], max(1, 4_000_000 // max(1, len(ids)))
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    for i in range(0, len(q_ids), step):
        s = _scores(q[i:i + step], v)
        for qid, row in zip(q_ids[i:i + step], s):
            keep = np.flatnonzero(ids != qid)
            r = row[keep]
            if len(r) > k:                       # all rows at or above the k-th score, then ties by id
                floor = np.partition(r, len(r) - k)[len(r) - k]
                keep = keep[r >= floor]
                r = row[keep]
            top = np.lexsort((ids[keep], -r))[:k] if (r > -2 ** 63).all() else sorted(range(len(r)), key=lambda j: (-int(r[j]), int(ids[keep[j]])))[:k]
            out.append((qid, ids[keep][top], r[top]))
    return pd.DataFrame({"query_id": np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64),
                         "id": np.concatenate([o[1] for o in out]) if out else np.array([], dtype=np.int64),
                         "score": np.concatenate([o[2] for o in out]) if out else np.array([], dtype=np.int64)})


def _enough(ids, k: int) -> tuple[list[int], bool]:
    """Places of the first of ``ids`` (best first) that leave k rows whichever one id is left out,
    at most k rows of an id and 2 k in all; and whether there are so many."""
    at, seen = [], Counter()
    for i, x in enumerate(ids):
        if seen[x] < k:
            seen[x] += 1
            at.append(i)
            if len(at) - max(seen.values()) >= k:
                return at, True
    return at, False


def topk_join(queries: DataFrame, data: DataFrame, k: int = 5, pivots: int = 64, pivot_sample: int = 4096,
              query_rows: int = 2048, slice_rows: int = 50_000, seed: int = 11) -> DataFrame:
    """(query_id, rank, id, score): the k best rows of ``data`` for each row of ``queries``;
    both are frames of :func:`quantise`."""
    data, queries = cut(data, "knn-data"), cut(queries, "knn-queries")
    total = data.count()
    parts = []
    for (dim,) in queries.select("dim").distinct().collect():     # vector lengths: a handful
        own = data.filter(F.col("dim") == dim)
        parts.append(_join_dim(queries.filter(F.col("dim") == dim), own, dim, total, k, pivots, pivot_sample,
                               query_rows, slice_rows, seed))
    spark = data.sparkSession
    local = spark.createDataFrame([], "query_id long, id long, score long")
    for p in parts:
        local = local.unionByName(p)
    # each slice sends k rows for a query, so a query's list is k * slices long
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return local.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def _join_dim(queries: DataFrame, data: DataFrame, dim: int, total: int, k: int, pivots: int, pivot_sample: int,
              query_rows: int, slice_rows: int, seed: int) -> DataFrame:
    drawn = data.dropDuplicates(["vec"]).orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(min(pivots, pivot_sample)).collect()
    p = _matrix([bytes(r["vec"]) for r in drawn], dim) if drawn else np.zeros((0, dim))
    if not len(p):
        return queries.sparkSession.createDataFrame([], "query_id long, id long, score long")
    p_len = np.sqrt((p * p).sum(axis=1))

    def assign(frames):
        for f in frames:
            if len(f):
                x = _matrix(f["vec"].tolist(), dim)
                cell, dist = _nearest(x, p)
                yield pd.DataFrame({"id": f["id"], "vec": f["vec"], "cell": cell.astype(np.int32), "dist": dist,
                                    "norm": np.sqrt((x * x).sum(axis=1))})

    kind = "id long, vec binary, cell int, dist double, norm double"
    data, queries = cut(data.mapInPandas(assign, kind), "knn-cells"), cut(queries.mapInPandas(assign, kind), "knn-qcells")
    # summaries: for each of at most `pivots` cells, the nearest members that `_enough` wants (2 k at most)
    def nearest(f):
        f = f.sort_values(["dist", "id"], kind="stable")
        return f.iloc[_enough(f["id"].tolist(), k)[0]]

    def summary(frames):
        near: dict = {}
        for f in frames:
            for c, g in f.groupby("cell"):
                near[c] = nearest(pd.concat([near[c], g]) if c in near else g)
        yield pd.concat(near.values()) if near else pd.DataFrame({"cell": np.zeros(0, np.int32), "dist": np.zeros(0), "id": np.zeros(0, np.int64)})

    near: dict = {}
    of_cell = "cell int, dist double, id long"
    for r in data.select("cell", "dist", "id").mapInPandas(summary, of_cell) \
            .groupBy("cell").applyInPandas(nearest, of_cell).collect():
        near.setdefault(r["cell"], []).append((r["dist"], r["id"]))
    groups = queries.groupBy("cell").agg(F.max("dist").alias("rho"), F.max("norm").alias("norm"),
                                         F.count(F.lit(1)).alias("n")).collect()

    # Neighbouring small cells share a query group; a cell of more than `query_rows` is cut into pieces.
    cells, floors, rhos, group_of, pieces = [], [], [], [], []
    filled = query_rows
    for g in sorted(groups, key=lambda g: (float(p[g["cell"]] @ p[0]), g["cell"])):
        c, rho, qn = g["cell"], g["rho"] * (1 + SLACK) + SLACK, g["norm"] * (1 + SLACK) + SLACK
        low = sorted(((p[c] @ p[j] - rho * p_len[j] - qn * d, i) for j, ds in near.items() for d, i in ds), reverse=True)
        at, enough = _enough([i for _, i in low], k)
        floors.append(low[at[-1]][0] if enough else -np.inf)  # k rows of other ids at least score that much
        cells.append(c)
        rhos.append(rho)
        if filled + g["n"] > query_rows:
            pieces.append(-(-g["n"] // query_rows))
            filled = 0
        filled += g["n"]
        group_of.append(len(pieces) - 1)
    centres, floor, rho = p[cells], np.array(floors), np.array(rhos)
    floor = np.where(np.isfinite(floor), floor - SLACK * np.abs(floor) - 1.0, floor)
    slices = max(1, -(-total // slice_rows))
    starts = [group_of.index(g) for g in range(len(pieces))]     # the cells of a group are consecutive

    def replicate(frames):
        """Each row once for every query group (and piece of it) that it may serve."""
        for f in frames:
            if not len(f) or not cells:
                continue
            x = _matrix(f["vec"].tolist(), dim)
            ceiling = x @ centres.T + rho[None, :] * f["norm"].to_numpy()[:, None]
            need = ceiling * (1 + SLACK * np.sign(ceiling)) + SLACK >= floor[None, :]
            need = np.logical_or.reduceat(need, starts, axis=1)
            for g, n in enumerate(pieces):
                at = np.flatnonzero(need[:, g])
                for piece in range(n if len(at) else 0):
                    yield pd.DataFrame({"grp": np.full(len(at), g, dtype=np.int32), "piece": np.full(len(at), piece, dtype=np.int32),
                                        "id": f["id"].to_numpy()[at], "vec": f["vec"].to_numpy()[at]})

    def solve(key, q, v):
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        return best(q["id"].to_numpy(), _matrix(q["vec"].tolist(), dim), v["id"].to_numpy(), _matrix(v["vec"].tolist(), dim), k)

    if not cells:
        return queries.sparkSession.createDataFrame([], "query_id long, id long, score long")
    lookup = F.create_map(*[F.lit(int(x)) for c, g in zip(cells, group_of) for x in (c, g)])
    grp = lookup[F.col("cell")]
    n_pieces = F.create_map(*[F.lit(int(x)) for g, n in enumerate(pieces) for x in (g, n)])[F.col("grp")]
    left = queries.withColumn("grp", grp) \
        .withColumn("piece", F.pmod(F.xxhash64(F.lit(seed + 1), "id"), n_pieces).cast("int")) \
        .select("grp", "piece", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "id", "vec")
    right = data.select("id", "vec", "norm").mapInPandas(replicate, "grp int, piece int, id long, vec binary") \
        .withColumn("slice", F.pmod(F.xxhash64(F.lit(seed + 2), "id"), F.lit(slices)).cast("int"))
    on = ["grp", "piece", "slice"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(solve, "query_id long, id long, score long")
