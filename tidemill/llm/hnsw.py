"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard (operator 2).

Vectors are dealt by a hash of their id into shards of at most ``SHARD_ROWS`` rows on average (and
``SHARDS`` of them for parallel work, where each has ``LEAST_ROWS`` or more).  Each shard is one row of the index: ids,
vectors, and for each level flat arrays of members and neighbours (``links`` a member, -1 where
there are fewer).  Every query searches every shard and the shard results are merged.

Within a shard equal vectors are one point that carries all its ids, so copies neither crowd
the neighbour lists nor lose their ties.  Points enter the graph in batches that double up to
``BATCH``: a batch searches the graph so far and looks at its own members exactly, keeps diverse
neighbours, and links back.  All searches of a batch move in step, one array operation at a time.
Largest inner product becomes least distance by one more coordinate that lifts all vectors to
one length; scores are inner products of the original vectors in double precision.

Edge cases: rows whose vector is null, empty, zero, of another length than most, or holds null
or non-finite components take no part, neither as queries nor as candidates; so do null ids;
of repeated rows of one id the one with the least vector counts, as query and candidate; fewer candidates than ``k`` are all
returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, on_executors

SHARD_ROWS, SHARDS, LEAST_ROWS, QUERY_ROWS = 50_000, 12, 1000, 4096
LINKS, EF_BUILD, EF_SEARCH, BATCH, SEED = 16, 64, 128, 512, 3


def _near(points: np.ndarray, queries: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Squared distances (less the query's own square) of each query to its row of points; -1 is far."""
    found = points[which]
    d = np.einsum("qkd,qkd->qk", found, found) - 2 * np.einsum("qkd,qd->qk", found, queries)
    d[which < 0] = np.inf
    return d


def _search(points: np.ndarray, graph: np.ndarray, queries: np.ndarray, start: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one level for all queries in step: (members, distances), nearest first.

    ``graph`` has a row of neighbours per point.  A query stops when none of its ``ef`` best is
    unexpanded.
    """
    n = len(queries)
    ids = np.full((n, ef), -1, np.int64)
    ids[:, :start.shape[1]] = start[:, :ef]
    dist = _near(points, queries, ids)
    done = ids < 0
    seen = np.zeros((n, len(graph) + 1), bool)
    np.put_along_axis(seen, ids, True, 1)
    live = np.arange(n)
    while len(live):
        open_ = np.where(done[live], np.inf, dist[live])
        best = open_.argmin(axis=1)
        more = np.isfinite(open_[np.arange(len(live)), best])
        live, best = live[more], best[more]
        if not len(live):
            break
        done[live, best] = True
        around = graph[ids[live, best]]
        known = seen[live[:, None], around]
        around = np.where(known, -1, around)
        seen[live[:, None], around] = True
        fresh = _near(points, queries[live], around)
        all_ids = np.concatenate((ids[live], around), axis=1)
        all_dist = np.concatenate((dist[live], fresh), axis=1)
        all_done = np.concatenate((done[live], around < 0), axis=1)
        keep = np.argpartition(all_dist, ef - 1, axis=1)[:, :ef]
        ids[live] = np.take_along_axis(all_ids, keep, 1)
        dist[live] = np.take_along_axis(all_dist, keep, 1)
        done[live] = np.take_along_axis(all_done, keep, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    ids[~np.isfinite(dist)] = -1
    return ids, dist


def _diverse(points: np.ndarray, ids: np.ndarray, dist: np.ndarray, links: int) -> np.ndarray:
    """Of candidates sorted by distance, those nearer to the point than to any kept before; the
    places left go to the nearest of the rest."""
    n, m = ids.shape
    found = points[ids]
    square = np.einsum("qkd,qkd->qk", found, found)
    between = square[:, :, None] + square[:, None, :] - 2 * np.einsum("qkd,qld->qkl", found, found)
    kept = np.zeros((n, m), bool)
    for k in range(m):
        blocked = (kept[:, :k] & (between[:, k, :k] < dist[:, k, None])).any(axis=1) if k else np.zeros(n, bool)
        kept[:, k] = (ids[:, k] >= 0) & ~blocked & (kept.sum(axis=1) < links)
    rank = np.where(ids < 0, 2 * m, np.where(kept, 0, m) + np.arange(m))
    first = np.argsort(rank, axis=1, kind="stable")[:, :links]
    out = np.take_along_axis(ids, first, 1)
    if out.shape[1] < links:
        out = np.concatenate((out, np.full((n, links - out.shape[1]), -1)), axis=1)
    return out


def build(points: np.ndarray, links: int = LINKS, ef: int = EF_BUILD, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the widest up: (members, neighbours of each member), as indices of points."""
    n = len(points)
    rng = np.random.Generator(np.random.PCG64(seed))
    height = np.minimum((-np.log(1 - rng.random(n)) / math.log(links)).astype(int), 8)
    order = np.argsort(-height, kind="stable")  # those of high levels first, so that every level grows from its top
    top = int(height.max()) if n else 0
    graphs = [np.full((n + 1, links * (2 if level == 0 else 1)), -1, np.int64) for level in range(top + 1)]
    at, size = 0, 1
    while at < n:
        batch = order[at:at + size]
        for level in range(top, -1, -1):
            here = batch[height[batch] >= level]
            if not len(here):
                continue
            graph = graphs[level]
            wide = graph.shape[1]
            x = points[here]
            inner = ((x * x).sum(axis=1)[None, :] - 2 * x @ x.T)
            np.fill_diagonal(inner, np.inf)
            near = min(len(here), links)
            peers = np.argpartition(inner, near - 1, axis=1)[:, :near] if len(here) > 1 else np.zeros((len(here), 0), int)
            ids = np.where(np.isfinite(np.take_along_axis(inner, peers, 1)), here[peers], -1) if peers.size else np.full((len(here), 1), -1)
            before = order[:at]
            if (height[before] >= level).any():
                entry = np.full((len(here), 1), order[0])
                for up in range(top, level, -1):
                    if (height[before] >= up).any():
                        entry = _search(points, graphs[up], x, entry, 1)[0]
                found = _search(points, graph, x, entry, ef)[0]
                ids = np.concatenate((found, ids), axis=1)
            dist = _near(points, x, ids)
            by = np.argsort(dist, axis=1, kind="stable")[:, :max(ef, links)]
            ids, dist = np.take_along_axis(ids, by, 1), np.take_along_axis(dist, by, 1)
            ids[~np.isfinite(dist)] = -1
            dist = dist + (x * x).sum(axis=1)[:, None]
            graph[here, :links] = _diverse(points, ids, dist, links)
            _link_back(points, graph, here, links, wide)
        at += len(batch)
        size = min(BATCH, max(1, at))
    members = [np.flatnonzero(height >= level) for level in range(top + 1)]
    return [(m, g[m]) for m, g in zip(members, graphs)]


def _link_back(points, graph, here, links, wide) -> None:
    """Each neighbour of a new member gets it as a candidate and keeps the diverse ones."""
    a = np.repeat(here, links)
    b = graph[here, :links].ravel()
    a, b = a[b >= 0], b[b >= 0]
    if not len(b):
        return
    by = np.argsort(b, kind="stable")
    a, b = a[by], b[by]
    who, first, count = np.unique(b, return_index=True, return_counts=True)
    for low in range(0, len(who), 2048):
        w, f, c = who[low:low + 2048], first[low:low + 2048], count[low:low + 2048]
        new = np.full((len(w), int(c.max())), -1, np.int64)
        new[np.repeat(np.arange(len(w)), c), np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)] = a[f[0]:f[0] + c.sum()]
        ids = np.concatenate((graph[w], new), axis=1)
        ids.sort(axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        few = (ids >= 0).sum(axis=1) <= wide
        packed = -np.sort(-ids, axis=1)[:, :wide]
        graph[w[few]] = packed[few, :wide] if packed.shape[1] == wide else np.pad(
            packed[few], ((0, 0), (0, wide - packed.shape[1])), constant_values=-1)
        full = np.flatnonzero(~few)
        if len(full):
            x = points[w[full]]
            dist = _near(points, x, ids[full])
            by = np.argsort(dist, axis=1, kind="stable")
            near, dist = np.take_along_axis(ids[full], by, 1), np.take_along_axis(dist, by, 1)
            most = min(near.shape[1], 3 * wide)
            near, dist = near[:, :most], dist[:, :most] + (x * x).sum(axis=1)[:, None]
            near[~np.isfinite(dist)] = -1
            graph[w[full]] = _diverse(points, near, dist, wide)


def search(points: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, ef: int) -> np.ndarray:
    """The nearest members of the lowest level found for each query, nearest first."""
    entry = np.full((len(queries), 1), levels[-1][0][0])
    for level in range(len(levels) - 1, -1, -1):
        members, around = levels[level]
        graph = np.full((len(points) + 1, around.shape[1]), -1, np.int64)
        graph[members] = around
        entry = _search(points, graph, queries, entry, ef if level == 0 else 1)[0]
    return entry


def _good_vectors(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    """One more coordinate that gives all vectors the length ``most``."""
    return np.concatenate((x, np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))[:, None]), axis=1)


_INDEX = ("shard int, ids binary, points binary, owner binary, levels array<struct<members:binary,around:binary,wide:int>>, "
          "width int, most double")


def _build_shard(most: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        twice = pdf["id"].duplicated(keep=False)
        if twice.any():  # one row of an id: the least vector, as one_each() takes it
            least = pdf[twice].assign(by=[tuple(v) for v in pdf.loc[twice, "v"]]).sort_values(["id", "by"]).drop_duplicates("id")
            pdf = pd.concat([pdf[~twice], least.drop(columns="by")]).sort_values("id", kind="stable")
        x = _good_vectors(pdf["v"])
        points, owner = np.unique(x, axis=0, return_inverse=True)
        levels = build(_lifted(points, most))
        return pd.DataFrame({
            "shard": [int(pdf["shard"].iloc[0])], "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "points": [points.tobytes()],
            "owner": [owner.astype(np.int32).ravel().tobytes()],
            "levels": [[{"members": m.astype(np.int32).tobytes(), "around": g.astype(np.int32).tobytes(), "wide": g.shape[1]}
                        for m, g in levels]], "width": [x.shape[1]], "most": [most]})

    return run


def _search_shard(k: int, ef: int):
    def run(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(index) or not len(asked):
            return none
        row = index.iloc[0]
        ids = np.frombuffer(row["ids"], np.int64)
        points = np.frombuffer(row["points"], np.float64).reshape(-1, row["width"])
        owner = np.frombuffer(row["owner"], np.int32)
        levels = [(np.frombuffer(x["members"], np.int32).astype(np.int64),
                   np.frombuffer(x["around"], np.int32).astype(np.int64).reshape(-1, x["wide"])) for x in row["levels"]]
        by = np.argsort(owner, kind="stable")  # ids ascend, so each point's ids do
        count = np.bincount(owner, minlength=len(points))
        start = np.cumsum(count) - count
        lifted = _lifted(points, row["most"])
        parts = []
        for low in range(0, len(asked), 512):
            own = asked.iloc[low:low + 512]
            q = _good_vectors(own["v"])
            found = search(lifted, levels, np.concatenate((q, np.zeros((len(q), 1))), axis=1), min(ef, max(len(points), 1)))
            score = np.einsum("qkd,qd->qk", points[found], q)
            each = np.where(found >= 0, np.minimum(count[found], k + 1), 0)
            who = np.repeat(np.arange(len(q)), each.sum(axis=1))
            flat, n = found.ravel(), each.ravel()
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            vec = ids[by[np.repeat(start[flat], n) + place]]
            part = pd.DataFrame({"query_id": own["id"].to_numpy(np.int64)[who], "vec_id": vec, "score": np.repeat(score.ravel(), n)})
            part = part[part["query_id"] != part["vec_id"]]
            part = part.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True], kind="stable")
            parts.append(part.groupby("query_id", sort=False).head(k))
        return pd.concat(parts) if parts else none

    return run


def vectors(df: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, v): the rows that take part."""
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{column}`").cast("array<double>").alias("v"))
    rows = rows.where("id is not null and size(v) > 0 and exists(v, x -> x <> 0) and "
                      "not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    return rows.where(F.size("v") == sizes[0]["size"]) if sizes else rows


def one_each(rows: DataFrame) -> DataFrame:
    """(id, v): of rows with one id the least vector."""
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS, shards: int = SHARDS) -> DataFrame:
    """One row of flat arrays per shard of (id, v) rows, cut at the shared folder."""
    on_executors(rows.sparkSession)
    length = F.expr("aggregate(v, 0D, (a, x) -> a + x * x)")
    r = rows.agg(F.count("*").alias("n"), F.max(length).alias("most")).first()
    number = max(1, min(shards, r["n"] // LEAST_ROWS), math.ceil(r["n"] / shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(number)).cast("int"))
    return cut(dealt.groupBy("shard").applyInPandas(_build_shard(float(r["most"] or 0.0)), _INDEX), "hnsw")


def search_index(index: DataFrame, queries: DataFrame, k: int = 20, ef: int = EF_SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest that the shards found, merged.

    Queries travel to each shard in blocks of about ``QUERY_ROWS``; a block and one shard meet in a task.
    """
    queries = one_each(queries.select("id", "v"))
    blocks = max(1, math.ceil(queries.count() / QUERY_ROWS))
    last = index.agg(F.max("shard")).first()[0] or 0
    asked = (queries.select("id", "v").withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last)))))
    dealt = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
             .applyInPandas(_search_shard(k, max(ef, k + 1)), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
