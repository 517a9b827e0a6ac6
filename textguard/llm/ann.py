"""Approximate nearest neighbours by balanced posting lists.

Index: a bounded sample is halved again and again at the median between two
means, which gives centroids of even weight. They are held in memory with a
neighbour graph; a beam search over the graph finds a vector's nearest ones.
Every row goes to the list of its nearest centroid, and a boundary row also to
the next ones that are nearly as near (REPLICAS lists at most).
Search: the beam is widened until it holds every list within ``ratio`` times the
distance of the LEAST_LISTS-th nearest one (the very nearest is no measure: a row that
the index was fitted on lies nearer to its own centroid than others do); the others are pruned, and the rows of those kept are compared
exactly, in double precision. A row that stands in several of a query's lists is
compared in the first of them only, so no query compares more rows than there are.

The ratio is fitted: of some sampled rows, which are kept out of the centroids for
it, the exact neighbours within the sample are known, and with them the ratio that
each would have needed; the one taken finds the share ``recall`` of them. In the whole table neighbours are nearer
than in the sample. LEAST_LISTS are always kept; there is no largest number, so recall
doesn't fall as lists become more.

Scale: centroids and graph are bounded by ``max_lists`` and travel with the
tasks. Of rows with equal vectors only the k + 1 smallest ids can be in any
answer, so the others are left out before the shuffle: that is exact and
disarms a vector that very many rows share. Short lists share a task; long ones
are cut into parts of PART_ROWS rows and QUERIES_AT_ONCE queries, so no task holds
a whole long list.

Defined results: rows whose vector is null, zero, of another length than most,
or holds a null or non-finite component take no part; repeated rows of one id
count once, with their nearest vector; a null id takes no part; fewer than k
candidates give fewer rows; an empty table gives none; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textguard.llm.common import pin

REPLICAS, PART_ROWS, QUERIES_AT_ONCE = 4, 4096, 256
#: Lists that are searched for every query, however far they are.
LEAST_LISTS = 16
#: Links of a centroid in the graph: nearest ones, and some at random.
NEAR_LINKS, FAR_LINKS = 24, 8
#: Centroids where a search begins, of either kind.
ENTRIES = 64


@dataclass
class Lists:
    """Centroids of the posting lists and their neighbour graph."""

    centroids: np.ndarray  # (lists, dim)
    graph: np.ndarray  # (lists, links)
    entries: np.ndarray  # where a search begins

    def nearest(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the ``beam`` nearest centroids found, in order."""
        n, count = len(x), len(self.centroids)
        beam = min(beam, count)
        norms = (self.centroids**2).sum(axis=1)
        own = (x**2).sum(axis=1)[:, None]
        start = self.entries
        d = own + norms[start] - 2 * x @ self.centroids[start].T
        seen = np.zeros((n, count), bool)
        seen[:, start] = True
        order = np.argsort(d, axis=1, kind="stable")[:, :beam]
        ids, dist = start[order], np.take_along_axis(d, order, 1)
        if ids.shape[1] < beam:
            pad = beam - ids.shape[1]
            ids, dist = np.pad(ids, ((0, 0), (0, pad))), np.pad(dist, ((0, 0), (0, pad)), constant_values=np.inf)
        open_ = np.isfinite(dist)
        rows, width = np.arange(n), max(1, beam // 16)  # centroids whose links are followed at once
        while open_.any():
            best = np.argsort(np.where(open_, dist, np.inf), axis=1, kind="stable")[:, :width]
            live = np.take_along_axis(open_, best, 1)
            r = rows[live.any(axis=1)]
            best, live = best[r], live[r]
            open_[r[:, None], best] = False
            links = self.graph[ids[r[:, None], best]]
            links[~live] = ids[r, best[:, 0]][:, None, None].repeat(width, 1)[~live]  # seen already
            links = links.reshape(len(r), -1)
            # A centroid that several of them link to counts once.
            order = np.argsort(links, axis=1, kind="stable")
            sorted_ = np.take_along_axis(links, order, 1)
            fresh = ~seen[r[:, None], sorted_]
            fresh[:, 1:] &= sorted_[:, 1:] != sorted_[:, :-1]
            seen[r[:, None], sorted_] = True
            dn = own[r] + norms[sorted_] - 2 * np.einsum("ij,ikj->ik", x[r], self.centroids[sorted_])
            dn[~fresh] = np.inf
            all_d, all_i = np.concatenate([dist[r], dn], axis=1), np.concatenate([ids[r], sorted_], axis=1)
            all_o = np.concatenate([open_[r], np.isfinite(dn)], axis=1)
            top = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            dist[r], ids[r], open_[r] = (np.take_along_axis(v, top, 1) for v in (all_d, all_i, all_o))
        return ids, np.sqrt(np.maximum(dist, 0))


def halve(x: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Centroids of ``lists`` groups of (almost) equal size, by repeated halving."""
    rng, out, todo = np.random.default_rng(seed), [], [(np.arange(len(x)), lists)]
    while todo:
        rows, k = todo.pop()
        if k <= 1 or len(rows) < 2:
            out.append(x[rows].mean(axis=0))
            continue
        part = x[rows]
        a, b = part[rng.choice(len(rows), 2, replace=False)]
        side = np.zeros(len(rows))
        for _ in range(6):
            side = ((part - a) ** 2).sum(axis=1) - ((part - b) ** 2).sum(axis=1)
            first = np.argsort(side, kind="stable")
            cut = len(rows) * (k // 2) // k
            a, b = part[first[:cut]].mean(axis=0), part[first[cut:]].mean(axis=0)
        todo += [(rows[first[:cut]], k // 2), (rows[first[cut:]], k - k // 2)]
    return np.unique(np.array(out), axis=0)


def build(sample: np.ndarray, lists: int, seed: int = 7) -> Lists:
    """Centroids and graph from a sample of vectors."""
    c = halve(sample, max(1, min(lists, len(sample))), seed)
    n, rng = len(c), np.random.default_rng(seed)
    near = min(NEAR_LINKS, n - 1)
    graph = np.zeros((n, near + FAR_LINKS), np.int64)
    norms = (c**2).sum(axis=1)
    for i in range(0, n, 1024):
        d = norms[None, :] - 2 * c[i : i + 1024] @ c.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        graph[i : i + 1024, :near] = np.argpartition(d, near - 1, axis=1)[:, :near] if near else 0
    graph[:, near:] = rng.integers(0, n, (n, FAR_LINKS))
    # A search begins at some centroids all over, and at those that lie far from each other: a tight group
    # of rows away from the rest has centroids that link to one another only.
    far, d = [0], ((c - c[0]) ** 2).sum(axis=1)
    while len(far) < min(n, ENTRIES):
        far.append(int(d.argmax()))
        d = np.minimum(d, ((c - c[far[-1]]) ** 2).sum(axis=1))
    return Lists(c, graph, np.unique([*np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64).tolist(), *far]))


def assign(lists: Lists, x: np.ndarray, epsilon: float, replicas: int = REPLICAS) -> list[np.ndarray]:
    """Lists of every row of ``x``: the nearest one, and those of a boundary row, nearer ones first.

    All centroids are compared, which one product does; the graph serves the queries."""
    c = lists.centroids
    d = (c**2).sum(axis=1) - 2 * x @ c.T
    some = min(replicas, len(c))
    ids = np.argpartition(d, some - 1, axis=1)[:, :some]
    ids = np.take_along_axis(ids, np.argsort(np.take_along_axis(d, ids, 1), axis=1, kind="stable"), 1)
    dist = np.sqrt(np.maximum(np.take_along_axis(d, ids, 1) + (x**2).sum(axis=1)[:, None], 0))
    near = dist <= (1 + epsilon) * dist[:, :1]
    return [row[c] for row, c in zip(ids, near)]


def probe(lists: Lists, x: np.ndarray, ratio: float, beam: int = 64) -> list[np.ndarray]:
    """Lists within ``ratio`` times the distance of the LEAST_LISTS-th nearest, for every row."""
    out: list = [None] * len(x)
    todo = np.arange(len(x))
    while len(todo):
        ids, dist = lists.nearest(x[todo], beam)
        limit = ratio * dist[:, min(LEAST_LISTS, dist.shape[1]) - 1]
        done = (dist[:, -1] > limit) | (beam >= len(lists.centroids))
        for i, row, d, most in zip(todo[done], ids[done], dist[done], limit[done]):
            out[i] = row[(d <= most) & np.isfinite(d)]
        todo, beam = todo[~done], 2 * beam
    return out


def fit_ratio(sample: np.ndarray, n_lists: int, epsilon: float, k: int, recall: float, queries: int = 400) -> float:
    """The least ratio with which ``queries`` rows of the sample find the share
    ``recall`` of their ``k`` nearest rows of the sample, in lists that those
    rows had no part in."""
    asked = np.unique(np.linspace(0, len(sample) - 1, min(queries, len(sample) // 2 + 1)).astype(np.int64))
    lists = build(np.delete(sample, asked, axis=0), n_lists) if len(asked) < len(sample) else build(sample, n_lists)
    held = [a for i in range(0, len(sample), 1024) for a in assign(lists, sample[i : i + 1024], epsilon)]
    norms, needed = (sample**2).sum(axis=1), []
    for q in asked:
        d = norms - 2 * sample @ sample[q]
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(sample) - 1)]
        far = np.sqrt(((lists.centroids - sample[q]) ** 2).sum(axis=1))
        base = max(np.partition(far, min(LEAST_LISTS, len(far)) - 1)[min(LEAST_LISTS, len(far)) - 1], 1e-12)
        needed.append(np.array([far[held[i]].min() for i in near]) / base)
    return max(1.0, float(np.quantile(np.concatenate(needed), recall))) if len(sample) > 1 else 1.0


def usable(vector: Column) -> Column:
    """Not null, finite in all components and not zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    return np.array(column.to_list(), float).reshape(len(column), -1)


def search(
    vectors: DataFrame, queries: str, k: int = 10, key: str = "vec_id", vector: str = "embedding",
    sample: int = 20_000, list_rows: int = 32, max_lists: int = 4096, epsilon: float = 0.1, ratio: float | None = None, recall: float = 0.92,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of every row
    that ``queries`` (SQL on the column ``id``) holds for, by Euclidean
    distance, the row itself excluded. Without a ``ratio`` one is fitted."""
    spark = vectors.sparkSession
    kind = vectors.schema[vector].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # floats stay as they are until they are compared, as doubles
    ok = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    dims = ok.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if dims is None:
        return spark.createDataFrame([], schema)
    # Only the k + 1 smallest ids of equal vectors can be in an answer; repeated rows go first, so each id has one place.
    twin = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    rows = pin(ok.filter(F.size("v") == dims["dim"]).dropDuplicates(["id", "v"]).withColumn("twin", twin).filter(F.col("twin") <= k + 1).drop("twin"), "ann-rows")
    asked = ok.filter((F.size("v") == dims["dim"]) & F.expr(queries)).dropDuplicates(["id", "v"])
    picked = rows.orderBy(F.xxhash64(F.lit("sample"), F.col("id")), "id").select("v").limit(sample).toPandas()  # bounded by its parameter
    fitted = _matrix(picked["v"])
    n_lists = min(max_lists, -(-dims["n"] // list_rows))
    lists, ratio = build(fitted, n_lists), fit_ratio(fitted, n_lists, epsilon, k, recall) if ratio is None else ratio

    def post(batches):
        import pandas as pd

        for pdf in batches:
            x = _matrix(pdf["v"])
            found = [a for i in range(0, len(x), 1024) for a in assign(lists, x[i : i + 1024], epsilon)]
            at = np.repeat(np.arange(len(pdf)), [len(a) for a in found])
            earlier = [a[:j].tolist() for a in found for j in range(len(a))]
            yield pd.DataFrame({"list": np.concatenate(found) if found else [], "earlier": earlier, "id": pdf["id"].to_numpy()[at], "v": [pdf["v"].iloc[i] for i in at]})

    def ask(batches):
        import pandas as pd

        for pdf in batches:
            x = _matrix(pdf["v"])
            out = [a for i in range(0, len(x), 256) for a in probe(lists, x[i : i + 256], ratio)]
            at = np.repeat(np.arange(len(pdf)), [len(a) for a in out])
            bits = np.zeros((len(pdf), len(lists.centroids)), bool)
            for row, a in zip(bits, out):
                row[a] = True
            probed = [b.tobytes() for b in np.packbits(bits, axis=1)]  # a bit a list
            yield pd.DataFrame({"list": np.concatenate(out) if out else [], "probed": [probed[i] for i in at], "id": pdf["id"].to_numpy()[at], "v": [pdf["v"].iloc[i] for i in at]})

    postings = pin(rows.mapInPandas(post, f"list long, earlier array<long>, id long, v {kind}"), "ann-postings")
    probed = pin(asked.mapInPandas(ask, f"list long, probed binary, id long, v {kind}"), "ann-probes")
    # Blocks of a list: as many as its rows and its queries ask for. Lists of one block share tasks.
    parts = lambda df, at_once, name: df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / at_once).cast("int").alias(name))
    together = max(1, -(-len(lists.centroids) * list_rows // PART_ROWS))
    blocks = parts(postings, PART_ROWS, "p").join(parts(probed, QUERIES_AT_ONCE, "q"), "list")
    alone = F.greatest("p", "q") > 1
    blocks = blocks.withColumn("task", F.when(alone, F.col("list") + together).otherwise(F.col("list") % together))
    blocks = F.broadcast(pin(blocks, "ann-blocks"))  # max_lists rows at most
    here = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = postings.join(blocks, "list").select("task", "list", here("p").alias("pi"), every("q").alias("qi"), "id", "earlier", "v")
    right = probed.join(blocks, "list").select("task", "list", every("p").alias("pi"), here("q").alias("qi"), "id", "probed", "v")
    right = right.toDF(*right.columns)  # columns of its own: both sides stem from one table of blocks

    def compare(posted, queried):
        import pandas as pd

        asked, found, scores = [], [], []
        by_list = posted.groupby("list").indices
        for number, at in queried.groupby("list").indices.items():
            here = posted.iloc[by_list.get(number, [])]
            if not len(here):
                continue
            x, ids = _matrix(here["v"]), here["id"].to_numpy()
            earlier = [np.asarray(e, np.int64) for e in here["earlier"]]
            owner, first = np.repeat(np.arange(len(x)), [len(e) for e in earlier]), np.concatenate(earlier)
            for q, v, bits in zip(*(queried[c].iloc[at] for c in ("id", "v", "probed"))):
                # Rows that an earlier list of theirs brings to this query are not compared again.
                others = np.unpackbits(np.frombuffer(bits, np.uint8))[first].astype(bool)
                kept = np.ones(len(x), bool)
                kept[owner[others]] = False
                kept = np.flatnonzero(kept & (ids != q))
                near, of = np.unique(ids[kept], return_inverse=True)
                score = np.full(len(near), np.inf)
                d = x[kept] - np.asarray(v, float)
                np.minimum.at(score, of, np.sqrt((d * d).sum(axis=1)))  # an id counts once, with its nearest vector
                top = _top(score, near, k)
                asked.append(np.full(len(top), q))
                found.append(near[top])
                scores.append(score[top])
        join = lambda parts: np.concatenate(parts) if parts else []
        return pd.DataFrame({"query_id": join(asked), "vec_id": join(found), "score": join(scores)})

    block = ["task", "pi", "qi"]
    near = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(compare, "query_id long, vec_id long, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest scores, ties to the smaller id."""
    limit = np.partition(score, k - 1)[k - 1] if len(score) > k else np.inf
    near = np.flatnonzero((score <= limit) & np.isfinite(score))
    return near[np.lexsort((ids[near], score[near]))][:k]

