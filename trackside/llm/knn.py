"""Operator 1: exact top-k search by a Voronoi join."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackside.session import landed


class Plan(NamedTuple):
    """What the driver derives from summaries, a few numbers per pair of cells."""

    pivots: np.ndarray  # cells x dimensions
    theta: np.ndarray  # per query cell: no query of it needs a score below
    high: np.ndarray  # query cell x data cell: the largest score of a query with the data cell's pivot
    longest: np.ndarray  # per query cell: the largest norm
    blocks: list[tuple[int, ...]]  # the query cells of each block
    splits: list[int]  # into how many blocks the queries of a cell are dealt


def _floored(column: pa.ListArray, width: int) -> np.ndarray:
    """floor(1024 x) of each vector as exact doubles; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * 1024)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered rows, exact at any size; beyond 64 bits they stop there."""
    top = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in a], object).reshape(a.shape) @ np.array([[int(x) for x in row] for row in b], object).reshape(b.shape).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _vectors(cells: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.float64).reshape(len(cells), width) if width else np.zeros((len(cells), 0))


def _assigned(vectors: DataFrame, pivots: np.ndarray, every: int) -> DataFrame:
    """(vec_id, vec, cell, dist, asks): each vector with its nearest pivot."""
    width = pivots.shape[1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (pivots**2).sum(1)
        for batch in batches:
            x = _floored(batch.column("embedding"), width)
            cell = (squares[None, :] - 2 * x @ pivots.T).argmin(1)
            dist = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            ids = batch.column("vec_id")
            asks = pa.array(ids.to_numpy() % every == 0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([r.tobytes() for r in x], pa.binary()), pa.array(cell.astype(np.int32)), pa.array(dist), asks], names=["vec_id", "vec", "cell", "dist", "asks"]
            )

    return vectors.mapInArrow(rows, "vec_id long, vec binary, cell int, dist double, asks boolean")


def _query_summaries(asking: DataFrame, pivots: np.ndarray) -> pd.DataFrame:
    """Per query cell and pivot: lowest and highest score, longest query, count. Cells squared rows."""
    width = pivots.shape[1]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = _vectors(frame["vec"], width)
            scores, norms = x @ pivots.T, np.sqrt((x**2).sum(1))
            for cell in frame["cell"].unique():
                own = (frame["cell"] == cell).to_numpy()
                yield pd.DataFrame({"cell": cell, "pivot": np.arange(len(pivots)), "low": scores[own].min(0), "high": scores[own].max(0), "longest": norms[own].max(), "n": own.sum()})

    parts = asking.select("vec", "cell").mapInPandas(rows, "cell int, pivot int, low double, high double, longest double, n long")
    return parts.groupBy("cell", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("longest").alias("longest"), F.sum("n").alias("n")).toPandas()


def _plan(assigned: DataFrame, asking: DataFrame, pivots: np.ndarray, k: int, block_rows: int) -> Plan:
    cells, queries = len(pivots), _query_summaries(asking, pivots)
    low, high = np.full((cells, cells), -np.inf), np.full((cells, cells), -np.inf)
    low[queries["cell"], queries["pivot"]], high[queries["cell"], queries["pivot"]] = queries["low"], queries["high"]
    longest, n = np.zeros(cells), np.zeros(cells, np.int64)
    longest[queries["cell"]], n[queries["cell"]] = queries["longest"], queries["n"]
    # The k + 1 vec_ids nearest to each pivot, each by its nearest row: the rows of one of them may be the query's own.
    near = Window.partitionBy("cell").orderBy("dist", "vec_id")
    own = assigned.groupBy("cell", "vec_id").agg(F.min("dist").alias("dist"))
    nearest = own.withColumn("at", F.row_number().over(near)).filter(F.col("at") <= k + 1).select("cell", "dist", "vec_id").toPandas()
    theta = np.full(cells, -np.inf)
    for cell in np.flatnonzero(n):
        # Cauchy-Schwarz: a score differs from that of the pivot by norm times distance at most.
        # A vec_id counts once, with its best row, whatever the number of cells it is in.
        reached = pd.Series(low[cell, nearest["cell"]] - longest[cell] * nearest["dist"].to_numpy())
        least = np.sort(reached.groupby(nearest["vec_id"].to_numpy()).max().to_numpy())
        if len(least) > k:
            theta[cell] = least[-k - 1]
    # Cells of similar pivots share a block of queries; large cells are dealt to several.
    order, rest = [], set(np.flatnonzero(n).tolist())
    while rest:
        last = pivots[order[-1]] if order else np.zeros(pivots.shape[1])
        order.append(min(rest, key=lambda c: (float(((pivots[c] - last) ** 2).sum()), c)))
        rest.remove(order[-1])
    blocks: list[tuple[int, ...]] = []
    splits, held = [1] * cells, block_rows
    for cell in order:
        splits[cell] = max(1, -(-int(n[cell]) // block_rows))
        if splits[cell] > 1:
            blocks += [(cell,)] * splits[cell]
            held = block_rows
        elif held + n[cell] > block_rows:
            blocks.append((cell,))
            held = int(n[cell])
        else:
            blocks[-1] += (cell,)
            held += int(n[cell])
    return Plan(pivots, theta, high, longest, blocks, splits)


def _needed(cell: np.ndarray, dist: np.ndarray, plan: Plan) -> np.ndarray:
    """rows x blocks: may a query of the block have this vector among its best?"""
    # Sums of doubles err by far less than this.
    slack = 1 + 1e-9 * (np.abs(plan.high[np.isfinite(plan.high)]).max(initial=0) + plan.longest.max(initial=0) * dist.max(initial=0))
    by_cell = plan.high[:, cell] + plan.longest[:, None] * dist[None, :] + slack >= plan.theta[:, None]
    return np.stack([by_cell[list(block)].any(0) for block in plan.blocks], 1)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores, earlier columns first among equal ones."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, cells: int = 64, block_rows: int = 2048, part_rows: int = 16384) -> DataFrame:
    """The k highest integer inner products of each query: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows but the query's
    own; ties go to the smaller vec_id; a query with fewer candidates gets them all. Vectors are
    compared as floor(1024 x). NULL vectors, vectors with NULL or non-finite components and rows
    without vec_id take no part. Vectors shorter than the longest end in zeros; an empty vector
    scores 0. Rows that repeat a vec_id are candidates each; as queries they ask once. Scores beyond
    64 bits stop at its ends. Other columns are not read; an empty table gives no rows.

    Voronoi join: vectors go to the nearest of ``cells`` pivots, which are a bounded sample. From
    summaries of pairs of cells follows a score that k vec_ids reach for every query of a cell, and
    from a vector's distance to its pivot the best it can do there; it is copied only to the blocks
    of queries where it can matter. Blocks hold ``block_rows`` queries and meet ``part_rows`` vectors
    at a time, so a hot cell is many blocks and many parts.
    """
    valid = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(valid)
    out = "query_id long, rank int, vec_id long, score long"
    spark = vectors.sparkSession
    total = usable.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width")).first()
    if not total.n:
        return spark.createDataFrame([], out)
    width, parts = total.width, -(-total.n // part_rows)
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(cells).select(F.col("embedding").cast("array<double>").alias("embedding")).collect()
    pivots = np.zeros((len(sample), width))
    for row, at in zip(sample, pivots):
        at[: len(row.embedding)] = np.floor(np.array(row.embedding, float) * 1024)
    assigned = landed(_assigned(usable, pivots, every), "knn-cells")
    asking = assigned.filter("asks").groupBy("vec_id").agg(F.min(F.struct("vec", "cell")).alias("row")).select("vec_id", "row.vec", "row.cell")
    plan = _plan(assigned, asking, pivots, k, block_rows)
    if not plan.blocks:
        return spark.createDataFrame([], out)

    def copies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            row, block = np.nonzero(_needed(frame["cell"].to_numpy(), frame["dist"].to_numpy(), plan))
            yield frame[["part", "vec_id", "vec"]].iloc[row].assign(block=block.astype(np.int32))

    def local(asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("vec_id", kind="stable")
        ids, x = found["vec_id"].to_numpy(), _vectors(found["vec"], width)
        out = []
        for at in range(0, len(asked) if len(ids) else 0, 256):
            some = asked.iloc[at : at + 256]
            for query, scores in zip(some["vec_id"], _dot(_vectors(some["vec"], width), x)):
                others = np.flatnonzero(ids != query)
                best = others[_best(scores[others], k)]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    # Dealt by row, because a vec_id may repeat; queries meet every part. The rows are landed, so a task run again has the same numbers.
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int").alias("part")
    data = assigned.select("vec_id", "vec", "cell", "dist", part).mapInPandas(copies, "part int, vec_id long, vec binary, block int")
    # Blocks of each cell: one, or one of those that the cell's queries are dealt to.
    first = {cell: block for block, own in reversed(list(enumerate(plan.blocks))) for cell in own}
    block = F.element_at(F.create_map(*[F.lit(x) for c in first for x in (c, first[c])]), F.col("cell"))
    spread = F.element_at(F.create_map(*[F.lit(x) for c in first for x in (c, plan.splits[c])]), F.col("cell"))
    queries = asking.select("vec_id", "vec", (block + F.pmod(F.xxhash64("vec_id"), spread)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    pairs = queries.groupBy("block", "part").cogroup(data.groupBy("block", "part")).applyInPandas(local, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
