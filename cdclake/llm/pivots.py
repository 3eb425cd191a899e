"""Exact top-k inner products through a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

K = 10
SCALE = 1024  # components become floor(SCALE * x)
PIVOTS = 64  # most pivots of a dimension
SAMPLE = 4096  # rows, about, that pivots are chosen from
BLOCK_ROWS = 4096  # vectors of a block, about
QUERY_BLOCK = 4096  # queries that are compared with a block at once, about
RING = 256  # vectors of one step of an annulus


def vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, dim, vec: usable rows as integer vectors (little-endian doubles that hold integers exactly)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            values = np.floor(scale * column.values.to_numpy(zero_copy_only=False).astype(np.float64))
            off = column.offsets.to_numpy()
            blobs = [values[a:b].tobytes() for a, b in zip(off[:-1], off[1:])]
            dims = pa.array(np.diff(off).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), dims, pa.array(blobs, pa.binary())], ["vec_id", "dim", "vec"])

    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    ready = table.where("embedding is not null and vec_id is not null").where(usable & (F.size("embedding") > 0))
    return ready.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, "vec_id bigint, dim int, vec binary")


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def choose_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first: each next pivot is the vector farthest from those before; equal vectors give one."""
    picked = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(picked) < min(most, len(sample)) and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[picked[-1]]) ** 2).sum(1))
    return sample[picked]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _assign(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for low in range(0, part.num_rows, 4096):
                    rows = part.slice(low, 4096)
                    x = _matrix(rows.column("vec"), dim)
                    far = _distances(x, pivots[int(dim)])
                    near = far.argmin(1)
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(x)), near]), pa.array(np.sqrt((x**2).sum(1)))],
                        ["vec_id", "dim", "vec", "pivot", "distance", "norm"])

    return run


def upper_bound(query: np.ndarray, norm: float, pivot: np.ndarray, gap: float, near: np.ndarray, far: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """Largest inner product that a vector may have whose distance to ``pivot`` is in [near, far] and whose norm is at most ``longest``.

    gap is the query's own distance to the pivot. By the triangle inequality
    the vector is at least near - gap or gap - far away, and 2 q.x = |q|^2 + |x|^2 - |q - x|^2;
    also q.x is at most q.p plus |q| times the distance to p.
    """
    apart = np.maximum(0, np.maximum(near - gap, gap - far))
    triangle = (norm**2 + longest**2 - apart**2) / 2
    around = query @ pivot + norm * far
    return np.minimum(np.minimum(triangle, around), norm * longest)


def _better(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def _block(key: tuple, rows: pa.Table) -> pa.Table:
    """A block's vectors as one row, by distance to their pivot."""
    rows = rows.sort_by([("distance", "ascending"), ("vec_id", "ascending")])
    data = {x: rows.column(x).to_numpy().tobytes() for x in ("vec_id", "distance", "norm")}
    data["vec"] = b"".join(rows.column("vec").to_pylist())
    names, types = ("dim", "pivot", "block"), [pa.int32()] * 3
    return pa.table([*[pa.array([k.as_py()], t) for k, t in zip(key, types)], *[pa.array([data[x]], pa.binary()) for x in ("vec_id", "distance", "norm", "vec")]], [*names, "vec_id", "distance", "norm", "vec"])


def _search(pivots: dict[int, np.ndarray], k: int):
    """The best of a block for each of the queries that a row holds beside it."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        out = []
        for batch in table.to_batches():
            for i in range(batch.num_rows):
                row = {x: batch.column(x)[i].as_py() for x in ("dim", "pivot", "vec_id", "distance", "norm", "vec")}
                asked = batch.column("asked")[i].values
                out.append(search(row, asked.field("vec_id"), asked.field("vec"), asked.field("least")))
        return pa.Table.from_batches(out)

    def search(row: dict, q_ids: pa.Array, q_vecs: pa.Array, q_least: pa.Array) -> pa.RecordBatch:
        out_q, out_v, out_s = [], [], []
        if len(q_ids):
            dim = row["dim"]
            p = pivots[dim][row["pivot"]]
            x, ids, dist, norms = np.frombuffer(row["vec"]).reshape(-1, dim), np.frombuffer(row["vec_id"], np.int64), np.frombuffer(row["distance"]), np.frombuffer(row["norm"])
            cut = np.arange(0, len(ids), RING)
            near, far, longest = dist[cut], dist[np.r_[cut[1:], len(ids)] - 1], np.maximum.reduceat(norms, cut)
            q, q_ids, least = _matrix(q_vecs, dim), q_ids.to_numpy(), q_least.to_numpy(zero_copy_only=False).astype(np.float64)
            gaps = _distances(q, p[None, :])[:, 0]
            for i in range(len(q_ids)):
                norm = float(np.sqrt((q[i] ** 2).sum()))
                bound = upper_bound(q[i], norm, p, gaps[i], near, far, longest)
                slack = 1e-9 * (1 + norm * float(longest.max()))
                score, found, floor = np.empty(0), np.empty(0, np.int64), least[i]
                # Annuli by how far they lie from the query's own distance to the pivot: outward in both directions.
                away = np.maximum(0, np.maximum(near - gaps[i], gaps[i] - far))
                whole = (norm**2 + longest.max() ** 2 - away**2) / 2
                for ring in np.argsort(away, kind="stable"):
                    if not np.isnan(floor) and whole[ring] + slack < floor:
                        break  # all annuli beyond are at least as far
                    if not np.isnan(floor) and bound[ring] + slack < floor:
                        continue
                    part = slice(cut[ring], cut[ring] + RING)
                    other = ids[part] != q_ids[i]
                    score, found = np.r_[score, (x[part] @ q[i])[other]], np.r_[found, ids[part][other]]
                    top = _better(score, found, k)
                    score, found = score[top], found[top]
                    if len(score) == k:
                        floor = score[-1] if np.isnan(floor) else max(floor, score[-1])
                out_q.append(np.full(len(found), q_ids[i]))
                out_v.append(found)
                out_s.append(score)
        cat = lambda xs, t: np.concatenate(xs).astype(t) if xs else np.empty(0, t)
        return pa.RecordBatch.from_pydict({"query_id": cat(out_q, np.int64), "vec_id": cat(out_v, np.int64), "score": cat(out_s, np.int64)})

    return run


def _targets(pivots: dict[int, np.ndarray], cells: dict[tuple[int, int], tuple[float, float, float, int]], first: bool):
    """Rows (dim, pivot, block) for each query: those of its own pivot first, later all others whose bound reaches its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim, own, floor = (batch.column(x)[row].as_py() for x in ("dim", "pivot", "least"))
                q = np.frombuffer(batch.column("vec")[row].as_py(), np.float64)
                norm, gaps = float(np.sqrt((q**2).sum())), _distances(q[None, :], pivots[dim])[0]
                pick = []
                for p in range(len(pivots[dim])):
                    if (dim, p) not in cells or (p == own) != first:
                        continue
                    near, far, longest, blocks = cells[dim, p]
                    top = upper_bound(q, norm, pivots[dim][p], gaps[p], np.array([near]), np.array([far]), np.array([longest]))[0]
                    if floor is None or top + 1e-9 * (1 + norm * longest) >= floor:
                        pick += [(p, b) for b in range(blocks)]
                n = len(pick)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * n, pa.int32()), pa.array([x[0] for x in pick], pa.int32()), pa.array([x[1] for x in pick], pa.int32()), *[pa.array([batch.column(x)[row].as_py()] * n, t) for x, t in (("vec_id", pa.int64()), ("vec", pa.binary()), ("least", pa.float64()))]],
                    ["dim", "pivot", "block", "vec_id", "vec", "least"])

    return run


def nearest(table: DataFrame, queries: DataFrame, *, k: int = K, scale: int = SCALE, most_pivots: int = PIVOTS, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest integer inner products with other vec_ids, exactly.

    Both tables have vec_id and embedding; components become floor(scale * x).
    Rows whose id or vector is null, empty, or holds null or non-finite
    components take no part. Vectors of different lengths have no product. Ties go to
    the smaller vec_id. A vec_id that occurs more than once is a candidate once for each row;
    of rows that repeat a query's id one asks. Rows with the query's own id are no candidates. Scores are exact while they fit in 2**53.

    Every vector is keyed by its nearest pivot and its distance to it; a pivot's
    vectors are dealt into blocks by hash, so a vector that a third of all rows
    hold spreads over blocks. A query first searches its own pivot's blocks,
    which gives a floor for its k-th score, then those blocks of other
    pivots whose bound reaches the floor; inside a block annuli are
    expanded from the query's own distance until the triangle inequality ends the search.
    A block travels as one row, once for each of the two searches; queries meet it in turns of about ``QUERY_BLOCK``.
    Pivots come from a sample of about ``sample`` rows; the sample changes the cost, never the result.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "pivots")
    base = scratch.keep(vectors(table, scale), "vectors")
    wanted = vectors(queries, scale).groupBy("vec_id").agg(F.min(F.struct("dim", "vec")).alias("one")).select("vec_id", "one.dim", "one.vec")
    sizes = {r["dim"]: r["count"] for r in base.groupBy("dim").count().collect()}
    result = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not sizes:
        return spark.createDataFrame([], result)
    chosen: dict[int, np.ndarray] = {}
    for dim, n in sizes.items():
        part = min(1.0, sample / n)
        draw = F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(2**40)) / F.lit(float(2**40))
        picked = base.where(F.col("dim") == dim).where(draw < part).orderBy(draw, "vec_id").limit(sample).select("vec").toArrow()
        if not picked.num_rows:
            picked = base.where(F.col("dim") == dim).limit(1).select("vec").toArrow()
        chosen[dim] = choose_pivots(_matrix(picked.column("vec"), dim), most_pivots)
    keyed = "vec_id bigint, dim int, vec binary, pivot int, distance double, norm double"
    index = scratch.keep(base.mapInArrow(_assign(chosen), keyed), "index")
    stats = index.groupBy("dim", "pivot").agg(F.min("distance"), F.max("distance"), F.max("norm"), F.count("*")).collect()
    cells = {(r[0], r[1]): (r[2], r[3], r[4], -(-r[5] // block_rows)) for r in stats}
    parts = F.create_map(*[F.lit(x) for (d, p), v in cells.items() for x in (f"{d},{p}", v[3])])
    spread = F.element_at(parts, F.concat_ws(",", "dim", "pivot"))
    turns = max(1, -(-wanted.count() // QUERY_BLOCK))
    dealt = index.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(9)), spread).cast("int"))
    blocks = dealt.groupBy("dim", "pivot", "block").applyInArrow(_block, "dim int, pivot int, block int, vec_id binary, distance binary, norm binary, vec binary")
    blocks = scratch.keep(blocks, "blocks")  # about block_rows vectors a row: moved once for all queries
    asked = scratch.keep(wanted.where(F.col("dim").isin(list(sizes))).mapInArrow(_assign(chosen), keyed).select("vec_id", "dim", "vec", "pivot", F.lit(None).cast("double").alias("least")), "asked")

    def search(rows: DataFrame, first: bool) -> DataFrame:
        where = "dim int, pivot int, block int, vec_id bigint, vec binary, least double"
        target = rows.mapInArrow(_targets(chosen, cells, first), where)
        turn = F.pmod(F.xxhash64("vec_id"), F.lit(turns)).alias("turn")
        target = target.groupBy("dim", "pivot", "block", turn).agg(F.collect_list(F.struct("vec_id", "vec", "least")).alias("asked"))
        met = target.join(blocks.hint("merge"), ["dim", "pivot", "block"])
        # A row at a time; the join has dealt the rows by block, so grouping them moves none.
        return met.groupBy("dim", "pivot", "block", "turn").applyInArrow(_search(chosen, k), "query_id bigint, vec_id bigint, score bigint")

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    home = scratch.keep(search(asked, True), "home")
    floors = home.withColumn("rank", rank).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))
    again = asked.join(floors, asked["vec_id"] == floors["query_id"], "left").select("vec_id", "dim", "vec", "pivot", F.col("floor").alias("least"))
    rest = search(again, False)
    return home.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
