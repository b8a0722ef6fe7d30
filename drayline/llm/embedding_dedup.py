"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Unit vectors are turned by the principal axes of all of them, so the first
coordinates hold most of each product.  Tiles of vectors are compared pairwise:

* a tile is a cell of ranges on the first two axes; two cells whose ranges lie
  further apart than vectors of the threshold's cosine can be are never paired;
* inside a pair the leading coordinates are multiplied first and what the rest
  can add is bounded by the product of the suffix norms (one more column of the
  same matrix product); pairs that cannot reach the threshold stop there, the
  others go on to the next coordinates;
* what is left is decided by the cosine of the vectors themselves in double
  precision.

Equal vectors are one vector with a count.  Links are counted in the tile and
leave it as a count a vector and a spanning forest, never as all pairs.  A cell
with too many vectors, such as a large group of near copies, is cut into tiles
of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from drayline.llm.components import components
from drayline.session import RunFolder

THRESHOLD = 0.95
TILE = 4096
#: Rows of a tile that are compared with the other tile at a time.
STRIP = 512
#: Rounding allowed for when single-precision bounds decide that a pair stops.
SLACK = 1e-4
#: Share of a strip's pairs left after the first bound beyond which all of them are multiplied at once.
DENSE = 0.02


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype="<f8").reshape(len(vectors), -1)


def _scaled(vector: np.ndarray) -> np.ndarray:
    """The vector times the power of two that puts its largest component between a half and one, so that no sum of squares runs over or under."""
    return np.ldexp(vector, -np.frexp(np.abs(vector).max())[1])


def _steps(width: int) -> list[int]:
    """Numbers of leading coordinates: a quarter, a half and all."""
    return sorted({max(1, width // 4), max(1, width // 2), width})


def _turned(matrix: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and the same along the principal axes."""
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    return unit, unit @ axes


def linked_pairs(first: np.ndarray, second: np.ndarray, axes: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``(i, j)`` in the two tiles of all pairs whose cosine reaches the threshold, strip by strip."""
    (unit_a, a), (unit_b, b) = _turned(first, axes), _turned(second, axes)
    steps = _steps(a.shape[1])
    rest_a = [np.sqrt(np.maximum((a[:, k:] ** 2).sum(axis=1), 0)) for k in steps]
    rest_b = [np.sqrt(np.maximum((b[:, k:] ** 2).sum(axis=1), 0)) for k in steps]
    lead = steps[0]
    wide_b = np.column_stack([b[:, :lead], rest_b[0]]).astype(np.float32).T.copy()
    wide_a = np.column_stack([a[:, :lead], rest_a[0]]).astype(np.float32)
    for begin in range(0, len(a), STRIP):
        most = wide_a[begin : begin + STRIP] @ wide_b
        flat = np.flatnonzero(most >= threshold - SLACK)
        if len(flat) > DENSE * most.size:
            i, j = np.nonzero(unit_a[begin : begin + STRIP] @ unit_b.T >= threshold)
            yield i + begin, j
            continue
        i, j = np.divmod(flat, most.shape[1])
        i += begin
        product = np.einsum("ij,ij->i", a[i, :lead], b[j, :lead])
        for k, (done, upto) in enumerate(zip(steps, steps[1:], strict=False)):
            product += np.einsum("ij,ij->i", a[i, done:upto], b[j, done:upto])
            go_on = product + rest_a[k + 1][i] * rest_b[k + 1][j] >= threshold - SLACK
            i, j, product = i[go_on], j[go_on], product[go_on]
        exact = np.einsum("ij,ij->i", unit_a[i], unit_b[j]) >= threshold
        yield i[exact], j[exact]


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each of ``n`` places over the given links."""
    label = np.arange(n)
    while len(i):
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _compare(tile_a: dict, tile_b: dict | None, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one pair of tiles: ids, the links each has there, and the smallest id it reaches there."""
    same = tile_b is None
    other = tile_a if same else tile_b
    ids = tile_a["ids"] if same else np.concatenate([tile_a["ids"], other["ids"]])
    counts = tile_a["counts"] if same else np.concatenate([tile_a["counts"], other["counts"]])
    shift = 0 if same else len(tile_a["ids"])
    links = np.zeros(len(ids), dtype=np.int64)
    froms, tos = [], []
    for i, j in linked_pairs(tile_a["vectors"], other["vectors"], axes, threshold):
        if same:
            apart = i < j
            i, j = i[apart], j[apart]
        j = j + shift
        links += np.bincount(i, counts[j], len(ids)).astype(np.int64) + np.bincount(j, counts[i], len(ids)).astype(np.int64)
        label = _labels(len(ids), i, j)
        moved = np.flatnonzero(label != np.arange(len(ids)))
        froms.append(moved)
        tos.append(label[moved])
    order = np.argsort(ids, kind="stable")  # labels must follow the ids
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.arange(len(ids))
    i, j = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (froms, tos))
    label = _labels(len(ids), rank[i], rank[j])
    least = ids[order][label[rank]]
    touched = np.flatnonzero(links)
    return ids[touched], links[touched], least[touched]


def _principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Columns: the directions of most weight of the unit vectors, from the sum over all of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            unit = _matrix(batch.column(0).to_pylist())
            unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
            total += unit.T @ unit
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), width)), pa.array(np.tile(np.arange(width), width)), pa.array(total.ravel())], names=["i", "j", "x"])

    cells = vectors.select("vector").mapInArrow(add, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    total = np.zeros((width, width))
    for row in cells.collect():  # width squared numbers
        total[row.i, row.j] = row.x
    return np.linalg.eigh(total)[1][:, ::-1].copy()


def _tiles(vectors: DataFrame, axes: np.ndarray, run: RunFolder, label: str, tile: int) -> DataFrame:
    """``tile``, ranges on the first two axes, and the ids, counts and vectors of each tile."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = _turned(_matrix(batch.column(2).to_pylist()), axes)[1]
            second = turned[:, 1] if turned.shape[1] > 1 else np.zeros(len(turned))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(turned[:, 0]), pa.array(second)], names=["id", "n", "vector", "x", "y"])

    placed = run.keep(vectors.select("id", "n", "vector").mapInArrow(place, "id long, n long, vector binary, x double, y double"), f"{label}-placed")
    rows = placed.count()
    side = max(1, math.ceil(math.sqrt(rows / tile)))
    cuts = [k / side for k in range(1, side)]
    bounds = placed.approxQuantile(["x", "y"], cuts, 0.01) if cuts else [[], []]
    cell = F.lit(0)
    for column, limits in zip(("x", "y"), bounds, strict=True):
        part = sum([F.when(F.col(column) >= b, 1).otherwise(0) for b in limits], F.lit(0))
        cell = cell * side + part
    celled = placed.withColumn("cell", cell)
    parts = celled.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("parts"))
    dealt = celled.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    dealt = dealt.repartition("cell", "part")  # else the join's partitioning by cell would keep a large cell in one task

    def gather(table: pa.Table) -> pa.Table:
        ids, counts = table.column("id").to_numpy(), table.column("n").to_numpy()
        x, y = table.column("x").to_numpy(), table.column("y").to_numpy()
        return pa.table(
            {
                "tile": pa.array([int(table.column("cell")[0].as_py()) << 32 | int(table.column("part")[0].as_py())], pa.int64()),
                "x0": [x.min()], "x1": [x.max()], "y0": [y.min()], "y1": [y.max()],
                "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                "counts": pa.array([counts.astype("<i8").tobytes()], pa.binary()),
                "vectors": pa.array([b"".join(table.column("vector").to_pylist())], pa.binary()),
            }
        )

    shape = "tile long, x0 double, x1 double, y0 double, y1 double, ids binary, counts binary, vectors binary"
    return run.keep(dealt.groupBy("cell", "part").applyInArrow(gather, shape), f"{label}-tiles")


def _pairs(tiles: DataFrame, reach: float) -> DataFrame:
    """Pairs ``a <= b`` of tiles whose ranges come within ``reach`` of each other, met by equal steps of that width."""
    ranges = tiles.select("tile", "x0", "x1", "y0", "y1")

    def steps(low: str, high: str, more: float) -> F.Column:
        return F.explode(F.sequence(F.floor(F.col(low) / reach), F.floor((F.col(high) + more) / reach)))

    left = ranges.withColumn("u", steps("x0", "x1", reach)).withColumn("v", steps("y0", "y1", reach))
    right = ranges.withColumn("u", steps("x0", "x1", reach)).withColumn("v", steps("y0", "y1", reach))
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in ("tile", "x0", "x1", "y0", "y1")], "u", "v")
    met = left.join(right, ["u", "v"]).where(F.col("tile") <= F.col("r_tile"))
    gap = lambda c: F.greatest(F.col(f"r_{c}0") - F.col(f"{c}1"), F.col(f"{c}0") - F.col(f"r_{c}1"), F.lit(0.0))
    near = gap("x") * gap("x") + gap("y") * gap("y") <= reach * reach
    return met.where(near).select(F.col("tile").alias("a"), F.col("r_tile").alias("b")).distinct()


def near_duplicates(
    vectors: DataFrame,
    run: RunFolder,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """For every row the id, ``n_links``, ``component_id`` and ``kept``.

    Two rows are linked if the cosine of their vectors in double precision is at
    least ``threshold`` (over 0).  Rows whose vector is null, empty, zero or
    holds null or non-finite components, and rows without an id, link with
    nothing; nor do vectors of different length.  ``n_links`` counts the other
    rows linked directly, ``component_id`` is the smallest id reachable (the
    own id included), ``kept`` tells that it is the own id.  Rows with equal
    vectors are linked, also where ids or whole rows repeat; rows of one id
    share a component.  Other columns of the input are not read.  An empty
    table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    nonzero = F.exists("v", lambda x: x != 0)
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & (F.size("v") > 0) & finite & nonzero, F.lit(False))
    rows = run.keep(rows.withColumn("v", F.when(usable, F.col("v"))), "rows")
    distinct = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [_scaled(np.asarray(v, dtype="<f8")) for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes() for c in cells], pa.binary()), pa.array([len(c) for c in cells], pa.int32())],
                names=["id", "n", "vector", "width"],
            )

    packed = run.keep(distinct.select("id", "n", "v").mapInArrow(pack, "id long, n long, vector binary, width int"), "vectors")
    found = None
    for (width,) in packed.select("width").distinct().orderBy("width").collect():  # the different lengths of vectors
        part = _linked(packed.where(F.col("width") == width), int(width), run, f"width{width}", threshold, tile)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = run.keep(found, "found")
    degree = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")), run)
    known = distinct.join(degree, "id", "left").join(parts, distinct.id == parts.vertex, "left")
    known = known.select(
        F.col("v").alias("w"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    joined = rows.join(known, F.col("v") == F.col("w"), "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _linked(vectors: DataFrame, width: int, run: RunFolder, label: str, threshold: float, tile: int) -> DataFrame:
    """``id``, ``links`` and ``least`` (an id it is connected to) of each vector in each pair of tiles."""
    axes = _principal_axes(vectors, width)
    tiles = _tiles(vectors, axes, run, label, tile)
    pairs = run.keep(_pairs(tiles, math.sqrt(max(2 - 2 * threshold, 0.0)) + SLACK), f"{label}-pairs")
    data = ["ids", "counts", "vectors"]
    first = tiles.select(F.col("tile").alias("a"), *[F.col(c).alias(f"{c}_a") for c in data]).join(pairs, "a")
    second = tiles.select(F.col("tile").alias("b"), *[F.col(c).alias(f"{c}_b") for c in data]).join(pairs.where("a <> b"), "b")
    both = first.join(second, ["a", "b"], "left")

    def read(batch: pa.RecordBatch, row: int, side: str) -> dict | None:
        cells = {c: batch.column(batch.schema.get_field_index(f"{c}_{side}"))[row].as_py() for c in data}
        if cells["ids"] is None:
            return None
        return {
            "ids": np.frombuffer(cells["ids"], dtype="<i8"),
            "counts": np.frombuffer(cells["counts"], dtype="<i8"),
            "vectors": np.frombuffer(cells["vectors"], dtype="<f8").reshape(-1, width),
        }

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, links, least = _compare(read(batch, row, "a"), read(batch, row, "b"), axes, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(least)], names=["id", "links", "least"])

    return both.mapInArrow(compare, "id long, links long, least long")
