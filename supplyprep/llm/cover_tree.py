"""Embedding near-duplicates: exact cosine pairs by dual traversal of cover trees.

Vectors are scaled to length one; a cosine of at least t is a distance of at most
sqrt(2 - 2 t). A cover tree is a series of nested sets of centres: each level holds the centres
above it and enough others that every vector lies within the level's radius of one, and the radius
halves from level to level. A node knows the largest distance from its centre to anything below
it, its covering radius.

Two trees are traversed together. A pair of nodes whose centres are further apart than the
distance plus both covering radii is pruned; a pair that is closer than the distance minus both is
linked as a whole, and its links are counted from the nodes' sizes; any other pair is replaced by
pairs of their children. What is left are single vectors, decided by their cosine in double
precision.

On Spark, equal vectors are first folded into one row. The upper tree is grown over a bounded sample
(``sample`` vectors): a node is cut by centres of half the radius, again and again, as long as its
share of all vectors is above a sixteenth of ``block``. The nodes that are left are cells; every vector goes to the
cell with the nearest centre, and the covering radii are taken over all vectors. Neighbouring cells
share a block of at most ``block`` vectors; a cell that holds more, such as a tight group of copies,
is cut into several, and its links are counted, not listed. A vector is sent to another block only
if that holds a cell which it can reach: the centre is no further than the distance plus the cell's
radius, and so is the border half-way between that centre and the vector's own. Two blocks meet in
one traversal, with those vectors that reach each other's cells. Links that leave it are a spanning
forest, from which the components are found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.llm.common import least_by_hash, map_arrow, staged
from supplyprep.llm.components import connected_components

#: Float32 products decide what is further than this from the threshold; double precision the rest.
SLACK = 1e-4
TOP_RADIUS = 2.0
LEVELS = 7
#: Vectors that are compared with all centres at a time.
STRIP = 512
#: Cells that a block is made for: small cells have small radii and are pruned.
CELLS = 16


# --- trees -------------------------------------------------------------------------------


@dataclass
class Tree:
    """Levels of a cover tree over the rows of ``points``, each a node list from coarse to fine.

    ``points`` are in traversal order, so a node covers the rows from first to last. The last level
    has one node per row.
    """

    points: np.ndarray
    order: np.ndarray
    centres: list[np.ndarray] = field(default_factory=list)  # row of each node's centre
    first: list[np.ndarray] = field(default_factory=list)
    last: list[np.ndarray] = field(default_factory=list)  # exclusive
    radius: list[np.ndarray] = field(default_factory=list)  # covering radius
    child: list[np.ndarray] = field(default_factory=list)  # children of node i in the next level: child[i] .. child[i + 1]


def net(points: np.ndarray, radius: float) -> tuple[list[int], np.ndarray]:
    """Centres, the first row always one of them, such that each row is within ``radius`` of its own; and the centre of each row."""
    owner = np.full(len(points), -1)
    centres: list[int] = []
    least = 1 - radius * radius / 2  # cosine at that distance
    left = np.arange(len(points))
    while len(left):
        # A bounded handful of open rows is thinned out to new centres, then rows near them are taken.
        head = left[:128]
        near = points[head] @ points[head].T >= least
        chosen: list[int] = []
        for i in range(len(head)):
            if not near[i, chosen].any():
                chosen.append(i)
        cosines = points[left] @ points[head[chosen]].T
        best = cosines.argmax(axis=1)
        taken = cosines[np.arange(len(left)), best] >= least
        taken[: len(head)] = True
        best[: len(head)] = [int(np.argmax(np.where(near[i, chosen], cosines[i], -2))) for i in range(len(head))]
        best[chosen] = np.arange(len(chosen))
        owner[left[taken]] = len(centres) + best[taken]
        centres += head[chosen].tolist()
        left = left[~taken]
    return centres, owner


def grow(points: np.ndarray) -> Tree:
    """A cover tree over unit vectors (float32)."""
    order = np.arange(len(points))
    groups = [order]  # rows of each node of the level, its centre first
    levels: list[list[np.ndarray]] = []
    radius = TOP_RADIUS
    for level in range(LEVELS):
        following = []
        for rows in groups:
            if len(rows) == 1 or level == 0:
                following.append(rows)
                continue
            centres, owner = net(points[rows], radius)
            by = np.argsort(owner, kind="stable")
            for part, centre in zip(np.split(by, np.flatnonzero(np.diff(owner[by])) + 1), centres, strict=True):
                following.append(np.concatenate([[rows[centre]], rows[part[part != centre]]]))
        groups = following
        levels.append(groups)
        radius /= 2
    levels.append([np.array([r]) for rows in groups for r in rows])
    order = np.concatenate([rows for rows in levels[-1]]) if len(points) else order
    tree = Tree(np.ascontiguousarray(points[order]), order)
    for k, groups in enumerate(levels):
        sizes = np.array([len(rows) for rows in groups])
        last = np.cumsum(sizes)
        first = last - sizes
        # A centre is the first row of its node, in every level below as well.
        owner = np.repeat(first, sizes)
        cosines = np.einsum("ij,ij->i", tree.points, tree.points[owner])
        far = np.sqrt(np.maximum(0, 2 - 2 * np.minimum.reduceat(cosines, first))) + 1e-3 if k < len(levels) - 1 else np.zeros(len(first))
        tree.centres.append(first)
        tree.first.append(first)
        tree.last.append(last)
        tree.radius.append(np.where(sizes == 1, 0.0, far))
        if k:
            tree.child[-1] = np.append(np.searchsorted(first, tree.first[k - 1]), len(first))
        tree.child.append(np.zeros(0, dtype=np.int64))
    return tree


# --- dual traversal -------------------------------------------------------------------------------


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * cosine))


def linked_pairs(a: Tree, b: Tree, exact_a: np.ndarray, exact_b: np.ndarray, least: float, same: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Ranges of rows all of which are linked: first and last rows in ``a`` and in ``b``.

    ``exact_*`` are the unit vectors in double precision, in the order of the trees. With ``same``
    the trees are one, each pair of rows comes once, in either order, and no row with itself.
    """
    reach = float(np.sqrt(2 - 2 * least))
    frontier = (np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)) if len(a.points) and len(b.points) else (np.zeros(0, dtype=np.int64),) * 2
    depth = len(a.centres) - 1
    for level in range(depth + 1):
        found_u, found_v = [], []
        for u, v, d in _centre_distances(a, b, level, *frontier, reach, same):
            ru, rv = a.radius[level][u], b.radius[level][v]
            if level == depth:
                sure = d < reach - SLACK
                unsure = ~sure & (d <= reach + SLACK)
                pu, pv = a.first[level][u[unsure]], b.first[level][v[unsure]]
                exact = np.einsum("ij,ij->i", exact_a[pu], exact_b[pv]) >= least
                pu = np.concatenate([a.first[level][u[sure]], pu[exact]])
                pv = np.concatenate([b.first[level][v[sure]], pv[exact]])
                if len(pu):
                    yield pu, pu + 1, pv, pv + 1
                continue
            whole = d + ru + rv < reach - SLACK
            if same:
                whole &= u != v
            if whole.any():
                yield a.first[level][u[whole]], a.last[level][u[whole]], b.first[level][v[whole]], b.last[level][v[whole]]
            found_u.append(u[~whole])
            found_v.append(v[~whole])
        if level == depth:
            return
        frontier = (np.concatenate(found_u), np.concatenate(found_v)) if found_u else (np.zeros(0, dtype=np.int64),) * 2


def _centre_distances(a: Tree, b: Tree, level: int, up_u: np.ndarray, up_v: np.ndarray, reach: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of nodes of a level below the frontier that are not pruned, with the distance of their centres.

    Large families are compared by matrix products in strips, small ones pair by pair.
    """
    if level == 0:
        families = [(0, len(a.first[0]), 0, len(b.first[0]))]
        small = None
    else:
        ca, cb = a.child[level - 1], b.child[level - 1]
        nu, nv = ca[up_u + 1] - ca[up_u], cb[up_v + 1] - cb[up_v]
        large = nu * nv >= 256
        families = list(zip(ca[up_u[large]], ca[up_u[large] + 1], cb[up_v[large]], cb[up_v[large] + 1], strict=True))
        small = (ca[up_u[~large]], nu[~large], cb[up_v[~large]], nv[~large])
    for u0, u1, v0, v1 in families:
        itself = same and (u0, u1) == (v0, v1)
        by_a, by_b = _by_radius(a.radius[level], u0, u1), _by_radius(b.radius[level], v0, v1)
        for x, left in enumerate(by_a):
            for y, right in enumerate(by_b):
                if not len(left) or not len(right) or (itself and y < x):
                    continue
                far = min(2.0, reach + float(a.radius[level][left].max()) + float(b.radius[level][right].max()) + SLACK)
                other = b.points[b.centres[level][right]]
                strip = max(1, (1 << 22) // len(right))
                for s in range(0, len(left), strip):
                    skip = s if itself and x == y else 0  # of a family with itself, one half
                    cosine = a.points[a.centres[level][left[s : s + strip]]] @ other[skip:].T
                    i, j = np.nonzero(cosine >= 1 - far * far / 2)
                    u, v = left[s + i], right[skip + j]
                    if itself and x != y:
                        u, v = np.minimum(u, v), np.maximum(u, v)
                    yield from _kept(a, b, level, u, v, _distance(cosine[i, j]), reach, same)
    if small is not None and len(small[0]):
        fu, nu, fv, nv = small
        ends = np.cumsum(nu * nv)
        cuts = [0, *(np.flatnonzero(np.diff(ends // (1 << 18))) + 1).tolist(), len(ends)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if s == e:
                continue
            n = nu[s:e] * nv[s:e]
            which = np.repeat(np.arange(s, e), n)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            u, v = fu[which] + inner // nv[which], fv[which] + inner % nv[which]
            cosine = np.einsum("ij,ij->i", a.points[a.centres[level][u]], b.points[b.centres[level][v]])
            yield from _kept(a, b, level, u, v, _distance(cosine), reach, same)


def _by_radius(radius: np.ndarray, first: int, last: int) -> list[np.ndarray]:
    """Nodes first .. last - 1 by covering radius: nearly points, small, large. Each kind is pruned by its own bound."""
    place = np.digitize(radius[first:last], (0.05, 0.35))
    return [first + np.flatnonzero(place == k) for k in range(3)]


def _kept(a: Tree, b: Tree, level: int, u: np.ndarray, v: np.ndarray, d: np.ndarray, reach: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    near = d <= reach + a.radius[level][u] + b.radius[level][v] + SLACK
    if same:
        leaf = level == len(a.centres) - 1
        near &= (u < v) if leaf else (u <= v)
    if near.any():
        yield u[near], v[near], d[near]


def traverse(a: Tree, b: Tree, exact_a: np.ndarray, exact_b: np.ndarray, weight_a: np.ndarray, weight_b: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of each row of ``a`` and ``b`` (weighted by the copies on the other side), and a spanning forest of them as row pairs."""
    count_a, count_b = np.zeros(len(weight_a) + 1, dtype=np.int64), np.zeros(len(weight_b) + 1, dtype=np.int64)
    total_a, total_b = np.concatenate([[0], np.cumsum(weight_a)]), np.concatenate([[0], np.cumsum(weight_b)])
    n = len(weight_a)
    shift = 0 if same else n
    label = np.arange(n if same else n + len(weight_b))
    tree_x, tree_y = [], []

    def join(x: np.ndarray, y: np.ndarray) -> None:
        """Merge the components of row pairs; pairs that are joined already add nothing."""
        nonlocal label
        while len(x):
            lx, ly = label[x], label[y]
            open_ = lx != ly
            x, y, lx, ly = x[open_], y[open_], lx[open_], ly[open_]
            if not len(x):
                return
            high, low = np.maximum(lx, ly), np.minimum(lx, ly)
            high, at = np.unique(high, return_index=True)
            tree_x.append(x[at])
            tree_y.append(y[at])
            to = np.arange(len(label))
            to[high] = low[at]
            while True:
                hop = to[to]
                if np.array_equal(hop, to):
                    break
                to = hop
            label = to[label]

    for u0, u1, v0, v1 in linked_pairs(a, b, exact_a, exact_b, least, same):
        np.add.at(count_a, u0, total_b[v1] - total_b[v0])
        np.add.at(count_a, u1, -(total_b[v1] - total_b[v0]))
        np.add.at(count_b, v0, total_a[u1] - total_a[u0])
        np.add.at(count_b, v1, -(total_a[u1] - total_a[u0]))
        wide = (u1 - u0 > 1) | (v1 - v0 > 1)
        join(u0, v0 + shift)
        for p, q, r, s in zip(u0[wide].tolist(), u1[wide].tolist(), v0[wide].tolist(), v1[wide].tolist(), strict=True):
            rows_u, rows_v = np.arange(p, q), np.arange(r, s) + shift
            join(np.full(len(rows_v), p), rows_v)
            join(rows_u, np.full(len(rows_u), r + shift))
    links_a, links_b = np.cumsum(count_a)[:-1], np.cumsum(count_b)[:-1]
    if same:
        links_a, links_b = links_a + links_b, np.zeros(0, dtype=np.int64)
    x = np.concatenate(tree_x) if tree_x else np.zeros(0, dtype=np.int64)
    y = np.concatenate(tree_y) if tree_y else np.zeros(0, dtype=np.int64)
    return links_a, links_b, x, y


# --- tables -------------------------------------------------------------------------------


def _unit(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal length scaled to length one, and which of them can be: not zero, all finite."""
    rows = values.reshape(len(starts) - 1, -1).astype(np.float64)
    with np.errstate(all="ignore"):
        largest = np.abs(rows).max(axis=1, initial=0.0)
        ok = np.isfinite(rows).all(axis=1) & (largest > 0)
        scaled = rows / np.where(ok, largest, 1.0)[:, None]
        return scaled / np.where(ok, np.sqrt((scaled * scaled).sum(axis=1)), 1.0)[:, None], ok


def unit_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, dim, unit, mark) of every row: the unit vector as bytes of doubles, and a hash of it; null where it links with nothing."""
    source = vectors.select(F.col(key), F.col(vector).cast("array<double>").alias("v"))
    key_type = dict(source.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            units: list[bytes | None] = [None] * batch.num_rows
            sizes = np.array([-1 if v is None else len(v) for v in column.to_pylist()], dtype=np.int64)
            flat = np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            starts = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
            for size in np.unique(sizes[sizes > 0]):
                which = np.flatnonzero(sizes == size)
                rows, ok = _unit(flat[starts[which][:, None] + np.arange(size)].ravel(), np.arange(len(which) + 1))
                for i, row, good in zip(which.tolist(), rows, ok.tolist(), strict=True):
                    units[i] = row.tobytes() if good else None
            marks = [None if u is None else xxhash.xxh3_128_digest(u) for u in units]
            dims = [None if u is None else len(u) // 8 for u in units]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(units, pa.binary()), pa.array(marks, pa.binary())], names=[key, "dim", "unit", "mark"])

    return map_arrow(source, run, f"`{key}` {key_type}, dim int, unit binary, mark binary")


def leaf_centres(sample: np.ndarray, share: float, most: float) -> np.ndarray:
    """Centres of the sample's nested nets, neighbours side by side: a node that stands for more than ``most`` vectors, ``share`` for each of its own, is cut further."""
    groups, radius = [np.arange(len(sample))], TOP_RADIUS
    points = sample.astype(np.float32)
    for _ in range(LEVELS):
        radius /= 2
        following = []
        for rows in groups:
            if len(rows) == 1 or len(rows) * share <= most:
                following.append(rows)
                continue
            centres, owner = net(points[rows], radius)
            for k, centre in enumerate(centres):
                part = np.flatnonzero(owner == k)
                following.append(rows[np.concatenate([[centre], part[part != centre]])])
        groups = following
    return sample[[rows[0] for rows in groups]]


def _cells(distinct: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``distinct`` with the cell of the nearest centre of its dimension and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            units = batch.column(2).to_pylist()
            cell, far = np.zeros(len(dims), dtype=np.int32), np.zeros(len(dims))
            for dim in np.unique(dims):
                which = np.flatnonzero(dims == dim)
                for at in range(0, len(which), STRIP):
                    rows = which[at : at + STRIP]
                    cosine = np.frombuffer(b"".join(units[i] for i in rows)).reshape(-1, dim) @ centres[dim].T
                    best = cosine.argmax(axis=1)
                    cell[rows], far[rows] = best, _distance(cosine[np.arange(len(rows)), best])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    return map_arrow(distinct, run, "rep long, dim int, unit binary, copies long, cell int, far double")


@dataclass
class Layout:
    """The cells of one dimension: covering radius (-inf: empty), and the first cell and number of parts of each block."""

    centres: np.ndarray
    far: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    shift: int  # number of the first block among those of all dimensions

    @staticmethod
    def of(centres: np.ndarray, count: np.ndarray, far: np.ndarray, block: int, shift: int) -> Layout:
        first, held = [0], 0
        for cell, n in enumerate(count.tolist()):
            if held and held + n > block:
                first.append(cell)
                held = 0
            held += n
        total = np.add.reduceat(count, first)
        return Layout(centres, far, np.array(first), np.maximum(1, -(-total // block)), shift)

    def meetings(self, units: np.ndarray, reps: np.ndarray, cell: np.ndarray, reach: float) -> tuple[np.ndarray, ...]:
        """For each row and pair of block parts it goes to: row, first block and part, second block and part, side."""
        cosine = units @ self.centres.T
        own = np.searchsorted(self.first, cell, side="right") - 1
        near = _distance(cosine) <= reach + self.far[None, :] + SLACK
        # Whatever lies in another cell is on the far side of the border half-way between the centres.
        near &= cosine[np.arange(len(cell)), cell][:, None] - cosine <= (reach + SLACK) * _distance(self.centres[cell] @ self.centres.T) + SLACK
        near[np.arange(len(cell)), cell] = True
        row, other = np.nonzero(np.logical_or.reduceat(near, self.first, axis=1))
        n = self.parts[other]
        row, other = np.repeat(row, n), np.repeat(other, n)
        part = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        mine, mine_part = own[row], (reps % self.parts[own])[row]
        side = (other < mine) | ((other == mine) & (part < mine_part))
        pick = lambda x, y: np.where(side, x, y).astype(np.int32)
        return row, pick(other, mine) + np.int32(self.shift), pick(part, mine_part), pick(mine, other) + np.int32(self.shift), pick(mine_part, part), side


def _meetings(placed: DataFrame, layouts: dict[int, Layout], reach: float) -> DataFrame:
    """One row per vector and pair of block parts that it goes to."""
    pair = ("a", "part_a", "b", "part_b", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                which = np.flatnonzero(dims == dim)
                for at in range(0, len(which), STRIP):
                    some = batch.take(pa.array(which[at : at + STRIP]))
                    units = np.frombuffer(b"".join(some.column(2).to_pylist())).reshape(-1, dim)
                    row, *found = layouts[dim].meetings(units, some.column(0).to_numpy(), some.column(4).to_numpy(), reach)
                    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=some.num_rows))]).astype(np.int32)
                    met = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(f) for f in found], names=list(pair)))
                    yield pa.RecordBatch.from_arrays([*some.columns[:4], met], names=[*some.schema.names[:4], "met"])

    listed = map_arrow(placed, run, "rep long, dim int, unit binary, copies long, met array<struct<a:int, part_a:int, b:int, part_b:int, side:boolean>>")
    return listed.select("rep", "dim", "unit", "copies", F.explode("met").alias("met")).select(*[F.col(f"met.{c}") for c in pair], "rep", "dim", "unit", "copies")


def vector_meetings(distinct: DataFrame, least: float, sample: int = 4096, block: int = 6000) -> DataFrame | None:
    """The vectors of (rep, dim, unit, copies) with the pairs of block parts they go to; without vectors None.

    The sample is shared by the vector lengths; each gets one row at least.
    """
    dims = {r["dim"]: r["n"] for r in distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").limit(1001).collect()}
    if len(dims) > 1000:
        raise ValueError("more than 1000 different vector lengths")
    if not dims:
        return None
    centres = {}
    for dim, n in dims.items():
        most = max(1, sample * n // sum(dims.values()))
        rows = least_by_hash(distinct.where(F.col("dim") == dim).select("unit"), F.xxhash64("unit"), n, most)
        units = np.stack([np.frombuffer(r["unit"]) for r in rows])
        centres[dim] = leaf_centres(units, n / len(units), block / CELLS)
    placed = staged(_cells(distinct, centres), "cells")
    count, far = {d: np.zeros(len(c), dtype=np.int64) for d, c in centres.items()}, {d: np.full(len(c), -np.inf) for d, c in centres.items()}
    for r in placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():  # no more than the sample
        count[r["dim"]][r["cell"]], far[r["dim"]][r["cell"]] = r["n"], r["far"]
    layouts, shift = {}, 0
    for dim in dims:
        layouts[dim] = Layout.of(centres[dim], count[dim], far[dim], block, shift)
        shift += len(layouts[dim].first)
    return _meetings(placed, layouts, float(np.sqrt(2 - 2 * least)))


def _pair_links(meetings: DataFrame, least: float) -> DataFrame:
    """Link counts (id, n) and spanning links (id, other) of the vectors that meet; the rows of a pair follow each other, the first side first."""

    def links(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        dim, middle = held[0][6], sum(not h[4] for h in held)
        same = held[0][0:2] == held[0][2:4]
        if not middle or (not same and middle == len(held)):
            return

        def side(rows: list[tuple]) -> tuple[Tree, np.ndarray, np.ndarray, np.ndarray]:
            units = np.frombuffer(b"".join(h[7] for h in rows)).reshape(-1, dim)
            tree = grow(units.astype(np.float32))
            return tree, units[tree.order], np.array([h[8] for h in rows])[tree.order], np.array([h[5] for h in rows])[tree.order]

        a, exact_a, copies_a, ids = side(held[:middle])
        if same:
            n, _, x, y = traverse(a, a, exact_a, exact_a, copies_a, copies_a, least, True)
        else:
            b, exact_b, copies_b, other = side(held[middle:])
            links_a, links_b, x, y = traverse(a, b, exact_a, exact_b, copies_a, copies_b, least, False)
            ids, n = np.concatenate([ids, other]), np.concatenate([links_a, links_b])
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.nulls(len(some), pa.int64()), pa.array(n[some])], names=["id", "other", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y]), pa.nulls(len(x), pa.int64())], names=["id", "other", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:4] != held[0][:4]:
                    yield from links(held)
                    held = []
                held.append(row)
        if held:
            yield from links(held)

    key = ["a", "part_a", "b", "part_b"]
    dealt = meetings.repartition(*key).sortWithinPartitions(*key, "side", "rep")
    return map_arrow(dealt.select(*key, "side", "rep", "dim", "unit", "copies"), run, "id long, other long, n long")


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding", sample: int = 4096, block: int = 6000) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept.

    Two rows are linked if the cosine of their vectors is at least ``least``; rows with equal
    vectors are linked, too. Vectors of different lengths, and those that are null, zero or hold
    null or non-finite components, link with nothing and keep themselves. Keys are numbers and
    name rows; rows that share a key and a vector are copies of each other. A row with a null key
    is left out of components but counted; no rows: no rows. Other columns are not read.
    """
    if not 0 < least <= 1:
        raise ValueError("the cosine must be above 0")
    spark = vectors.sparkSession
    marked = staged(unit_vectors(vectors, key, vector), "unit-vectors")
    valid = marked.where("mark is not null")
    folded = valid.groupBy("mark").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit"), F.first("dim").alias("dim"))
    # Nodes are numbered by a hash of the vector, so rows without a key have one, too.
    folded = staged(folded.withColumn("rep", F.xxhash64("mark")), "distinct-vectors")
    meetings = vector_meetings(folded.select("rep", "dim", "unit", "copies"), least, sample, block)
    found = staged(_pair_links(meetings, least), "vector-links") if meetings else spark.createDataFrame([], "id long, other long, n long")
    counted = found.where("other is null").groupBy("id").agg(F.sum("n").alias("n"))
    components = connected_components(found.where("other is not null"), "id", "other")
    named = folded.select("mark", "rep", "first", "copies").join(counted.withColumnRenamed("id", "rep"), "rep", "left").join(components.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    # Written before it is joined back: then a hot component can be split over tasks.
    smallest = staged(named.groupBy("component").agg(F.min("first").alias("component_id")), "components")
    per_vector = named.join(smallest, "component").select("mark", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    joined = marked.select(key, "mark").join(per_vector, "mark", "left")
    component = F.coalesce("component_id", key).cast("long")
    return joined.select(key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col(key) == component, F.lit(False)).alias("kept"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(node, start) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT links.b, reach.start FROM reach JOIN links ON links.a = reach.node)
SELECT vec_id, coalesce(k, 0) AS n_links, least_one AS component_id, vec_id = least_one AS kept
FROM embeddings JOIN (SELECT node, min(start) AS least_one FROM reach GROUP BY node) ON node = vec_id
LEFT JOIN (SELECT a, count(*) AS k FROM links GROUP BY a) ON a = vec_id
"""
