"""Embedding near-dedup by a subspace pigeonhole join: finds every pair of vectors with a cosine at or above a limit.

Unit vectors with cosine c are 2 - 2c apart in squared distance. They are rotated (to the principal axes of a sample;
any rotation is right) and split into BLOCKS blocks; a pair within the limit is within its proportional share of that
squared distance in one block at least. (More and smaller blocks let through far more pairs that are near by chance in
one of them: at 64 dimensions and 0.95 some 0.5 % of random pairs in a block of 4, one in 10^8 in a block of 16.)

Each block is range-joined on a grid over its first GRID axes, with cells twice the radius wide, so that partners are in
the same cell or in neighbours. A vector stands in its own cell and, by a bit for each axis, in those below it that it is
near to; a pair is compared in the one cell that is the lesser of theirs on every axis, which is where the two share no
bit. Within a cell vectors are sorted on the next axis and compared in tiles. Cells are cut into chunks, so that no task
holds more than two chunks however full a cell is. Candidates are verified on whole vectors in double precision; a pair
counts in the first block that admits it. All ways to a pair use one routine for its distances, on coordinates that
were computed once, wherever a tile's faster sum is too near to a limit to tell.

A vector with more than DENSE candidates in a task is not listed with them: such groups are verified inside a task,
which returns numbers of links and one edge for each vector. Equal vectors are one class throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm.graph import components
from fernglass.llm.shared import discard, pick, stash

LEAST = 0.95
BLOCKS = 4
#: Axes of a block that the grid divides.
GRID = 3
#: Vectors of a chunk, and rows of a tile.
CHUNK, TILE = 6_000, 512
DENSE = 64
#: Vectors from which the rotation is fitted, about.
SAMPLE = 20_000
#: Room for rounding: of squared block distances in single precision, and of the shares in double.
SLACK, TINY = 1e-4, 1e-12
#: How near to a limit a tile's sum in double precision is decided by squares() or products() instead.
UNSURE = 1e-9


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units, dims = [], []
        for values in batch.column("embedding").to_pylist():
            unit = None
            if values and None not in values:
                x = np.array(values, np.float64)
                if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                    x = x / top
                    unit = (x / math.sqrt(float(x @ x))).tobytes()
            units.append(unit)
            dims.append(len(values) if unit is not None else None)
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], names=["row", "vec_id", "dim", "unit"])


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, added up axis by axis: the same bits in whatever company a pair is computed."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        d = a[:, k] - b[:, k]
        out += d * d
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, in the same way."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


class Space:
    """The rotation and the blocks of vectors of one length, and what a pair within the limit may be apart in each."""

    def __init__(self, dim: int, sample: np.ndarray, least: float):
        self.least = least
        count = min(BLOCKS, dim)
        _, axes = np.linalg.eigh(sample.T @ sample + 1e-9 * np.eye(dim))
        axes = axes[:, ::-1]  # by falling variance, dealt out to the blocks in turn
        order = [i for b in range(count) for i in range(b, dim, count)]
        self.axes = np.ascontiguousarray(axes[:, order])
        sizes = [len(range(b, dim, count)) for b in range(count)]
        ends = np.cumsum(sizes)
        self.blocks = [slice(int(e - s), int(e)) for s, e in zip(sizes, ends)]
        self.shares = [max(0.0, 2 - 2 * least) * s / dim + TINY for s in sizes]
        self.radii = [math.sqrt(s + SLACK) for s in self.shares]
        self.grid = [min(GRID, s) for s in sizes]

    def rotate(self, units: np.ndarray) -> np.ndarray:
        return units @ self.axes

    def admits(self, a: np.ndarray, b: np.ndarray, block: int) -> np.ndarray:
        """Whether this is the first block that admits each pair (row of a, row of b)."""
        out = np.ones(len(a), bool)
        for k in range(block + 1):
            near = squares(a[:, self.blocks[k]], b[:, self.blocks[k]]) <= self.shares[k]
            out &= near if k == block else ~near
        return out

    def links(self, near: np.ndarray, ua: np.ndarray, ub: np.ndarray, ra: np.ndarray, rb: np.ndarray, block: int) -> np.ndarray:
        """Of a tile's candidates, those that link and have this as their first block."""
        sims = ua @ ub.T
        i, j = np.nonzero(near & (np.abs(sims - self.least) <= UNSURE))
        sims[i, j] = products(ua[i], ub[j])
        near = near & (sims >= self.least)
        for k in range(block + 1):
            x, y = ra[:, self.blocks[k]], rb[:, self.blocks[k]]
            d = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y)[None, :] - 2 * (x @ y.T)
            i, j = np.nonzero(near & (np.abs(d - self.shares[k]) <= UNSURE))
            d[i, j] = squares(x[i], y[j])
            near = near & (d <= self.shares[k] if k == block else d > self.shares[k])
        return near


def _stack(column, kind=np.float64) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1) if rows else np.zeros((0, 1), kind)


def _packed(x: np.ndarray) -> pa.Array:
    """Rows of numbers as binary cells."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * width).astype(np.int32)), pa.py_buffer(x.tobytes())])


def _rotated(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("unit"), batch.column("copies"), _packed(space.rotate(_stack(batch.column("unit"))))], names=["node", "unit", "copies", "rotated"])

    return run


def _placed(space: Space):
    """Rows (block, cell, bits, node, x): each vector in its cell, and in those below that it is near to, by a bit for each axis."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            rotated = _stack(batch.column("rotated"))
            for b, part in enumerate(space.blocks):
                x = np.ascontiguousarray(rotated[:, part], np.float32)
                width, g = 2 * space.radii[b], space.grid[b]
                head = x[:, :g].astype(np.float64)
                cell = np.floor(head / width).astype(np.int64)
                upper = head - cell * width <= space.radii[b]
                for bits in range(1 << g):
                    on = np.array([bits >> k & 1 for k in range(g)], bool)
                    at = np.flatnonzero(upper[:, on].all(axis=1))
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), b, np.int32)), pa.array(_cell_key(cell[at] - on)), pa.array(np.full(len(at), bits, np.int32)), pa.array(node[at]), _packed(x[at])], names=["block", "cell", "bits", "node", "x"])

    return run


def _cell_key(cell: np.ndarray) -> np.ndarray:
    """A cell of up to three axes as one number; coordinates of unit vectors are within 1 of 0, cells 0.02 wide at least."""
    out = np.zeros(len(cell), np.int64)
    for k in range(cell.shape[1]):
        out = (out << 12) + cell[:, k] + 2048
    return out


PLACED = "block int, cell long, bits int, node long, x binary"


class Deal:
    """Numbers the tasks: each cell's chunks against each other, (lo, hi) as lo x chunks + hi.

    counts: (block, cell) -> vectors there and the bits that all of them share, which leave no pair to compare.
    """

    def __init__(self, counts: dict[tuple[int, int], tuple[int, int]]):
        cells, at = [], 0
        for (block, cell), (n, shared) in sorted(counts.items()):
            if n > 1 and not shared:
                h = -(-n // CHUNK)
                cells.append((cell * BLOCKS + block, at, h, block))
                at += h * h
        self.keys, self.at, self.chunks, self.block_of = (np.array(c, np.int64) for c in zip(*sorted(cells))) if cells else (np.zeros(0, np.int64),) * 4
        order = np.argsort(self.at)
        self.firsts, self.blocks = self.at[order], self.block_of[order]

    def block(self, task: int) -> int:
        return int(self.blocks[np.searchsorted(self.firsts, task, "right") - 1])

    def tasks_of(self, block: np.ndarray, cell: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, task, side): each row in every task that needs it; side 1 are the rows of a pair's second chunk."""
        if not len(self.keys):
            return (np.zeros(0, np.int64),) * 3
        key = cell * BLOCKS + block
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rows = np.flatnonzero(self.keys[place] == key)
        place = place[rows]
        h = self.chunks[place]
        with np.errstate(over="ignore"):
            chunk = ((node[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % h
        rows, place, chunk, each = (np.repeat(v, h) for v in (rows, place, chunk, h))
        other = np.arange(len(rows)) - np.repeat(np.cumsum(h) - h, h)
        task = self.at[place] + np.minimum(chunk, other) * each + np.maximum(chunk, other)
        return rows, task, (other < chunk).astype(np.int64)


def _dealt(deal: Deal):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, task, side = deal.tasks_of(*(batch.column(c).to_numpy().astype(np.int64) for c in ("block", "cell", "node")))
            for i in range(0, len(rows), 20_000):
                part = batch.take(pa.array(rows[i : i + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(task[i : i + 20_000]), pa.array(side[i : i + 20_000].astype(np.int32)), part.column("bits"), part.column("node"), part.column("x")], names=["task", "side", "bits", "node", "x"])

    return run


def _tiles(a: np.ndarray, b: np.ndarray, radius: float, same: bool) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(a from, a to, b from, b to, squared distances) of tiles that may hold partners; both are sorted on one axis."""
    axis = min(GRID, a.shape[1] - 1)
    aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    for lo in range(0, len(a), TILE):
        hi = min(lo + TILE, len(a))
        first = np.searchsorted(b[:, axis], a[lo, axis] - radius, "left")
        last = np.searchsorted(b[:, axis], a[hi - 1, axis] + radius, "right")
        first = max(first, lo) if same else first
        for p in range(first, last, 8 * TILE):
            q = min(p + 8 * TILE, last)
            d = a[lo:hi] @ b[p:q].T
            d *= -2
            d += aa[lo:hi, None]
            d += bb[None, p:q]
            yield lo, hi, p, q, d


def _sides(table: pa.Table, extra: list[str]) -> tuple[list, list, bool]:
    """Both sides of a task, each (node, x, bits, *extra) sorted on an axis; whether there is one side only."""
    side = table.column("side").to_numpy()
    x = _stack(table.column("x"), np.float32)
    cols = [table.column("node").to_numpy(), x, table.column("bits").to_numpy(), *(_stack(table.column(c)) if c in ("unit", "rotated") else table.column(c).to_numpy() for c in extra)]
    out = []
    for s in (0, 1):
        at = np.flatnonzero(side == s)
        at = at[np.lexsort((cols[0][at], x[at, min(GRID, x.shape[1] - 1)]))]
        out.append([c[at] for c in cols])
    same = not len(out[1][0])
    return out[0], out[0] if same else out[1], same


def _mask(d: np.ndarray, limit: float, lo: int, p: int, same: bool, bits_a: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """The tile's candidates: near enough, without a bit in common, and each pair of one side once."""
    near = d <= limit
    near &= (bits_a[lo : lo + d.shape[0], None] & bits_b[None, p : p + d.shape[1]]) == 0
    if same and p < lo + d.shape[0]:
        near &= (np.arange(lo, lo + d.shape[0])[:, None]) < (np.arange(p, p + d.shape[1])[None, :])
    return near


def _candidates(space: Space, deal: Deal):
    """Of a task: listed pairs (task, a, b, null), and the vectors of dense groups (task, null, null, node, dense)."""

    def run(table: pa.Table) -> pa.Table:
        task = table.column("task")[0].as_py()
        block = deal.block(task)
        (na, xa, ba), (nb, xb, bb_), same = _sides(table, [])
        limit, radius = space.shares[block] + SLACK, space.radii[block]
        ca, cb = np.zeros(len(na), np.int64), np.zeros(len(nb), np.int64)
        kept, large = [], []
        for lo, hi, p, q, d in _tiles(xa, xb, radius, same):
            near = _mask(d, limit, lo, p, same, ba, bb_)
            if not (total := int(np.count_nonzero(near))):
                continue
            ca[lo:hi] += near.sum(axis=1)
            cb[p:q] += near.sum(axis=0)
            if total <= 4 * TILE:
                i, j = np.nonzero(near)
                kept.append((i + lo, j + p))
            else:
                large.append((lo, hi, p, q))
        if same:
            ca = cb = ca + cb
        da, db = ca > DENSE, cb > DENSE
        partner_a, partner_b = np.zeros(len(na), bool), np.zeros(len(nb), bool)
        aa, bb = np.einsum("ij,ij->i", xa, xa), np.einsum("ij,ij->i", xb, xb)
        for lo, hi, p, q in large:
            d = aa[lo:hi, None] + bb[None, p:q] - 2 * (xa[lo:hi] @ xb[p:q].T)
            near = _mask(d, limit, lo, p, same, ba, bb_)
            dense = near & (da[lo:hi, None] | db[None, p:q])
            partner_a[lo:hi] |= dense.any(axis=1)
            partner_b[p:q] |= dense.any(axis=0)
            i, j = np.nonzero(near & ~dense)
            kept.append((i + lo, j + p))
        i, j = (np.concatenate([k[s] for k in kept]) if kept else np.zeros(0, np.int64) for s in (0, 1))
        dense = da[i] | db[j]
        partner_a[i[dense]] = True
        partner_b[j[dense]] = True
        i, j = i[~dense], j[~dense]
        flags = {}
        for nodes, partner, full in ((na, partner_a, da), (nb, partner_b, db)):
            for n, f in zip(nodes[partner].tolist(), full[partner].tolist()):
                flags[n] = flags.get(n, False) or f
        m = len(i)
        return pa.table({
            "task": pa.array([task] * (m + len(flags)), pa.int64()),
            "block": pa.array([block] * (m + len(flags)), pa.int32()),
            "a": pa.array(na[i].tolist() + [None] * len(flags), pa.int64()),
            "b": pa.array(nb[j].tolist() + [None] * len(flags), pa.int64()),
            "node": pa.array([None] * m + list(flags), pa.int64()),
            "dense": pa.array([None] * m + list(flags.values()), pa.bool_()),
        })

    return run


CANDIDATES = "task long, block int, a long, b long, node long, dense boolean"


def _verified(space: Space):
    """Of listed pairs, those that link, in the first block that admits them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = products(_stack(batch.column("unit_a")), _stack(batch.column("unit_b"))) >= space.least
            a, b = _stack(batch.column("rotated_a")), _stack(batch.column("rotated_b"))
            block = batch.column("block").to_numpy()
            for k in range(len(space.blocks)):
                own = np.flatnonzero(block == k)
                keep[own] &= space.admits(a[own], b[own], k)
            yield batch.select(["a", "b", "copies_a", "copies_b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _dense_links(space: Space, deal: Deal):
    """Of a task's dense groups: for each vector its number of links there, and the least one it is joined to."""

    def run(table: pa.Table) -> pa.Table:
        block = deal.block(table.column("task")[0].as_py())
        a, b, same = _sides(table, ["unit", "rotated", "copies", "dense"])
        limit = space.shares[block] + SLACK
        la, lb = np.zeros(len(a[0]), np.int64), np.zeros(len(b[0]), np.int64)
        root_a, root_b = a[0].copy(), (a[0] if same else b[0]).copy()
        if same:
            root_b, lb = root_a, la
        masks = []
        for lo, hi, p, q, d in _tiles(a[1], b[1], space.radii[block], same):
            near = _mask(d, limit, lo, p, same, a[2], b[2])
            near &= a[6][lo:hi, None] | b[6][None, p:q]
            if not near.any():
                continue
            near = space.links(near, a[3][lo:hi], b[3][p:q], a[4][lo:hi], b[4][p:q], block)
            if near.any():
                la[lo:hi] += near @ b[5][p:q]
                lb[p:q] += a[5][lo:hi] @ near
                masks.append((lo, hi, p, q, np.packbits(near, axis=1), near.shape[1]))
        top = np.iinfo(np.int64).max
        changed = True
        while changed:  # least labels spread along the links of this task
            changed = False
            for lo, hi, p, q, packed, n in masks:
                near = np.unpackbits(packed, axis=1, count=n).astype(bool)
                for own, other, m in ((root_a[lo:hi], root_b[p:q], near), (root_b[p:q], root_a[lo:hi], near.T)):
                    low = np.minimum(own, np.where(m, other[None, :], top).min(axis=1))
                    if (low < own).any():
                        own[:] = low
                        changed = True
        nodes, links, roots = (a[0], la, root_a) if same else (np.concatenate([a[0], b[0]]), np.concatenate([la, lb]), np.concatenate([root_a, root_b]))
        some = links > 0
        return pa.table({"node": pa.array(nodes[some]), "links": pa.array(links[some]), "root": pa.array(roots[some])})

    return run


def _links(classes: DataFrame, dim: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Of classes (node, unit, copies) with vectors of one length: (node, links) parts, and edges (a, b)."""
    own = classes.where(F.col("dim") == dim).select("node", "unit", "copies")
    n = own.count()
    share = F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(1_000_003)) / 1_000_003
    sample = [r["unit"] for r in own.where(share < SAMPLE / max(n, 1)).select("unit").collect()]
    space = Space(dim, np.frombuffer(b"".join(sample), np.float64).reshape(len(sample), dim), least)
    own = stash(own.mapInArrow(_rotated(space), "node long, unit binary, copies long, rotated binary"), "rotated")
    placed = stash(own.select("node", "rotated").mapInArrow(_placed(space), PLACED), "placed")
    # At most BLOCKS x (2 / cell width + 3) ^ GRID rows, some thousands: the coordinates of unit vectors are within 1 of 0.
    cells = placed.groupBy("block", "cell").agg(F.count("*").alias("n"), F.expr("bit_and(bits)").alias("shared")).collect()
    deal = Deal({(r["block"], r["cell"]): (r["n"], r["shared"]) for r in cells})
    dealt = stash(placed.mapInArrow(_dealt(deal), "task long, side int, bits int, node long, x binary"), "dealt")
    discard(placed)
    found = stash(dealt.groupBy("task").applyInArrow(_candidates(space, deal), CANDIDATES), "candidates")
    side = lambda k: own.select(*[F.col(c).alias(k if c == "node" else f"{c}_{k}") for c in ("node", "unit", "copies", "rotated")])
    listed = found.where("a is not null").select("block", "a", "b").join(side("a"), "a").join(side("b"), "b")
    listed = stash(listed.select("block", "a", "b", "unit_a", "unit_b", "rotated_a", "rotated_b", "copies_a", "copies_b").mapInArrow(_verified(space), "a long, b long, copies_a long, copies_b long"), "listed")
    flagged = found.where("node is not null").select("task", "node", "dense")
    dense = dealt.join(flagged, ["task", "node"]).join(own, "node").select("task", "side", "bits", "node", "x", "unit", "rotated", "copies", "dense")
    dense = stash(dense.groupBy("task").applyInArrow(_dense_links(space, deal), "node long, links long, root long"), "dense")
    discard(dealt)
    parts = listed.select(F.col("a").alias("node"), F.col("copies_b").alias("links")).unionByName(listed.select(F.col("b").alias("node"), F.col("copies_a").alias("links"))).unionByName(dense.select("node", "links"))
    edges = listed.select("a", "b").unionByName(dense.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return parts, edges


def near_vectors(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per row of vectors: row, vec_id, n_links, component_id, first.

    n_links counts the other rows whose vector has a cosine of at least `least` with this one (which must be above 0);
    component_id is the smallest vec_id reachable by links, itself included, a null id last. first marks one row of
    each component. Vectors that are null, empty or zero, or hold null or non-finite components, and vectors of other
    lengths link with nothing. Rows that repeat are linked as equal vectors. Only vec_id and embedding are read; empty
    table: no rows. Lengths are handled one after the other: very many of them take as many jobs.
    """
    rows = pick(vectors, "vec_id", "embedding").select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    units = stash(rows.mapInArrow(_units, "row long, vec_id long, dim int, unit binary"), "units")
    classes = stash(units.where("unit is not null").groupBy("dim", "unit").agg(F.min("row").alias("node"), F.count("*").alias("copies")), "classes")
    parts = edges = None
    # Lengths with two different vectors at least; a table has one, or a few.
    for r in classes.groupBy("dim").count().where("count > 1").collect():
        p, e = _links(classes, r["dim"], least)
        parts, edges = (p, e) if parts is None else (parts.unionByName(p), edges.unionByName(e))
    nodes = classes.select("dim", "unit", "node", "copies")
    if parts is not None:
        nodes = nodes.join(parts.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(components(edges), "node", "left")
    else:
        nodes = nodes.withColumns({"links": F.lit(0).cast("long"), "component": F.lit(None).cast("long")})
    nodes = nodes.select("dim", "unit", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("group"))
    out = stash(units.join(nodes, ["dim", "unit"], "left").select("row", "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("group", "row").alias("group")), "grouped")
    best = out.groupBy("group").agg(F.min("vec_id").alias("component_id"), F.min(F.struct(F.col("vec_id").isNull(), "vec_id", "row")).alias("best"))
    best = stash(best.select("group", "component_id", F.col("best.row").alias("best")), "least")  # so that Spark can split the join
    return out.join(best, "group").select("row", "vec_id", "n_links", "component_id", (F.col("row") == F.col("best")).alias("first"))


def near_dedup(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept (vec_id = component_id; false for a null id) for each row; see near_vectors."""
    return near_vectors(vectors, least).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


SQL = """
with recursive v as (
  select vec_id, embedding::double[64] as e from embeddings
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and array_cosine_similarity(a.e, b.e) >= 0.95
), reach as (
  select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join links l on r.b = l.a
), comp as (
  select a, min(b) as component_id from reach group by a
), n as (
  select a, count(*) as n_links from links group by a
)
select v.vec_id, cast(coalesce(n.n_links, 0) as bigint) as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join comp c on c.a = v.vec_id left join n on n.a = v.vec_id
"""
