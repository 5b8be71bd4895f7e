"""Embedding near-duplicates: spherical k-means cells, vectors packed in blocks, cosine products of pairs of blocks.

Equal vectors are one class.  Spherical k-means is fitted on at most about ``FIT_ROWS`` classes, chosen by a hash; every
class is then assigned to its nearest cell (home).  It meets the classes of its cell, and those of every earlier cell that
can hold a vector it links with: a vector of cell k lies on k's side of the plane midway between the centroids of h and k,
so a vector of cell h with ``x (c_h - c_k) > sin(acos(threshold)) |c_h - c_k|`` is too far from all of them.

Each class is written once, in a block of at most about ``BLOCK`` rows: cells follow each other in the blocks, and a
crowded cell fills several.  A pair of blocks meets where the cells of one are reached from the other.  The pairs are a
product of the stored blocks with themselves: each task reads two pieces of the table, nothing is shuffled, so the disk
needed follows the number of vectors and not that of the pairs.  Products are taken in single precision first; what comes
near the threshold is decided by products of vectors normalised in double precision, and links at ``threshold`` or more.
A pair of blocks gives each vector its number of links and its component within the pair, never the links.

Every pair at ``threshold`` or more is found, once; the cells only save comparisons, and where vectors are spread evenly
few are saved: the comparisons, though not the disk, then grow with the square of the table.  Only vectors of one
length are compared.  Vectors that are null, empty, zero or hold a null or non-finite component link with nothing,
nor do rows without id.  Rows that repeat an id are one node of the components; each counts as a vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import components, free_memory, stored

FIT_ROWS, PER_CELL, MOST_CELLS = 20_000, 400, 2048
# rows and bytes of a block; a small table is cut in about FEW blocks of LEAST rows or more, so that there are tasks enough
BLOCK, BLOCK_BYTES, FEW, LEAST = 4096, 4 << 20, 64, 512
TILE = 512  # vectors of a cell that are compared at once


def normalised(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Unit centroids of unit vectors; an empty cell takes the vector worst served."""
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        best, cos = np.zeros(len(x), np.int64), np.zeros(len(x))
        for a in range(0, len(x), 4096):
            p = x[a : a + 4096] @ c.T
            best[a : a + 4096], cos[a : a + 4096] = p.argmax(1), p.max(1)
        sums = np.zeros_like(c)
        np.add.at(sums, best, x)
        size = np.sqrt((sums * sums).sum(1))
        for i, j in zip(np.nonzero(size < 1e-9)[0], np.argsort(cos), strict=False):
            sums[i], size[i] = x[j], 1.0
        c = sums / size[:, None]
    return c


def fit(classes: DataFrame, seed: int = 0) -> dict[int, np.ndarray]:
    """Centroids for each length of vector, on a bounded sample of the classes (h1, dim, embedding)."""
    size = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}  # one row a vector length
    n = sum(size.values())
    if not n:
        return {}
    u = F.pmod(F.xxhash64("h1", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    got: dict[int, list] = {}
    for r in classes.where(u < min(1.0, FIT_ROWS / n)).select("dim", "embedding").orderBy("h1").collect():
        got.setdefault(r["dim"], []).append(r["embedding"])
    cells = {d: max(1, min(MOST_CELLS, c // PER_CELL)) for d, c in size.items()}
    return {d: spherical_kmeans(normalised(np.array(v)), cells[d], seed=seed) for d, v in got.items()}


# more than the rounding of the products below, so that no cell is missed by it
SLACK = 1e-7


def near(x: np.ndarray, home: np.ndarray, c: np.ndarray, cells: np.ndarray, threshold: float) -> np.ndarray:
    """For every unit vector and each of the cells, whether the cell can hold a vector at ``threshold`` or more."""
    own = np.einsum("ij,ij->i", x, c[home])[:, None]
    apart = np.sqrt(np.maximum(2 - 2 * (c @ c[cells].T), 0))
    far = np.sqrt(1 - min(threshold, 1.0) ** 2)
    return (own - x @ c[cells].T <= far * apart[home] + SLACK) | (threshold <= 0)


def reached(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home cell of every unit vector, and the cells before it that can hold a vector at ``threshold`` or more."""
    home = (x @ c.T).argmax(1)
    every = np.arange(len(c))
    return home, [np.nonzero(row)[0] for row in near(x, home, c, every, threshold) & (every < home[:, None])]


def _wide(blob: bytes, n: int, dim: int) -> np.ndarray:
    """n packed vectors in double precision."""
    return np.frombuffer(blob, np.float32 if len(blob) == 4 * n * dim else np.float64).astype(np.float64).reshape(n, dim)


def _packed(x: np.ndarray) -> np.ndarray:
    """In single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return short if (short == x).all() else x


HOMES = "dim int, cell int, id long, mult long, vec binary"
BLOCKS = "dim int, block long, cells array<int>, reach array<int>, at binary, id binary, mult binary, vec binary"


def homes(classes: DataFrame, sent) -> DataFrame:
    """The home cell of each class (id, mult, dim, embedding); ``sent`` are the broadcast centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b["dim"].to_numpy()
            ids, mult, every = b["id"].to_numpy(), b["mult"].to_numpy(), b["embedding"]
            for d in np.unique(dims):
                at = np.nonzero(dims == d)[0]
                x = every.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)
                c = sent.value.get(int(d))
                home = (normalised(x) @ c.T).argmax(1) if c is not None else np.zeros(len(at), int)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), d, np.int32)), pa.array(home.astype(np.int32)), pa.array(ids[at]), pa.array(mult[at]),
                    pa.array([v.tobytes() for v in _packed(x)], pa.binary()),
                ], ["dim", "cell", "id", "mult", "vec"])

    return classes.select("id", "mult", "dim", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, HOMES)


def _packer(sent, threshold: float):
    def pack(t: pa.Table) -> pa.Table:
        dim = t["dim"][0].as_py()
        home, ids = t["cell"].to_numpy(), t["id"].to_numpy()
        by = np.lexsort((ids, home))
        home, x = home[by], np.concatenate([_wide(v, 1, dim) for v in t["vec"].to_pylist()])[by]
        cells, c = np.unique(home), sent.value.get(dim)
        reach = cells
        if c is not None:
            every = np.arange(len(c))
            for a in range(0, len(x), 1024):
                h = home[a : a + 1024]
                seen = (near(normalised(x[a : a + 1024]), h, c, every, threshold) & (every < h[:, None])).any(0)
                reach = np.union1d(reach, every[seen])
        return pa.table([
            pa.array([dim], pa.int32()), pa.array([t["block"][0].as_py()]), pa.array([cells], pa.list_(pa.int32())), pa.array([reach.astype(np.int32)], pa.list_(pa.int32())),
            *[pa.array([v.tobytes()], pa.binary()) for v in (home.astype(np.int32), ids[by], t["mult"].to_numpy()[by], _packed(x))],
        ], names=["dim", "block", "cells", "reach", "at", "id", "mult", "vec"])

    return pack


def blocks(classes: DataFrame, sent, threshold: float) -> DataFrame:
    """All classes, once each, in blocks: their cells, the cells reached from them, and their rows by cell."""
    rows = homes(classes, sent)
    before = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    count, total = F.col("count"), F.sum("count").over(Window.partitionBy("dim"))
    size = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.greatest(F.lit(LEAST), F.ceil(total / FEW)), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim")))))
    sizes = rows.groupBy("dim", "cell").count().select("dim", "cell", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"), size.alias("size"))
    rows = rows.join(F.broadcast(sizes), ["dim", "cell"])  # at most MOST_CELLS rows a length
    block = F.floor((F.col("start") + F.pmod(F.xxhash64("id"), count)) / F.col("size")).alias("block")
    return rows.select(*[f.split()[0] for f in HOMES.split(", ")], block).groupBy("dim", "block").applyInArrow(_packer(sent, threshold), BLOCKS)


def _labels(r: np.ndarray, c: np.ndarray, row_ids: np.ndarray, col_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id connected with each row and column by the entries (r, c)."""
    a, b = row_ids.copy(), col_ids.copy()
    while True:
        low = np.minimum(a[r], b[c])
        np.minimum.at(a, r, low)
        np.minimum.at(b, c, low)
        if (a[r] == b[c]).all():
            return a, b


def linked(a: np.ndarray, b: np.ndarray, a4: np.ndarray, b4: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the unit vectors of a and b with a product of ``threshold`` or more; a4 and b4 are their short forms."""
    p = a4 @ b4.T
    r, c = np.divmod(np.flatnonzero(p >= threshold - 1e-6 - 2e-7 * a.shape[1]), len(b))  # beyond the rounding of short products
    if 64 * len(r) > p.size:
        return np.nonzero(a @ b.T >= threshold)
    sure = np.einsum("ij,ij->i", a[r], b[c]) >= threshold
    return r[sure], c[sure]


def met(one: dict, two: dict, c: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, links, lows) of the vectors of two blocks, or of one block given twice, that link within them."""
    same = one["block"] == two["block"]
    if one["block"] < two["block"]:  # the later one visits the cells of the earlier
        one, two = two, one
    
    def rows(block):
        at, ids, mult = (np.frombuffer(block[k], t) for k, t in (("at", np.int32), ("id", np.int64), ("mult", np.int64)))
        x = normalised(_wide(block["vec"], len(ids), block["dim"]))
        return at, ids, mult, x, x.astype(np.float32)

    home, ida, ma, a, a4 = rows(one)
    at, idb, mb, b, b4 = (home, ida, ma, a, a4) if same else rows(two)
    cells, starts = np.unique(at, return_index=True)
    meets = near(a, home, c, cells, threshold) if c is not None else np.ones((len(a), len(cells)), bool)
    na, nb, edges = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), []
    for k, (start, stop) in enumerate(zip(starts, [*starts[1:], len(b)], strict=True)):
        for s in range(start, stop, TILE):
            e, first = min(s + TILE, stop), s if same else 0
            who = np.nonzero(meets[first:, k])[0] + first
            if 4 * len(who) > 3 * (len(a) - first):
                who = slice(first, len(a))
            p, q = linked(a[who], b[s:e], a4[who], b4[s:e], threshold)
            p, q = (p + first if isinstance(who, slice) else who[p]), q + s
            if same:  # every pair once
                p, q = p[p > q], q[p > q]
            if not len(p):
                continue
            na += np.bincount(p, mb[q], len(a)).astype(np.int64)
            nb += np.bincount(q, ma[p], len(b)).astype(np.int64)
            la, lb = _labels(p, q - s, ida, idb[s:e])
            p, q = np.unique(p), np.unique(q)
            edges += [(ida[p], la[p]), (idb[q], lb[q - s])]
    if not edges:
        return (np.zeros(0, np.int64),) * 3
    node, low = (np.concatenate(x) for x in zip(*edges, strict=True))
    nodes, place = np.unique(np.concatenate([node, low]), return_inverse=True)
    u, v, every = place[: len(node)], place[len(node) :], np.arange(len(nodes))
    lows, _ = _labels(np.concatenate([u, every]), np.concatenate([v, every]), nodes, nodes)
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, np.searchsorted(nodes, ida[na > 0]), na[na > 0])
    np.add.at(links, np.searchsorted(nodes, idb[nb > 0]), nb[nb > 0])
    return nodes, links, lows


MET = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])


def compared(packed: DataFrame, sent, threshold: float) -> DataFrame:
    """(id, links, low) from every pair of the stored blocks that meets; the pairs are read, not shuffled."""
    one, two = (packed.select(*[F.col(c).alias(f"{c}_{n}") for c in packed.columns]) for n in (1, 2))
    i, j = F.col("block_1"), F.col("block_2")

    def reaches(later: int, earlier: int) -> Column:
        return F.arrays_overlap(f"reach_{later}", f"cells_{earlier}")

    once = (i == j) | ((i < j) == ((i + j) % 2 == 0))  # one of (i, j) and (j, i), so that tasks are alike
    pairs = one.join(two.hint("shuffle_replicate_nl"), (F.col("dim_1") == F.col("dim_2")) & once & F.when(i < j, reaches(2, 1)).otherwise(reaches(1, 2)))
    names = ("dim", "block", "at", "id", "mult", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(b.num_rows):
                left, right = ({k: b[f"{k}_{side}"][n].as_py() for k in names} for side in (1, 2))
                found = met(left, right, sent.value.get(left["dim"]), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], schema=MET)
            free_memory()

    return pairs.select(*[f"{k}_{side}" for side in (1, 2) for k in names]).mapInArrow(run, "id long, links long, low long")


def deduplicated(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding)."""
    e = F.col("embedding").cast("array<double>")
    usable = F.col("vec_id").isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce(usable, F.lit(False)).alias("usable"))
    rows = rows.withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64("embedding", F.lit(1))})
    good = rows.where("usable")
    reps = good.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("mult"))
    classes = good.select("h1", "h2", F.col("vec_id").alias("id"), F.size("embedding").alias("dim"), "embedding").join(reps, ["h1", "h2", "id"]).dropDuplicates(["h1", "h2"])
    classes = stored(classes)
    sent = classes.sparkSession.sparkContext.broadcast(fit(classes))
    found = stored(compared(stored(blocks(classes, sent, threshold)), sent, threshold))
    comps = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = reps.join(links, "id", "left").join(comps, F.col("id") == F.col("node"), "left").select(
        "h1", "h2", F.lit(True).alias("usable"), (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.select("vec_id", "h1", "h2", "usable").join(known, ["h1", "h2", "usable"], "left")
    comp = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(F.col("vec_id") == comp, F.lit(False)).alias("kept"))
