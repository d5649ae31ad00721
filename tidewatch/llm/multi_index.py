"""Near-duplicate embeddings by an inverted multi-index.

The halves of unit vectors have independent codebooks, whose product is a grid of cells; every
vector lies in one. For a query the entries of each half come in the order of a lower bound
of its distance to their Voronoi regions, and a multi-sequence traversal visits the product
cells nearest first, by the sum of the squared bounds, until the reach that the target recall
needs. The reach is calibrated: partners at exactly the least cosine, in random directions,
and the real pairs of a bounded sample must be reached at the target rate. A target of 1 takes
the greatest distance of a link as reach, which loses none. A pair in two cells is searched
from the cell that comes first, so it is met once.

Equal vectors of a label are one vector with a count. Neighbouring cells are packed into bins, a
vector is sent once to each bin it visits, and a bin with too many arrivals is cut into blocks
that are compared two by two. Tasks verify cosines in double precision by matrix products,
and return for each vector the number of its links and one link to the head of its part of the
bin, never a pair for each link. Components follow from these links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import stage_table
from tidewatch.llm.probminhash import components

LEAST, TARGET_RECALL = 0.93, 0.999
#: vectors (about) that codebooks and reach are fitted on; all vectors are indexed
SAMPLE = 16_384
#: of these, queries for the calibration
QUERIES = 4096
#: vectors of the largest label for one cell, on average, and most entries of a half
CELL_VECTORS, MOST_ENTRIES = 64, 256
#: arrivals in a bin before a new one begins; a single cell with more is cut into blocks
BIN = 4096
#: vectors multiplied with a cell at once
CHUNK = 1024
#: rows of the table of linked or repeated vectors that may be broadcast
BROADCAST_ROWS = 500_000


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; they hold a value other than 0."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def lloyd(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Distinct codebook entries of ``x`` (rows in an order that decides the start)."""
    book = np.unique(x[:k], axis=0)
    for _ in range(rounds):
        nearest = ((book**2).sum(axis=1) - 2 * x @ book.T).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, nearest, x)
        book = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], book)
    return np.unique(book, axis=0)


@dataclass
class MultiIndex:
    """Codebooks of the two halves and the reach of a traversal."""

    books: tuple[np.ndarray, np.ndarray]
    reach: float = 0.0

    def bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: the nearest entry of each row, and lower bounds (rows x entries) of its distance to the
        points that are nearer to another entry."""
        out, at = [], 0
        for book in self.books:
            part = x[:, at:at + book.shape[1]]
            at += book.shape[1]
            d = (book**2).sum(axis=1) - 2 * part @ book.T
            own = d.argmin(axis=1)
            apart = np.sqrt(np.maximum(((book[:, None] - book[None]) ** 2).sum(axis=2), 0.0))[own]
            more = d - d[np.arange(len(x)), own][:, None]
            out.append((own, np.divide(more, 2 * apart, out=np.zeros_like(more), where=apart > 0)))
        return out

    def cells(self, x: np.ndarray) -> np.ndarray:
        (a, _), (b, _) = self.bounds(x)
        return a * len(self.books[1]) + b

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cell of each row, and the traversal as (row, cell) pairs, a row's nearest cells first: its own one,
        and those after it within the reach."""
        (a, la), (b, lb) = self.bounds(x)
        wide = len(self.books[1])
        own = a * wide + b
        oa, ob = np.argsort(la, axis=1, kind="stable"), np.argsort(lb, axis=1, kind="stable")
        la, lb = np.take_along_axis(la, oa, axis=1) ** 2, np.take_along_axis(lb, ob, axis=1) ** 2
        far = self.reach**2 + 1e-9
        rows, cells, near = [], [], []
        for step in range(la.shape[1]):            # along the first sequence; the second one is followed to the reach
            on = np.flatnonzero(la[:, step] <= far)
            if not len(on):
                break
            r, s = np.nonzero(lb[on] <= far - la[on, step][:, None])
            rows.append(on[r])
            cells.append(oa[on[r], step] * wide + ob[on[r], s])
            near.append(la[on[r], step] + lb[on[r], s])
        row, cell, near = np.concatenate(rows), np.concatenate(cells), np.concatenate(near)
        keep = cell >= own[row]
        row, cell, near = row[keep], cell[keep], near[keep]
        order = np.lexsort((cell, near, row))
        return own, row[order], cell[order]

    def needed(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Reach at which each pair of rows is met, from the one whose cell comes first."""
        (ax, lax), (bx, lbx) = self.bounds(x)
        (ay, lay), (by, lby) = self.bounds(y)
        i = np.arange(len(x))
        of_x, of_y = lax[i, ay] ** 2 + lbx[i, by] ** 2, lay[i, ax] ** 2 + lby[i, bx] ** 2
        return np.sqrt(np.where((ax < ay) | ((ax == ay) & (bx <= by)), of_x, of_y))


def fit(sample: np.ndarray, labels: np.ndarray, entries: int, least: float = LEAST, target_recall: float = TARGET_RECALL) -> MultiIndex:
    """Codebooks and reach from unit vectors of a sample."""
    half = (sample.shape[1] + 1) // 2
    index = MultiIndex((lloyd(sample[:, :half], entries), lloyd(sample[:, half:], entries)))
    farthest = float(np.sqrt(max(0.0, 2 - 2 * least)))
    if target_recall >= 1:
        return MultiIndex(index.books, farthest)
    q = sample[:QUERIES]
    aside = np.random.default_rng(0).normal(size=q.shape)
    aside -= (aside * q).sum(axis=1, keepdims=True) * q
    norm = np.linalg.norm(aside, axis=1)
    q, aside = q[norm > 0], aside[norm > 0] / norm[norm > 0][:, None]
    needs = [index.needed(q, least * q + np.sqrt(1 - least**2) * aside)]
    real = []
    for start in range(0, min(QUERIES, len(sample)), CHUNK):
        rows = slice(start, min(start + CHUNK, QUERIES, len(sample)))
        i, j = np.nonzero((sample[rows] @ sample.T >= least) & (labels[rows][:, None] == labels[None]))
        i += start
        real.append(index.needed(sample[i[i != j]], sample[j[i != j]]))
    needs.append(np.concatenate(real) if real else np.zeros(0))
    reach = max((float(np.quantile(n, target_recall, method="higher")) for n in needs if len(n)), default=farthest)
    return MultiIndex(index.books, min(reach, farthest))


def packed(arrivals: np.ndarray, limit: int = BIN) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each cell (runs of neighbouring cells with at most ``limit`` arrivals, or one cell) and number of blocks of each bin."""
    bins, blocks, filled = np.zeros(len(arrivals), np.int32), [], 0
    for cell, n in enumerate(arrivals):
        if not blocks or (filled and filled + n > limit):
            blocks.append(1)
            filled = 0
        filled += int(n)
        bins[cell] = len(blocks) - 1
        blocks[-1] = max(1, -(-filled // limit))
    return bins, np.array(blocks, np.int32)


def _matrix(batch: pa.RecordBatch | pa.Table, dim: int) -> np.ndarray:
    col = batch.column("vec")
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return unit(col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))


def _visited(index: MultiIndex, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, row, cell = index.visits(_matrix(b, dim))
            yield pa.RecordBatch.from_arrays([b.column("label").take(pa.array(row)), pa.array(cell.astype(np.int32))], names=["label", "cell"])

    return run


_SENT = ["label", "k1", "k2", "none", "id", "copies", "vec"]


def _send(index: MultiIndex, dim: int, bins: np.ndarray, blocks: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each bin that a vector visits and, in a bin of several blocks, each pair of blocks with its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, row, cell = index.visits(_matrix(b, dim))
            order = np.lexsort((cell, bins[cell], row))
            row, cell = row[order], cell[order]
            starts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (bins[cell[1:]] != bins[cell[:-1]])])
            ends = np.r_[starts[1:], len(row)]
            to = bins[cell[starts]]
            keys = b.column("k1").to_numpy(zero_copy_only=False)
            block = (keys[row[starts]].view(np.uint64) % blocks[to].astype(np.uint64)).astype(np.int32)
            message = np.repeat(np.arange(len(starts)), blocks[to])
            other = (np.arange(len(message)) - np.repeat(np.cumsum(blocks[to]) - blocks[to], blocks[to])).astype(np.int32)
            who = row[starts][message]
            sizes = (ends - starts)[message]
            at = np.repeat(starts[message] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(cell[at].astype(np.int32)))
            mine = block[message]
            columns = [pa.array(to[message]), pa.array(np.minimum(mine, other)), pa.array(np.maximum(mine, other)), pa.array(mine), pa.array(own[who].astype(np.int32)), lists]
            taken = b.select(_SENT).take(pa.array(who))
            yield pa.RecordBatch.from_arrays([*columns, *taken.columns], names=["bin", "x", "y", "block", "own", "cells", *_SENT])

    return run


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make the sets of ``a`` and ``b`` one; a set is named by its least member."""
    while True:
        ra, rb = root[a], root[b]
        on = ra != rb
        if not on.any():
            return
        a, b, ra, rb = a[on], b[on], ra[on], rb[on]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root[:] = further


def _compare(least: float, dim: int) -> Callable[[pa.Table], pa.Table]:
    """Links within a bin, or between two blocks of it: their number for each vector, and the head of its set."""
    def run(t: pa.Table) -> pa.Table:
        x = _matrix(t, dim)
        number = lambda c: t.column(c).to_numpy()
        own, block, copies = number("own"), number("block"), number("copies")
        first, second = number("x")[0], number("y")[0]
        cells = t.column("cells").combine_chunks()
        row = np.repeat(np.arange(len(own)), np.diff(cells.offsets.to_numpy()))
        cell = cells.flatten().to_numpy()
        order = np.argsort(cell, kind="stable")
        row, cell = row[order], cell[order]
        count, root = np.zeros(len(own), np.int64), np.arange(len(own))

        def pairs(a: np.ndarray, b: np.ndarray, same: bool) -> None:
            for start in range(0, len(a), CHUNK):
                piece = a[start:start + CHUNK]
                hit = x[piece] @ x[b].T >= least
                if same:
                    hit &= np.arange(len(b))[None] > np.arange(start, start + len(piece))[:, None]
                i, j = np.nonzero(hit)
                if len(i):
                    i, j = piece[i], b[j]
                    np.add.at(count, i, copies[j])
                    np.add.at(count, j, copies[i])
                    _join(root, i, j)

        begins = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
        for start, end in zip(begins, np.r_[begins[1:], len(cell)], strict=True):
            here = row[start:end]
            inside = own[here] == cell[start]
            members, others = here[inside], here[~inside]
            if first == second:
                pairs(members, members, True)
                pairs(others, members, False)
            else:
                left, right = members[block[members] == first], members[block[members] == second]
                pairs(left, right, False)
                pairs(others[block[others] == first], right, False)
                pairs(others[block[others] == second], left, False)
        linked = np.flatnonzero(count)
        mine = t.select(["label", "k1", "k2", "none", "id", "copies"]).take(pa.array(linked))
        head = t.select(["k1", "k2", "none", "id"]).take(pa.array(root[linked])).rename_columns(["hk1", "hk2", "hnone", "hid"])
        out = mine.append_column("n", pa.array(count[linked]))
        for name in head.column_names:
            out = out.append_column(name, head.column(name))
        return out

    return run


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 least: float = LEAST, target_recall: float = TARGET_RECALL) -> DataFrame:
    """Links and components of the rows of ``vectors``, compared within a label by cosine >= ``least``.

    Returns ``id_col``, ``n_links`` (other rows linked directly), ``component_id`` (the least id
    reachable by links, its own included) and ``kept`` (id and component id are equal). A
    vector that is null, empty, zero, of another length than most, or that holds a null or
    non-finite component links with nothing, and neither does one whose label is null.
    Repeated rows are vectors of their own that link with each other; a null id comes after
    all others, so it names a component only if that has no other id; other columns are left
    out; an empty table gives an empty result.
    """
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    vec = F.col("vec")
    base = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    usable = F.col("label").isNotNull() & vec.isNotNull() & F.forall("vec", finite) & F.exists("vec", lambda v: v != 0)
    base = base.withColumn("size", F.when(F.coalesce(usable, F.lit(False)), F.size("vec")))
    base = base.withColumn("k1", F.when(F.col("size").isNotNull(), F.xxhash64("vec"))).withColumn("k2", F.when(F.col("size").isNotNull(), F.xxhash64(F.lit("copy"), "vec")))
    common = base.filter("size IS NOT NULL").groupBy("size").count().orderBy(F.desc("count"), "size").first()
    alone = base.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if common is None:
        return alone
    dim = common["size"]

    keys = ["label", "k1", "k2"]
    copies = base.filter(F.col("size") == dim).groupBy(*keys).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("head"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    every = stage_table(copies.select(*keys, "head.none", "head.id", "copies", "vec"), "vectors")
    sizes = every.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    entries = int(np.clip(round((sizes[0] / CELL_VECTORS) ** 0.5), 2, MOST_ENTRIES))
    share = min(1.0, SAMPLE / sizes[1])
    some = every.filter(F.pmod(F.xxhash64(F.lit("sample"), "k1", "k2"), F.lit(1 << 40)) < int(share * (1 << 40))).select("label", "k1", "k2", "vec")
    some = some.toArrow()
    order = np.lexsort((some.column("k2").to_numpy(), some.column("k1").to_numpy()))
    x = _matrix(some, dim)[order]
    labels = np.unique(np.array(some.column("label").to_pylist(), dtype=str), return_inverse=True)[1][order]
    index = fit(x, labels, entries, least, target_recall)

    cell = T.StructType([every.schema["label"], T.StructField("cell", T.IntegerType())])
    seen = every.select("label", "vec").mapInArrow(_visited(index, dim), cell).groupBy("label", "cell").count().groupBy("cell").agg(F.max("count").alias("n"))
    arrivals = np.zeros(len(index.books[0]) * len(index.books[1]), np.int64)
    for r in seen.collect():        # a row for each cell of the grid
        arrivals[r.cell] = r.n
    bins, blocks = packed(arrivals)

    fields = {f.name: f for f in every.schema}
    whole = lambda name, kind=T.IntegerType(): T.StructField(name, kind)
    message = T.StructType([whole("bin"), whole("x"), whole("y"), whole("block"), whole("own"), whole("cells", T.ArrayType(T.IntegerType())), *(fields[c] for c in _SENT)])
    heads = [T.StructField("h" + c, fields[c].dataType) for c in ("k1", "k2", "none", "id")]
    result = T.StructType([*(fields[c] for c in (*keys, "none", "id", "copies")), whole("n", T.LongType()), *heads])
    sent = every.select(*_SENT).mapInArrow(_send(index, dim, bins, blocks), message)
    links = stage_table(sent.groupBy("label", "bin", "x", "y").applyInArrow(_compare(least, dim), result), "links")

    node = lambda p: F.struct(F.col(p + "none").alias("none"), F.col(p + "id").alias("id"), "label", F.col(p + "k1").alias("k1"), F.col(p + "k2").alias("k2"))
    edges = links.select(node("").alias("a"), node("h").alias("b")).filter("a <> b").distinct()
    member = components(edges).select("c", F.col("to.id").alias("least_id"))
    touched = links.select(*keys, "none", "id", "copies", "n").unionByName(every.filter("copies > 1").select(*keys, "none", "id", "copies", F.lit(0).cast("long").alias("n")))
    touched = touched.groupBy(*keys, "none", "id", "copies").agg(F.sum("n").alias("n")).withColumn("c", node(""))
    touched = touched.join(member, "c", "left").select(*keys, (F.col("n") + F.col("copies") - 1).alias("n_links"), F.when(F.col("least_id").isNotNull(), F.col("least_id")).otherwise(F.col("id")).alias("least_id"))
    touched = stage_table(touched, "touched")
    if touched.count() <= BROADCAST_ROWS:
        touched = F.broadcast(touched)
    found = base.select("id", *(F.when(F.col("size") == dim, F.col(c)).alias(c) for c in keys)).join(touched, keys, "left")
    component = F.coalesce("least_id", "id")
    return found.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def oracle_sql(least: float = LEAST) -> str:
    """The registered query's result in DuckDB's SQL, by comparing all pairs of a label."""
    return f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS MATERIALIZED (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v),
link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= {least}),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN degree ON degree.a = vec_id LEFT JOIN least ON least.a = vec_id
"""
