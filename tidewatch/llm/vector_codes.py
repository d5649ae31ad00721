"""Vector compression by product quantisation with memoised grid cells.

Components become integers, vectors are cut into equal parts, and every part position has a
codebook of entries that Lloyd's rounds improve. Assigning a part to its nearest entry goes
through a grid: the part's coarse cell (its components divided by the cell's width) is
looked up in a memo; a new cell is entered with the entries that aren't dominated across
its box, i.e. whose least distance to the box is no larger than the smallest of all
entries' greatest distances. The nearest entry of any point of the box is among them, so
the part is compared exactly with these alone. Parts that share a cell (copies, near copies,
and most parts of a large table) share the entry.

A round is one pass over a written table of integers: tasks add up the parts of every entry
and send one row for each (position, entry); the sums of a round have as many rows as the
codebooks and go to the driver, nothing else does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import stage_table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: side of a grid cell, in integer units
CELL = 32
#: cells in a memo of one task and part position; a full memo starts anew, which changes no result
MEMO_CELLS = 65_536
#: larger integers are refused, as their squares could overflow
LARGEST = 1 << 26
#: pairs of a part and an entry that are compared at once
PAIRS = 1 << 18
#: rows of the table of label totals that may be broadcast
BROADCAST_ROWS = 1_000_000


class CellMemo:
    """Nearest entries of one codebook through a memo of grid cells."""

    def __init__(self, book: np.ndarray, width: int = CELL, limit: int = MEMO_CELLS):
        self.book, self.width, self.limit = book, width, limit
        self.place: dict[bytes, int] = {}
        self.masks = np.zeros((0, len(book)), bool)
        self.asked = self.entered = self.compared = 0

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, which entries can be nearest to one of the integer points in its box."""
        small = max(int(np.abs(cells).max(initial=0) + 1) * self.width, int(np.abs(self.book).max(initial=0)))
        kind = np.int32 if (2 * small) ** 2 * self.book.shape[1] < 2**31 else np.int64
        least, most = np.zeros((len(cells), len(self.book)), kind), np.zeros((len(cells), len(self.book)), kind)
        for d in range(self.book.shape[1]):
            steps, at = np.unique(cells[:, d], return_inverse=True)
            low = steps[:, None] * self.width
            high = low + self.width - 1
            e = self.book[None, :, d]
            gap = np.maximum(np.maximum(low - e, e - high), 0)
            far = np.maximum(np.abs(e - low), np.abs(high - e))
            least += (gap * gap).astype(kind)[at]
            most += (far * far).astype(kind)[at]
        return least <= most.min(axis=1, keepdims=True)

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """Mask (parts x entries) of the entries to compare with."""
        cells = np.floor_divide(parts, self.width)
        keys = np.ascontiguousarray(cells).view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
        distinct, first, at = np.unique(keys, return_index=True, return_inverse=True)
        names = [k.tobytes() for k in distinct]
        if len(self.place) + len(names) > self.limit:
            self.place, self.masks = {}, self.masks[:0]
        new = np.array([k for k, name in enumerate(names) if name not in self.place], np.int64)
        if len(new):
            self.place.update((names[k], len(self.masks) + j) for j, k in enumerate(new))
            self.masks = np.concatenate([self.masks, self.undominated(cells[first[new]])])
        self.asked, self.entered = self.asked + len(parts), self.entered + len(new)
        return self.masks[np.array([self.place[name] for name in names], np.int64)[at]]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower one of a tie) and its squared distance, for each part."""
        best, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        step = max(1, PAIRS // max(1, len(self.book)))
        for start in range(0, len(parts), step):
            piece = parts[start:start + step]
            row, entry = np.nonzero(self.candidates(piece))
            self.compared += len(row)
            off = piece[row] - self.book[entry]
            d = np.einsum("ij,ij->i", off, off)
            begins = np.searchsorted(row, np.arange(len(piece)))
            least = np.minimum.reduceat(d, begins)
            won = np.flatnonzero(d == least[row])
            won = won[np.unique(row[won], return_index=True)[1]]     # entries ascend within a row
            best[start:start + step], distance[start:start + step] = entry[won], least
        return best, distance


def _integers(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _sums(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums and counts of the parts of every entry, one row for each entry used in the partition."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [CellMemo(b) for b in books]
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            q = _integers(b, "q", parts * width)
            for p, memo in enumerate(memos):
                piece = q[:, p * width:(p + 1) * width]
                best, _ = memo.nearest(piece)
                count[p] += np.bincount(best, minlength=entries)
                np.add.at(total[p], best, piece)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), *(pa.array(total[part, entry, d]) for d in range(width))],
            names=["part", "entry", "n", *(f"s{d}" for d in range(width))])

    return run


def _codes(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [CellMemo(b) for b in books]
        for b in batches:
            q = _integers(b, "q", parts * width)
            found = [memo.nearest(q[:, p * width:(p + 1) * width]) for p, memo in enumerate(memos)]
            code = [bytes(c).hex() for c in np.stack([f[0] for f in found], axis=1).astype(np.uint8)]
            error = np.sum([f[1] for f in found], axis=0)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(code, pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    return run


def quantised(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """Written table (``id``, ``label``, ``q``) of the usable vectors as integers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    v = v.filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))

    def whole(x: Column) -> Column:
        y = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(y) <= LARGEST, y).otherwise(F.raise_error(F.lit("a component is too large for integer distances")).cast("long")).cast("int")

    return stage_table(v.select("id", "label", F.transform("v", whole).alias("q")), "integers")


def codebooks(q: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (positions x entries x components of a part) after Lloyd's rounds over all rows of ``q``.
    They start as the parts of the rows with the least ids, so a table of fewer rows has fewer entries."""
    width = dim // parts
    first = q.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    books = np.array([r.q for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    schema = "part int, entry int, n long, " + ", ".join(f"s{d} long" for d in range(width))
    for _ in range(rounds):
        sums = q.select("q").mapInArrow(_sums(books), schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(f"s{d}").alias(f"s{d}") for d in range(width)))
        for r in sums.collect():      # a row for each entry of the codebooks
            books[r.part, r.entry] = [r[f"s{d}"] // r.n for d in range(width)]
    return books


def digest(books: np.ndarray) -> str:
    """Lower-case SHA-256 of the entries' components by position, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Codes of the vectors and the codebooks they refer to.

    The frame has ``id``, ``label``, ``code`` (two hex digits for each part), ``error`` (squared
    distance to the entries) and ``label_error`` (its sum over the rows with that label, null
    labels together). Rows with a vector that is null, empty or holds a null or non-finite
    component are dropped, and so are vectors of another length than the row of the least id;
    repeated rows each get a row; other columns are left out; an empty table gives an empty
    frame and codebooks without entries. ``entries`` is 256 at most (two hex digits).
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits, so 1 to 256 entries")
    q = quantised(vectors, id_col, vec_col, label_col, scale)
    head = q.orderBy(F.col("id").asc_nulls_last(), "q").limit(1).collect()
    if not head:
        return q.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")), np.zeros((parts, 0, 0), np.int64)
    dim = len(head[0].q)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    q = q.filter(F.size("q") == dim)
    books = codebooks(q, dim, parts, entries, rounds)
    schema = T.StructType([q.schema["id"], q.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = stage_table(q.mapInArrow(_codes(books), schema), "codes")
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    totals = stage_table(totals, "label-errors")
    if totals.count() <= BROADCAST_ROWS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, dim: int = 64) -> str:
    """The registered query's result in DuckDB's SQL: every part against every entry in every round."""
    w = dim // parts
    steps = [f"""q AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
piece AS MATERIALIZED (SELECT vec_id, p, v[p * {w} + 1:p * {w} + {w}] AS x FROM q, range({parts}) t(p)),
b0 AS MATERIALIZED (SELECT p, (row_number() OVER (PARTITION BY p ORDER BY vec_id)) - 1 AS e, x AS c FROM piece
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT vec_id, p, x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
  SELECT vec_id, p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM piece JOIN b{k} USING (p)) GROUP BY vec_id, p, x)""")
        if k < rounds:
            steps.append(f"""b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM b{k} LEFT JOIN (
  SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS m FROM (
    SELECT p, e, i, CAST(sum(x[i]) AS DOUBLE) AS s, count(*) AS n FROM a{k}, range(1, {w + 1}) t(i) GROUP BY p, e, i) GROUP BY p, e) USING (p, e))""")
    return "WITH " + ",\n".join(steps) + f""",
r AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN q USING (vec_id) CROSS JOIN h
"""
