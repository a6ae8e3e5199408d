"""Product quantisation of vectors with integer arithmetic and Orchard's nearest-entry search.

Components become ``floor(4096 * x)``; vectors are cut into ``PARTS`` equal consecutive parts,
each with a codebook of ``ENTRIES``. Rounds of Lloyd's iteration run as one aggregation each:
tasks assign the parts of their rows and send one sum per (part, entry, place) and task, so the
shuffle and what the driver sees depend on the codebooks' size alone. All sums and means are
exact integers: the result does not depend on how rows are dealt.

Orchard's search: every entry has the other entries sorted by their distance from it. A query
stands on an entry and walks that entry's list; on meeting a nearer entry it jumps to that
entry's list, entries it has met are marked and not measured again, and it ends where the list
is farther than twice its own distance: by the triangle inequality no entry from there on can be
as near. Queries of a batch walk together in numpy. Distances are squared integers, so "twice"
is four times. Of equally near entries the one with the lower index counts; ties lie inside the
bound and are met too.

Rows dropped: null vectors and vectors with a null or non-finite component. Vectors without
components, or of another length than most vectors (of equally frequent lengths the longest),
cannot be cut and are dropped too. That length must be a multiple of ``PARTS``. Components so
large that squared distances leave 64 bits raise an error. Repeated and null ids: rows count one
by one; seeds are taken by id (nulls last), then vector. With fewer than ``ENTRIES`` rows there
are as many entries as rows. An empty table gives an empty result. Other columns are not used.
The input is read once per round and three times more: pass a table, not a long plan.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, materialize, read

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6


def whole_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, length, values)`` of the vectors whose components are all finite, values laid end to end."""
    size = np.array(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = column.flatten()
    value = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    owner = np.repeat(np.arange(len(size)), size)
    bad = np.zeros(len(size), dtype=bool)
    bad[owner[~np.isfinite(value)]] = True
    good = np.asarray(column.is_valid()) & ~bad & (size > 0)
    return np.flatnonzero(good), size[good], value[good[owner]]


def integers(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, matrix)`` of the usable vectors with ``width`` components."""
    row, size, value = whole_rows(column)
    fits = size == width
    value = np.floor(value[np.repeat(fits, size)] * SCALE)
    # a part's squared distance, summed over parts, must stay in 64 bits
    if len(value) and np.abs(value).max() >= (2.0**63 / width) ** 0.5 / 2:
        raise ValueError(f"components beyond {(2.0**63 / width) ** 0.5 / 2 / SCALE:.0f} do not fit the integer distances")
    return row[fits], value.astype(np.int64).reshape(-1, width)


class Orchard:
    """Nearest entries of the codebooks ``books`` (part, entry, place)."""

    def __init__(self, books: np.ndarray):
        self.books = books
        gap = np.square(books[:, :, None] - books[:, None]).sum(axis=-1)
        self.list = np.argsort(gap, axis=-1, kind="stable")
        #: An entry at squared distance ``gap`` is worth a look while ``ceil(gap / 4)`` is at most the query's.
        self.reach = (np.take_along_axis(gap, self.list, axis=-1) + 3) // 4

    def __call__(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry: arrays of (row, part)."""
        parts, entries, width = self.books.shape
        query = rows.reshape(-1, width)
        part = np.tile(np.arange(parts), len(rows))
        at = np.zeros(len(query), dtype=np.int64)
        best = np.square(query - self.books[part, 0]).sum(axis=1)
        place = np.zeros(len(query), dtype=np.int64)
        met = np.zeros((len(query), entries), dtype=bool)
        met[:, 0] = True
        walking = np.arange(len(query))
        while len(walking):
            p, c, k = part[walking], at[walking], place[walking]
            near = self.reach[p, c, k] <= best[walking]
            walking, p, c, k = walking[near], p[near], c[near], k[near]
            entry = self.list[p, c, k]
            place[walking] = k + 1
            new = ~met[walking, entry]
            some, p, entry = walking[new], p[new], entry[new]
            met[some, entry] = True
            far = np.square(query[some] - self.books[p, entry]).sum(axis=1)
            better = (far < best[some]) | ((far == best[some]) & (entry < at[some]))
            some = some[better]
            at[some], best[some], place[some] = entry[better], far[better], 0
            walking = walking[place[walking] < entries]
        return at.reshape(-1, parts), best.reshape(-1, parts)


def width_of(vectors: DataFrame) -> int | None:
    """The length most usable vectors have."""

    def make():
        def step(batch):
            size, n = np.unique(whole_rows(batch.column(0))[1], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(size, pa.int64()), pa.array(n, pa.int64())], ["size", "n"])

        return step

    sizes = arrow_map(vectors.select("v"), make, "size bigint, n bigint").groupBy("size").agg(F.sum("n").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return top.size if top else None


def seeds(vectors: DataFrame, width: int, entries: int = ENTRIES) -> np.ndarray:
    """The vectors of the smallest ids, one row each. A batch sends on its own smallest only."""

    def make():
        def step(batch):
            row, matrix = integers(batch.column(1), width)
            ids = batch.column(0).take(pa.array(row))
            null = ids.is_null().to_numpy(zero_copy_only=False)
            number = ids.fill_null(0).to_numpy(zero_copy_only=False)
            first = np.lexsort([*matrix.T[::-1], number, null])[:entries]
            return pa.RecordBatch.from_arrays(
                [ids.take(pa.array(first)), pa.array(matrix[first].tolist(), pa.list_(pa.int64()))], ["id", "v"]
            )

        return step

    top = arrow_map(vectors.select("id", "v"), make, "id bigint, v array<bigint>")
    rows = top.orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    return np.array([r.v for r in rows], dtype=np.int64)


def by_part(rows: np.ndarray, parts: int = PARTS) -> np.ndarray:
    return np.ascontiguousarray(rows.reshape(len(rows), parts, -1).swapaxes(0, 1))


def improved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of its parts; unused ones stay."""
    parts, entries, width = books.shape

    def make():
        search = Orchard(books)

        def step(batch):
            matrix = integers(batch.column(0), parts * width)[1]
            if not len(matrix):
                return None
            code = search(matrix)[0]
            cell = (np.arange(parts) * entries + code).ravel()
            order = np.argsort(cell, kind="stable")
            edge = np.flatnonzero(np.diff(cell[order], prepend=-1))
            total = np.add.reduceat(matrix.reshape(-1, width)[order], edge, axis=0)
            n = np.diff([*edge, len(order)])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(cell[order][edge], width)), pa.array(np.tile(np.arange(width), len(edge))),
                    pa.array(total.ravel()), pa.array(np.repeat(n, width)),
                ],
                ["cell", "place", "total", "n"],
            )

        return step

    sums = arrow_map(vectors.select("v"), make, "cell bigint, place bigint, total bigint, n bigint")
    exact = sums.groupBy("cell", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    out = books.copy().reshape(parts * entries, width)
    for r in exact.collect():  # parts x entries x width rows
        out[r.cell, r.place] = int(r.total) // r.n
    return out.reshape(books.shape)


def codebooks(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, place) fitted on all of ``vectors`` (``id``, ``v``)."""
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    books = by_part(seeds(vectors, width, entries), parts)
    for _ in range(rounds):
        books = improved(vectors, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of every usable row of ``vectors`` (``id``, ``label``, ``v``)."""
    parts, _, width = books.shape
    label = vectors.schema["label"].dataType.simpleString()

    def make():
        search = Orchard(books)
        digits = np.array([f"{i:02x}" for i in range(256)])

        def step(batch):
            row, matrix = integers(batch.column(2), parts * width)
            code, far = search(matrix)
            text = ["".join(x) for x in digits[code].tolist()]
            take = pa.array(row)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(text, pa.string()), pa.array(far.sum(axis=1))],
                ["id", "label", "code", "error"],
            )

        return step

    return arrow_map(vectors.select("id", "label", "v"), make, f"id bigint, label {label}, code string, error bigint")


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` with ``approximation``, the integer vector that ``code`` stands for."""
    tables = F.array(*[F.array(*[F.array(*map(F.lit, e.tolist())) for e in part]) for part in books])
    digit = F.transform(
        F.sequence(F.lit(0), F.lit(len(books) - 1)),
        lambda i: F.get(F.get(tables, i), F.conv(F.substring(F.col("code"), i * 2 + 1, F.lit(2)), 16, 10).cast("int")),
    )
    return codes.withColumn("approximation", F.flatten(digit))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


RESULT = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for ``vec_id, embedding, label``.

    Errors per label are added up before they meet the rows; the totals are written, so they are
    broadcast only if small, and otherwise a label with very many rows is split by AQE.
    """
    vectors = rows.select(F.col("vec_id").cast("bigint").alias("id"), "label", F.col("embedding").alias("v"))
    width = width_of(vectors)
    if width is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    books = codebooks(vectors, width, parts, entries, rounds)
    coded = materialize(encode(vectors, books), "codes")
    totals = materialize(
        coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "label_errors"
    )
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def op11_vector_codes(spark, sf_dir) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def _sql() -> str:
    assigned = """SELECT q.row_no, q.part, arg_min(b.entry, (d.far, b.entry)) AS entry, min(d.far) AS far
        FROM parts q JOIN {books} b ON b.part = q.part,
        LATERAL (SELECT list_sum(list_transform(list_zip(q.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS far) d
        GROUP BY q.row_no, q.part"""
    out = f"""WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row_no, vec_id, label,
            list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT row_no, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS v
        FROM kept, range({PARTS}) AS r(part)),
    books0 AS MATERIALIZED (SELECT part, row_no - 1 AS entry, v FROM parts WHERE row_no <= {ENTRIES})"""
    for i in range(ROUNDS):
        out += f""",
    near{i} AS MATERIALIZED ({assigned.format(books=f"books{i}")}),
    sums{i} AS (
        SELECT part, entry, place, sum(x) AS s, count(*) AS n
        FROM (SELECT part, entry, unnest(q.v) AS x, unnest(range(len(q.v))) AS place
            FROM near{i} JOIN parts q USING (row_no, part))
        GROUP BY ALL),
    means{i} AS (
        SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY place)::BIGINT[] AS v
        FROM sums{i} GROUP BY part, entry),
    books{i + 1} AS MATERIALIZED (
        SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
        FROM books{i} b LEFT JOIN means{i} m ON m.part = b.part AND m.entry = b.entry)"""
    return out + f""",
    last AS MATERIALIZED ({assigned.format(books=f"books{ROUNDS}")}),
    coded AS (
        SELECT row_no, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error
        FROM last GROUP BY row_no),
    digest AS (
        SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{ROUNDS})
    SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, d.codebooks_sha256
    FROM coded c JOIN kept k USING (row_no), digest d"""


SQL = _sql()
