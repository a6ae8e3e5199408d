"""Word-window dedup behind a count-min prefilter.

A word goes if it lies in a window of ``WINDOW`` consecutive words whose sequence also starts
anywhere else, in the same text or another. Every window has an anchor, the smallest hash among
its ``GRAM``-word grams (leftmost on ties). The choice depends on the window's words alone, so
the places where a window starts and those places' anchors go together one to one, and an anchor
occurs at least as often as any window it serves. Neighbouring windows mostly share an anchor;
those of one anchor's place are a phrase.

1. Tasks sketch the anchors: in ``ROWS`` rows of cells an anchor adds one to its cell of each row.
   The sketches of the partitions are merged by adding cells up. The least of an anchor's cells
   overestimates the anchor, and so its windows: what is estimated at one is unique and is done with.
2. The other phrases are grouped exactly, by digest. One found twice or more is repeated whole.
3. Where an anchor serves unlike phrases, some windows of those found once may be shared: their
   windows are grouped exactly, one by one, with those of one example of each repeated phrase.
4. Spans found are made distinct per text before they are gathered, and cut from the rows.
   Fixed-size bitmaps spare rows that need no grouping, and texts without spans the shuffle.

No window is lost: a repeated one has a repeated anchor, so it reaches step 2, and unless its
phrases are equal, step 3. Rows are told apart by the digest of their text: equal texts are cut
alike, as all their windows are repeated, while each row counts by itself in steps 1 to 3.

Size: the sketch has four cells for each anchor expected of the text's bytes, up to
``ROWS * MAX_CELLS`` cells; two bits of what is merged are looked up in the second pass, 2 bits a
cell of one row, so 32 MB at most are broadcast. On more text cells fill up and step 2 groups more
phrases: some 40 bytes for every 16 words. Results do not change.

Exact means by 128-bit digests: words by lanes of eight bytes mixed into two numbers (long ones by
BLAKE2b), windows by two independent sums of their word digests under random odd factors. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts
have none. Texts of any length are read whole, in Arrow batches and slices of ``SLICE`` bytes or one
text, so an executor holds a few of them whatever the rows' length; only the last pass of ``clean``, run
by its caller, takes the batches the session is set to. ``report`` is written and read back. Null and
repeated ids are plain rows; an empty table gives an empty result; other columns pass through
``clean``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, bitmap, by_bytes, in_bitmap, materialize, read
from tradelane.llm.phrases import mix, sliding_min, union
from tradelane.llm.words import word_digests
from tradelane.session import arrow_batches, shuffles_dropped

U = np.uint64
WINDOW, GRAM = 35, 5
ROWS = 2
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 27
#: Text bytes for which the sketch has one cell a row: about a quarter of an anchor.
BYTES_PER_CELL = 24
SLICE = 2 << 20


class Windows:
    """Word digests of a slice of texts, its windows' anchors and digests."""

    def __init__(self, window: int = WINDOW):
        if window < GRAM:
            raise ValueError(f"windows have at least {GRAM} words")
        self.window = window
        stream = np.random.default_rng(1201)
        self.gram = stream.integers(0, 2**63, GRAM, dtype=np.uint64) * U(2) + U(1)
        self.factors = stream.integers(0, 2**63, (2, window), dtype=np.uint64) * U(2) + U(1)

    def load(self, texts: list[bytes | None]) -> None:
        self.words, self.count = word_digests(texts)
        self.first = np.cumsum(self.count) - self.count

    def phrases(self):
        """``(anchor, start, windows, offset of the anchor)`` of the runs of windows with one anchor."""
        none = np.zeros(0, dtype=np.int64)
        w, n = self.words[0], self.words.shape[1] - GRAM + 1
        if n < self.window - GRAM + 1:
            return none.astype(np.uint64), none, none, none
        gram = np.zeros(n, dtype=np.uint64)
        for j, factor in enumerate(self.gram):
            gram += w[j : j + n] * factor
        gram = mix(gram)
        packed = (gram & U(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        at = (sliding_min(packed, self.window - GRAM + 1) & U(0xFFFFFFFF)).astype(np.int64)
        text = np.repeat(np.arange(len(self.count)), self.count)
        inside = np.flatnonzero(text[: len(at)] == text[self.window - 1 :])  # windows of one text
        if not len(inside):
            return none.astype(np.uint64), none, none, none
        at = at[inside]
        new = np.flatnonzero(np.diff(at, prepend=-1) != 0)
        start = inside[new]
        return gram[at[new]], start, np.diff([*new, len(inside)]), at[new] - start

    def digests(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent digests of the windows that start at ``start``."""
        out = np.zeros((2, len(start)), dtype=np.uint64)
        for j in range(self.window):
            out += self.words[:, start + j] * self.factors[:, j, None]
        return mix(out[0]), mix(out[1])

    def text_of(self, start: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first + self.count, start, side="right")


def text_key(text: bytes | None) -> bytes:
    return hashlib.blake2b(text or b"", digest_size=16).digest()


def _cells(anchor: np.ndarray, cells: int) -> np.ndarray:
    """An anchor's cell in each row of the sketch."""
    high = mix(anchor ^ U(0xC2B2AE3D27D4EB4F))
    return np.stack([(anchor & U(cells - 1)), (high & U(cells - 1))]).astype(np.int64)


def cells_for(texts: DataFrame) -> int:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = max(MIN_CELLS, -(-size // BYTES_PER_CELL))
    return min(MAX_CELLS, 1 << (wanted - 1).bit_length())


def sketch(texts: DataFrame, cells: int, window: int = WINDOW) -> np.ndarray:
    """The merged sketch as bits (row, 64 cells a word): whether a cell counts two or more.

    A partition's counts are added up in its tasks, partitions' counts by the grouping;
    what reaches the driver is bounded by ``cells``.
    """

    def make():
        windows = Windows(window)

        def step(batch):
            for part in by_bytes(batch, 0, SLICE):
                windows.load(part.column(0).to_pylist())
                anchor = windows.phrases()[0]
                cell, n = np.unique(_cells(anchor, cells) + np.arange(ROWS)[:, None] * cells, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

        return step

    counted = arrow_map(texts, make, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    full = counted.where("n > 1").select(F.shiftright("cell", 6).alias("word"), F.expr("shiftleft(1L, cast(cell & 63 as int))").alias("bit"))
    with shuffles_dropped(texts.sparkSession):
        words = full.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(ROWS * cells // 64, dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out.reshape(ROWS, -1)


def estimated_repeated(bits: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    hit = np.ones(len(anchor), dtype=bool)
    for row, cell in zip(bits, _cells(anchor, bits.shape[1] * 64), strict=True):
        hit &= (row[cell >> 6] >> (cell & 63).astype(np.uint64)) & U(1) == 1
    return hit


def _phrases(texts: DataFrame, window: int, result) -> DataFrame:
    """Rows of the texts' phrases: ``result()``, made once per task, chooses by anchor and builds them."""

    def make():
        windows, made = Windows(window), result()

        def step(batch):
            for part in by_bytes(batch, 0, SLICE):
                own = part.column(0).to_pylist()
                windows.load(own)
                anchor, start, n, offset = windows.phrases()
                hit = made.wants(anchor)
                if not hit.any():
                    continue
                anchor, start, n, offset = anchor[hit], start[hit], n[hit], offset[hit]
                text = windows.text_of(start)
                some = np.unique(text)
                keys = np.frombuffer(b"".join([text_key(own[t]) for t in some.tolist()]), dtype="V16")[np.searchsorted(some, text)]
                yield made.rows(windows, anchor, start, n, offset, keys, start - windows.first[text])

        return step

    return arrow_map(texts, make, result.schema)


def _binary(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.tolist(), pa.binary())


def _phrase_digests(windows: Windows, start, n, offset):
    """First and last window share or touch, so together they are the phrase."""
    (a1, a2), (b1, b2) = windows.digests(start), windows.digests(start + n - 1)
    shape = (n * 64 + offset).astype(np.uint64)
    return mix(a1 * U(0x9E3779B97F4A7C15) + b1 + shape), mix(a2 * U(0xC2B2AE3D27D4EB4F) + b2 + shape)


def _spot(keys: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number for a place in a text."""
    return mix(keys.view(np.uint64).reshape(-1, 2)[:, 0] + place.astype(np.uint64) * U(0x9E3779B97F4A7C15))


class _Repeated:
    """Step 2's rows: phrases whose anchor the sketch estimates as repeated."""

    schema = "key binary, start int, n int, anchor bigint, h1 bigint, h2 bigint, spot bigint"

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def wants(self, anchor):
        return estimated_repeated(self.bits, anchor)

    def rows(self, windows, anchor, start, n, offset, keys, place):
        h1, h2 = _phrase_digests(windows, start, n, offset)
        numbers = [x.view(np.int64) for x in (anchor, h1, h2, _spot(keys, place))]
        return pa.RecordBatch.from_arrays(
            [_binary(keys), pa.array(place.astype(np.int32)), pa.array(n.astype(np.int32)), *map(pa.array, numbers)],
            ["key", "start", "n", "anchor", "h1", "h2", "spot"],
        )


class _Single:
    """Step 3's rows: windows of phrases found once, and without place those of one of each repeated phrase."""

    schema = "key binary, start int, weight int, h1 bigint, h2 bigint"

    def __init__(self, anchors: np.ndarray, lone: np.ndarray, examples: np.ndarray):
        self.anchors, self.lone, self.examples = anchors, lone, examples

    def wants(self, anchor):
        return in_bitmap(self.anchors, anchor)

    def rows(self, windows, anchor, start, n, offset, keys, place):
        lone = in_bitmap(self.lone, _phrase_digests(windows, start, n, offset)[0])
        use = lone | in_bitmap(self.examples, _spot(keys, place))
        lone, start, n, keys, place = lone[use], start[use], n[use], keys[use], place[use]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        lone, keys, place = (np.repeat(x, n) for x in (lone, keys, place))
        h1, h2 = windows.digests(np.repeat(start, n) + inner)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k if x else None for k, x in zip(keys.tolist(), lone.tolist(), strict=True)], pa.binary()),
                pa.array((place + inner).astype(np.int32)), pa.array(np.where(lone, 1, 2).astype(np.int32)),
                pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
            ],
            ["key", "start", "weight", "h1", "h2"],
        )


def _within(df: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """Rows whose ``column`` may be in the bitmap."""
    shared = df.sparkSession.sparkContext.broadcast(bits)
    at = df.columns.index(column)

    def step(batch):
        return batch.filter(pa.array(in_bitmap(shared.value, batch.column(at).to_numpy(zero_copy_only=False))))

    return arrow_map(df, lambda: step, ", ".join(f"{n} {t}" for n, t in df.dtypes))


def spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key, start, length``: distinct runs of words in repeated windows, by text digest; they may overlap.

    ``texts`` has one column, ``text`` (binary), and is read four times over.
    """
    spark = texts.sparkSession
    share = spark.sparkContext.broadcast
    merged = share(sketch(texts, cells_for(texts), window))
    phrases = materialize(_phrases(texts, window, _late(_Repeated, merged)), "phrases")
    counts = materialize(
        phrases.groupBy("anchor", "h1", "h2").agg(F.count(F.lit(1)).alias("c"), F.min("spot").alias("spot")), "phrase_counts"
    )
    whole = phrases.join(counts.where("c > 1").select("anchor", "h1", "h2"), ["anchor", "h1", "h2"], "left_semi")
    unlike = materialize(counts.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor"), "anchors")
    mixed = counts.join(unlike, "anchor", "left_semi")
    chosen = [share(bitmap(*x)) for x in ((unlike, "anchor"), (mixed.where("c = 1"), "h1"), (mixed.where("c > 1"), "spot"))]
    singles = materialize(_phrases(texts, window, _late(_Single, *chosen)), "windows")
    twice = materialize(
        singles.groupBy("h1", "h2").agg(F.sum("weight").alias("w")).where("w > 1").select("h1", "h2"), "repeated"
    )
    shared = _within(singles.where("key is not null"), "h1", bitmap(twice, "h1")).join(twice, ["h1", "h2"], "left_semi")
    found = [x.select("key", "start", (n + window - 1).alias("length")) for x, n in ((whole, F.col("n")), (shared, F.lit(1)))]
    return found[0].unionByName(found[1]).distinct()


def _late(kind, *shared):
    """``kind`` made in the task from broadcast values."""

    def make():
        return kind(*[x.value for x in shared])

    make.schema = kind.schema
    return make


def _cut(docs: DataFrame, window: int, schema: str, result) -> DataFrame:
    """``mapInArrow`` over ``docs``, text as bytes, with ``result(batch, (words, kept words) per row)``.

    Only texts with a span, going by a bitmap of their digests, are shuffled to meet their spans.
    """
    names = [f"_{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    packed = docs.toDF(*names)
    source = packed.withColumn(names[at], F.col(names[at]).cast("binary"))
    texts = source.select(F.col(names[at]).alias("text"))
    place = F.struct("start", "length")
    head = F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("bigint").alias("head")
    with arrow_batches(docs.sparkSession, SLICE):
        gathered = materialize(spans(texts, window).groupBy("key").agg(F.collect_list(place).alias("spans")), "spans")
        hit = docs.sparkSession.sparkContext.broadcast(bitmap(gathered.select(head), "head"))
    own = ", ".join(f"`{n}` {t}" for n, t in source.dtypes)

    def marked(batch):
        keys = [text_key(t) for t in batch.column(at).to_pylist()]
        return keys, in_bitmap(hit.value, np.array([int.from_bytes(k[:7], "big") for k in keys], dtype=np.int64))

    def with_key(batch):
        for part in by_bytes(batch, at, SLICE):
            keys, cut = marked(part)
            part = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *part.columns], ["_key", *part.schema.names])
            yield part.filter(pa.array(cut))

    def untouched(batch):
        batch = batch.filter(pa.array(~marked(batch)[1]))
        for part in by_bytes(batch, at, SLICE) if batch.num_rows else ():
            yield result(part, [_split(t, None) for t in part.column(at).to_pylist()])

    def cut(batch):
        for part in by_bytes(batch, at, SLICE):
            rows = zip(part.column(at).to_pylist(), part.column("spans").to_pylist(), strict=True)
            yield result(part, [_split(*row) for row in rows])

    keyed = arrow_map(source, lambda: with_key, f"_key binary, {own}")
    joined = keyed.join(gathered, F.col("_key") == F.col("key"), "left").select(*names, "spans")
    return arrow_map(source, lambda: untouched, schema).unionByName(arrow_map(joined, lambda: cut, schema))


def _split(text: bytes | None, spans: list[dict] | None) -> tuple[int, list[bytes]]:
    """``(words, words that stay)``."""
    words = text.split() if text else []
    if not spans:
        return len(words), words
    start, length = (np.array([x[k] for x in spans], dtype=np.int64) for k in ("start", "length"))
    kept: list[bytes] = []
    done = 0
    for a, b in zip(*(x.tolist() for x in union(start, start + length)), strict=True):
        kept += words[done:a]
        done = b
    return len(words), kept + words[done:]


def clean(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated windows' words removed from ``text``, the rest joined by one space.

    Texts that lose nothing are left as they are; ``n_chars``, where there is one, is counted anew.
    """
    names = docs.columns
    schema = ", ".join(f"`_{i}` {t}" for i, (_, t) in enumerate(docs.dtypes))
    at = {names.index("text"): pa.string()} | ({names.index("n_chars"): None} if "n_chars" in names else {})

    def result(batch, rows):
        old = batch.column(names.index("text")).to_pylist()
        text = [o if len(kept) == n else b" ".join(kept) for o, (n, kept) in zip(old, rows, strict=True)]
        text = [None if t is None else t.decode() for t in text]
        columns = list(batch.columns[: len(names)])
        for i, kind in at.items():
            columns[i] = pa.array(text, kind) if kind else pa.array([len(t or "") for t in text]).cast(columns[i].type)
        return pa.RecordBatch.from_arrays(columns, batch.schema.names[: len(names)])

    return _cut(docs, window, schema, result).toDF(*names)


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``."""

    def result(batch, rows):
        n, kept = [r[0] for r in rows], [r[1] for r in rows]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(n, pa.int64()), pa.array([a - len(k) for a, k in zip(n, kept, strict=True)], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for k in kept]),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    with arrow_batches(docs.sparkSession, SLICE):
        return materialize(_cut(docs.select("doc_id", "text"), window, schema, result), "report")


def op12_window_dedup(spark, sf_dir) -> DataFrame:
    return report(read(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))


SQL = f"""
WITH rows AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents),
windows AS MATERIALIZED (
    SELECT row_no, place, md5(array_to_string(words[place : place + {WINDOW - 1}], ' ')) AS digest
    FROM (SELECT row_no, words, unnest(range(1, len(words) - {WINDOW - 2})) AS place FROM rows)),
repeated AS (
    SELECT row_no, place FROM windows JOIN (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1) USING (digest)),
single AS (SELECT row_no, doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM rows),
marked AS (
    SELECT s.row_no, s.word, s.place,
        count(r.place) OVER (PARTITION BY s.row_no ORDER BY s.place ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) > 0 AS gone
    FROM single s LEFT JOIN repeated r ON r.row_no = s.row_no AND r.place = s.place),
totals AS (
    SELECT row_no, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS kept
    FROM marked GROUP BY row_no)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM rows LEFT JOIN totals USING (row_no)
"""
