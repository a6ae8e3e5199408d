"""Repeated-passage removal by prefix-free parsing.

Texts are cut into phrases by rolling-hash triggers (``phrases``). The dictionary is the
set of distinct phrases with the place of each one's first occurrence; the parse is the
list of phrase occurrences in corpus order. A window of ``window`` bytes lies whole inside
one phrase, so

* an occurrence of a phrase that is not its first repeats all windows of the phrase, which
  the parse alone decides, once per phrase and not per byte;
* two different dictionary phrases can share windows only if they share their trigger.
  (Phrases with a repeated trigger are cut into pieces with longer triggers first, so few
  do.) For those the dictionary's windows are grouped by digest, and in a group the
  parse's order names the first in the corpus.

Both together say of every window whether it starts earlier in the corpus too. No suffix array is
built, neither of the dictionary nor of the parse: only equality to the depth of one window
counts, which the digests tell without an order.

Scale: hot phrases are reduced inside each task before anything is shuffled, the joins are
on digests, and each step moves a few rows per phrase that is not unique. Phrases with a
unique trigger, most of a corpus, never leave the scan: a bitmap of fixed size drops them.

Digests: a phrase by 128 bits (trigger and phrase), a suffix by 96.

Nulls: a null text is empty; a null id comes before all others. Texts shorter than the
window repeat nothing. Rows that share an id are documents of their own: they come by a digest
of their content, and equal rows by a row number that is written once, so a span is cut only from
the row it was found in, and of equal texts the first alone stays. Other columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, bitmap, by_bytes, doc_key, in_bitmap, materialize, read
from tradelane.llm.phrases import Parser, mix, union

WINDOW = 100
#: Bytes of text that a task holds in arrays at a time.
CHUNK = 8 << 20
U = np.uint64


def identified(rows: DataFrame, content: str) -> tuple[DataFrame, list[str]]:
    """``rows``, and the columns that tell each from all others, in corpus order.

    ``doc`` alone where no id repeats. Otherwise a digest of the column ``content`` and a row
    number are written with the rows.
    """
    if rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return rows, ["doc"]
    told = rows.withColumn("content", F.xxhash64(content)).withColumn("copy", F.monotonically_increasing_id())
    return materialize(told, "rows"), ["doc", "content", "copy"]


def _typed(ids: list[str]) -> str:
    return ", ".join(f"{c} bigint" for c in ids)


def _bytes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(t or b"", dtype=np.uint8) for t in batch.column("text").to_pylist()]


def _ranks(batch: pa.RecordBatch, ids: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Each row's place among the rows of the batch, and the ``ids`` by place."""
    columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ids]
    order = np.lexsort(columns[::-1])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return rank, {c: x[order] for c, x in zip(ids, columns, strict=True)}


def _batch(**columns) -> pa.RecordBatch:
    arrays = []
    for v in columns.values():
        v = np.asarray(v)
        arrays.append(pa.array(v.view(np.int64) if v.dtype == np.uint64 else v))
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Unions of the intervals of each document."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    out = []
    for part in np.split(np.arange(len(doc)), np.flatnonzero(doc[1:] != doc[:-1]) + 1):
        if len(part):
            s, e = union(start[part], end[part])
            out.append((np.full(len(s), doc[part[0]]), s, e))
    if not out:
        return doc, start, end
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _repeated_triggers(texts: DataFrame, window: int) -> DataFrame:
    def make():
        parser = Parser(window)

        def step(batch):
            keys = np.concatenate([parser.parse(t)[0] for t in _bytes(batch)])
            key, n = np.unique(keys, return_counts=True)
            return _batch(key=key, n=np.minimum(n, 2).astype(np.int64))

        return step

    return (
        arrow_map(texts, make, "key bigint, n bigint")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .select("key")
    )


def _firsts(window: int, ids: dict[str, np.ndarray], key, phrase, doc, start, n) -> pa.RecordBatch:
    """One row per phrase of a task, its first; spans of the others are known to repeat.

    ``doc`` is a place in ``ids``.
    """
    order = np.lexsort((start, doc, phrase, key))
    key, phrase, doc, start, n = (x[order] for x in (key, phrase, doc, start, n))
    first = np.ones(len(key), dtype=bool)
    first[1:] = (key[1:] != key[:-1]) | (phrase[1:] != phrase[:-1])
    d, s, e = _merge(doc[~first], start[~first], start[~first] + n[~first] + window - 1)
    k, none = first.sum(), np.zeros(len(d), dtype=np.uint64)
    doc = np.concatenate([doc[first], d])
    return _batch(
        key=np.concatenate([key[first], none]),
        phrase=np.concatenate([phrase[first], none]),
        **{c: x[doc] for c, x in ids.items()},
        start=np.concatenate([start[first], s]).astype(np.int32),
        n=np.concatenate([n[first], e - s - window + 1]).astype(np.int32),
        again=np.arange(k + len(d)) >= k,
    )


def _parse(texts: DataFrame, ids: list[str], window: int, bits: np.ndarray) -> DataFrame:
    """The parse: pieces of phrases whose trigger may repeat, by document and place."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def make():
        parser = Parser(window)

        def step(batch):
            for part in by_bytes(batch, batch.schema.get_field_index("text"), CHUNK):
                found = []
                rank, known = _ranks(part, ids)
                for doc, text in zip(rank, _bytes(part), strict=True):
                    key, phrase, start, n = parser.pieces(text, lambda k: in_bitmap(shared.value, k))
                    found.append((key, phrase, np.full(len(key), doc), start, n))
                yield _firsts(window, known, *(np.concatenate(x) for x in zip(*found, strict=True)))

        return step

    return arrow_map(texts, make, f"key bigint, phrase bigint, {_typed(ids)}, start int, n int, again boolean")


def _suffixes(entries: DataFrame, ids: list[str], window: int) -> DataFrame:
    """Window digests of dictionary phrases; ``again`` where the task itself has an earlier one."""

    def make():
        parser = Parser(window)

        def step(batch):
            for part in by_bytes(batch, batch.schema.get_field_index("text"), CHUNK):
                found = []
                rank, known = _ranks(part, ids)
                for doc, text, items in zip(rank, _bytes(part), part.column("entries").to_pylist(), strict=True):
                    n = np.array([x["n"] for x in items])
                    shift = np.repeat(np.array([x["start"] for x in items]) - np.cumsum(n) + n, n)
                    place = shift + np.arange(n.sum())
                    check = np.repeat(np.array([x["key"] for x in items], dtype=np.int64).view(np.uint64), n)
                    check = (check * U(0x9E3779B97F4A7C15)) >> U(33)
                    h = mix(parser.windows(text)[place] ^ check)
                    found.append((h, np.full(len(h), doc), (check << U(32)) | place.astype(np.uint64)))
                h, doc, place = (np.concatenate(x) for x in zip(*found, strict=True))
                pos, check = place & U(0xFFFFFFFF), place >> U(32)
                order = np.lexsort((pos, doc, check, h))
                h, doc, place, pos, check = (x[order] for x in (h, doc, place, pos, check))
                first = np.ones(len(h), dtype=bool)
                first[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
                yield _batch(digest=h, **{c: x[doc] for c, x in known.items()}, place=place, again=~first)

        return step

    return arrow_map(entries, make, f"digest bigint, {_typed(ids)}, place bigint, again boolean")


def _resolve(phrases: DataFrame, ids: list[str], window: int) -> tuple[DataFrame, DataFrame]:
    """Spans of phrases that are not the first of their kind, and the entries to look into.

    A phrase has at most one row from each task, however common it is.
    """
    order = Window.partitionBy("key", "phrase").orderBy(*ids, "start")
    # spans that are known already ride along, spread by their place
    spread = phrases.withColumn("key", F.when(F.col("again"), F.xxhash64(*ids, "start")).otherwise(F.col("key")))
    ranked = materialize(spread.withColumn("_later", F.rank().over(order) > 1), "ranked")
    end = (F.col("start") + F.col("n") + (window - 1)).alias("end")
    repeated = ranked.where("again or _later").select(*ids, "start", end)
    dictionary = ranked.where("not again and not _later")
    shared = dictionary.groupBy("key").agg(F.min("phrase").alias("_a"), F.max("phrase").alias("_b"))
    entries = (
        dictionary.join(shared.where("_a != _b").select("key"), "key")
        .select(*ids, F.struct("key", "start", "n").alias("entry"))
        .groupBy(*ids)
        .agg(F.collect_list("entry").alias("entries"))
    )
    return repeated, entries


def _group(ids: list[str]) -> Column:
    """The window's digest; rows known to repeat ride along, spread by their place."""
    return F.when(F.col("again"), F.xxhash64(*ids, "place")).otherwise(F.col("digest"))


def spans(docs: DataFrame, ids: list[str], window: int = WINDOW) -> DataFrame:
    """``ids``, ``text, spans``: for each row of ``ids`` and ``text`` (binary) its repeated intervals.

    Intervals may overlap; ``spans`` is null where nothing repeats.
    """
    bits = bitmap(_repeated_triggers(docs, window), "key")
    coarse, entries = _resolve(_parse(docs, ids, window, bits), ids, window)
    dealt = docs.repartition(*ids)  # one exchange of the texts serves both joins
    with_entries = dealt.join(entries.hint("shuffle_hash"), ids).select(*ids, "text", "entries")
    order = Window.partitionBy("group", F.shiftright("place", 32), "again").orderBy(*ids, "place")
    position = F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")
    single = (
        _suffixes(with_entries, ids, window)
        .withColumn("group", _group(ids))
        .withColumn("_rank", F.rank().over(order))
        .where("again or _rank > 1")
        .select(*ids, position.alias("start"), (position + window).alias("end"))
    )
    per_doc = (
        coarse.unionByName(single)
        .groupBy(*ids)
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    return dealt.join(per_doc.hint("shuffle_hash"), ids, "left").select(*ids, "text", "spans")


def cut(text: bytes, found: list | None) -> tuple[list[tuple[int, int]], bytes]:
    """Merged intervals of a text and what is left of it."""
    if not found:
        return [], text
    start = np.array([x["start"] for x in found], dtype=np.int64)
    end = np.minimum(np.array([x["end"] for x in found], dtype=np.int64), len(text))
    start, end = union(start[start < end], end[start < end])
    edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(text)]
    left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return list(zip(start.tolist(), end.tolist(), strict=True)), left


def clean(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` cut and ``n_chars`` counted anew; characters cut in half go."""
    rest = [c for c in docs.columns if c != "text"]
    names = [f"_{i}" for i in range(len(rest))]
    packed = docs.select(
        doc_key().alias("doc"), F.struct(F.col("text").cast("binary").alias("text"),
                                         *[F.col(c).alias(n) for c, n in zip(rest, names, strict=True)]).alias("row")
    )
    packed, ids = identified(packed, "row")
    found = spans(packed.select(*ids, F.col("row.text").alias("text")), ids, window)

    def make():
        def step(batch):
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                got, left = cut(text or b"", found)
                out.append(left.decode("utf-8", "ignore") if got else None)
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ids), pa.array(out, pa.string())], [*ids, "left"])

        return step

    cuts = arrow_map(found.where("spans is not null"), make, f"{_typed(ids)}, left string").where("left is not null")
    joined = packed.join(cuts, ids, "left")
    text = F.coalesce("left", F.col("row.text").cast("string"))
    values = {n: F.col(f"row.{n}") for n in names}
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(text.alias("text"))
        elif c == "n_chars":
            columns.append(F.coalesce(F.char_length("left").cast("bigint"), values[names[rest.index(c)]]).alias(c))
        else:
            columns.append(values[names[rest.index(c)]].alias(c))
    return joined.select(columns)


def op2_suffix_array_dedup(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows, ids = identified(docs.select(doc_key().alias("doc"), F.col("text").cast("binary").alias("text")), "text")
    found = spans(rows.select(*ids, "text"), ids)

    def make():
        def step(batch):
            rows = []
            for doc, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "spans")), strict=True):
                text = text or b""
                got, left = cut(text, found)
                rows.append((doc, len(text), len(text) - len(left), len(got), hashlib.sha256(left).hexdigest()))
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in zip(*rows, strict=True)], ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

        return step

    out = arrow_map(found, make, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.select(F.nullif(F.col("doc"), F.lit(-(2**63))).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
