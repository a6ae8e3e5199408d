"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

Two permutations give the whole signature: the first scatters a text's shingle hashes
over 2**20 places, the second is a table of 2**20 values whose circular shift by k is
the k-th hash function. So coordinate k is the least table value at ``place + k``, and the
coordinates of a shingle are neighbours in memory.

Steps: texts with equal shingle sets are one class, kept as its smallest id. Classes are
put into band buckets. A bucket's smallest id, its hub, is compared with the other members:
one candidate per member and bucket, however large the bucket; a hub of many meets them in lots.
Linked classes are united.
Buckets whose members are then still in more than one component are compared on, in blocks
of bounded size dealt over the tasks: members outside the hub's component against all members of
another component, all pairs of a block in one exact matrix product. So a bucket of copies costs
its length, and no link that would join two components is left out. Candidates with a hub first
pass a bound on set sizes and the signatures' estimate (six standard deviations below the
threshold), then the exact test on full sets.

With 32 bands of 6 a pair at similarity 0.85 shares a bucket with probability 1 - 3e-7
(0.80: 1 - 6e-5).

Shingles are told apart by 64-bit hashes of their words' 128-bit digests; no arrangement of words or
bytes makes two of them meet but chance.

Nulls and odd rows: null and empty texts, and texts without words, have an empty set and are
alone. Rows with a null id are left alone too (the query gives the size of their set). Rows that share an id are one document. Other columns
are not touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, bitmap, in_bitmap, materialize, read
from tradelane.llm.phrases import mix
from tradelane.llm.words import word_digests

U = np.uint64
PLACES = 20
BANDS, ROWS = 32, 6
WORDS = 5
BLOCK = 256
#: Pairs of one hub that share a copy of its set.
LOT = 64
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles, made of the words' 128-bit digests."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.factors = np.random.default_rng(103).integers(0, 2**63, (2, words), dtype=np.uint64) * U(2) + U(1)

    def __call__(self, text: bytes | None) -> np.ndarray:
        word = word_digests([(text or b"").translate(LOWER)])[0]
        if not word.shape[1]:
            return np.zeros(0, dtype=np.uint64)
        k = min(self.words, word.shape[1])
        n = word.shape[1] - k + 1
        total = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            total += word[0, j : j + n] * self.factors[0, j] + word[1, j : j + n] * self.factors[1, j]
        return np.unique(mix(total))


class Circulant:
    """Signatures of ``size`` coordinates from two permutations."""

    def __init__(self, size: int = BANDS * ROWS):
        self.size = size
        table = np.random.default_rng(107).permutation(1 << PLACES).astype(np.int32)
        ring = np.concatenate([table, table[:size]])
        self.rows = np.lib.stride_tricks.sliding_window_view(ring, size)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        place = (mix(hashes ^ U(0x5851F42D4C957F2D)) >> U(64 - PLACES)).astype(np.int64)
        best = np.full(self.size, 2**31 - 1, dtype=np.int32)
        for i in range(0, len(place), 4096):
            np.minimum(best, self.rows[place[i : i + 4096]].min(axis=0), out=best)
        return best


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.reshape(bands, -1).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)
    for j in range(rows.shape[1]):
        key = mix(key * U(0x9E3779B97F4A7C15) + rows[:, j] + U(1))
    return key


def prints(texts: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """``doc, n, h1, h2, signature, bands`` for ``doc, text`` (binary)."""

    def make():
        shingle, sign = Shingler(words), Circulant(bands * rows)

        def step(batch):
            out = {k: [] for k in ("n", "h1", "h2", "signature", "bands")}
            for text in batch.column(1).to_pylist():
                s = shingle(text)
                sig = sign(s)
                out["n"].append(len(s))
                out["h1"].append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                out["h2"].append(int(mix(s ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                out["signature"].append((sig & 255).astype(np.uint8).tobytes() if len(s) else None)
                out["bands"].append(band_keys(sig, bands).view(np.int64) if len(s) else None)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["n"], pa.int64()), pa.array(out["h1"], pa.int64()),
                 pa.array(out["h2"], pa.int64()), pa.array(out["signature"], pa.binary()),
                 pa.array(out["bands"], pa.list_(pa.int64()))],
                ["doc", "n", "h1", "h2", "signature", "bands"],
            )

        return step

    return arrow_map(
        texts, make, "doc bigint, n bigint, h1 bigint, h2 bigint, signature binary, bands array<bigint>"
    )


def _sizes_fit(a: str, b: str, percent: int):
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def _estimate(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b, slot, sa, sb`` whose signatures agree often enough."""

    def make():
        def step(batch):
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8) for i in (3, 4))
            size = len(a) // batch.num_rows
            same = (a == b).reshape(batch.num_rows, size).sum(axis=1)
            hit = same >= least_agreement(size, percent)
            return pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(hit)) for i in (0, 1, 2)], ["a", "b", "slot"]
            )

        return step

    return arrow_map(pairs.select("a", "b", "slot", "sa", "sb"), make, "a bigint, b bigint, slot bigint")


def _with_hub(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """``pairs`` (``a, b, slot``) joined with ``values`` (``a`` and more) by lots: a hub that is in a
    great many pairs has them in lots of about ``LOT``, each of which gets its own copy of the value."""
    lots = pairs.select("a", "slot").distinct()
    return pairs.join(lots.join(values, "a"), ["a", "slot"])


def least_agreement(size: int, percent: int) -> float:
    """Six standard deviations below what a pair at the threshold agrees on."""
    t = percent / 100
    return size * t - 6 * (size * t * (1 - t)) ** 0.5


def full_sets(texts: DataFrame, ids: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc, set``: the sorted shingle hashes of the documents in ``ids`` (``doc``)."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap(ids, "doc"))

    def make():
        shingle = Shingler(words)

        def step(batch):
            hit = in_bitmap(shared.value, batch.column(0).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(hit))
            sets = [shingle(t).tobytes() for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc", "set"])

        return step

    return arrow_map(texts, make, "doc bigint, set binary").join(ids, "doc", "left_semi")


def verify(texts: DataFrame, pairs: DataFrame, percent: int, words: int = WORDS) -> DataFrame:
    """The pairs ``a, b`` with ``100 * intersection >= percent * union`` on their full sets.

    ``slot``, if given, numbers the lots that the pairs of one ``a`` are dealt into.
    """
    if "slot" not in pairs.columns:
        pairs = pairs.withColumn("slot", F.lit(0).cast("bigint"))
    ids = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    sets = full_sets(texts, ids, words)

    def make_test():
        def step(batch):
            hit = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                hit.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            keep = pa.array(hit)
            return pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], ["a", "b"])

        return step

    joined = (
        _with_hub(pairs, sets.select(F.col("doc").alias("a"), F.col("set").alias("sa")))
        .join(sets.select(F.col("doc").alias("b"), F.col("set").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
    )
    return arrow_map(joined, make_test, "a bigint, b bigint").distinct()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node, component`` (smallest node reachable) of undirected ``links`` ``a, b``.

    Alternating large and small stars: every round adds up minima per node and writes the
    edges, so nothing is gathered and a lost executor costs one round. With ``rounds`` it
    stops early: a component is then some smaller node that is truly connected.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    seen = None
    for _ in range(rounds or 60):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        if rounds:
            continue
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    else:
        if not rounds:
            raise RuntimeError("components did not settle")
    least = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("node")).distinct().join(least, "node", "left_anti")
    return least.unionByName(roots.withColumn("component", F.col("node")))


def shared_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections: a product of 0/1 matrices, in strips of ``width`` hashes."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = n[column] > 1  # hashes of one set alone are in no intersection
    owner, column = owner[several], (np.cumsum(n > 1) - 1)[column[several]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + width, width))
    for k, (a, b) in enumerate(zip(edges, [*edges[1:], len(column)], strict=True)):
        if a < b:
            strip = np.zeros((len(sets), width), dtype=np.float32)
            strip[owner[a:b], column[a:b] - k * width] = 1
            out += strip @ strip.T
    return out.astype(np.int64)


def _across(members: DataFrame, sets, percent: int) -> DataFrame:
    """Links between components of one bucket: ``key, id, n, component, home`` in.

    ``home`` is the component of the bucket's hub. Members outside it are dealt into blocks
    of about ``BLOCK``, and each block meets each block of all members. Buckets with the same
    members are looked at once. ``sets`` gives the full sets of a frame of ids; the test is
    exact, and of a block's links those that join its components are returned.
    """
    size = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("all"),
        F.sum((F.col("component") != F.col("home")).cast("int")).alias("strays"),
        F.bit_xor(F.xxhash64("id")).alias("who"),
    )
    chosen = size.where("strays > 0").groupBy("who", "all", "strays").agg(F.min("key").alias("key"))
    rows = materialize(members.join(chosen, "key"), "mixed")
    rows = rows.join(sets(rows.select(F.col("id").alias("doc")).distinct()).withColumnRenamed("doc", "id"), "id")
    blocks_all = F.ceil(F.col("all") / BLOCK).cast("int")
    blocks_stray = F.ceil(F.col("strays") / BLOCK).cast("int")
    slot = F.xxhash64("id", "key")
    keep = ["key", "id", "n", "component", "set"]
    stray = F.col("component") != F.col("home")
    i, j = F.pmod(slot, blocks_stray), F.pmod(slot, blocks_all)
    # a row goes to the blocks it sits in: as a stray against all, and as one of all against each block of strays
    as_one = F.transform(F.sequence(F.lit(0), blocks_stray - 1), lambda x: F.struct(x.cast("bigint").alias("i"), j.cast("bigint").alias("j"), (stray & (x == i)).alias("stray"), F.lit(True).alias("one")))
    as_stray = F.when(
        stray,
        F.transform(
            F.filter(F.sequence(F.lit(0), blocks_all - 1), lambda x: x != j),
            lambda x: F.struct(i.cast("bigint").alias("i"), x.cast("bigint").alias("j"), F.lit(True).alias("stray"), F.lit(False).alias("one")),
        ),
    ).otherwise(F.array().cast("array<struct<i:bigint,j:bigint,stray:boolean,one:boolean>>"))
    dealt = rows.select(*keep, F.explode(F.concat(as_one, as_stray)).alias("at")).select(*keep, "at.*")

    def compare(table: pa.Table) -> pa.Table:
        stray, one = (table.column(c).to_numpy() for c in ("stray", "one"))
        ids, n, comp = (table.column(c).to_numpy() for c in ("id", "n", "component"))
        both = shared_counts([np.frombuffer(x, dtype=np.uint64) for x in table.column("set").to_pylist()])
        fits = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        x, y = np.nonzero(fits & (comp[:, None] != comp[None, :]) & stray[:, None] & one[None, :])
        parent: dict[int, int] = {}

        def root(c):
            while parent.get(c, c) != c:
                c = parent[c]
            return c

        a, b = [], []
        for p, q in zip(x.tolist(), y.tolist(), strict=True):
            s, t = root(comp[p]), root(comp[q])
            if s != t:
                parent[max(s, t)] = min(s, t)
                a.append(min(ids[p], ids[q]))
                b.append(max(ids[p], ids[q]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct()


def groups(docs: DataFrame, percent: int = 80, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """``doc, n, component`` for every row of ``docs`` with an id (``doc_id``, ``text``)."""
    texts = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("doc"), F.col("text").cast("binary").alias("text")
    )
    seen = materialize(prints(texts, bands, rows, words), "prints")
    plain = seen.select("doc", "n", "h1", "h2")
    classes = plain.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc").alias("id"))
    nodes = materialize(
        seen.where("n > 0").join(classes, ["h1", "h2", "n"]).where("doc = id").select("id", "n", "signature", "bands"), "classes"
    ).dropDuplicates(["id", "n", "signature"])
    banded = nodes.select("id", "n", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min(F.struct("id", "n")).alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1")
    members = materialize(
        banded.join(hubs, "key").select("key", "id", "n", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), "c"), "buckets"
    )
    signatures = nodes.select("id", "signature")
    # a hub of a full bucket is in as many pairs: they are dealt into lots by the bucket's size
    first = (
        members.where("id != hub")
        .where(_sizes_fit("n", "hub_n", percent))
        .groupBy(F.col("hub").alias("a"), F.col("id").alias("b"))
        .agg(F.max("c").alias("c"))
        .select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("c") / LOT).cast("bigint")).alias("slot"))
    )
    signed = _with_hub(first, signatures.select(F.col("id").alias("a"), F.col("signature").alias("sa"))).join(
        signatures.select(F.col("id").alias("b"), F.col("signature").alias("sb")), "b"
    )
    links = materialize(verify(texts, materialize(_estimate(signed, percent).distinct(), "pairs"), percent, words), "links")
    # ids repeated over several texts are one node already; classes of one id need no link
    united = materialize(components(links), "components")

    def component(frame, column, out):
        named = united.select(F.col("node").alias(column), F.col("component").alias(out))
        return frame.join(named, column, "left").withColumn(out, F.coalesce(out, column))

    placed = component(component(members, "id", "component"), "hub", "home").select("key", "id", "n", "component", "home")
    extra = materialize(_across(placed, lambda ids: full_sets(texts, ids, words), percent), "links")
    united = materialize(components(links.unionByName(extra)), "components")
    labelled = component(classes, "id", "component").select("h1", "h2", "n", "component")
    named = plain.where("n > 0").join(labelled, ["h1", "h2", "n"]).select("doc", "n", "component")
    alone = plain.where("n = 0").select("doc", "n", F.col("doc").alias("component"))
    return named.unionByName(alone)


def dedup(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, columns as they are, whatever their names."""
    gone = groups(docs, percent).where("component != doc").select("doc").distinct().toDF("_doc")
    packed = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    at = f"_{docs.columns.index('doc_id')}"
    return packed.join(gone, packed[at] == gone["_doc"], "left_anti").toDF(*docs.columns)


def op9_minhash_near_dedup(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    known = groups(docs, percent=85).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        (F.col("doc") == F.col("component")).alias("kept"),
    )
    nameless = docs.where("doc_id is null").select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    alone = prints(nameless).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"), F.lit(True).alias("kept")
    )
    return known.unionByName(alone)
