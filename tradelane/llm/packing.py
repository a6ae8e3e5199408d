"""Best-fit packing with certified bin counts.

Documents become token ids; longer ones than a sequence are cut into full pieces and a
rest. The pieces are dealt into partitions of about ``PART`` and each is packed by best-fit
decreasing. A lower bound from dual feasible functions (round sizes up to a whole bin above
``capacity - a``, drop those below ``a``, for every ``a``) certifies a partition whose bin
count equals it. Partitions with a gap put their pieces into a common pool, certified ones the
contents of their emptiest bin; the pool is dealt anew and packed again, in rounds, until it fits
one partition, or until a round neither shrinks it nor saves a bin; then the pool's packing with the
fewest bins is taken. Where most parts meet the bound a round's pool holds about one bin of every
partition and shrinks fast. The bins used and the bound of all pieces are logged.

Null text is empty, and an empty text is one piece holding the end id alone. Repeated rows
are packed as often as they occur. An empty table gives no pieces.
"""

from __future__ import annotations

import logging
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, materialize, read

CAPACITY = 2048
PART = 50_000
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a task remembers; the oldest half goes when it is full.
MEMORY = 400_000


log = logging.getLogger(__name__)

#: A closing mark that stands alone after a Latin letter, and words of such letters.
_MARK = re.compile(rb"[.,](?![^ \t\n\r])(?:(?<=[a-z].)|(?<=\xc3[\xa0-\xb6\xb8-\xbf].))")
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


class Words:
    """Ids of texts, word by word.

    The vocabulary drops white space and never joins characters across it, so a text's
    ids are those of its words in turn; ids are kept as little-endian 32-bit bytes. It also
    lower-cases, and parts letters from a closing mark, so ``Word,`` needs only ``word`` and ``,``.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _alone(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters only, many in one call: each is one unit of the vocabulary."""
        out = []
        for i in range(0, len(words), 2000):
            part = words[i : i + 2000]
            e = self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False)
            unit = np.array(e.word_ids, dtype=np.int64)
            ids = np.array(e.ids, dtype="<u4").tobytes()
            edge = (np.searchsorted(unit, np.arange(len(part) + 1)) * 4).tolist()
            out += [ids[a:b] for a, b in zip(edge, edge[1:], strict=False)]
        return out

    def batch(self, texts: list[bytes | None]) -> list[bytes]:
        split = []
        for t in texts:
            t = t or b""
            # special strings are told by their case
            split.append((t if b"<|" in t else _MARK.sub(rb" \g<0>", t.lower())).split())
        known = self.known
        if len(known) > MEMORY:
            for w in list(known)[: MEMORY // 2]:
                del known[w]
        new = set().union(*split).difference(known)
        letters = [w for w in new if _LETTERS.fullmatch(w)]
        known.update(zip(letters, self._letters(letters), strict=True))
        odd = list(new.difference(known))
        for i in range(0, len(odd), 20_000):
            known.update(zip(odd[i : i + 20_000], self._alone(odd[i : i + 20_000]), strict=True))
        return [b"".join(map(known.__getitem__, words)) for words in split]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids, end id included."""
    width = 4 * capacity

    def make():
        words = Words(path)

        def step(batch):
            rows = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(ids), 1000):
                for doc, data in zip(ids[i : i + 1000], words.batch(texts[i : i + 1000]), strict=True):
                    data += b"\0\0\0\0"
                    for k in range(0, len(data), width):
                        part = data[k : k + width]
                        rows.append((doc, k // width, k // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

        return step

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    return arrow_map(texts, make, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, for lengths in descending order.

    ``open_[r]`` holds the bins with ``r`` places left; bit ``r`` of ``mask`` says if any.
    """
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, count = 0, 0
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for i, size in enumerate(lengths.tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_[room].pop()
            if not open_[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, count
            count += 1
        bins[i], offsets[i] = b, capacity - room
        room -= size
        if room:
            open_[room].append(b)
            mask |= 1 << room
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing has fewer bins, by the best of the dual feasible functions for each ``a``."""
    return _bound(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def _bound(n: np.ndarray, capacity: int) -> int:
    """``lower_bound`` of ``n[x]`` items of each length ``x``."""
    count, total = np.cumsum(n), np.cumsum(n * np.arange(capacity + 1))
    a = np.arange(capacity // 2 + 1)
    above = count[-1] - count[capacity - a]  # counted as a whole bin
    below = np.where(a > 0, total[np.maximum(a - 1, 0)], 0)  # counted as nothing
    middle = total[capacity - a] - below
    return int((above + -(-middle // capacity)).max())


def _packed(table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
    lengths = table.column("length").to_numpy()
    bins, offsets = best_fit(lengths, capacity)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    if len(fill) > lower_bound(lengths, capacity):
        again = np.ones(len(bins), dtype=bool)
    else:
        last = int(np.argmin(fill))
        again = (bins == last) & (fill[last] < capacity)
    return table.append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets)).append_column("again", pa.array(again))


def pack(items: DataFrame, capacity: int = CAPACITY, part: int = PART) -> DataFrame:
    """``items`` (``doc_id, piece, start, length, ids_crc32``) with ``sequence_id`` and ``offset``."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint, bin bigint, offset bigint, again boolean"
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pool, done = materialize(items.select(columns), "pieces"), []
    n = np.zeros(capacity + 1, dtype=np.int64)
    for r in pool.groupBy("length").count().collect():
        n[r["length"]] = r["count"]
    left, used, k = int(n.sum()), 0, 0
    best = None  # the present pool's packing with the fewest bins, and their number

    def close(packed: DataFrame, k: int) -> None:
        number = F.lit(k << 48) + F.shiftleft(F.col("part"), 24) + F.col("bin")
        done.append(packed.select(*columns, number.alias("sequence_id"), "offset"))

    while True:
        parts = max(1, -(-left // part))
        dealt = pool.withColumn("part", F.pmod(F.xxhash64(F.lit(k), *columns, F.monotonically_increasing_id()), F.lit(parts)))
        packed = materialize(dealt.groupBy("part").applyInArrow(lambda t: _packed(t, capacity), schema), "packed")
        # a part puts back all its bins, or one, or none
        back = F.when(F.col("again") == F.col("rows"), F.col("bins")).otherwise((F.col("again") > 0).cast("bigint"))
        bins, again, held = (
            packed.groupBy("part")
            .agg((F.max("bin") + 1).alias("bins"), F.count_if("again").alias("again"), F.count(F.lit(1)).alias("rows"))
            .agg(F.coalesce(F.sum("bins"), F.lit(0)), F.coalesce(F.sum("again"), F.lit(0)), F.coalesce(F.sum(back), F.lit(0)))
            .first()
        )
        stuck = again == left and best is not None and bins >= best[1]
        if parts == 1 or not again or stuck:
            packed, bins, k = min(((packed, bins, k), best or (packed, bins, k)), key=lambda x: x[1])
            close(packed, k)
            used += bins
            break
        if again < left:
            close(packed.where("not again"), k)
            pool, left, used = packed.where("again").select(columns), again, used + bins - held
        best = (packed.where("again"), held, k)
        k += 1
    log.info("%d sequences, at least %d needed", used, _bound(n, capacity))
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out


def packed_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    return pack(pieces(docs, path or public_tokenizers.path(VOCABULARY)))


def op10_best_fit_packing(spark, sf_dir) -> DataFrame:
    return packed_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
