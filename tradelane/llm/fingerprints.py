"""Document fingerprints by one-permutation MinHash, in built-in functions only.

Every five-word shingle is hashed once. The top bits of the hash name one of ``BINS`` bins
and each bin keeps its least value. An empty bin is filled by optimal densification: it
tries other bins in a pseudo-random order of its own and borrows from the first full one (after
``TRIES`` in vain, from the full bin with the least hash beside its own number). Of each bin the low
eight bits are stored, seven bins packed into a long; the likeness of two fingerprints
is the share of equal bins, corrected for the 1 in 256 that agree by chance.

Words are split at white space after lower-casing; a text with fewer than five words is one
shingle. Null and empty texts, and texts without words, have the empty fingerprint: like each
other (1.0), unlike any other (0.0). Texts are read whole, a very long one within one row; repeated
rows and ids are rows like others, null ids come last; an empty table gives an empty result; other
columns pass through ``with_fingerprint``.

The query needs every document's successor. The table is dealt out by range of its ids once and
written in order with running numbers; neighbours then meet in slices of ``SLICE`` rows. No cut is
a literal: the plan does not grow with the rows, and the driver collects none.
"""

from __future__ import annotations

from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelane.llm.common import NO_ID, read
from tradelane.session import new_path, shuffles_dropped

BIN_BITS = 8
BINS = 1 << BIN_BITS
WORDS = 5
LANES = 7
#: Bits of a bin's value below the bin number: 56-bit hashes.
LOW_BITS = 56 - BIN_BITS
LOW = (1 << LOW_BITS) - 1
#: Factors and addends (48 bits) of an empty bin's first tries.
TRIES = [tuple(Random(k).getrandbits(48) | 1 for _ in range(2)) for k in range(16)]
#: Rows of one slice when neighbours are looked up, a power of two.
SLICE = 512
#: Bits of a row's number within its range partition, as Spark numbers rows.
RANGE_BITS = 33


def with_fingerprint(df: DataFrame, text: str, out: str, packed: str | None = None) -> DataFrame:
    """``df`` with the hex fingerprint of column ``text`` in ``out``, and as longs in ``packed``."""
    kept = df.columns
    none = F.slice(F.array(F.lit(0).cast("bigint")), 1, 0)  # an array without nulls is sorted as plain longs
    empties = F.array(*[F.lit((b << LOW_BITS) | LOW).cast("bigint") for b in range(BINS)])
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+"), lambda w: w != "")
    step = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("_h")
    shingle = F.when(
        n >= WORDS,
        F.transform(
            F.sequence(F.lit(1), F.greatest(n - (WORDS - 1), F.lit(1))),
            lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get("_h", i + (j - 1)) for j in range(WORDS)]), 8),
        ),
    ).otherwise(F.when(n > 0, F.array(F.shiftrightunsigned(F.xxhash64("_h"), 8))).otherwise(none))
    step = step.withColumn("_s", F.sort_array(F.concat(shingle, empties)))
    # the first of each run of equal bins: one value per bin, in bin order
    step = step.withColumn(
        "_d",
        F.filter(
            "_s",
            lambda v, i: (i == 0)
            | (F.shiftrightunsigned(v, LOW_BITS) != F.shiftrightunsigned(F.get("_s", i - 1), LOW_BITS)),
        ),
    ).withColumn("_f", F.filter("_d", lambda v: v.bitwiseAND(LOW) != LOW))

    def borrowed(v: Column) -> Column:
        rank = F.transform(
            "_f",
            lambda x: F.xxhash64(F.shiftrightunsigned(v, LOW_BITS), F.shiftrightunsigned(x, LOW_BITS))
            .bitwiseAND(~255)
            .bitwiseOR(x.bitwiseAND(255)),
        )
        return F.array_min(rank).bitwiseAND(255)

    step = step.withColumn("_n", F.transform("_d", lambda v: F.when(v.bitwiseAND(LOW) != LOW, v.bitwiseAND(255))))

    def tried(v: Column) -> list[Column]:
        """The bins an empty bin tries first, by multiply-shift hashing of its number."""
        b = F.shiftrightunsigned(v, LOW_BITS)
        return [F.get("_n", F.shiftrightunsigned(b * F.lit(m) + F.lit(a), 40).bitwiseAND(BINS - 1).cast("int")) for m, a in TRIES]

    step = step.withColumn(
        "_b",
        F.transform(
            "_d", lambda v: F.when(v.bitwiseAND(LOW) != LOW, v.bitwiseAND(255)).otherwise(F.coalesce(*tried(v), borrowed(v)))
        ),
    )

    def lane(i: Column) -> Column:
        value = F.lit(0).cast("bigint")
        for j in range(LANES):
            value = value.bitwiseOR(F.shiftleft(F.coalesce(F.get("_b", i + j), F.lit(0).cast("bigint")), 8 * j))
        return value

    lanes = F.when(F.size("_f") > 0, F.transform(F.sequence(F.lit(0), F.lit(BINS - 1), F.lit(LANES)), lane))
    step = step.withColumn("_l", lanes)
    return step.select(*kept, as_text("_l").alias(out), *([F.col("_l").alias(packed)] if packed else []))


def as_text(packed: str) -> Column:
    """Packed longs as hex lanes; empty for the empty fingerprint."""
    lanes = F.transform(packed, lambda x: F.lpad(F.hex(x), 2 * LANES, "0"))
    return F.coalesce(F.array_join(lanes, ""), F.lit(""))


def likeness(a: str, b: str) -> Column:
    """Bias-corrected share of equal bins of two packed fingerprints."""

    def differ(x: Column) -> Column:
        x = x.bitwiseOR(F.shiftrightunsigned(x, 4))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseAND(0x01010101010101)).cast("bigint")

    off = F.aggregate(F.zip_with(a, b, lambda x, y: differ(x.bitwiseXOR(y))), F.lit(0).cast("bigint"), lambda s, x: s + x)
    share = (F.lit(1.0) - off / F.lit(float(BINS)) - F.lit(1 / 256)) / F.lit(255 / 256)
    return (
        F.when(F.col(a).isNull() & F.col(b).isNull(), F.lit(1.0))
        .when(F.col(a).isNull() | F.col(b).isNull(), F.lit(0.0))
        .otherwise(F.greatest(share, F.lit(0.0)))
    )


def in_order(df: DataFrame, order: str, ties: list[str]) -> DataFrame:
    """``df`` written in descending ``order``, with ``_at``: a row's place, growing along the order.

    Rows are dealt out by range, sorted there and numbered; the number of the range is in the upper
    bits. Nulls come last; rows of equal ``order`` follow by ``ties``, and equal rows by their place
    in the input, so that they are dealt out like any others.
    """
    spark = df.sparkSession
    by = [F.col("_key").desc(), *ties, "_row"]
    path = new_path(spark, "ordered")
    keyed = df.withColumn("_key", F.coalesce(order, F.lit(NO_ID))).withColumn("_row", F.monotonically_increasing_id())
    placed = keyed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.drop("_key", "_row")
    with shuffles_dropped(spark):
        placed.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def with_next(placed: DataFrame, columns: list[str]) -> DataFrame:
    """A table :func:`in_order` with ``next_<c>`` of the following row; the last is followed by the first.

    Windows hold ``SLICE`` rows of one range and the first row of the slice after; which slice goes
    before a range's first one is looked up in a table of one row per range.
    """
    bits = SLICE.bit_length() - 1
    ranges = placed.groupBy(F.shiftright("_at", RANGE_BITS).alias("_range")).agg(F.max("_at").alias("_last"))
    along = Window.orderBy("_range")  # as many rows as ranges
    everything = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ranges.select("_range", F.coalesce(F.lag("_last").over(along), F.max("_last").over(everything)).alias("_before"))
    first = placed.where(F.col("_at").bitwiseAND(SLICE - 1) == 0)
    begins = F.col("_at").bitwiseAND((1 << RANGE_BITS) - 1) == 0
    handed = first.join(F.broadcast(before), F.shiftright("_at", RANGE_BITS) == F.col("_range")).withColumn(
        "_slice", F.when(begins, F.shiftright("_before", bits)).otherwise(F.shiftright("_at", bits) - 1)
    )
    rows = placed.withColumn("_slice", F.shiftright("_at", bits)).withColumn("_handed", F.lit(0))
    rows = rows.unionByName(handed.drop("_range", "_before").withColumn("_handed", F.lit(1)))
    window = Window.partitionBy("_slice").orderBy("_handed", "_at")
    return (
        rows.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
        .where("_handed = 0")
        .drop("_at", "_slice", "_handed")
    )


def op1_document_fingerprints(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    packed = with_fingerprint(in_order(docs, "doc_id", ["text"]), "text", "fingerprint", "_p").drop("fingerprint")
    both = with_next(packed, ["text", "_p"])
    n = F.char_length("text")
    half = F.floor(n / F.lit(2)).cast("int")
    both = both.withColumn("n_chars", n.cast("bigint")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    ).withColumn("edited_sha256", F.sha2("edited", 256)).drop("text", "next_text")
    return with_fingerprint(both, "edited", "edited_fingerprint", "_e").select(
        "doc_id", "n_chars", "edited_sha256", as_text("_p").alias("fingerprint"), "edited_fingerprint",
        likeness("_p", "_e").alias("near_edited"), likeness("_p", "next__p").alias("near_next"),
    )
