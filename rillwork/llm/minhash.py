"""Near-duplicate texts by HyperMinHash.

A text's distinct word shingles are hashed to 64 bits; seven bits choose one of
128 buckets, and the smallest remaining value of each bucket is kept as a 16-bit
register: the number of leading zeros and the ten bits after the leading one.
Empty buckets borrow the register of another bucket by a fixed random order, so
short texts have full sketches too.  Four registers make a band; texts that agree
in a band are candidates.  A pair with a similarity of 0.8 misses all 32 bands
with a probability of 5e-8.

Texts with equal shingle sets are one class.  In every band value the smallest id
is the hub; each other member is compared with it.  Where members of one band
value still lie in different components afterwards, those are compared too, so
copies never meet in all pairs, yet no candidate link between components is left
out: texts that meet a large component are compared with its members in blocks, on
the full sets at once; the others in pairs.  A pair is verified on the full sets if
the sizes allow a link and the collision-corrected estimate is not far below the
limit; at a similarity of 0.8 it is too far below with a probability of 1.4e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillwork.llm.common import add_columns, saved, scratch, small_batches
from rillwork.llm.graph import components

#: Registers, and registers of a band.
BUCKETS, BAND = 128, 4
MANTISSA = 10
REST = 57
#: Share of equal shingles, in hundredths, and words of a shingle.
LEAST = 80
SHINGLE = 2
#: Estimates further below the limit than this are not verified; it is five times their spread there.
MARGIN = 0.18
#: Members of a component that is compared in blocks, and texts of a block.
LARGE = 64
BLOCK = 128
#: Members of a band value that meet at once.
PAIR_BLOCK = 1024


def shingle_set(text: bytes | None, size: int) -> frozenset:
    """The distinct shingles of a text in lower case (A to Z); the whole sequence if it is shorter."""
    words = (text or b"").lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[i:] for i in range(size)]))


def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """A 64-bit hash per shingle, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    short = len(words) < size
    parts = [hashed[i : i + 1] for i in range(len(words))] if short else [
        hashed[i : len(words) - size + 1 + i] for i in range(size)
    ]
    mixed = np.full(len(parts[0]), 0x9E3779B97F4A7C15 + (len(parts) if short else 0), dtype=np.uint64)
    for p in parts:
        mixed ^= p
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
    return mixed


@lru_cache(maxsize=1)
def donors() -> np.ndarray:
    """For every bucket a fixed random order of all buckets."""
    return np.random.default_rng(20).permuted(np.tile(np.arange(BUCKETS), (BUCKETS, 1)), axis=1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set of hashes, sorted by bucket: bucket in the high bits."""
    bucket = (hashes >> np.uint64(REST)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    least = hashes[first] & np.uint64((1 << REST) - 1)
    top = np.frexp((least >> np.uint64(REST - 53)).astype(np.float64))[1]  # bits in use of the highest 53
    shift = np.maximum(top + (REST - 53) - 1 - MANTISSA, 0).astype(np.uint64)
    mantissa = (least >> shift) & np.uint64((1 << MANTISSA) - 1)
    registers = np.full(BUCKETS, -1, dtype=np.int64)
    registers[bucket[first]] = ((53 - top) << MANTISSA) | mantissa.astype(np.int64)
    empty = np.flatnonzero(registers < 0)
    if len(empty):
        order = donors()[empty]
        giver = (registers[order] >= 0).argmax(axis=1)
        registers[empty] = registers[order[np.arange(len(empty)), giver]]
    return registers


def sketches(df: DataFrame, text: str, size: int) -> DataFrame:
    """Replace every text by the size and digest of its shingle set and its registers, four to a number."""

    def make():
        def row(value):
            hashes = np.unique(shingle_hashes(value, size))
            if not len(hashes):
                return 0, None, None
            registers = sketch(hashes).astype(np.uint64).reshape(-1, BAND)
            packed = np.zeros(len(registers), dtype=np.uint64)
            for i in range(BAND):
                packed = (packed << np.uint64(16)) | registers[:, i]
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            return len(hashes), digest, packed.view(np.int64).tolist()

        return row

    fields = [
        ("n_shingles", T.LongType()),
        ("_digest", T.BinaryType()),
        ("_bands", T.ArrayType(T.LongType())),
    ]
    return add_columns(df, [text], fields, make, drop=[text])


def estimate(a: str, b: str, n: str, m: str) -> Column:
    """Similarity by equal registers, less those that agree by chance.

    Two different minima share a register with a probability of about
    0.1699 * 2^-MANTISSA * 4r / (1 + r)^2, where r is the ratio of the set sizes.
    """
    differ = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))

    def lanes(x):
        same = [
            F.when(F.shiftright(x, 16 * i).bitwiseAND(F.lit(0xFFFF)) == 0, 1).otherwise(0) for i in range(BAND)
        ]
        return sum(same[1:], same[0])

    equal = F.aggregate(differ, F.lit(0), lambda total, x: total + lanes(x)) / F.lit(float(BUCKETS))
    ratio = F.col(n) / F.col(m)
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * ratio / ((1 + ratio) * (1 + ratio))
    return (equal - chance) / (1 - chance)


def likely(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Pairs whose sizes and sketches leave a link possible."""
    left = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bands").alias("ra"))
    right = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bands").alias("rb"))
    sized = 100 * F.least("na", "nb") >= least * F.greatest("na", "nb")
    near = estimate("ra", "rb", "na", "nb") >= least / 100 - MARGIN
    return pairs.join(left, "a").join(right, "b").filter(sized & near).select("a", "b").distinct()


def verify(pairs: DataFrame, texts: DataFrame, size: int, least: int) -> DataFrame:
    """Pairs whose full sets have at least ``least`` hundredths of their union in common."""
    small_batches(texts.sparkSession)
    left = texts.select(F.col("id").alias("b"), F.col("text").cast("binary").alias("tb"))
    right = texts.select(F.col("id").alias("a"), F.col("text").cast("binary").alias("ta"))
    joined = pairs.join(left, "b").join(right, "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hub = None, frozenset()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                piece = batch.slice(start, 64)
                linked = []
                for a, ta, tb in zip(*[piece.column(c).to_pylist() for c in ("a", "ta", "tb")]):
                    if a != known or ta != text:
                        known, text, hub = a, ta, shingle_set(ta, size)
                    other = shingle_set(tb, size)
                    both = len(hub & other)
                    linked.append(both > 0 and 100 * both >= least * (len(hub) + len(other) - both))
                yield piece.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return joined.mapInArrow(run, "a bigint, b bigint")


def near_texts(
    df: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE, least: int = LEAST
) -> DataFrame:
    """Components of documents whose shingle sets are at least ``least`` hundredths alike.

    Returns one row per row of ``df``: its id, ``n_shingles`` (size of its set),
    ``component_id`` (smallest id reachable, itself included) and ``kept`` (the id
    is the component's smallest).  Null and empty texts have no shingles and link
    with nothing; a text of fewer than ``size`` words is one shingle; whole texts of
    any length count.  Rows with the same id are one vertex; a null id links with
    nothing and is kept.  An empty table gives an empty result; other columns are
    ignored.  Calling it runs jobs.
    """
    rows = df.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    sketched = saved(sketches(rows, "text", size), "sketches")
    with scratch(df.sparkSession):
        able = F.col("id").isNotNull() & F.col("_digest").isNotNull()
        classes = saved(
            sketched.filter(able)
            .groupBy("_digest")
            .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("_bands").alias("bands")),
            "classes",
        )
        keyed = classes.select("id", F.posexplode("bands").alias("band", "value")).select(
            "id", "band", F.xxhash64("band", "value").alias("key")
        )
        hubs = (
            keyed.groupBy("key")
            .agg(F.min("id").alias("hub"), F.max("id").alias("last"))
            .filter(F.col("hub") != F.col("last"))
            .select(F.col("key").alias("k"), "hub")
        )
        hubs = saved(hubs, "hubs")
        members = saved(
            keyed.join(hubs, F.col("key") == F.col("k")).select("key", "band", "hub", "id"), "members"
        )
        stars = saved(
            members.filter(F.col("hub") != F.col("id"))
            .select(F.col("hub").alias("a"), F.col("id").alias("b"))
            .distinct(),
            "stars",
        )
        ids = saved(members.select(F.col("id").alias("i")).distinct(), "ids")
        texts = saved(rows.join(ids, F.col("id") == F.col("i"), "left_semi"), "texts")
        slim = saved(classes.join(ids, F.col("id") == F.col("i"), "left_semi").drop("_digest"), "slim")
        first = saved(verify(likely(stars, slim, least), texts, size, least), "linked")
        open_ = still_open(members, components(first), slim)
        second = in_blocks(open_, texts, size, least).unionAll(
            verify(in_pairs(open_, least), texts, size, least)
        )
        parts = components(first.unionAll(second))
        known = saved(
            classes.join(parts.withColumnRenamed("id", "p"), F.col("id") == F.col("p"), "left").select(
                F.col("_digest").alias("d"), F.coalesce("component", "id").alias("component")
            ),
            "known",
            outlives=True,
        )
    joined = sketched.withColumn("_d", F.when(F.col("id").isNotNull(), F.col("_digest"))).join(
        known, F.col("_d") == F.col("d"), "left"
    )
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def still_open(members: DataFrame, parts: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of the band values that hold several components, with component, its size, and sketch."""
    sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sized = saved(parts.join(sizes, "component"), "sized").withColumnRenamed("id", "p")
    placed = saved(
        members.join(sized, F.col("id") == F.col("p"), "left").select(
            "key", "band", "id", F.coalesce("component", "id").alias("part"), F.coalesce("size", F.lit(1)).alias("size")
        ),
        "placed",
    )
    split = saved(
        placed.groupBy("key")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .filter("low < high")
        .select(F.col("key").alias("k")),
        "split",
    )
    sketch_of = classes.select(F.col("id").alias("i"), "n", "bands")
    kept = placed.join(split, F.col("key") == F.col("k")).drop("k")
    return saved(kept.join(sketch_of, F.col("id") == F.col("i")).drop("i"), "open")


def in_pairs(open_: DataFrame, least: int) -> DataFrame:
    """Likely pairs of one band value that lie in different components, none of them large.

    The members of a band value are dealt into blocks of about ``PAIR_BLOCK``, and
    each two blocks meet under a key of their own, so no task has all of them.  A pair
    is given out in the first band that it agrees in.
    """
    small = open_.filter(F.col("size") < LARGE)
    blocks = small.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / PAIR_BLOCK).cast("int").alias("blocks"))
    place = F.pmod(F.xxhash64(F.lit(6), "id"), F.col("blocks")).cast("int")
    dealt = small.join(blocks.withColumnRenamed("key", "b"), F.col("key") == F.col("b")).withColumn("place", place)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("place", "other"), "j": F.greatest("place", "other")})
    names = ("id", "part", "n", "bands", "place")
    left = dealt.select("key", "i", "j", "band", *[F.col(c).alias(f"{c}_a") for c in names])
    right = dealt.select(*[F.col(c).alias(f"{c}_") for c in ("key", "i", "j")], *[F.col(c).alias(f"{c}_b") for c in names])
    same = F.zip_with("bands_a", "bands_b", lambda x, y: x == y)
    found = (
        (F.col("key") == F.col("key_"))
        & (F.col("i") == F.col("i_"))
        & (F.col("j") == F.col("j_"))
        & (F.col("id_a") < F.col("id_b"))
        # Two members of one block meet where the block meets itself.
        & ((F.col("place_a") != F.col("place_b")) | (F.col("i") == F.col("j")))
        & (F.col("part_a") != F.col("part_b"))
        & (100 * F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b"))
        & (F.array_position(same, True) == F.col("band") + 1)
        & (estimate("bands_a", "bands_b", "n_a", "n_b") >= least / 100 - MARGIN)
    )
    return saved(left.join(right, found).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), "pairs")


def in_blocks(open_: DataFrame, texts: DataFrame, size: int, least: int) -> DataFrame:
    """Links (a, b) between texts and large components that share a band value with them.

    Of two components the smaller one's texts are compared with all open members of
    the larger one; one link per text and block is enough for the components.
    """
    large = open_.filter(F.col("size") >= LARGE)
    met = saved(
        large.select(F.col("key").alias("k"), F.col("part").alias("whole"), F.col("size").alias("s")).distinct(), "met"
    )
    smaller = (F.col("size") < F.col("s")) | ((F.col("size") == F.col("s")) & (F.col("part") < F.col("whole")))
    guests = (
        open_.join(met, (F.col("key") == F.col("k")) & (F.col("part") != F.col("whole")) & smaller)
        .select("whole", "id", F.lit(1).alias("guest"))
        .distinct()
    )
    own = large.select(F.col("part").alias("whole"), "id", F.lit(0).alias("guest")).distinct()
    both = saved(guests.unionAll(own), "sides")
    counts = saved(
        both.groupBy("whole").agg(
            F.ceil(F.sum("guest") / BLOCK).cast("int").alias("guests"),
            F.ceil(F.sum(1 - F.col("guest")) / BLOCK).cast("int").alias("owns"),
        ).filter("guests > 0"),
        "counts",
    )
    hashed = F.xxhash64(F.lit(5), "id")
    place = F.pmod(hashed, F.when(F.col("guest") == 1, F.col("guests")).otherwise(F.col("owns"))).cast("int")
    other = F.sequence(F.lit(0), F.when(F.col("guest") == 1, F.col("owns")).otherwise(F.col("guests")) - 1)
    dealt = both.join(counts, "whole").select(
        "whole", "guest", "id", place.alias("place"), F.explode(other).alias("other")
    )
    tasks = dealt.select(
        "whole", "guest", "id",
        F.when(F.col("guest") == 1, F.col("place")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("guest") == 1, F.col("other")).otherwise(F.col("place")).alias("j"),
    )
    named = texts.select(F.col("id").alias("t"), F.col("text").cast("binary").alias("text"))
    full = tasks.join(named, F.col("id") == F.col("t")).drop("t")

    def run(table: pa.Table) -> pa.Table:
        links = block_links(
            *[
                [(i, shingle_set(t, size)) for g, i, t in zip(*[table[c].to_pylist() for c in ("guest", "id", "text")]) if g == side]
                for side in (1, 0)
            ],
            least,
        )
        return pa.table(
            {"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())}
        )

    return saved(full.groupBy("whole", "i", "j").applyInArrow(run, "a bigint, b bigint"), "block-links")


def block_links(guests: list, owns: list, least: int) -> list[tuple[int, int]]:
    """For every guest the first member whose set is at least ``least`` hundredths alike, if any."""
    number: dict = {}
    for _, shingles in guests:
        for g in shingles:
            number.setdefault(g, len(number))
    inside = np.zeros((len(number), len(guests)), dtype=np.uint8)
    for i, (_, shingles) in enumerate(guests):
        inside[[number[g] for g in shingles], i] = 1
    sizes = np.array([len(s) for _, s in guests])
    open_ = np.ones(len(guests), dtype=bool)
    out = []
    for id, shingles in owns:
        rows = [number[g] for g in shingles if g in number]
        if not rows:
            continue
        shared = inside[rows].sum(axis=0, dtype=np.int64)
        linked = open_ & (shared > 0) & (100 * shared >= least * (sizes + len(shingles) - shared))
        for i in np.flatnonzero(linked):
            out.append((guests[i][0], id))
        open_ &= ~linked
    return out


def keep_first(df: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """The rows of ``df``, with all columns, whose id is the smallest of its component.

    Rows with one id are one document; they stay together.  Rows without an id,
    and null and empty texts, which link with nothing, stay; an empty table stays
    empty; columns may have any names.  Calling it runs jobs.
    """
    with scratch(df.sparkSession):
        found = near_texts(df, id, text, size, least)
        gone = found.filter(~F.col("kept")).select(F.col(id).alias("_gone")).distinct()
        dropped = saved(gone, "gone", outlives=True)
    # The row travels as one column, so its columns cannot clash with the operator's own.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(id).cast("bigint").alias("_id"))
    return rows.join(dropped, F.col("_id") == F.col("_gone"), "left_anti").select("_row.*")
