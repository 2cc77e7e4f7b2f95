"""How the sources of a language differ in their words, with texts of terms kept out of the shuffles.

Terms are counted under 64-bit digests: each task adds up the terms of its
documents per language and source, and writes them with their digests; a term's
text is written beside it the first time the task sees it, and stays there.  Only
digests and numbers are shuffled and ranked.  The smallest and the largest text of
a digest tell whether two terms share it; such a digest is split: its terms alone
are counted again under digests of another seed.  Texts are joined back to the
terms that are reported, and to those that tie with the last of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillwork.llm.common import SLICE_ROWS, saved, scratch, small_batches

#: Documents of a language that have a term before the term is kept, and terms reported per source.
LEAST_DOCS, MOST_TERMS = 10, 10
#: Terms per language and source that a task adds up before it writes them, and terms that it knows to be written.
HELD_TERMS, SEEN_TERMS = 600_000, 600_000

#: Bytes between terms become spaces, A-Z becomes a-z; bytes of longer characters belong to terms.
TERM_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
POSTINGS = "lang string, source string, digest bigint, n bigint, n_docs bigint, term string"


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text: runs of A-Z, a-z and all characters beyond U+007F, with A-Z as a-z."""
    return (text or b"").translate(TERM_BYTES).split()


def digest(term: bytes, bits: int, split: set[int], only: set[int] | None = None) -> int | None:
    """The first of a term's digests by seed that is not in ``split``, as a signed number.

    The first seed's has ``bits`` bits.  With ``only``, none unless one before it is in ``only``.
    """
    hit = only is None
    for seed in range(1 << 16):
        found = xxhash.xxh64_intdigest(term, seed)
        found = found >> (64 - bits) if not seed else found
        found = found - (1 << 64) if found >> 63 else found
        if found not in split:
            return found if hit else None
        hit = hit or found in only
    raise ValueError("a term shares its digests under every seed")


def postings(docs: DataFrame, bits: int, split: set[int], only: set[int] | None = None) -> DataFrame:
    """Counts of terms and of documents per language, source and digest, as far as one task adds them up.

    A term's text is given the first time; with ``only``, only terms that ``digest`` finds are.
    """
    small_batches(docs.sparkSession)
    names = ["lang", "source", "digest", "n", "n_docs", "term"]
    plain = bits == 64 and not split and only is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        seen: set[bytes] = set()

        def written() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, n_docs) in counts.items():
                found = list(n)
                if plain:
                    marks = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)).view(np.int64)
                else:
                    marks = [digest(t, bits, split, only) for t in found]
                if only is not None:
                    found = [t for t, d in zip(found, marks) if d is not None]
                    marks = [d for d in marks if d is not None]
                texts = pa.array([None if t in seen else t for t in found], pa.binary())
                seen.update(found)
                arrays = [pa.array([v] * len(found), pa.string()) for v in (lang, source)]
                arrays += [pa.array(v, pa.int64()) for v in (marks, list(map(n.__getitem__, found)), list(map(n_docs.__getitem__, found)))]
                yield pa.RecordBatch.from_arrays([*arrays, texts.cast(pa.string())], names=names)
            counts.clear()
            if len(seen) > SEEN_TERMS:
                seen.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(start, SLICE_ROWS)
                texts = piece.column("text").cast(pa.binary()).to_pylist()
                for lang, source, text in zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), texts):
                    n, n_docs = counts.setdefault((lang, source), (Counter(), Counter()))
                    here = terms(text)
                    n.update(here)
                    n_docs.update(set(here))
                if sum(len(n) for n, _ in counts.values()) > HELD_TERMS:
                    yield from written()
        yield from written()

    return docs.mapInArrow(run, POSTINGS)


def counted(docs: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Counts per language, source and digest, and the term of every digest; no two terms share one.

    Two of n terms share a 64-bit digest in n * n / 2 ** 65 cases on average, so the
    digests to split are few; they alone go to the driver and to the tasks.
    """
    split: set[int] = set()
    posted = saved(postings(docs, bits, split), "audit-postings")
    while True:
        texts = posted.filter(F.col("term").isNotNull()).groupBy("digest")
        names = saved(texts.agg(F.min("term").alias("term"), F.max("term").alias("_last")), "audit-terms")
        shared = {r.digest for r in names.filter(F.col("term") != F.col("_last")).select("digest").collect()}
        if not shared:
            break
        split |= shared
        found = docs.sparkSession.createDataFrame([(d,) for d in sorted(shared)], "digest bigint")
        rest = posted.join(F.broadcast(found), "digest", "left_anti").select(*posted.columns)
        posted = saved(rest.unionByName(postings(docs, bits, split, shared)), "audit-postings")
    sums = posted.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    return sums, names.select("digest", "term")


def share(n: str, total: str, kept: str) -> Column:
    """A smoothed share in billionths; exact at every size, null where nothing is kept."""
    return F.expr(
        f"1 + (CAST(1000000000 AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))) "
        f"div CAST(nullif({total} + 2 * {kept}, 0) AS DECIMAL(20,0))"
    )


def apart(p: str, q: str) -> Column:
    """Triangular divergence of two shares: the square of their difference by their sum, rounded down."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """Divergence of every two sources of a language over all kept terms, both ways.

    Most terms are missing from most sources, and a missing term has one share per
    source.  So the sum begins with all terms as missing from both, corrects it for
    the terms of each side (by how many have a count), and for the terms of both.
    """
    one = groups.select("lang", F.col("source").alias("a"), "v", F.col("none").alias("none_a"))
    two = groups.select("lang", F.col("source").alias("b"), F.col("none").alias("none_b"))
    lo, hi = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")

    missing = one.join(two, "lang").filter(F.col("a") < F.col("b"))
    missing = missing.select("lang", "a", "b", (F.col("v") * apart("none_a", "none_b")).alias("value"))

    sizes = kept.groupBy("lang", F.col("source").alias("a"), "p", F.col("none").alias("none_a"))
    sizes = sizes.agg(F.count(F.lit(1)).alias("terms"))
    sided = sizes.join(two, "lang").filter(F.col("a") != F.col("b"))
    more = F.col("terms") * (apart("p", "none_b") - apart("none_a", "none_b"))
    sided = sided.select("lang", lo, hi, more.alias("value"))

    left = kept.select("lang", "digest", F.col("source").alias("a"), F.col("p").alias("p_a"), F.col("none").alias("none_a"))
    right = kept.select("lang", "digest", F.col("source").alias("b"), F.col("p").alias("p_b"), F.col("none").alias("none_b"))
    both = left.join(right, ["lang", "digest"]).filter(F.col("a") < F.col("b"))
    more = apart("p_a", "p_b") - apart("p_a", "none_b") - apart("none_a", "p_b") + apart("none_a", "none_b")
    both = both.select("lang", "a", "b", more.alias("value"))

    summed = missing.unionByName(sided).unionByName(both).groupBy("lang", "a", "b").agg(
        F.coalesce(F.sum("value"), F.lit(0)).alias("value")
    )
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return summed.select("lang", F.explode(ways).alias("way"), "value").select("lang", "way.*", "value")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS, bits: int = 64) -> DataFrame:
    """How sources of a language differ: ``lang, source, part, item, value, rank``.

    Part ``pair`` has every other source of the language, part ``term`` the terms
    that the source uses more than its language, with the largest divergence first,
    ties by the item's bytes.  ``docs`` needs text, lang and source; null is the
    empty string in each, and other columns are not read.  Every row is a document
    of its own, also where rows repeat.  A language without kept terms has pairs of
    value 0; a source alone in its language has none; an empty table gives no rows.
    ``bits`` shortens the first digests, for tests.  Calling it runs jobs.
    """
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    with scratch(docs.sparkSession):
        sums, names = counted(docs, bits)
        of_term = Window.partitionBy("lang", "digest")
        kept = sums.withColumns(
            {
                "_docs": F.sum("n_docs").over(of_term),
                "n_lang": F.sum("n").over(of_term),
                "first": F.col("source") == F.min("source").over(of_term),
            }
        )
        kept = saved(kept.filter(F.col("_docs") >= least_docs).drop("_docs", "n_docs"), "audit-kept")

        totals = kept.groupBy("lang", "source").agg(
            F.sum("n").alias("total"), F.count_if("first").alias("terms_first")
        )
        groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
        of_lang = Window.partitionBy("lang")
        groups = groups.fillna(0, ["total", "terms_first"]).withColumns(
            {"v": F.sum("terms_first").over(of_lang), "lang_total": F.sum("total").over(of_lang)}
        )
        groups = saved(groups.withColumn("none", share("0", "total", "v")).drop("terms_first"), "audit-groups")
        kept = kept.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "v"))

        used = kept.withColumn("q", share("n_lang", "lang_total", "v")).filter(F.col("p") > F.col("q"))
        used = used.select("lang", "source", "digest", apart("p", "q").alias("value"))
        by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        best = saved(used.withColumn("_rank", F.rank().over(by_value)).filter(F.col("_rank") <= most_terms), "audit-best")
        in_order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        named = best.join(names, "digest").withColumn("item", F.col("term"))
        best = named.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= most_terms)

        other = pairs(groups, kept).withColumn("rank", F.row_number().over(in_order))
        shown = [
            part.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
            for name, part in (("pair", other), ("term", best))
        ]
        return saved(shown[0].unionByName(shown[1]), "audit", outlives=True)
