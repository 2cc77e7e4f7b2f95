"""Secrets in texts, found with DataFrame functions alone.

Three plain patterns (assignments, access keys, hexadecimal strings) come first.
The method adds tokens that look random: two first-order Markov models of
characters, one of random strings and one of ordinary words, are compared by
their log-likelihood ratio.  The models are trained on labelled samples: values
that the plain patterns caught, and strings that are random by construction
(base 64 and hexadecimal digests of ids), against the ordinary words of a bounded
sample of texts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import saved, scratch

#: Kinds in the order in which spans that begin at one place are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"(?=[pPsStTaA])((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: A run of the characters that is long enough is a match of the open pattern that is not dropped, and the other way round.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
LEAST_ASSIGNED = 6
#: Tokens that the models judge, the characters they know, and the limits of the ratio: in all and per character.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}+"
#: Ordinary words are whole ones that are too short to be judged: pieces of keys in the texts would be learnt as words.
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{3,19}+(?![A-Za-z0-9+/_=-])"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_RATIO = 12.0
LEAST_MEAN = 0.5
#: The limits for tokens without a digit: ordinary words run together come nearer to random strings than words with numbers do.
LETTERS_RATIO = 40.0
LETTERS_MEAN = 2.0
#: Texts that give ordinary words, and caught values, that the models are trained on at most (about).
TRAIN_TEXTS = 2_000
TRAIN_VALUES = 20_000
#: Weight of the single characters' frequencies in every row of a model.
PRIOR = 5.0
MASK = "[SECRET]"
#: Matches that are numbered together, and bits of the number of spans of one kind in a text.
BLOCK = 256
SPAN_BITS = 30


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def in_blocks(items: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` items.  Work that copies what it has so far then copies a block at most."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    return F.transform(numbers, lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def so_far(values: Column, begin: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What ``add`` makes of the values before each one."""
    state = F.struct(begin.alias("at"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, value: Column) -> Column:
        here = F.concat(state["out"], F.array(state["at"]))
        return F.struct(add(state["at"], value).alias("at"), here.alias("out"))

    return F.aggregate(values, state, step, lambda s: s["out"])


def found(text: Column, pattern: str, kind: str, value_group: int = 0, least: int = 0) -> Column:
    """Matches of a pattern as an array of (start, end, kind, value), in code points, end exclusive.

    The text between matches and the matches alternate, so their lengths give
    the places: lengths are added up per block of matches, then inside each block.
    Null and empty texts have no match.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else whole
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"), value.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>")

    def length(x: Column) -> Column:
        return F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = state["at"] + length(x)
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        taken = x["hit"].isNotNull() & (F.length(x["value"]) >= least)
        return F.struct(end.alias("at"), F.when(taken, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    def placed(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + length(x)))
        starts = so_far(sizes, F.lit(0), lambda n, size: n + size)
        one = lambda b, at: F.aggregate(b, F.struct(at.alias("at"), empty.alias("out")), step, lambda s: s["out"])
        return F.flatten(F.zip_with(blocks, starts, one))

    spans = let(pieces, lambda p: let(in_blocks(p), placed))
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(empty)


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    """Whether one of some spans, which are in order and apart from each other, overlaps a stretch.

    Only the last span that begins before the stretch ends can; it is found by halving.
    """
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(SPAN_BITS))])

    def step(n: Column, power: Column) -> Column:
        return F.when(F.coalesce(F.get(spans, n + power - 1)["start"] < end, F.lit(False)), n + power).otherwise(n)

    return let(F.aggregate(powers, F.lit(0), step), lambda n: F.coalesce(F.get(spans, n - 1)["end"] > start, F.lit(False)))


def with_base(df: DataFrame, text: str) -> DataFrame:
    """Add the plain patterns' spans by kind: ``_assign``, ``_access``, ``_hex``."""
    t = F.col(text)
    return df.withColumns(
        {
            "_assign": found(t, ASSIGN, "assign", 2, LEAST_ASSIGNED),
            "_access": found(t, ACCESS, "access"),
            "_hex": found(t, HEX, "hex"),
        }
    )


def code(character: Column) -> Column:
    """Place of a character in the alphabet, 0 for all others."""
    return F.instr(F.lit(ALPHABET), character)


def transitions(strings: DataFrame, column: str) -> DataFrame:
    """How often each pair of neighbouring characters occurs: ``pair`` (a number), ``n``."""
    c = F.col(column)
    pairs = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))
    cut = strings.filter(F.length(c) >= 2).select(F.explode(pairs).alias("two"))
    width = len(ALPHABET) + 1
    number = code(F.substring("two", 1, 1)) * width + code(F.substring("two", 2, 1))
    return cut.groupBy("two").agg(F.count(F.lit(1)).alias("n")).groupBy(number.alias("pair")).agg(F.sum("n").alias("n"))


def smoothed(counts: dict[int, int]) -> list[float]:
    """Log-probabilities of a character after another.

    Every row is mixed with ``PRIOR`` draws from the frequencies of single
    characters, one added to each, so that a character that never begins a pair
    still says how common its successor is.
    """
    width = len(ALPHABET) + 1
    single = [1 + sum(counts.get(first * width + c, 0) for first in range(width)) for c in range(width)]
    whole = sum(single)
    out = []
    for first in range(width):
        row = [counts.get(first * width + c, 0) + PRIOR * single[c] / whole for c in range(width)]
        total = sum(row)
        out += [log(n / total) for n in row]
    return out


def train(df: DataFrame, base: DataFrame, text: str) -> list[float]:
    """The log-likelihood ratio of every transition, random over ordinary.

    ``base`` has the plain patterns' spans of the texts of ``df``.  About ``TRAIN_TEXTS`` texts and
    ``TRAIN_VALUES`` caught values are used, chosen by a hash of the text or value;
    what reaches the driver is one count per pair of characters, 4,624 at most.
    """
    def chosen(column: Column, most: int, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most / max(n, 1)))

    n_texts, n_values = base.agg(
        F.count(F.lit(1)), F.sum(F.size("_assign") + F.size("_access") + F.size("_hex"))
    ).first()
    some = df.filter(F.col(text).isNotNull() & chosen(F.col(text), TRAIN_TEXTS, n_texts))
    ordinary = some.select(F.explode(F.regexp_extract_all(text, F.lit(ORDINARY), F.lit(0))).alias("s"))
    caught = base.select(F.explode(F.concat("_assign", "_access", "_hex")).alias("x")).select(
        F.col("x.value").alias("s")
    )
    caught = caught.filter(chosen(F.col("s"), TRAIN_VALUES, n_values or 0))
    digest = F.sha2(F.col(text), 256)
    made = some.select(F.explode(F.array(F.base64(F.unhex(digest)), digest)).alias("s"))
    both = transitions(ordinary, "s").withColumn("model", F.lit(0)).unionAll(
        transitions(caught.unionAll(made), "s").withColumn("model", F.lit(1))
    )
    counts: tuple[dict, dict] = ({}, {})
    for row in both.collect():
        counts[row.model][row.pair] = row.n
    plain, odd = smoothed(counts[0]), smoothed(counts[1])
    return [b - a for a, b in zip(plain, odd)]


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token under the two models."""
    table = F.lit(model)
    width = len(ALPHABET) + 1
    codes = F.transform(F.split(token, ""), code)
    begin = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last"))

    def step(state, c):
        gained = F.when(state["last"] < 0, F.lit(0.0)).otherwise(F.get(table, state["last"] * width + c))
        return F.struct((state["sum"] + gained).alias("sum"), c.alias("last"))

    return F.aggregate(codes, begin, step, lambda s: s["sum"])


def scan(df: DataFrame, text: str = "text", id: str | None = None) -> DataFrame:
    """Add ``_assign``, ``_access``, ``_hex`` and ``_random``: arrays of (start, end, kind, value).

    Whole texts of any length are searched; null and empty texts have no spans; an
    empty table stays empty; repeated rows are searched like any others.  Spans of
    the models overlap no span of the plain patterns; tokens without a digit have higher
    limits, and those without a letter are no secrets, because the models cannot tell keys
    of digits from other numbers.  Input columns of these four names are replaced.  Calling it runs jobs: the texts are searched for the plain
    patterns once for training and once for the result, so no copy of them is written.
    """
    base = with_base(df, text)
    with scratch(df.sparkSession):
        model = train(df, saved(base.select("_assign", "_access", "_hex"), "spans"), text)
    judged = F.transform(
        F.filter(found(F.col(text), TOKEN, "random"), lambda s: s["value"].rlike("[A-Za-z]")),
        lambda s: F.struct(
            s.alias("span"), ratio(s["value"], model).alias("ratio"), s["value"].rlike("[0-9]").alias("digits")
        ),
    )

    def limit(s: Column, with_digits: float, letters: float) -> Column:
        return F.when(s["digits"], with_digits).otherwise(letters)

    random = F.filter(
        judged,
        lambda s: (s["ratio"] >= limit(s, LEAST_RATIO, LETTERS_RATIO))
        & (s["ratio"] >= limit(s, LEAST_MEAN, LETTERS_MEAN) * F.length(s["span"]["value"]))
        & ~reduce(lambda a, b: a | b, [overlaps(F.col(f"_{k}"), s["span"]["start"], s["span"]["end"]) for k in KINDS[:3]]),
    )
    return base.withColumn("_random", F.transform(random, lambda s: s["span"]))


def listed(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of all spans of some kinds, by start, then kind as listed."""
    spans = reduce(lambda a, b: F.concat(a, b), [F.col(f"_{k}") for k in kinds])
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("s"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("e"))
    )
    return F.array_join(
        F.transform(
            F.array_sort(keyed),
            lambda s: F.concat_ws(":", F.get(order, (s["k"] - 1).cast("int")), s["s"].cast("string"), s["e"].cast("string")),
        ),
        ",",
    )


def report(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: its id, counts of the plain kinds, their digest, and all spans.

    Null and empty texts have none; repeated rows get a row each; an empty table
    gives no rows; other columns are ignored.
    """
    scanned = scan(df.select(F.col(id), F.col(text)), text)
    return scanned.select(
        id,
        *[F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(KINDS[:3]), 256).alias("base_sha256"),
        listed(KINDS).alias("spans"),
        F.size("_random").cast("bigint").alias("n_random"),
    )


def masked(text: Column) -> Column:
    """The text with every stretch that any span covers replaced by ``MASK``."""
    spans = F.array_sort(
        F.transform(
            F.concat("_assign", "_access", "_hex", "_random"),
            lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e")),
        )
    )

    def one(block: Column, before: Column) -> Column:
        """The text from the end of the spans before a block to the end of the block's own, masked."""
        whole = F.substring(text, before + 1, F.greatest(before, last_end(block)) - before)

        def masked_part(part: Column) -> Column:
            begin = F.struct(before.alias("at"), F.array().cast("array<string>").alias("out"))

            def step(state: Column, s: Column) -> Column:
                gap = F.substring(part, state["at"] - before + 1, s["s"] - state["at"])
                here = F.when(s["s"] >= state["at"], F.concat(gap, F.lit(MASK))).otherwise("")
                return F.struct(
                    F.greatest(state["at"], s["e"]).alias("at"), F.concat(state["out"], F.array(here)).alias("out")
                )

            return F.aggregate(block, begin, step, lambda s: F.array_join(s["out"], ""))

        return let(whole, masked_part)

    def last_end(block: Column) -> Column:
        return F.array_max(F.transform(block, lambda s: s["e"]))

    def joined(blocks: Column) -> Column:
        ends = F.transform(blocks, last_end)
        parts = F.zip_with(blocks, so_far(ends, F.lit(0), lambda a, b: F.greatest(a, b)), one)
        return F.concat(F.array_join(parts, ""), F.substring(text, F.array_max(ends) + 1, F.length(text)))

    return F.when(F.size(spans) > 0, let(spans, lambda s: let(in_blocks(s), joined))).otherwise(text)


def mask(df: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """Every row of ``df`` with its secrets masked; a column ``length`` counts the new text's characters.

    Null and empty texts stay as they are, and so does an empty table; repeated rows
    all stay; other columns may have any names.
    """
    # The row travels as one column, so its columns cannot clash with the operator's own.
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    inside = f"_row.{text}"
    scanned = scan(packed, inside).withColumn("_new", masked(F.col(inside)))
    row = F.col("_row").withField(text, F.col("_new"))
    if length in df.columns:
        counted = F.coalesce(F.length("_new"), F.col("_row")[length]).cast(df.schema[length].dataType)
        row = row.withField(length, counted)
    return scanned.select(row.alias("_row")).select("_row.*")
