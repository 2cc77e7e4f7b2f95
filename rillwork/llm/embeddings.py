"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

The cells only save comparisons, they lose no link.  Let x lie in the cell of
centre c, and let y be linked to x.  Unit vectors with cosine ``least`` or more
are at most ``reach = sqrt(2 - 2 * least)`` apart, and x is no nearer to any other
centre d, so y.d - y.c <= reach * |d - c| for every d.  A vector is therefore a
member of the cell of its nearest centre and a guest of each cell of a smaller
number that meets this bound; every pair then meets exactly once.  Well separated
cells have few guests; vectors without any structure are compared with all
vectors of their label, which no exact method avoids.

Members and guests of a cell are dealt into blocks of bounded size, and a task
multiplies two blocks.  Equal vectors are compared as one.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import saved
from rillwork.llm.graph import components

#: Different vectors of one label that get a cell, and rows of a block.
CELL_ROWS = 1024
#: Most centres in all, and most sampled vectors per centre that they are fitted on.
MOST_CENTRES = 4096
FIT_PER_CENTRE = 64
#: Most numbers in the sample of one label (256 MB), and rows of it that are compared with all centres at once.
FIT_NUMBERS = 1 << 25
FIT_ROWS = 1024
ROUNDS = 6


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of vectors of one length as rows, without a Python number for each component."""
    column = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def unit(rows) -> np.ndarray:
    """Rows as unit vectors in double precision; scaling first keeps squares in range."""
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def usable(vector: str, label: str) -> Column:
    """Labelled vectors with a direction: no null or non-finite component, not all zero."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x).cast("double") == float("inf")),
    )
    some = F.exists(vector, lambda x: x != 0)
    return F.col(label).isNotNull() & F.coalesce(~bad & some, F.lit(False))


def fit_centres(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; begins with the vector that is worst covered so far, so it has no randomness."""
    centres = [x[0]]
    best = x @ x[0]
    for _ in range(k - 1):
        centres.append(x[int(best.argmin())])
        best = np.maximum(best, x @ centres[-1])
    c = np.array(centres)
    for _ in range(ROUNDS):
        # Products with all centres are taken for a few rows at a time.
        home = np.concatenate([(x[i : i + FIT_ROWS] @ c.T).argmax(axis=1) for i in range(0, len(x), FIT_ROWS)])
        order = np.argsort(home, kind="stable")
        cells, first = np.unique(home[order], return_index=True)
        for i, mine in zip(cells, np.split(order, first[1:])):
            total = x[mine].sum(axis=0)
            size = np.sqrt(total @ total)
            c[i] = total / size if size > 0 else c[i]
    return c


def centres_of(classes: DataFrame, cell_rows: int) -> dict:
    """Centres per group with more than ``cell_rows`` vectors, at most ``MOST_CENTRES`` in all.

    They are fitted, one task per group, on up to about ``FIT_PER_CENTRE`` vectors
    per centre, and ``FIT_NUMBERS`` numbers in all, chosen by a hash of the vector.  Groups beyond the limit stay one
    cell; their blocks are compared all the same.
    """
    sizes = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"))
    share = (
        sizes.filter(F.col("n") > cell_rows)
        .select("grp", "n", "width", F.ceil(F.col("n") / cell_rows).alias("k"))
        .orderBy(F.desc("n"), "grp")
        .limit(MOST_CENTRES // 2)
        .collect()
    )
    wanted = sum(r.k for r in share)
    if not share:
        return {}
    scale = min(1.0, MOST_CENTRES / wanted)
    plan = {r.grp: (max(2, int(r.k * scale)), r.n, r.width) for r in share}

    def sampled(k: int, n: int, width: int) -> float:
        return min(1.0, min(FIT_PER_CENTRE * k, max(2 * k, FIT_NUMBERS // width)) / n)

    spark = classes.sparkSession
    part = spark.createDataFrame(
        [(g, k, sampled(k, n, width)) for g, (k, n, width) in plan.items()],
        "grp string, k int, share double",
    )
    draw = F.pmod(F.xxhash64("vector"), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    sample = classes.join(F.broadcast(part), "grp").filter(draw).select("grp", "k", "vector")

    def fit(table: pa.Table) -> pa.Table:
        k = min(table["k"][0].as_py(), table.num_rows)
        c = fit_centres(unit(matrix(table["vector"])), k)
        return pa.table(
            [[table["grp"][0].as_py()], [c.ravel().tolist()], pa.array([k], pa.int32())],
            names=["grp", "centres", "k"],
        )

    fitted = sample.groupBy("grp").applyInArrow(fit, "grp string, centres array<double>, k int")
    return {r.grp: np.array(r.centres).reshape(r.k, -1) for r in fitted.collect()}


def guest_cells(y: np.ndarray, home: np.ndarray, apart: np.ndarray, reach: float) -> list[list[int]]:
    """Per row of cosines with the centres, the cells of smaller number that meet the bound against every centre.

    Few cells meet it against the row's own centre, and only those are tried against the others.
    """
    near = y[np.arange(len(y)), home][:, None] - y <= reach * apart[home]
    near &= np.arange(y.shape[1])[None, :] < home[:, None]
    rows, cells = np.nonzero(near)
    out: list[list[int]] = [[] for _ in range(len(y))]
    for first in range(0, len(rows), FIT_ROWS):
        r, c = rows[first : first + FIT_ROWS], cells[first : first + FIT_ROWS]
        fits = (y[r] - y[r, c][:, None] - reach * apart[c]).max(axis=1) <= 0
        for row, cell in zip(r[fits].tolist(), c[fits].tolist()):
            out[row].append(cell)
    return out


def place(classes: DataFrame, centres: dict, least: float) -> DataFrame:
    """Each vector with its cell and the cells that it is a guest of."""
    reach = sqrt(2 - 2 * least) + 1e-9
    apart = {
        g: np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0)) for g, c in centres.items()
    }

    def run(batches):
        for batch in batches:
            cells = np.zeros(batch.num_rows, dtype=np.int32)
            guests: list[list[int]] = [[]] * batch.num_rows
            groups = batch.column("grp").to_pylist()
            for g in set(groups) & set(centres):
                at = [i for i, other in enumerate(groups) if other == g]
                y = unit(matrix(batch.column("vector").take(pa.array(at)))) @ centres[g].T
                home = y.argmax(axis=1)
                found = guest_cells(y, home, apart[g], reach)
                for row, i in enumerate(at):
                    cells[i] = home[row]
                    guests[i] = found[row]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells), pa.array(guests, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "cell", "guest_of"],
            )

    schema = "grp string, id bigint, n bigint, vector array<double>, cell int, guest_of array<int>"
    return classes.select("grp", "id", "n", "vector").mapInArrow(run, schema)


def blocks(placed: DataFrame, block_rows: int) -> DataFrame:
    """One row per vector and pair of blocks that it takes part in."""
    both = placed.select("grp", "id", "n", "vector", "cell", F.lit(0).alias("guest")).unionAll(
        placed.select("grp", "id", "n", "vector", F.explode("guest_of").alias("cell"), F.lit(1).alias("guest"))
    )
    sizes = saved(
        both.groupBy("grp", "cell").agg(
            F.ceil(F.sum(1 - F.col("guest")) / block_rows).cast("int").alias("members"),
            F.ceil(F.sum("guest") / block_rows).cast("int").alias("guests"),
        ),
        "cells",
    )
    joined = both.join(sizes, ["grp", "cell"])
    hashed = F.xxhash64(F.lit(7), "id")
    own = F.when(F.col("guest") == 0, F.pmod(hashed, F.col("members"))).otherwise(
        F.pmod(hashed, F.greatest("guests", F.lit(1)))
    ).cast("int")

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    with_members = F.transform(
        upto(F.col("members")),
        lambda j: F.struct(
            F.lit(0).alias("kind"), F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")
        ),
    )
    with_guests = F.transform(
        upto(F.col("guests")),
        lambda j: F.struct(F.lit(1).alias("kind"), F.col("own").alias("i"), j.alias("j")),
    )
    as_guest = F.transform(
        upto(F.col("members")),
        lambda i: F.struct(F.lit(1).alias("kind"), i.alias("i"), F.col("own").alias("j")),
    )
    tasks = F.when(F.col("guest") == 0, F.concat(with_members, with_guests)).otherwise(as_guest)
    dealt = joined.withColumn("own", own).withColumn("task", F.explode(tasks))
    return dealt.select(
        "grp", "cell", F.col("task.kind").alias("kind"), F.col("task.i").alias("i"), F.col("task.j").alias("j"),
        F.when(F.col("guest") == 1, F.lit(1))
        .when((F.col("task.kind") == 0) & (F.col("own") != F.col("task.i")), F.lit(1))
        .otherwise(F.lit(0)).alias("side"),
        "id", "n", "vector",
    )


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> set[tuple[int, int]]:
    """Few edges with the same components as a 0/1 matrix of links between two lists of ids."""
    big = np.iinfo(np.int64).max
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    m, left, right = linked[np.ix_(rows, cols)], left[rows], right[cols]
    top, side = left.copy(), right.copy()
    while len(rows):
        new_side = np.minimum(side, np.where(m, top[:, None], big).min(axis=0))
        new_top = np.minimum(top, np.where(m, new_side[None, :], big).min(axis=1))
        # An id can stand on both sides; both take the smaller label.
        least: dict[int, int] = {}
        for i, x in zip([*left, *right], [*new_top, *new_side]):
            least[i] = min(least.get(i, x), x)
        new_top = np.array([least[i] for i in left])
        new_side = np.array([least[i] for i in right])
        if (new_top == top).all() and (new_side == side).all():
            break
        top, side = new_top, new_side
    return {(int(i), int(x)) for i, x in zip([*left, *right], [*top, *side]) if i != x}


def compare(table: pa.Table, least: float) -> pa.Table:
    """Links between the two blocks of a task: how many vectors each is linked to, and edges."""
    side = np.array(table["side"])
    kind, i, j = (table[c][0].as_py() for c in ("kind", "i", "j"))
    ids, sizes = np.array(table["id"]), np.array(table["n"])
    x = unit(matrix(table["vector"]))
    alone = kind == 0 and i == j
    a = np.flatnonzero(side == 0)
    b = a if alone else np.flatnonzero(side == 1)
    out: dict[str, list] = {"a": [], "b": [], "n": []}
    if len(a) and len(b):
        linked = x[a] @ x[b].T >= least
        if alone:
            np.fill_diagonal(linked, False)
        counts = [(ids[a], linked @ sizes[b])] + ([] if alone else [(ids[b], sizes[a] @ linked)])
        for who, n in counts:
            some = np.flatnonzero(n)
            out["a"] += who[some].tolist()
            out["n"] += n[some].tolist()
        out["b"] = [None] * len(out["a"])
        edges = forest(linked, ids[a], ids[b])
        out["a"] += [e[0] for e in edges]
        out["b"] += [e[1] for e in edges]
        out["n"] += [0] * len(edges)
    return pa.table(out, schema=pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]))


def near_vectors(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.93,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Links between vectors of one label with a cosine of ``least`` or more, and their components.

    Returns one row per row of ``df`` with its id, ``n_links`` (other rows linked
    directly), ``component_id`` (smallest id reachable, itself included) and
    ``kept``, true for the smallest id of a component.  Null and unusable vectors,
    null labels and null ids link with nothing (a null id is its own component and
    kept); vectors of different lengths do not link; equal vectors always link.
    Rows with the same id are one vertex of the graph.  An empty table gives an
    empty result; other columns are ignored.  Calling it runs jobs.
    """
    rows = df.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("v"), F.col(label).alias("l"))
    good = rows.filter(usable("v", "l") & F.col("id").isNotNull()).select(
        "id",
        F.concat_ws(":", F.size("v").cast("string"), F.col("l").cast("string")).alias("grp"),
        F.col("v").cast("array<double>").alias("vector"),
    )
    classes = saved(
        good.groupBy("grp", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "classes"
    )
    placed = saved(place(classes, centres_of(classes, cell_rows), least), "placed")
    keys = ["grp", "cell", "kind", "i", "j"]
    found = saved(
        blocks(placed, cell_rows)
        .groupBy(*keys)
        .applyInArrow(lambda table: compare(table, least), "a bigint, b bigint, n bigint"),
        "links",
    )
    links = found.filter(F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("linked"))
    parts = components(found.filter(F.col("b").isNotNull()))
    known = saved(
        classes.join(links, classes.id == links.a, "left")
        .drop("a")
        .join(parts.withColumnRenamed("id", "p"), F.col("id") == F.col("p"), "left")
        .select(
            "grp", "vector", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "known",
    )
    keyed = rows.select(
        "id",
        F.when(
            usable("v", "l") & F.col("id").isNotNull(),
            F.concat_ws(":", F.size("v").cast("string"), F.col("l").cast("string")),
        ).alias("g"),
        F.col("v").cast("array<double>").alias("x"),
    )
    joined = keyed.join(known, (F.col("g") == F.col("grp")) & (F.col("x") == F.col("vector")), "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
