"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them.

Every vector belongs to the cell whose centre is nearest. Two vectors as similar as asked for may still lie on
two sides of a border; then their distances to it add up to no more than theirs to each other, so one of them is within half of that.
A vector therefore also visits the cells whose border is that close: no pair is missed, and one that meets in both cells
counts in the one of lower number. Cells are cut into blocks and a task compares two blocks, so that a crowded cell is many tasks. Tasks return, per vector, how many links they found
and one link that keeps what they found connected, never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import extended, staged
from tiermill.llm.components import components, local_roots

SIMILARITY = 0.95
# Vectors that the centres are fitted on (the driver holds them), vectors per cell, and most cells.
SAMPLE = 20_000
PER_CELL = 4_000
MOST_CELLS = 4_096
ROUNDS = 8
BLOCK = 8_000
# Rows of a block that are multiplied at once, and components of a vector that the first product takes.
ROWS_AT_ONCE = 256
HEAD = 16


def _usable(vector: str) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    number = lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return _units(np.stack(vectors.to_list()).astype(np.float64))


def spherical_centres(units: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of ``units`` by spherical k-means, begun with evenly chosen ones; at most one per vector."""
    centres = units[np.linspace(0, len(units) - 1, min(cells, len(units))).astype(int)]
    for _ in range(rounds):
        nearest = _nearest(units, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        lengths = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(lengths > 1e-9, sums / np.maximum(lengths, 1e-9), centres)
    return centres


def _nearest(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([(units[i : i + BLOCK] @ centres.T).argmax(axis=1) for i in range(0, len(units), BLOCK)])


def _visits(units: np.ndarray, centres: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector, cell) of the cells where each vector is, its own and those it visits, and the cell where each lives.

    If x lives in c, y in c' and |x - y| <= t, then x.(c - c') + y.(c' - c) = (x - y).(c - c') <= t |c - c'|, and neither
    part is negative, so one of them is at most half of that.
    """
    reach = np.sqrt(2 - 2 * similarity) / 2
    products = units @ centres.T
    home = products.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    margin = products[np.arange(len(units)), home][:, None] - products
    vector, cell = np.nonzero(margin <= reach * apart[home] + 1e-9)
    return vector, cell, home


def _in_cells(distinct: DataFrame, centres: np.ndarray, similarity: float) -> DataFrame:
    """(node, copies, vector, size, cell, lives, visits): each vector in its cell and in those it visits, with the numbers of all of them.

    Vectors of another size than the centres' are all in one cell.
    """
    schema = extended(distinct.schema, "size int, cell int, lives int, visits array<int>")

    def run(parts):
        for part in parts:
            sizes = part["vector"].map(len)
            for size, rows in part.groupby(sizes):
                vector, cell, home = np.arange(len(rows)), np.zeros(len(rows), int), np.zeros(len(rows), int)
                if size == centres.shape[1]:
                    vector, cell, home = _visits(_matrix(rows["vector"]), centres, similarity)
                numbers = cell.astype(np.int32)
                lists = np.split(numbers, np.flatnonzero(np.diff(vector)) + 1)
                visits = [lists[i] for i in vector.tolist()]
                yield rows.iloc[vector].assign(size=np.int32(size), cell=numbers, lives=home[vector].astype(np.int32), visits=visits)

    return distinct.mapInPandas(run, schema)


def _tiles(placed: DataFrame, block: int) -> DataFrame:
    """Rows dealt to pairs of blocks of a cell: (left, right) both at home, or left at home and right visiting."""
    cell = ["size", "cell"]
    placed = placed.withColumn("home", F.col("cell") == F.col("lives"))
    counts = placed.groupBy(*cell).agg(F.count_if("home").alias("own"), F.count_if(~F.col("home")).alias("visiting"))
    in_blocks = {"blocks": F.ceil(F.col("own") / block), "guests": F.ceil(F.col("visiting") / block)}
    counts = counts.select(*cell, *[n.cast("int").alias(name) for name, n in in_blocks.items()])
    rows = placed.join(counts, cell)
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("blocks")).otherwise(F.col("guests"))).cast("int")
    rows = rows.withColumn("mine", mine)
    me, no, yes = F.col("mine"), F.lit(False), F.lit(True)

    def tile(left: Column, right: Column, guest: Column, side: Column) -> Column:
        return F.struct(left.alias("left"), right.alias("right"), guest.alias("guest"), side.alias("side"))

    def with_each(many: str, make: Callable[[Column], Column]) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.col(many) - 1, F.lit(0)))
        return F.when(F.col(many) > 0, F.transform(numbers, make)).otherwise(nothing)

    nothing = F.array().cast("array<struct<left:int,right:int,guest:boolean,side:boolean>>")
    others = with_each("blocks", lambda j: tile(F.least(me, j), F.greatest(me, j), no, me > j))
    guests = with_each("guests", lambda r: tile(me, r, yes, no))
    hosts = with_each("blocks", lambda i: tile(i, me, yes, yes))
    dealt = rows.withColumn("tile", F.explode(F.when(F.col("home"), F.concat(others, guests)).otherwise(hosts)))
    return dealt.select("node", "copies", "vector", "lives", "visits", *cell, "tile.*")


def _heads(units: np.ndarray) -> np.ndarray:
    """The first components and the length of the rest: their products are never below the cosines."""
    rest = np.sqrt(np.maximum((units[:, HEAD:] ** 2).sum(axis=1, keepdims=True), 0))
    return np.concatenate([units[:, :HEAD], rest], axis=1).astype(np.float32)


def _similar(left: np.ndarray, right: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of left, row of right) with a cosine of at least ``similarity``, in double precision, by and by."""
    left_heads, right_heads = _heads(left), _heads(right).T
    for begin in range(0, len(left), ROWS_AT_ONCE):
        some = left[begin : begin + ROWS_AT_ONCE]
        i, j = np.nonzero(left_heads[begin : begin + ROWS_AT_ONCE] @ right_heads >= similarity - 1e-5)
        if len(i) * 8 > len(some) * len(right):
            i, j = np.nonzero(some @ right.T >= similarity)
        else:
            close = np.einsum("ij,ij->i", some[i], right[j]) >= similarity
            i, j = i[close], j[close]
        yield i + begin, j


def _met_before(hosts: pd.DataFrame, guests: pd.DataFrame, cell: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a host also visits a cell of lower number that guests come from, at [host, n], and the ``n`` of each guest."""
    cells, which = np.unique(guests["lives"].to_numpy(), return_inverse=True)
    counts = hosts["visits"].map(len).to_numpy()
    visited = np.concatenate([np.zeros(0, np.int32), *hosts["visits"]])
    at = np.minimum(np.searchsorted(cells, visited), len(cells) - 1)
    there = (cells[at] == visited) & (visited < cell)
    met = np.zeros((len(hosts), len(cells)), bool)
    met[np.repeat(np.arange(len(hosts)), counts)[there], at[there]] = True
    return met, which


def _tile_links(similarity: float):
    """What one tile finds, per vector: how many others it is linked with, and the root that its links lead to."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "node"], kind="stable")
        units, split = _matrix(rows["vector"]), int((~rows["side"]).sum())
        copies, nodes = rows["copies"].to_numpy(), rows["node"].to_numpy()
        alone = rows["left"].iloc[0] == rows["right"].iloc[0] and not rows["guest"].iloc[0]
        left, right = (units, units) if alone else (units[:split], units[split:])
        found, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
        met = None
        if rows["guest"].iloc[0] and 0 < split < len(rows):
            met, which = _met_before(rows.iloc[:split], rows.iloc[split:], int(rows["cell"].iloc[0]))
        for i, j in _similar(left, right, similarity) if len(right) else ():
            if met is not None:
                new = ~met[i, which[j]]
                i, j = i[new], j[new]
            j = j if alone else j + split
            i, j = i[i != j], j[i != j]
            found += np.bincount(i, weights=copies[j], minlength=len(rows)).astype(np.int64)
            if not alone:
                found += np.bincount(j, weights=copies[i], minlength=len(rows)).astype(np.int64)
            root = local_roots(len(rows), root[i], root[j])[root]
        some = np.flatnonzero(found)
        return pd.DataFrame({"node": nodes[some], "links": found[some], "root": nodes[root[some]]})

    return run


def similar_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    similarity: float = SIMILARITY,
    sample: int = SAMPLE,
    per_cell: int = PER_CELL,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of ``vectors``: the id, n_links, component_id and kept.

    Rows whose cosine (in double precision) is at least ``similarity`` are linked; n_links counts the others linked
    directly, component_id is the smallest id that links reach, and kept tells whether that is the row's own. Null,
    empty and zero vectors and those with null, NaN or infinite components are linked with nothing. Vectors of different
    sizes are not linked. Equal vectors are compared once, however many rows hold them. Null ids are never the smallest of
    a component that has others. Empty tables give no rows. Only fitting the centres uses a sample, of at most ``sample``
    vectors; all vectors are compared.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    usable = rows.filter(_usable("vector"))
    distinct = usable.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
    distinct = staged(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    sizes = distinct.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.orderBy(F.desc("n"), "size").first()
    nodes = distinct.select("node", "copies", "vector")
    if usual is None:
        found = staged(nodes.select("node", F.col("copies").alias("links"), F.col("node").alias("root")), "vector-links")
    else:
        chosen = nodes.filter(F.size("vector") == usual["size"]).orderBy(F.xxhash64("vector"), "node").limit(sample)
        units = _matrix(chosen.select("vector").toPandas()["vector"])
        centres = spherical_centres(units, max(1, min(MOST_CELLS, usual["n"] // per_cell)))
        placed = staged(_in_cells(nodes, centres, similarity), "vectors-in-cells")
        tiles = _tiles(placed, block).groupBy("size", "cell", "left", "right", "guest")
        found = staged(tiles.applyInPandas(_tile_links(similarity), "node bigint, links bigint, root bigint"), "vector-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = distinct.join(links, "node", "left").join(roots, "node", "left")
    own = [F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")]
    known = staged(known.select("vector", "first_id", "copies", *own), "linked-vectors")
    smallest = known.groupBy("root").agg(F.min("first_id").alias("smallest"))
    places = known.join(smallest, "root").select(F.col("vector").alias("same"), "copies", "links", "smallest")
    keyed = rows.withColumn("key", F.when(_usable("vector"), F.col("vector")))
    placed_rows = keyed.join(staged(places, "vector-components"), F.col("key") == F.col("same"), "left")
    component = F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("smallest"))
    return placed_rows.select(
        F.col("id").alias(id_column),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
