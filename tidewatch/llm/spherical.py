"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products, one representative per group.

Vectors of one label are compared; those at cosine `THRESHOLD` or more are linked, and groups are the connected components of links.
Equal vectors of a label are one node from the start, however many rows hold them.

Labels of more than `CELL` nodes are cut into cells by spherical k-means. Every node has a home, the cell of the
nearest centroid, and visits each lower-numbered cell in which a partner could be at home: that cell's side of the bisecting
plane must come nearer than the threshold angle. So every pair above the threshold meets in a cell, and only
there. The rows of a cell lie in blocks of about `BLOCK` rows, in the order of their angle to the centroid. By the triangle inequality a
pair of blocks whose largest angles add up to less than the threshold angle is linked as a whole, and one whose angles
differ by more has no link; these are settled by counting, which is what a large group of near copies around its centroid takes. All other pairs of
blocks are multiplied, a pair at a time; every pair of blocks hands on link counts and the links that span its groups, never all pairs.
Cosines are computed in double precision; those that fall within rounding of the threshold are added up again component by
component.

Centroids are fitted on at most `SAMPLE` nodes chosen by hash; all rows are assigned and compared. The fit decides on cost only,
not on the result. Data without clusters make nodes visit most cells: the work then is that of comparing all nodes of a label.

Vectors that are null, empty, all zero, or hold null or non-finite components, and rows without label, link with nothing; neither do
vectors of different lengths. Repeated rows count each: they link with each other. A null vec_id is kept as such; the component is
the smallest vec_id that is not null. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.neardup import components
from tidewatch.llm.neighbours import usable
from tidewatch.llm.rowwise import SLICE_ROWS, emit
from tidewatch.operators.lookup import join_lookup
from tidewatch.session import materialize

THRESHOLD = 0.93
#: Nodes of a label that make a cell worthwhile, rows of a block, and cells at most.
CELL, BLOCK, CELLS = 1024, 1024, 256
#: Nodes that the centroids are fitted on, and rounds of the fit.
SAMPLE, ROUNDS = 20_000, 8
SEED = 12
#: Angles are cut into this many steps up to a half turn.
STEPS = 1440
#: Radians by which angles may be off after rounding.
SLACK = 1e-6
#: Cosines this near to the threshold are computed again.
NEAR = 1e-9


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their largest entry first, so that no square over- or underflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spherical_kmeans(rows: np.ndarray, k: int, *, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """At most k unit centroids of unit rows: spread-out starts, then means of the nearest rows."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(rows)))]
    apart = 1.0 - rows @ rows[chosen[0]]
    while len(chosen) < k and (chance := np.maximum(apart, 0.0)).sum() > 1e-12:
        chosen.append(int(rng.choice(len(rows), p=chance / chance.sum())))
        apart = np.minimum(apart, 1.0 - rows @ rows[chosen[-1]])
    centroids = rows[chosen]
    for _ in range(rounds):
        home = (rows @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, rows)
        lengths = np.linalg.norm(sums, axis=1)
        centroids = np.where(lengths[:, None] > 1e-9, sums / np.maximum(lengths, 1e-9)[:, None], centroids)
    return np.unique(centroids, axis=0)


def angles(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Angles between unit vectors; exact for small ones too."""
    return 2.0 * np.arcsin(np.minimum(np.linalg.norm(rows - centroid, axis=-1) / 2.0, 1.0))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of aligned rows, added up component by component."""
    total = lambda x: np.cumsum(x, axis=1)[:, -1]
    return total(a * b) / (np.sqrt(total(a * a)) * np.sqrt(total(b * b)))


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of the links between the rows of two blocks."""
    near = unit(a) @ unit(b).T
    out = near >= threshold
    i, j = np.nonzero(np.abs(near - threshold) <= NEAR)
    if len(i):
        out[i, j] = cosines(a[i], b[j]) >= threshold
    return out


def spanning(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, column) that connect all that the matrix connects: every tree takes a link out of itself, again and again."""
    rows, columns = links.shape
    group = np.arange(rows + columns)
    out_row, out_column = [], []
    open_rows = np.flatnonzero(links.any(axis=1))
    while len(open_rows):
        leaving = links[open_rows] & (group[open_rows][:, None] != group[rows:][None, :])
        first = leaving.argmax(axis=1)
        has = leaving[np.arange(len(open_rows)), first]
        open_rows, first = open_rows[has], first[has]
        parent: dict[int, int] = {}

        def find(x: int, parent=parent) -> int:
            while x in parent:
                x = parent[x]
            return x

        for r, c in zip(open_rows.tolist(), first.tolist(), strict=True):
            x, y = find(int(group[r])), find(int(group[rows + c]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out_row.append(r)
                out_column.append(c)
        group = np.array([find(x) for x in group.tolist()])
    return np.array(out_row, np.int64), np.array(out_column, np.int64)


def _node() -> Column:
    """128 bits of label and vector; null for rows that link with nothing."""
    part = lambda seed: F.lpad(F.hex(F.xxhash64(F.lit(seed), "label", "embedding")), 16, "0")
    compared = F.col("label").isNotNull() & usable(F.col("embedding").cast("array<double>"))
    return F.when(compared, F.unhex(F.concat(part(1), part(2))))


def _placed(nodes: DataFrame, centroids: np.ndarray, threshold: float) -> DataFrame:
    """node, number, visitor, step: the home of every node among the centroids and its visits, with the step of its angle there."""
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)
    reach = math.sin(min(math.acos(threshold) + SLACK, math.pi / 2))

    def make(batches):
        centroids = shared.value
        between = np.linalg.norm(centroids[:, None] - centroids[None], axis=2)
        number = np.arange(len(centroids))
        for batch in batches:
            rows = unit(_vectors(batch, 4))
            every = np.arange(len(rows))
            near = rows @ centroids.T
            home = near.argmax(axis=1)
            here = (number < home[:, None]) & (near[every, home][:, None] - near <= reach * between[home] + SLACK)
            here[every, home] = True
            at, where = np.nonzero(here)
            step = (angles(rows[at], centroids[where]) * (STEPS / math.pi)).astype(np.int32)
            taken = pa.array(at)
            yield *[batch.column(k).take(taken) for k in range(4)], where.astype(np.int32), where != home[at], step

    kind = f"node binary, weight long, label {dict(nodes.dtypes)['label']}, size int, number int, visitor boolean, step int"
    return emit(nodes.select("node", "weight", "label", "size", "vector"), kind, make)


def _lowest(nodes: DataFrame, held: int) -> DataFrame:
    """The nodes, `held` in all, whose hashes lie below a bound that leaves the `SAMPLE` smallest and few more.

    To find the smallest, every task hands on `SAMPLE` rows; this keeps all of them together near that number.
    """
    share = (SAMPLE + 8 * math.sqrt(SAMPLE)) / held
    return nodes if share >= 1 else nodes.filter(F.col("node") < F.unhex(F.lit(f"{int(share * 2**64):016x}")))


def _sample(nodes: DataFrame, held: int) -> np.ndarray:
    """Unit vectors of the `SAMPLE` nodes with the smallest hashes, of nodes of one size."""
    table = _lowest(nodes, held).select("node", "vector").orderBy("node").limit(SAMPLE).toArrow()
    return np.concatenate([unit(_vectors(batch, 1)) for batch in table.to_batches(SLICE_ROWS) if batch.num_rows])


def _entries(nodes: DataFrame, threshold: float, cell: int, cells: int) -> DataFrame:
    """A row for the home of each node and one for every visit; labels that fit a cell have just one, without angles."""
    large = nodes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > cell)
    large = materialize(large, "large_labels")
    whole = join_lookup(nodes, large, ["label", "size"], "left")
    one = [F.lit(0).alias("number"), F.lit(False).alias("visitor"), F.lit(None).cast("int").alias("step")]
    parts = whole.filter("held IS NULL").select("node", "weight", "label", "size", *one)
    for row in large.groupBy("size").agg(F.max("held").alias("held"), F.sum("held").alias("every")).orderBy("size").collect():
        own = whole.filter((F.col("size") == row["size"]) & F.col("held").isNotNull())
        centroids = spherical_kmeans(_sample(own, row["every"]), min(cells, -(-row["held"] // cell)))
        parts = parts.union(_placed(own, centroids, threshold))
    return materialize(parts, "entries")


CELL_KEY = ["label", "size", "number"]
BLOCK_KEY = [*CELL_KEY, "visitor", "block"]


def _dealt(entries: DataFrame, block: int) -> DataFrame:
    """Entries with the block of their cell: neighbouring steps share one, a step of more rows is dealt out by hash."""
    steps = entries.groupBy(*CELL_KEY, "visitor", "step").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(*CELL_KEY, "visitor").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("first", F.floor(F.coalesce(F.sum("rows").over(before), F.lit(0)) / block))
    steps = steps.withColumn("parts", F.when(F.col("rows") > block, F.ceil(F.col("rows") / block)).otherwise(F.lit(0)))
    names = [*CELL_KEY, "visitor", "step"]
    rules = materialize(steps.select(*names, "first", "parts").fillna(-1, ["step"]), "blocks")
    part = F.when(F.col("parts") > 0, F.concat_ws(":", "step", F.pmod(F.xxhash64("node"), "parts"))).otherwise(F.lit(""))
    met = join_lookup(entries.fillna(-1, ["step"]), rules, names)
    return met.withColumn("block", F.concat_ws("/", "first", part)).drop("first", "parts")


def _pairs(dealt: DataFrame, threshold: float) -> DataFrame:
    """Pairs of blocks (a, b) of a cell that may hold links; sure: every row of a links with every row of b."""
    one = math.pi / STEPS
    blocks = dealt.groupBy(*BLOCK_KEY).agg(
        F.min("step").alias("low"), F.max("step").alias("high"), F.sum("weight").alias("weight"), F.min("node").alias("head")
    )
    known = F.col("low") >= 0
    blocks = blocks.withColumns({"low": F.when(known, F.col("low") * one).otherwise(0.0), "high": F.when(known, (F.col("high") + 1) * one).otherwise(math.pi)})
    blocks = materialize(blocks, "block_facts")
    facts = ["visitor", "block", "low", "high", "weight", "head"]
    side = lambda s: blocks.select(*CELL_KEY, *[F.col(c).alias(f"{c}_{s}") for c in facts])
    both = side("a").filter("NOT visitor_a").join(side("b"), CELL_KEY).filter("visitor_b OR block_a <= block_b")
    limit = math.acos(threshold)
    both = both.filter((F.col("low_a") - F.col("high_b") <= limit + SLACK) & (F.col("low_b") - F.col("high_a") <= limit + SLACK))
    sure = F.col("high_a") + F.col("high_b") <= limit - SLACK
    same = ~F.col("visitor_b") & (F.col("block_a") == F.col("block_b"))
    return materialize(both.select("*", sure.alias("sure"), same.alias("same"), F.monotonically_increasing_id().alias("pair")), "block_pairs")


def _sure(dealt: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links of blocks that are linked as a whole: a, b, n as in `_compared`.

    Every row is tied to one row of the innermost block that its own is sure of, at home if there is one; that connects all of them.
    """
    sides = []
    for own, other in (("a", "b"), ("b", "a")):
        chosen = pairs.filter("sure" if own == "a" else "sure AND NOT same")
        rank = F.struct(F.col(f"visitor_{other}").alias("v"), F.col(f"high_{other}").alias("h"), F.col(f"block_{other}").alias("k"), F.col(f"head_{other}").alias("head"))
        sides.append(chosen.select(
            *CELL_KEY, F.col(f"visitor_{own}").alias("visitor"), F.col(f"block_{own}").alias("block"), rank.alias("rank"), F.col(f"weight_{other}").alias("more"), "same"
        ))
    totals = sides[0].union(sides[1]).groupBy(*BLOCK_KEY).agg(
        F.min("rank").alias("rank"), F.sum("more").alias("more"), F.max("same").alias("own_too")
    )
    met = join_lookup(dealt, totals.select(*BLOCK_KEY, F.col("rank.head").alias("head"), "more", "own_too"), BLOCK_KEY)
    count = F.col("more") - F.when(F.col("own_too"), F.col("weight")).otherwise(F.lit(0))
    return met.select(F.explode(F.array(
        F.struct(F.col("node").alias("a"), F.lit(None).cast("binary").alias("b"), count.alias("n")),
        F.struct(F.col("node").alias("a"), F.col("head").alias("b"), F.lit(None).cast("long").alias("n")),
    )).alias("l")).select("l.*")


def _compared(dealt: DataFrame, pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links of all other pairs of blocks: (a, null, n) counts the rows linked with node a, (a, b, null) ties two nodes."""
    sides = [
        pairs.filter("NOT sure" if s == "a" else "NOT sure AND NOT same").select(
            *CELL_KEY, F.col(f"visitor_{s}").alias("visitor"), F.col(f"block_{s}").alias("block"), "pair", F.lit(s == "b").alias("second"), "same"
        )
        for s in "ab"
    ]
    rows = dealt.join(nodes.select("node", "vector"), "node")
    met = rows.join(sides[0].union(sides[1]), BLOCK_KEY).select("pair", "second", "same", "node", "weight", "vector")
    met = met.repartition("pair").sortWithinPartitions("pair", "second", "node")

    def compare(held: list[tuple]) -> list[list]:
        second, node, weight = (np.concatenate([h[k] for h in held]) for k in range(3))
        vector, same = np.concatenate([h[3] for h in held]), held[0][4]
        a = np.flatnonzero(~second)
        b = a if same else np.flatnonzero(second)
        links = linked(vector[a], vector[b], threshold)
        if same:
            np.fill_diagonal(links, False)
        sides = [(a, links @ weight[b])] + ([] if same else [(b, weight[a] @ links)])
        out = [[], [], []]
        for at, n in sides:
            for k in np.flatnonzero(n).tolist():
                for column, value in zip(out, (node[at[k]], None, int(n[k])), strict=True):
                    column.append(value)
        for r, c in zip(*spanning(links), strict=True):
            for column, value in zip(out, (node[a[r]], node[b[c]], None), strict=True):
                column.append(value)
        return out

    def make(batches):
        held: list[tuple] = []
        last = None
        for batch in batches:
            pair = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1).tolist(), len(pair)]
            for first, end in zip(cuts, cuts[1:], strict=False):
                if held and pair[first] != last:
                    yield compare(held)
                    held = []
                last = pair[first]
                part = batch.slice(first, end - first)
                node = np.empty(part.num_rows, object)
                node[:] = part.column(3).to_pylist()
                held.append((part.column(1).to_numpy(zero_copy_only=False), node, part.column(4).to_numpy(), _vectors(part, 5), part.column(2)[0].as_py()))
        if held:
            yield compare(held)

    return emit(met, "a binary, b binary, n long", make)


def _vectors(batch: pa.RecordBatch, place: int) -> np.ndarray:
    column = batch.column(place)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _components(vectors: DataFrame, threshold: float, cell: int, block: int, cells: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their nodes; nodes with links (rows linked directly), root, component_id and owner (the node of that id)."""
    keyed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("vector"), _node().alias("node"))
    nodes = keyed.filter("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector")
    )
    nodes = materialize(nodes.withColumn("size", F.size("vector")), "vectors")
    dealt = _dealt(_entries(nodes, threshold, cell, cells), block)
    pairs = _pairs(dealt, threshold)
    found = _compared(dealt, pairs, nodes, threshold)
    if not pairs.filter("sure").isEmpty():
        found = found.union(_sure(dealt, pairs))
    found = materialize(found, "vector_links")
    counts = found.filter("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    edges = found.filter("n IS NULL").select("a", "b")
    rooted = nodes.select("node", "weight", "first").join(counts, "node", "left")
    if edges.isEmpty():
        rooted = rooted.withColumn("root", F.col("node"))
    else:
        rooted = rooted.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted.withColumn("links", F.coalesce("n", F.lit(0)) + F.col("weight") - 1), "rooted")
    rank = F.min(F.struct(F.col("first").isNull().alias("unnamed"), "first", F.col("node").alias("owner"))).alias("r")
    heads = rooted.groupBy("root").agg(rank).select("root", F.col("r.first").alias("component_id"), F.col("r.owner").alias("owner"))
    return keyed, rooted.join(heads, "root").select("node", "links", "component_id", "owner")


def groups(vectors: DataFrame, *, threshold: float = THRESHOLD, cell: int = CELL, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding, label).

    kept holds for rows whose vec_id is the component's, also where both are null.
    """
    keyed, known = _components(vectors, threshold, cell, block, cells)
    joined = keyed.select("vec_id", "node").join(known.drop("owner"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def representatives(vectors: DataFrame, *, threshold: float = THRESHOLD, cell: int = CELL, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """The rows of `vectors`, all columns: one of each group, that of its smallest vec_id, and all that link with nothing by rule."""
    _, known = _components(vectors, threshold, cell, block, cells)
    heads = known.filter(F.col("owner") == F.col("node")).select(F.col("node").alias("_head"), F.col("component_id").alias("_first"))
    marked = vectors.select("*", F.col("vec_id").cast("long").alias("_vec"), _node().alias("_node"))
    met = marked.join(heads, (F.col("_node") == F.col("_head")) & F.col("_vec").eqNullSafe(F.col("_first"))).dropDuplicates(["_node"])
    return met.select(*vectors.columns).union(marked.filter("_node IS NULL").select(*vectors.columns))
