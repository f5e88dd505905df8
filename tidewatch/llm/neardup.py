"""MinHash near-duplicates by BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its five-word shingles. BagMinHash draws, for every shingle and every step of its discretised weight, a
Poisson process seeded by shingle and step: each point falls on a random signature component at a time, and a
component keeps its earliest point. The steps are the dyadic intervals [0,1), [1,2), [2,4), ...; the last one reached
is thinned to the weight, so two texts share the points of the smaller weight and the chance that a component agrees
is exactly the weighted Jaccard similarity. Only points before a time bound are drawn (the bound is raised if
a component stays empty), which costs about m log m points for any text.

Texts that agree in a band of the signature share a bucket. They meet the leader of the bucket first, one that is the same
for all buckets of a group and then one drawn for each bucket, and links join classes. Buckets that still hold several
classes are settled exactly: of the texts in them, those meet that share a shingle early enough in the order of
rarity (prefix and position bounds of a set join), which all pairs above the threshold do and few others. So no link that
banding found is lost, and no group is expanded into all its pairs. Every link is verified on the texts: the overlap of the shingle
multisets must reach the threshold. Classes are the connected components.

Copies of a text are one node from the start, however many they are; a node carries its smallest doc_id. Texts of
fewer than five words are one shingle; null or wordless texts have none and form a class each. Rows with equal
doc_id keep a row each. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.rowwise import emit
from tidewatch.llm.words import WordHashes, combine, mix, shingles, split_words, steps
from tidewatch.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
#: Rows per band and bands: two texts at the threshold share no band with a chance of 2 in 100,000.
ROWS, BANDS = 6, 36
#: Rounds of leaders before the rest of a bucket is settled by the set join.
ROUNDS = 2

_HASHES = WordHashes()


def bag(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text, sorted, and their counts."""
    return np.unique(shingles(_HASHES.of(split_words(text)), size), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Multiset Jaccard similarity; 0 where either is empty."""
    total = int(a[1].sum() + b[1].sum())
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][at], b[1][bt]).sum())
    return shared / (total - shared)


#: Points of the processes that are drawn in one step of array operations.
POINTS = 100_000


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, count: int, m: int) -> np.ndarray:
    """BagMinHash signatures of `count` bags, given as (owner, element, positive whole weight); one row of m times each."""
    total = np.bincount(owner, weights, count)
    signature = np.full((count, m), np.inf)
    open_bags = total > 0
    bound = np.where(open_bags, m * (np.log(m) + 4.0) / np.maximum(total, 1), 0.0)
    while open_bags.any():
        use = open_bags[owner]
        own, element, weight = owner[use], elements[use], weights[use]
        step = 0
        while len(own):
            low, width = (0, 1) if step == 0 else (1 << (step - 1), 1 << (step - 1))
            reached = weight > low
            own, element, weight = own[reached], element[reached], weight[reached]
            _draw(signature, own, mix(element + np.uint64(step)), weight - low, width, bound)
            step += 1
        open_bags &= np.isinf(signature).any(axis=1)
        bound *= 2.0
    return signature


def _draw(signature, own, seed, reach, width, bound) -> None:
    """Let the points of one dyadic step fall: rate `width`, kept below the level `reach`, up to the bound of the bag.

    Elements that are still short of their bound get as many points at once as they lack on average.
    """
    m = signature.shape[1]
    time, draw, many = np.zeros(len(own)), 0, 1
    flat = signature.reshape(-1)
    while len(own):
        number = np.arange(draw, draw + many, dtype=np.uint64)
        raw = mix(seed[:, None] + (np.uint64(2) * number + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        uniform = ((raw >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53  # in (0, 1]
        times = np.cumsum(np.concatenate([time[:, None], -np.log(uniform) / width], axis=1), axis=1)[:, 1:]
        end = bound[own]
        at, k = np.nonzero(times <= end[:, None])
        where = mix(seed[at] ^ (np.uint64(0xD6E8FEB86659FD93) * (number[k] + np.uint64(1))))
        component = (where >> np.uint64(32)) % np.uint64(m)
        level = (where & np.uint64(0xFFFFFFFF)).astype(np.float64) * (width / 2.0**32)
        kept = level < reach[at]
        np.minimum.at(flat, own[at[kept]] * m + component[kept].astype(np.int64), times[at[kept], k[kept]])
        alive = times[:, -1] <= end
        own, seed, reach, time = own[alive], seed[alive], reach[alive], times[alive, -1]
        draw += many
        if len(own):
            lacking = float(((end[alive] - time) * width).mean())
            many = max(1, min(int(lacking) + 1, POINTS // len(own)))


def band_hashes(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash per band, the band number mixed in; a row per bag."""
    bits = signature.view(np.uint64).reshape(len(signature), -1, rows)
    numbers = np.arange(bits.shape[1], dtype=np.uint64)[None, :].repeat(len(signature), 0)
    return combine([numbers, *(bits[:, :, k] for k in range(rows))]).view(np.int64)


def sketch(texts: list[str | None], rows: int = ROWS, bands: int = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """Number of shingles and band hashes of each text."""
    sizes = np.zeros(len(texts), np.int64)
    out = np.zeros((len(texts), bands), np.int64)
    for first, last in steps(texts):
        bags = [bag(t) for t in texts[first:last]]
        owner = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
        weights = np.concatenate([b[1] for b in bags])
        signature = signatures(owner, np.concatenate([b[0] for b in bags]), weights, len(bags), rows * bands)
        sizes[first:last] = np.bincount(owner, weights, len(bags))
        out[first:last] = band_hashes(signature, rows)
    return sizes, out


def _node():
    """What copies of a text share; null for a text without words."""
    worded = F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    return F.when(worded, F.unhex(F.md5(F.col("text").cast("binary"))))


def _sketches(keyed: DataFrame) -> DataFrame:
    def make(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in steps(texts):
                sizes, bands = sketch(texts[first:last])
                yield batch.column(0).slice(first, last - first), sizes, pa.array(list(bands), pa.list_(pa.int64()))

    first = keyed.filter("node IS NOT NULL").select("node", "text")
    return emit(first, "node binary, n long, bands array<long>", make)


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (a, b) of nodes those whose texts overlap enough."""

    def make(batches):
        known_node, known_bag = None, None
        for batch in batches:
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            keep = []
            for k, node in enumerate(b):
                if node != known_node:
                    known_node, known_bag = node, bag(text_b[k])
                if overlap(bag(text_a[k]), known_bag) >= threshold:
                    keep.append(k)
            yield [a[k] for k in keep], [b[k] for k in keep]

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return emit(both, "a binary, b binary", make)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (a, b); root is the smallest node of its component.

    Large-star and small-star steps in turn, each written to the shared folder, until only stars are left. No step
    gathers the neighbours of a node: minima combine before their shuffle and come back by a join.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    edges = materialize(ordered.distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("hub"), F.least("a", "low").alias("low"))
        large = both.join(lowest, F.col("a") == F.col("hub")).filter("b > a AND b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(large.distinct(), "large_star")
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        pairs = F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))
        small = large.join(lowest, "a").select(F.explode(pairs).alias("e")).select("e.a", F.col("e.low").alias("b"))
        edges = materialize(small.filter("a <> b").distinct(), "small_star")
        # done when every node has one edge and no root has one
        sides = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        sides = sides.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        if sides.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _rooted(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Bucket members with the root of their class so far."""
    if roots is None:
        return members.withColumn("root", F.col("node"))
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _fits(threshold: float):
    """The length bound: multisets whose sizes differ too much cannot overlap enough."""
    return F.least("n", "n_other") >= F.lit(threshold) * F.greatest("n", "n_other") - 1e-9


def _candidates(members: DataFrame, turn: int, threshold: float) -> DataFrame:
    """Pairs of each member with the leader of its bucket, where the two are not in one class yet."""
    by = F.xxhash64("node") if turn == 0 else F.xxhash64("node", "bucket", F.lit(turn))
    rank = F.struct(by.alias("by"), "node", "root", "n")
    leaders = members.groupBy("bucket").agg(F.min(rank).alias("leader"), F.min("root").alias("low"), F.max("root").alias("high"))
    leaders = leaders.filter("low <> high").select(
        "bucket", F.col("leader.node").alias("b"), F.col("leader.root").alias("other"), F.col("leader.n").alias("n_other")
    )
    met = members.join(leaders, "bucket").filter(F.col("root") != F.col("other")).filter(_fits(threshold))
    return met.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()


def _elements(texts: DataFrame) -> DataFrame:
    """(node, element) of the shingles of texts; the k-th copy of a shingle in a text is an element of its own."""

    def make(batches):
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes, counts = bag(text)
                copy = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                elements = mix(np.repeat(hashes, counts) + copy.astype(np.uint64)).view(np.int64)
                yield pa.array([node] * len(elements), pa.binary()), elements

    return emit(texts.select("node", "text"), "node binary, element long", make)


def _rest(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs that may still be linked, of all texts in buckets that hold several classes.

    Elements are ordered by how rare they are. A pair above the threshold shares its first common element within the prefix of
    each, and what follows that element must be long enough for the overlap both sizes ask for.
    """
    mixed = members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    open_nodes = members.join(mixed.select("bucket"), "bucket").select("node", "root", "n").distinct()
    open_nodes = materialize(open_nodes, "open_nodes")
    elements = materialize(_elements(texts.join(open_nodes.select("node"), "node")), "elements")
    shared = elements.groupBy("element").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    known = elements.join(shared, "element").join(open_nodes, "node")
    place, every = Window.partitionBy("node").orderBy("held", "element"), Window.partitionBy("node")
    # elements of one text alone are the rarest and come first: they only push the others back
    known = known.withColumn("place", F.col("n") - F.count(F.lit(1)).over(every) + F.row_number().over(place))
    prefix = known.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    prefix = materialize(prefix.select("element", "node", "root", "n", "place"), "prefixes")
    other = prefix.select("element", *[F.col(c).alias(f"{c}_b") for c in ("node", "root", "n", "place")])
    needed = F.ceil((F.col("n") + F.col("n_b")) * (threshold / (1 + threshold)) - 1e-9)
    reachable = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b")) + 1 >= needed
    fits = F.least("n", "n_b") >= F.lit(threshold) * F.greatest("n", "n_b") - 1e-9
    met = prefix.join(other, "element").filter("node > node_b AND root <> root_b").filter(reachable & fits)
    return met.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()


def classes(docs: DataFrame, *, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id (the smallest doc_id of its class) and class_rows.

    A class whose doc_ids are all null has a null class_id. `docs` needs doc_id and text; other columns are ignored.
    """
    keyed, nodes, heads = _classes(docs, threshold, rounds)
    named = heads.select("node", "class_id", "class_rows")
    joined = nodes.join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return joined.select("doc_id", own.alias("class_id"), F.coalesce("class_rows", F.lit(1)).alias("class_rows"))


def keep_first(docs: DataFrame, *, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """The rows of `docs`, all columns, without those that repeat a class: the row of its smallest doc_id stays.

    Rows without words are their own classes and stay.
    """
    marked = docs.select("*", *[c.alias(f"_{n}") for n, c in (("node", _node()), ("owner", F.col("doc_id")))])
    keyed, nodes, heads = _classes(docs, threshold, rounds)
    firsts = heads.filter("head").select(F.col("node").alias("_head"), F.col("owner").alias("_head_doc"), "rows")
    met = marked.join(firsts, (F.col("_node") == F.col("_head")) & F.col("_owner").eqNullSafe(F.col("_head_doc")))
    kept = met if heads.filter("head AND rows > 1").isEmpty() else met.filter("rows = 1").union(
        met.filter("rows > 1").dropDuplicates(["_node"])
    )
    return kept.select(*docs.columns).union(marked.filter("_node IS NULL").select(*docs.columns))


def _classes(docs: DataFrame, threshold: float, rounds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts with their nodes; the same without text; the nodes with their class (head: the node that stays)."""
    keyed = docs.select("doc_id", "text", _node().alias("node"))
    nodes = materialize(keyed.select("doc_id", "node"), "nodes")
    counted = nodes.filter("node IS NOT NULL").groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    owner = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rows")).alias("o")
    owners = counted.groupBy("node").agg(owner, F.sum("rows").alias("copies"))
    owners = materialize(owners.select("node", F.col("o.doc_id").alias("owner"), "o.rows", "copies"), "owners")

    sketched = materialize(_sketches(keyed).dropDuplicates(["node"]), "sketches")
    exploded = sketched.select("node", "n", F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("bucket")
    members = materialize(exploded.join(shared, "bucket"), "members")

    wanted = members.select("node").distinct().join(owners, "node")
    wanted = wanted.select(F.col("node").alias("wanted"), F.col("owner").alias("wanted_doc"))
    found = keyed.join(wanted, (F.col("node") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("wanted_doc")))
    texts = materialize(found.select("node", "text").dropDuplicates(["node"]), "texts")

    links: DataFrame | None = None
    roots: DataFrame | None = None
    for turn in range(rounds + 1):
        rooted = _rooted(members, roots)
        pairs = _candidates(rooted, turn, threshold) if turn < rounds else _rest(rooted, texts, threshold)
        new = materialize(_verified(pairs, texts, threshold), "links")
        if not new.isEmpty():
            links = new if links is None else links.union(new)
            roots = components(links)
    return keyed, nodes, _headed(owners, roots)


def _headed(owners: DataFrame, roots: DataFrame | None) -> DataFrame:
    rooted = _rooted(owners, roots)
    first = F.min(F.struct(F.col("owner").isNull().alias("unnamed"), "owner", F.col("node").alias("first"))).alias("f")
    named = rooted.groupBy("root").agg(first, F.sum("copies").alias("class_rows"))
    joined = rooted.join(named, "root")
    head = F.col("f.first") == F.col("node")
    return joined.select("node", "owner", "rows", F.col("f.owner").alias("class_id"), "class_rows", head.alias("head"))
