"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source gets a share of the budget by its weight, but no more than `EPOCHS` times its own size; what
capped sources leave over is shared again by weight among the others, until no target is above its cap. A target of 1.3
times the size of a source means one whole repetition of all its documents and a second one of
three tenths of its words: documents are ordered by a seeded hash and taken up to the words wanted.

The order is never sorted as a whole: words are added up in 4096 hash ranges per source, and only the range in which the cut falls is
walked document by document. What comes out is one number of whole repetitions and one cut per source, so the decision on a
document needs its own row only.

Size is the number of runs of non-space characters; null texts have size 0 and are never repeated. The null source is a
source of its own and sorts last. Rows alike in id and text are taken alike. Extra columns are kept, those named like
a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.rowwise import without
from tidewatch.operators.lookup import join_lookup
from tidewatch.session import materialize

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
EPOCHS = 2
SEED = "mix-1"
#: Hex digits of a hash that name its range.
RANGE_DIGITS = 3


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def _hash(seed: str) -> Column:
    parts = (F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.left(F.md5(F.concat_ws(":", *parts).cast("binary")), F.lit(16))


def _source(column: Column) -> Column:
    """A name that is never null: `s` and the source, or `z` for none, which sorts last."""
    return F.coalesce(F.concat(F.lit("s"), column), F.lit("z"))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    return docs.withColumns({"size": text_size(F.col("text")), "_key": _hash(seed), "_source": _source(F.col("source"))})


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """Adds target to (_source, source_size); a row per source."""
    place = (F.row_number().over(Window.orderBy("_source")) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    capped = sources.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(epochs))})
    capped = materialize(capped, "sources")
    level = F.lit(float("inf"))
    seen = -1
    while True:
        full = F.col("cap") < level * F.col("weight") if seen >= 0 else F.lit(False)
        count, taken, rest, total = capped.agg(
            F.count_if(full), F.sum(F.when(full, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum("source_size"),
        ).first()
        if count == seen or not rest:
            break
        seen, level = count, F.lit((budget * total - taken) / rest)
    return capped.select("_source", "source_size", F.least("cap", level * F.col("weight")).alias("target"))


def plan(rows: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: _source, source_size, target, whole (repetitions of all) and cut (last hash of the rest)."""
    sources = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
    shares = targets(sources, weights, budget, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    shares = shares.withColumn("whole", whole.cast("int"))
    shares = materialize(shares.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "shares")

    ranged = rows.withColumn("range", F.left("_key", F.lit(RANGE_DIGITS)))
    sums = ranged.groupBy("_source", "range").agg(F.sum("size").alias("words")).join(shares.select("_source", "rest"), "_source")
    before = Window.partitionBy("_source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    edges = sums.filter("before < rest AND before + words >= rest").select("_source", "range", "before", "rest")
    edges = materialize(edges, "edges")

    inside = join_lookup(ranged, edges, ["_source", "range"]).groupBy("_source", "range", "before", "rest", "_key")
    keys = inside.agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.withColumn("passed", F.col("before") + F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    last = keys.filter("passed + words / 2 <= rest").groupBy("_source").agg(F.max("_key").alias("last"))
    cut = edges.join(last, "_source", "left").select("_source", F.coalesce("last", "range").alias("cut"))
    return shares.join(cut, "_source", "left").select("_source", "source_size", "target", "whole", F.coalesce("cut", F.lit("")).alias("cut"))


def decide(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Adds the columns of the source and repeats, the times a document is taken."""
    joined = join_lookup(rows, per_source, ["_source"])
    return joined.withColumn("repeats", F.col("whole") + (F.col("_key") <= F.col("cut")).cast("int"))


def mix(docs: DataFrame, *, weights=WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """The documents with size, source_size, target and repeats. `docs` needs doc_id, text and source."""
    rows = sized(without(docs, ["size", "source_size", "target", "repeats", "whole", "cut", "_key", "_source"]), seed)
    narrow = materialize(rows.select("_source", "size", "_key"), "sizes")
    per_source = materialize(plan(narrow, weights, budget, epochs), "mix_plan")
    return decide(rows, per_source).drop("_source", "_key", "whole", "cut")


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, with the columns of `docs`."""
    mixed = mix(docs, **options).filter("repeats > 0")
    copies = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "repeats")))
    return copies.select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    narrow = materialize(sized(docs.select("doc_id", "text", "source")).drop("text", "source"), "sizes")
    per_source = materialize(plan(narrow), "mix_plan")
    taken = (F.col("size") * F.col("repeats")).alias("taken")
    return decide(narrow, per_source).select("doc_id", "size", "source_size", "target", taken)
