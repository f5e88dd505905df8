"""Filter interaction audit: what five filters remove alone, in every order, and by their Shapley shares.

Every document is reduced to the set of filters it fails. Counts by part and failure set tabulate the removals of all 32
coalitions of filters: a coalition removes the documents that fail any of its members. A step of an order then is the difference of two
coalitions, and the Shapley share of each filter is the exact solution of a constrained least squares problem: shares that fit the
coalition removals best under the Shapley kernel weights and add up to the removals of all filters, solved as normal
equations in rationals.

Filters, in the order of their letters: A under 200 words; B less than half of the words distinct; C over 3 % capitals; D any of
`#$%&*|`; E the text of a smaller doc_id again. Words are runs of `[^\\x20\\x09-\\x0D]`, case-sensitive; lengths
are code points.

Null texts are empty texts, null languages the part ''. Rows with equal doc_id count once each and share their labels; of
copies all rows with the smallest doc_id pass E, as does a row without doc_id. A label of several rows holds if one row has it; documents
without labels are neither good nor toxic. Extra columns are ignored. Without documents there are no rows.

Texts are read once and never shuffled. Copies meet on (text hash, doc_id), so a text that a third of all rows repeat is dealt out.
A part is at most 32 counts, and parts are worked off in tasks.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.rowwise import emit
from tidewatch.session import materialize

FILTERS = "ABCDE"
ALL = 2 ** len(FILTERS) - 1
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 3
ODD = "[#$%&*|]"

RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, text_key and the figures of each text that the filters look at."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.md5(text.cast("binary"))).alias("text_key"), counts.alias("words"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).alias("capitals"), F.length(text).alias("chars"), text.rlike(ODD).alias("odd"),
    )


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, fails (a bit per filter), good and toxic of every document."""
    rows = materialize(measured(docs), "audit_texts")
    firsts = rows.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    long = lambda c: F.col(c).cast("long")
    failed = [
        F.col("words.n") < MIN_WORDS,
        100 * long("words.d") < MIN_DISTINCT * long("words.n"),
        100 * long("capitals") > MAX_CAPITALS * long("chars"),
        F.col("odd"),
        F.col("doc_id").isNotNull() & F.col("first").isNull(),
    ]
    fails = sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(failed)), F.lit(0))
    joined = rows.join(firsts, ["text_key", "doc_id"], "left").join(marks, "doc_id", "left")
    known = lambda c: F.coalesce(c, F.lit(False))
    return joined.select("doc_id", "part", fails.alias("fails"), known("good").alias("good"), known("toxic").alias("toxic"))


def removals(counts: dict[int, int]) -> list[int]:
    """Documents that each coalition of filters removes, given their number by failure set."""
    return [sum(n for fails, n in counts.items() if fails & coalition) for coalition in range(ALL + 1)]


def _normal_equations() -> tuple[list[int], list[Fraction], list[list[Fraction]]]:
    """Proper coalitions, their kernel weights, and the matrix of the normal equations bordered by the sum constraint."""
    m = len(FILTERS)
    proper = list(range(1, ALL))
    weights = [Fraction(m - 1, comb(m, s) * s * (m - s)) for s in (c.bit_count() for c in proper)]
    matrix = [[Fraction(0)] * (m + 1) for _ in range(m + 1)]
    for c, w in zip(proper, weights, strict=True):
        for i in range(m):
            for j in range(m):
                if c >> i & 1 and c >> j & 1:
                    matrix[i][j] += w
    for i in range(m):
        matrix[i][m] = matrix[m][i] = Fraction(1)
    return proper, weights, matrix


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Gauss-Jordan elimination in rationals."""
    rows = [[*r, b] for r, b in zip(matrix, right, strict=True)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i, row in enumerate(rows):
            if i != k and row[k]:
                rows[i] = [x - row[k] * y for x, y in zip(row, rows[k], strict=True)]
    return [r[-1] for r in rows]


def shares(removed: list[int]) -> list[Fraction]:
    """The Shapley share of every filter in the removals of all."""
    proper, weights, matrix = _normal_equations()
    right = [sum((w * removed[c] for c, w in zip(proper, weights, strict=True) if c >> i & 1), Fraction(0)) for i in range(len(FILTERS))]
    return solve(matrix, [*right, Fraction(removed[ALL])])[:-1]


def interactions(part: str, table: list[tuple[int, int, int, int]]) -> list[tuple]:
    """All rows of a part, given (fails, documents, good, toxic)."""
    removed, good, toxic = (removals({t[0]: t[k] for t in table}) for k in (1, 2, 3))
    total = sum(t[1] for t in table)
    shapley = [int(s * factorial(len(FILTERS))) for s in shares(removed)]
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            after, alone = before | 1 << k, 1 << k
            lost = removed[after] - removed[before]
            out.append((
                part, "".join(FILTERS[i] for i in order), step, total - removed[after], lost, removed[alone] - lost,
                removed[ALL] - removed[ALL ^ alone], good[after] - good[before], toxic[after] - toxic[before], shapley[k],
            ))
            before = after
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, zeros included; shapley is the share summed over all orders.

    `docs` needs doc_id, text and lang, `labels` doc_id, quality and toxic.
    """
    counts = failures(docs, labels).groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    tables = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("table"))  # 32 at most

    def make(batches):
        for batch in batches:
            for part, table in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield tuple(zip(*interactions(part, [tuple(t.values()) for t in table]), strict=True))

    return emit(tables, RESULT, make)
