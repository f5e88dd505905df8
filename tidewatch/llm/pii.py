"""Personal data by weak supervision, in DataFrame operations only.

Base spans (e-mail, IP, card, phone) are found by pattern and check and always stay. Further candidates are
numbers and names that only look like personal data: matches that failed their check, grouped digits, titled
names. Five labelers vote on every candidate, yes, no or not at all: the check of the pattern, the structure of its digits,
a gazetteer, cue words on its left, and its surroundings. Expectation-maximisation over the vote patterns estimates how
reliable each labeler is and how likely each pattern is to be real. Its posteriors train the final span classifier, a
naive Bayes model on the shape of a span; candidates it accepts are added where they touch no base span.

Text offsets are code points, end exclusive. Null texts are empty. All passes over text use patterns that
need linear time. Rows are never shuffled; only counts by vote pattern and by feature are, and both tables have a fixed size
however many documents there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialize

# Base kinds in their listed order, as patterns. They accept what the plain forms
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+     ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card [0-9]([\x20-]?[0-9])+                                  phone \+[0-9][\x20().0-9-]+[0-9]
# accept, leftmost and non-overlapping, without going back over a run of characters that cannot match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further candidates: grouped digits without a plus sign, and a title with capitalised names.
MORE = {
    "number": r"(?<![0-9A-Za-z+.])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){2,4}(?![0-9A-Za-z])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Sr|Sra|Herr|Frau|Mme)\.? [A-Z]\p{L}{1,30}(?: [A-Z]\p{L}{1,30})?",
}
KINDS = [*PATTERNS, *MORE]
LABELERS = ("check", "structure", "gazetteer", "cue", "surroundings")
ITERATIONS = 12
THRESHOLD = 0.5
#: Characters to the left that count as context.
CONTEXT = 32

# Gazetteers and cue words: fixed values.
TOP_DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|it|uk|eu|us|ch|at|nl"
CALLING_CODES = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CARD_ISSUERS = r"(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65)"
CUES = r"(?i)\b(?:e-?mail|mail|contact|phone|tel|telephone|call|mobile|cell|fax|card|visa|account|iban|ssn|passport|ip|host|server|name|kontakt|telefon|correo|tarjeta|courriel|carte)\b[^\n]{0,12}$"
COUNTER_CUES = r"(?i)(?:\b(?:version|ver|v|page|pages|fig|figure|table|section|chapter|isbn|issn|order|price|total|year|vol|no)\b\.?|[$€£#%=])[\x20:]{0,3}$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        doubled = F.when(place % 2 == 0, digit * 2 - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)
        return total + doubled

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _is_base(kind: str, value: Column) -> Column:
    count = F.length(_digits(value))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(count.between(12, 19), _luhn(_digits(value))).otherwise(False)
    return count.between(9, 15) if kind == "phone" else F.lit(False)


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _starts(pieces: Column, found: Column) -> Column:
    """Start of every match: running sums of the lengths between and of the matches, in blocks of about the root of their number."""
    numbers = F.sequence(F.lit(0), F.size(found) - 1)
    gaps = F.transform(numbers, lambda i: F.length(F.get(pieces, i)) + F.coalesce(F.length(F.get(found, i - 1)), F.lit(0)))
    add = lambda total, x: total + x
    zero = F.lit(0)

    def walk(gaps: Column) -> Column:
        block = F.greatest(F.lit(1), F.floor(F.sqrt(F.size(gaps))).cast("int"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(gaps) - 1) / block).cast("int"))
        sums = F.transform(blocks, lambda b: F.aggregate(F.slice(gaps, b * block + 1, block), zero, add))
        before = _let(sums, lambda s: F.transform(blocks, lambda b: F.aggregate(F.slice(s, F.lit(1), b), zero, add)))
        own = lambda i, at: F.get(at, F.floor(i / block).cast("int")) + F.aggregate(F.slice(gaps, F.floor(i / block).cast("int") * block + 1, i % block + 1), zero, add)
        return _let(before, lambda at: F.transform(F.sequence(F.lit(0), F.size(gaps) - 1), lambda i: own(i, at)))

    return _let(gaps, walk)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, value, left, right) of all matches; left and right are what stands next to it, up to the next match."""

    def described(found: Column, pieces: Column) -> Column:
        def one(start: Column, i: Column) -> Column:
            left, right = F.right(F.get(pieces, i), F.lit(CONTEXT)), F.left(F.get(pieces, i + 1), F.lit(1))
            return F.struct(start.alias("start"), F.get(found, i).alias("value"), left.alias("left"), right.alias("right"))

        return F.transform(_starts(pieces, found), one)

    def placed(found: Column) -> Column:
        return F.when(F.size(found) > 0, _let(F.split(text, pattern, -1), lambda pieces: described(found, pieces)))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,value:string,left:string,right:string>>")
    return F.coalesce(_let(found, placed), none)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit("y")).when(no, F.lit("n")).otherwise(F.lit("-"))


def _votes(kind: str, value: Column, left: Column, right: Column, base: Column) -> Column:
    """One letter per labeler: y, n or - for no vote."""
    digits = _digits(value)
    count = F.length(digits)
    never = F.lit(False)
    checked = _vote(base, ~base if kind in PATTERNS else never)
    same = digits.rlike(r"^([0-9])\1*$")
    if kind == "email":
        structure, known = _vote(value.rlike(r"@.+\.[A-Za-z]{2,}$"), never), _vote(value.rlike(rf"(?i)\.(?:{TOP_DOMAINS})$"), never)
    elif kind == "ip":
        structure = _vote(~value.rlike(r"(?:^|\.)0[0-9]"), value.rlike(r"[0-9]{4}"))
        known = _vote(value.rlike(r"^(?:10|127|172|192)\."), never)
    elif kind == "name":
        structure, known = _vote(value.rlike(r" \S+ \S"), never), _vote(~value.rlike(r"\.? [A-Z]\p{L}$"), never)
    else:
        groups = value.rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$|^(?:[0-9]{4}[\x20-]){3}[0-9]{1,7}$|^\+")
        structure = _vote(groups & ~same, same | (count < 9))
        issued = F.when(count >= 12, digits.rlike(f"^{CARD_ISSUERS}")).otherwise(value.rlike(f"^{CALLING_CODES}"))
        known = _vote(issued, never)
    cue = _vote(left.rlike(CUES), left.rlike(COUNTER_CUES))
    around = _vote(left.rlike(r"(?:^|[\s(\[<:\"'])$") & right.rlike(r"^(?:$|[\s)\],;.:>\"'])"), left.rlike(r"[A-Za-z0-9]$") | right.rlike("^[A-Za-z0-9]"))
    return F.concat(checked, structure, known, cue, around)


def _features(kind: str, value: Column, left: Column, right: Column, base: Column) -> Column:
    """Shape of a span as name=value strings, each from a fixed list."""
    digits = F.length(_digits(value))
    form = F.when(value.contains("("), "paren").when(value.contains("-"), "dash").when(value.contains(" "), "space").when(value.contains("."), "dot").otherwise("solid")
    side = lambda c: F.when(c == "", "end").when(c.rlike(r"\s"), "space").when(c.rlike("[A-Za-z0-9]"), "word").otherwise("mark")
    return F.array(
        F.lit(f"kind={kind}"),
        F.concat(F.lit(f"{kind} digits="), F.least(digits, F.lit(20)).cast("string")),
        F.concat(F.lit(f"{kind} form="), form),
        F.concat(F.lit(f"{kind} valid="), base.cast("string")),
        F.concat(F.lit("left="), side(F.right(left, F.lit(1)))),
        F.concat(F.lit("right="), side(F.left(right, F.lit(1)))),
    )


def candidates(text: Column) -> Column:
    """All spans of a text, base or not, in the order of start and kind."""

    def described(kind: str) -> Column:
        def one(m: Column) -> Column:
            start, value, left, right = m["start"], m["value"], m["left"], m["right"]
            end = start + F.length(value)
            base = _is_base(kind, value)
            return F.struct(
                start.alias("start"), F.lit(KINDS.index(kind)).alias("place"), end.alias("end"), F.lit(kind).alias("kind"),
                base.alias("base"), _votes(kind, value, left, right, base).alias("votes"),
                _features(kind, value, left, right, base).alias("features"),
            )

        return F.transform(matches(text, PATTERNS.get(kind) or MORE[kind]), one)

    return F.array_sort(F.concat(*[described(k) for k in KINDS]))


def _log_odds(votes: Column, prior: float, table: dict) -> Column:
    """Log odds that a candidate with these votes is real, by the present estimates."""
    ratios = [(f"{LABELERS.index(name)}{vote}", math.log(real / other)) for (name, vote), (real, other) in table.items()]
    weights = F.create_map(*[F.lit(x) for pair in ratios for x in pair])
    cast = F.transform(F.sequence(F.lit(0), F.lit(len(LABELERS) - 1)), lambda k: F.concat(k.cast("string"), F.substring(votes, k + 1, F.lit(1))))
    return F.aggregate(cast, F.lit(math.log(prior / (1 - prior))), lambda total, key: total + F.element_at(weights, key))


def _chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def reliabilities(patterns: DataFrame) -> tuple[float, dict]:
    """Expectation-maximisation over (votes, n): the share of real candidates, and for each labeler and vote its
    chance on real and on other candidates. Starts from the balance of votes; sums are smoothed by one."""
    letter = F.substring("votes", F.col("place") + 1, F.lit(1)).alias("vote")
    places = F.explode(F.sequence(F.lit(0), F.lit(len(LABELERS) - 1))).alias("place")
    cast = materialize(patterns.select("votes", "n", places).select("votes", "n", "place", letter), "pii_casts")
    balance = F.length(F.replace("votes", F.lit("n"))) - F.length(F.replace("votes", F.lit("y")))
    chance = _chance(balance.cast("double"))
    for _ in range(ITERATIONS):
        sums = cast.withColumn("p", chance).groupBy("place", "vote").agg(F.sum(F.col("n") * F.col("p")).alias("real"), F.sum("n").alias("n"))
        rows = {(LABELERS[r["place"]], r["vote"]): (r["real"], r["n"]) for r in sums.collect()}  # a row per labeler and vote
        yes, total = (sum(r[k] for (name, _), r in rows.items() if name == LABELERS[0]) for k in (0, 1))
        prior = (yes + 1) / (total + 2)
        table = {}
        for key in [(name, vote) for name in LABELERS for vote in "yn-"]:
            real, n = rows.get(key, (0.0, 0))
            table[key] = (real + 1) / (yes + 3), (n - real + 1) / (total - yes + 3)
        chance = _chance(_log_odds(F.col("votes"), prior, table))
    return prior, table


def span_classifier(spans: DataFrame, prior: float, table: dict) -> Column:
    """Log odds of a span from its features: naive Bayes weighted by the posteriors of the votes."""
    weighted = spans.select("features", _chance(_log_odds(F.col("votes"), prior, table)).alias("p"))
    rows = weighted.select(F.explode("features").alias("feature"), "p").groupBy("feature")
    rows = rows.agg(F.sum("p").alias("real"), F.sum(1 - F.col("p")).alias("other")).collect()  # some 200 features at most
    real, other = (sum(r[c] for r in rows if r["feature"].startswith("kind=")) + 1.0 for c in ("real", "other"))
    weights = F.create_map(*[F.lit(x) for r in sorted(rows) for x in (r["feature"], math.log((r["real"] + 0.5) / (real + 1) * (other + 1) / (r["other"] + 0.5)))]) if rows else None

    def odds(features: Column) -> Column:
        start = F.lit(math.log(real / other))
        if weights is None:
            return start
        return F.aggregate(features, start, lambda total, f: total + F.coalesce(F.element_at(weights, f), F.lit(0.0)))

    return odds


def find(docs: DataFrame, of: str = "text") -> DataFrame:
    """doc_id and spans, an array of (kind, start, end, base) in the order of start and kind."""
    found = docs.select("doc_id", candidates(F.coalesce(F.col(of), F.lit(""))).alias("candidates"))
    found = materialize(found, "pii_candidates")
    spans = found.select(F.explode("candidates").alias("c")).select("c.votes", "c.features")
    patterns = materialize(spans.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "pii_votes")
    prior, table = reliabilities(patterns)
    odds = span_classifier(spans, prior, table)
    # stretches of 64 characters that base spans touch: most candidates are clear of them without a look at the spans
    stretches = lambda c: F.sequence(F.floor(c["start"] / 64), F.floor((c["end"] - 1) / 64))
    bases = F.filter("candidates", lambda c: c["base"])
    bases = F.struct(bases.alias("spans"), F.flatten(F.transform(bases, stretches)).alias("touched"))

    def clear(c: Column, bases: Column) -> Column:
        near = F.exists(stretches(c), lambda k: F.array_contains(bases["touched"], k))
        return ~near | ~F.exists(bases["spans"], lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    def accepted(c: Column, bases: Column) -> Column:
        return c["base"] | ((odds(c["features"]) >= math.log(THRESHOLD / (1 - THRESHOLD))) & clear(c, bases))

    kept = _let(bases, lambda b: F.filter("candidates", lambda c: accepted(c, b)))
    short = F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")))
    return found.select("doc_id", short.alias("spans"))


def listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans as text, n_base (base spans of all kinds) and n_added (the others)."""
    found = find(docs)
    base = F.filter("spans", lambda s: s["base"])
    found_of = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind)))
    counts = [found_of(k).cast("long").alias(f"n_{k}") for k in PATTERNS]
    digest = F.sha2(listed(base).cast("binary"), 256).alias("base_sha256")
    totals = [F.size(base).cast("long").alias("n_base"), (F.size("spans") - F.size(base)).cast("long").alias("n_added")]
    return found.select("doc_id", *counts, digest, listed(F.col("spans")).alias("spans"), *totals)
