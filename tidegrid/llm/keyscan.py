"""Secrets in texts: fixed base patterns, and strings that two character Markov models find more random than ordinary.

One model holds how characters follow each other in random strings, the other how they do in ordinary identifiers; both are
counted from labelled samples. A candidate is a secret if its log-likelihood ratio, summed over its characters, reaches a
threshold that held-out ordinary samples set. All work on rows is SQL expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex")
LEAST_VALUE = 12

ADDED = "random"
#: What the models look at: long runs of the characters of keys and identifiers, outside assignments.
LEAST_CANDIDATE = 16
CANDIDATE = rf"[A-Za-z0-9_+/=-]{{{LEAST_CANDIDATE},}}"
WORD = r"[A-Za-z0-9_+/=-]{4,}"
CODES = 96  # printable ASCII and, as 0, the start of a string
#: Both models start from an even distribution: so many times each character after each.
PRIOR = 1
#: Ordinary words are taken from some so many documents, those with the least digests of the text.
MAX_DOCS = 4_000
#: Share of held-out ordinary samples that may reach the threshold.
FALSE_SHARE = 0.001
#: Share of held-out random samples that may stay below it.
MISSED_SHARE = 0.01
BLOCK = 1_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(steps: Column) -> Column:
    """Sums of an array of numbers up to each place, block by block, so that long arrays cost little more than their length."""

    def plain(xs: Column) -> Column:
        last = lambda sums: F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("bigint"))
        return F.aggregate(xs, F.array().cast("array<bigint>"), lambda sums, x: F.concat(sums, F.array(last(sums) + x)))

    def joined(sums: Column) -> Column:
        before = lambda i, totals: F.coalesce(F.try_element_at(totals, i), F.lit(0).cast("bigint"))
        totals = plain(F.transform(sums, lambda s: F.element_at(s, -1)))
        shifted = lambda totals: F.flatten(F.transform(sums, lambda s, i: let(F.when(i > 0, before(i, totals)).otherwise(0), lambda n: F.transform(s, lambda x: x + n))))
        return let(totals, shifted)

    blocks = lambda xs: F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(BLOCK)), lambda k: plain(F.slice(xs, k, F.lit(BLOCK))))
    return let(steps, lambda xs: let(blocks(xs), joined))


def parts(text: Column, pattern: str, group: int = 0) -> Column:
    """The text cut at the matches: ``at``, where a gap begins, the ``gap``, the ``match`` behind it (null at last) and a ``value`` in it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("match"), values.alias("value"))
    size = lambda c: F.coalesce(F.char_length(c), F.lit(0)).cast("bigint")
    # arrays_zip inside lambdas names its fields by number
    gap, match, value = (lambda x: x["0"]), (lambda x: x["1"]), (lambda x: x["2"])
    placed = lambda cut: F.zip_with(
        cut,
        running(F.transform(cut, lambda x: size(gap(x)) + size(match(x)))),
        lambda x, end: F.struct((end - size(gap(x)) - size(match(x))).alias("at"), gap(x).alias("gap"), match(x).alias("match"), value(x).alias("value")),
    )
    renamed = F.transform(zipped, lambda x: F.struct(x["gap"].alias("0"), x["match"].alias("1"), x["value"].alias("2")))
    uncut = F.array(F.struct(F.lit(0).cast("bigint").alias("at"), text.alias("gap"), F.lit(None).cast("string").alias("match"), F.lit(None).cast("string").alias("value")))
    return F.when(text.rlike(pattern), let(renamed, placed)).otherwise(uncut)


def matches(cut: Column, kind: int, keep: Callable[[Column], Column]) -> Column:
    """Spans of the matches among ``parts`` that ``keep`` accepts: start, number of the kind, end (exclusive), value."""

    def span(x: Column) -> Column:
        start = x["at"] + F.char_length(x["gap"])
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.char_length(x["match"])).alias("end"), x["value"].alias("value"))

    return F.transform(F.filter(cut, lambda x: x["match"].isNotNull() & keep(x)), span)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Base spans and candidates of every whole text: ``row`` (the columns ``keep``), ``base`` and ``candidates``.

    Base spans of a kind do not overlap, leftmost first; positions are code points. Candidates are outside assignments and do
    not touch a base span. Null texts are empty. Everything stays in its row; nothing is shuffled.
    """
    keep = docs.columns if keep is None else keep
    every = lambda x: F.lit(True)
    rows = docs.select(F.struct(F.lit(0).alias("_tg"), *[F.col(f"`{c}`") for c in keep]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("cut", parts(F.col("text"), ASSIGN, 1))
    assigned = matches(F.col("cut"), 0, lambda x: F.char_length(x["value"]) >= LEAST_VALUE)
    base = F.concat(assigned, matches(parts(F.col("text"), ACCESS), 1, every), matches(parts(F.col("text"), HEX), 2, every))
    own = lambda x: F.transform(matches(parts(x["gap"], CANDIDATE), 3, lambda y: ~y["match"].rlike(f"{HEX}|{ACCESS}")), lambda y: moved(y, x["at"]))
    moved = lambda y, at: F.struct((y["start"] + at).alias("start"), y["kind"].alias("kind"), (y["end"] + at).alias("end"), y["value"].alias("value"))
    return rows.select("row", F.array_sort(base).alias("base"), F.flatten(F.transform("cut", own)).alias("candidates"))


@dataclass(frozen=True)
class Model:
    """Thousandths of the log-likelihood ratio of each pair of characters, as ``96 * before + after``, and the least sum of a secret."""

    ratio: tuple[int, ...]
    threshold: int

    def score(self, string: Column) -> Column:
        """Log-likelihood ratio of a string, in thousandths: positive if it looks random."""
        table = F.split(F.lit(",".join(map(str, self.ratio))), ",").cast("array<int>")
        step = lambda state, c: F.struct(code(c).alias("last"), (state["sum"] + F.get(table, state["last"] * CODES + code(c))).alias("sum"))
        start = F.struct(F.lit(0).alias("last"), F.lit(0).cast("bigint").alias("sum"))
        return F.aggregate(F.split(string, ""), start, step, lambda state: state["sum"])


def code(character: Column) -> Column:
    """1 to 95 for printable ASCII, the last of these for any other character."""
    return F.least(F.greatest(F.ascii(character) - 31, F.lit(1)), F.lit(CODES - 1))


def ratios(counts: dict[tuple[int, int, int], int]) -> tuple[int, ...]:
    """Thousandths of ln P(after | before, random) / P(after | before, ordinary) from counts by label, before and after."""
    total = [[PRIOR * (CODES - 1) + sum(counts.get((label, a, b), 0) for b in range(CODES)) for a in range(CODES)] for label in (0, 1)]

    def chance(label: int, a: int, b: int) -> float:
        return (counts.get((label, a, b), 0) + PRIOR) / total[label][a]

    return tuple(round(1000 * math.log(chance(1, a, b) / chance(0, a, b))) for a in range(CODES) for b in range(CODES))


def held_out(string: Column) -> Column:
    return F.substring(F.md5(string), 1, 1).isin("0", "1", "2")


def train(samples: DataFrame, string: str = "string", label: str = "label") -> Model:
    """A model from labelled strings: label 1 random, 0 ordinary. Repeated strings count once; nulls and empty ones are ignored.

    Three sixteenths of the strings are held out of the counts. Of those as long as a candidate, all but ``MISSED_SHARE`` of the
    random ones reach the threshold, but of the ordinary ones no more than ``FALSE_SHARE``, which goes first. Without
    held-out random strings it is at least 0; without samples of a label its model is even. Only counts of
    pairs of characters reach the driver, at most 2 * 96 * 96.
    """
    rows = samples.select(F.col(f"`{string}`").alias("string"), F.col(f"`{label}`").cast("int").alias("label")).where("string != ''").distinct()
    codes = F.concat(F.array(F.lit(0)), F.transform(F.split("string", ""), code))
    known = rows.where(~held_out(F.col("string"))).select("label", codes.alias("codes"))
    pairs = known.select("label", F.explode(F.zip_with(F.expr("slice(codes, 1, size(codes) - 1)"), F.expr("slice(codes, 2, size(codes) - 1)"), lambda a, b: a * CODES + b)).alias("pair"))
    counted = pairs.groupBy("label", "pair").count().collect()
    model = Model(ratios({(r["label"], r["pair"] // CODES, r["pair"] % CODES): r["count"] for r in counted}), 0)
    tests = rows.where(held_out(F.col("string")) & (F.char_length("string") >= LEAST_CANDIDATE))
    scored = tests.select("label", model.score(F.col("string")).alias("score"))
    of = lambda label, share: F.percentile(F.when(F.col("label") == label, F.col("score")), share)
    ordinary, random = scored.agg(of(0, 1 - FALSE_SHARE), of(1, MISSED_SHARE)).first()
    least = 0 if random is None else round(random)
    return Model(model.ratio, least if ordinary is None else max(least, round(ordinary) + 1))


def labelled(scanned: DataFrame, docs: DataFrame, text: str = "text", most: int = MAX_DOCS) -> DataFrame:
    """Labelled strings of a corpus: values of all base spans are random; words of some ``most`` documents are ordinary.

    A word counts as ordinary if it is shorter than a candidate, or letters alone, and holds no base span; so a secret that
    the base patterns miss does not teach that such strings are ordinary.
    """
    random = scanned.select(F.explode("base.value").alias("string")).withColumn("label", F.lit(1))
    share = F.lit(f"{min(2**32 - 1, most * 2**32 // max(1, scanned.count())):08x}")
    some = docs.where(F.substring(F.md5(F.col(f"`{text}`")), 1, 8) <= share)
    words = some.select(F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), F.lit(0))).alias("string"))
    plain = (F.char_length("string") < LEAST_CANDIDATE) | F.col("string").rlike("^[A-Za-z]+$") & ~F.col("string").rlike(f"{HEX}|{ACCESS}")
    return random.unionByName(words.where(plain).withColumn("label", F.lit(0)))


def find(scanned: DataFrame, model: Model) -> DataFrame:
    """``row`` with the spans: ``base`` and ``added`` (candidates that the model takes for random), ``n_assign``, ``n_access``, ``n_hex``,
    ``base_text`` and ``spans`` as ``kind:start:end``, by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, ADDED)])
    written = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    added = F.filter("candidates", lambda x: model.score(x["value"]) >= model.threshold)
    rows = scanned.select("row", "base", added.alias("added"))
    everything = F.array_sort(F.concat("base", "added"))
    return rows.select("row", "base", "added", *map(number, range(len(KINDS))), written(F.col("base")).alias("base_text"), written(everything).alias("spans"))


def find_secrets(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base`` and ``spans`` (text, see ``find``).

    Kept columns (default: all) named like a result are replaced. Null and empty texts have no spans; rows stay one by one.
    """
    made = [*(f"n_{k}" for k in KINDS), "base", "spans"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    found = find(scan(docs, text, keep), model)
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *made[:3], F.col("base_text").alias("base"), "spans")
