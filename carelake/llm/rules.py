"""Document quality by a learned decision list over text statistics (operator 9).

Statistics, training and verdict are DataFrame and SQL expressions only. The statistics of a document come from its own
row (no shuffle). A decision list is learnt from labelled documents by sequential covering: a rule is a
conjunction of thresholds that finds bad documents; it is *grown* by adding the threshold that improves
its precision most (FOIL's gain), *pruned* on the third of the labels that growing does not
see, kept if it is precise there, and what it covers is taken away before the next rule grows. Each step
is one aggregate of all labelled documents over all candidate thresholds, so only feature x threshold
counts come to the driver. Thresholds are quantiles of the labelled documents. The list is
emitted as an ordered chain of Spark conditionals: ``CASE WHEN rule 1 THEN false WHEN rule 2 .. ELSE true END``.

Defined cases: null text holds no words (its ratios are 0); documents without a label do not train, and a document with
contradicting labels counts as bad if any label is bad; without labels of both kinds the list is empty and only the
base rule decides; ties between thresholds go to the first in feature and threshold order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.session import pin

SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"  # fixed by the output's definition


# --- statistics ---------------------------------------------------------------------------------------

def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPLIT), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Each window's 64-bit hash gives up its low bits to its place, so that one sort of plain numbers puts equal
    windows side by side; neighbours are then compared by the whole hash. The places found, in
    order, cover min(3, distance to the next) words each.
    """
    n = F.size(words) - 2
    place_bits = F.ceil(F.log2(F.greatest(n, F.lit(2)).cast("double") + 1)).cast("int")
    hashes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    three = F.lit(3).cast("long")

    def covered(h: Column, size: Column) -> Column:
        full = lambda t: F.get(h, F.pmod(t, size).cast("int"))  # noqa: E731  the whole hash of a tagged place
        tagged = F.sort_array(F.transform(h, lambda x, i: x - F.pmod(x, size) + i))
        sorted_hashes = lambda t: F.transform(t, full)
        places = _let(tagged, lambda t: _let(sorted_hashes(t), lambda f: F.sort_array(F.transform(
            F.filter(t, lambda x, j: (F.get(f, j) == F.get(f, j - 1)) | (F.get(f, j) == F.get(f, j + 1))),
            lambda x: F.pmod(x, size)))))
        return _let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(three, F.coalesce(F.get(p, j + 1) - x, three))),
            F.lit(0).cast("long"), lambda total, x: total + x))

    return F.when(n < 2, F.lit(0).cast("long")).otherwise(
        _let(F.call_function("shiftleft", F.lit(1).cast("long"), place_bits), lambda size: _let(hashes, lambda h: covered(h, size))))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the features."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    p = lambda c: f"{prefix}{c}"
    out = docs.withColumn(p("words"), _words(t))
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    # array_distinct and length work on characters; translate with an empty target deletes
    out = out.withColumns({
        p("n_words"): F.size(p("words")).cast("long"),
        p("word_chars"): F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"),
        p("n_symbols"): (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        p("n_lines"): F.size(lines).cast("long"),
        p("n_dup_lines"): (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        p("n_upper"): (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
        p("n_marks"): (F.length(t) - F.length(F.translate(t, "!?", ""))).cast("long"),
        p("n_repeat_words"): _let(F.col(p("words")), _repeat_words),  # bound: a filter above may inline the words
    }).drop(p("words"))
    return out.withColumn(p("base_failed"), (F.col(p("n_words")) < 50) | (100 * F.col(p("n_repeat_words")) > 50 * F.col(p("n_words"))))


def features(prefix: str = "") -> dict[str, Column]:
    """The learner's features: ratios that do not grow with the length of a text."""
    c = lambda x: F.col(f"{prefix}{x}").cast("double")
    share = lambda a, b: F.coalesce(c(a) / F.nullif(c(b), F.lit(0.0)), F.lit(0.0))
    return {"word_length": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": share("n_upper", "word_chars"), "mark_share": share("n_marks", "n_words")}


# --- learning ----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self, feats: dict[str, Column]) -> Column:
        x = feats[self.feature]
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def _all(rule: Rule, feats) -> Column:
    out = F.lit(True)
    for t in rule:
        out = out & t.column(feats)
    return out


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    """FOIL's gain of going from (bad, good) = (p0, n0) to (p1, n1)."""
    if not p1:
        return -math.inf
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def _tables(rows: DataFrame, names: list[str]) -> dict:
    """(feature, bin) -> (bad, good): one aggregate of the rows."""
    bins = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in names])
    counted = (rows.select("bad", F.explode(bins).alias("x")).groupBy("x.f", "x.b")
               .agg(F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")))
    return {(r["f"], r["b"]): (r["p"], r["n"]) for r in counted.collect()}


def _bin(value: Column, thresholds: list[float]) -> Column:
    return F.size(F.filter(F.lit(thresholds), lambda x: x < value))


def _in_bins(rule: list[tuple]) -> Column:
    """A rule over bins, as (feature, above, bin): bin i holds the values over threshold i - 1 and up to threshold i."""
    out = F.lit(True)
    for f, above, i in rule:
        out = out & ((F.col(f) > i) if above else (F.col(f) <= i))
    return out


def learn_list(rows: DataFrame, names: list[str], max_rules: int = 6, max_tests: int = 3, cuts: int = 24,
               precision: float = 0.97, least: float = 0.005) -> list[Rule]:
    """The decision list of a table with the features ``names``, ``bad`` (boolean) and ``grow`` (boolean: for growing, else for
    pruning). A rule is kept if, on the pruning part, at least ``precision`` of what it covers is bad and that is at least the
    share ``least`` of the bad documents there."""
    # sizes, and quantiles of the bad and of the good documents: thresholds lie where either kind varies
    at = [(i + 0.5) / cuts for i in range(cuts)]
    known = {(r["bad"], r["grow"]): r["n"] for r in rows.groupBy("bad", "grow").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(known) < 4:
        return []
    found = rows.groupBy("bad").agg(*[F.percentile_approx(f, at, 10000).alias(f) for f in names]).collect()
    thresholds = {f: sorted({float(x) for r in found for x in r[f]}) for f in names}
    # a value's bin never changes: it is looked up once
    left = pin(rows.select("bad", "grow", *[_bin(F.col(f), thresholds[f]).alias(f) for f in names]), "bins")
    rules: list[list[tuple]] = []
    while len(rules) < max_rules:
        rule: list[tuple] = []
        part = left.where("grow")
        while len(rule) < max_tests:
            table = _tables(part, names)
            p0, n0 = (sum(v[i] for (f, _), v in table.items() if f == names[0]) for i in (0, 1))
            if not p0 or not n0:
                break
            best, test = 1e-9, None
            for f in names:
                below_p = below_n = 0
                for i in range(len(thresholds[f])):
                    p, n = table.get((f, i), (0, 0))
                    below_p, below_n = below_p + p, below_n + n
                    for above, (p1, n1) in ((True, (p0 - below_p, n0 - below_n)), (False, (below_p, below_n))):
                        gain = _gain(p0, n0, p1, n1)
                        if gain > best:
                            best, test = gain + 1e-9, (f, above, i)
            if test is None:
                break
            rule.append(test)
            part = part.where(_in_bins([test]))
        if not rule:
            break
        # prune: of the rule's beginnings the one with the best worth on documents that growing did not see
        begins = [rule[:i] for i in range(1, len(rule) + 1)]
        seen = left.where("not grow").agg(*[F.sum((_in_bins(r) & (F.col("bad") == bad)).cast("long")).alias(f"{name}{i}")
                                            for i, r in enumerate(begins) for name, bad in (("p", True), ("n", False))]).first()
        worth = [((seen[f"p{i}"] or 0), (seen[f"n{i}"] or 0)) for i in range(len(begins))]
        i = max(range(len(begins)), key=lambda i: ((worth[i][0] - worth[i][1]) / max(1, sum(worth[i])), worth[i][0], -i))
        p, n = worth[i]
        if p < max(1, least * known[True, False]) or p < precision * (p + n):
            break
        rules.append(begins[i])
        left = left.where(~_in_bins(begins[i]))
    return [tuple(Test(f, above, thresholds[f][i]) for f, above, i in r) for r in rules]


def verdict(rules: list[Rule], feats: dict[str, Column]) -> Column:
    """The list as one ordered conditional: false for what a rule finds, else true."""
    out = None
    for r in rules:
        out = F.when(_all(r, feats), F.lit(False)) if out is None else out.when(_all(r, feats), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn_from(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", prefix: str = "", **kw) -> list[Rule]:
    """The list learnt from a table with statistics and (doc_id, quality) labels; quality 0 is bad. A third of the
    documents, by a hash of the id, prunes. All labelled documents take part."""
    marks = (labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("__id"))
             .agg((F.min("quality") < 1).alias("bad")))
    feats = features(prefix)
    rows = stats.join(marks, F.col(f"`{id_col}`").cast("long") == F.col("__id"))
    rows = pin(rows.select("bad", (F.pmod(F.xxhash64("__id"), F.lit(3)) > 0).alias("grow"),
                           F.col(f"{prefix}base_failed").alias("base_failed"), *[c.alias(f) for f, c in feats.items()]), "labelled")
    return learn_list(rows.where(~F.col("base_failed")), list(feats), **kw)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every document."""
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    stats = pin(with_statistics(narrow).drop("text"), "statistics")  # a few numbers a document
    rules = learn_from(stats, labels)
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        (~F.col("base_failed") & verdict(rules, features())).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the base rule and the learned list keep, with their columns."""
    prefix = "__q_"
    marked = pin(with_statistics(docs, text, prefix), "statistics")  # computed once, for learning and for the verdict
    rules = learn_from(marked, labels, id_col, prefix)
    keep = ~F.col(f"{prefix}base_failed") & verdict(rules, features(prefix))
    return marked.where(keep).select(*[f"`{c}`" for c in docs.columns])
