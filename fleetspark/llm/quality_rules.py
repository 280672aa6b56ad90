"""Quality rules: an ordered decision list learned from labelled statistics, all in Spark.

Statistics of a text are native expressions. Sequential covering grows a rule on two thirds of the
labelled rows by adding the threshold condition of most information gain, prunes it on the other
third by dropping its last conditions, keeps it if it is precise there, removes the rows that it
covers and starts again. Every step is one aggregation over all labelled rows that returns a count
for each feature and interval between cut points, so nothing grows with the data but the scan. The
result is a conditional expression whose first fitting rule names the reason of rejection.

Null and empty texts have no words and statistics of zero. Labels that are null are left out; a
text with several labels counts with each. Without rows of both classes the list has no rule and
rejects nothing. Repeated rows are judged alike. ``with_statistics`` adds the columns of
``STATISTICS`` (and replaces columns of these names); all others stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage

WHITE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of every whole text."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in STATISTICS]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(f"[^{WHITE}]"))
    df = docs.select(
        *kept,
        F.length(F.regexp_replace(t, f"[{WHITE}]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long").alias("n_upper"),
        lines.alias("_lines"),
        F.transform(F.filter(F.split(t, f"[{WHITE}]+"), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("_words"),
    )
    names = [f"`{c}`" for c in df.columns if c not in ("_lines", "_words")]
    # Windows are compared by 64-bit hashes of their words' hashes, within one text only.
    window = F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
    )
    df = df.select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_words") >= WINDOW, window).alias("_windows"),
    )
    # Only texts that repeat a window are sorted: equal windows then lie side by side.
    places = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(repeats, places)).drop("_windows")
    again = F.filter(
        "_sorted",
        lambda w, k: (w["h"] == F.get("_sorted", k - 1)["h"]) | F.coalesce(w["h"] == F.get("_sorted", k + 1)["h"], F.lit(False)),
    )
    df = df.withColumn("_starts", F.array_sort(F.transform(again, lambda w: w["i"]))).drop("_sorted")
    gaps = F.transform("_starts", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - p, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(gaps, F.lit(0), lambda total, g: total + g), F.lit(0))
    df = df.withColumn("n_repeat_words", covered.cast("long"))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns if c not in STATISTICS], *STATISTICS)


def base_failed() -> Column:
    """The fixed rules that come before the learned ones: too few words, or too many repeated ones."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def passing(docs: DataFrame, rules: list[tuple[Condition, ...]], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither a fixed nor a learned rule rejects."""
    # The row number keeps Spark from moving the filter below the statistics, where each use of a
    # statistic would become a copy of all that computes it.
    measured = with_statistics(docs, text).withColumn("_row", F.monotonically_increasing_id())
    fits = (F.col("_row") >= 0) & ~base_failed() & decide(rules, features()).isNull()
    return measured.where(fits).drop("_row", *STATISTICS)


def features() -> dict[str, Column]:
    """What conditions are made of; all finite for every text."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "repeated_lines_per_word": F.col("n_dup_lines") / words,
        "repeated_words": F.col("n_repeat_words") / words,
        "upper_case": F.col("n_upper") / chars,
    }


@dataclass(frozen=True)
class Settings:
    cuts: int = 24
    max_rules: int = 12
    max_conditions: int = 4
    least_covered: int = 5
    least_precision: float = 0.9
    prune_third: int = 3


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    cut: float

    def column(self, value: Column) -> Column:
        return value >= self.cut if self.at_least else value < self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule, values: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, (c.column(values[c.feature]) for c in rule), F.lit(True))


def decide(rules: list[Rule], values: dict[str, Column]) -> Column:
    """The text of the first rule that holds, else null."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(holds(rule, values), F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def learn(rows: DataFrame, key: str, bad: Column, settings: Settings = Settings()) -> list[Rule]:
    """Rules for ``bad`` rows of a table with statistics; ``key`` decides which rows prune."""
    s, values = settings, features()
    rows = stage(
        rows.where(bad.isNotNull()).select(
            bad.alias("bad"),
            (F.pmod(F.xxhash64(key), F.lit(s.prune_third)) == 0).alias("prune"),
            *[v.alias(n) for n, v in values.items()],
        ),
        "labelled",
    )
    names, steps = list(values), [(k + 1) / (s.cuts + 1) for k in range(s.cuts)]
    quantiles = [
        F.percentile_approx(F.when(F.col("bad") == side, F.col(n)), steps, 10_000).alias(f"{n}_{side}")
        for n in names
        for side in (True, False)
    ]
    sketch = rows.agg(*quantiles).first()
    cuts = {n: sorted({c for side in (True, False) for c in sketch[f"{n}_{side}"] or []}) for n in names}
    columns = {n: F.col(n) for n in names}
    rules: list[Rule] = []
    left = rows
    for _ in range(s.max_rules):
        rule = _grow(left.where(~F.col("prune")), columns, cuts, s)
        if not rule:
            break
        rule = _prune(left.where("prune"), rule, columns, s)
        if not rule:
            break
        rules.append(rule)
        left = left.where(~holds(rule, columns))
    return rules


def _grow(rows: DataFrame, columns: dict[str, Column], cuts: dict[str, list[float]], s: Settings) -> Rule:
    rule: Rule = ()
    while len(rule) < s.max_conditions:
        place = [
            F.struct(F.lit(n).alias("feature"), _interval(columns[n], cuts[n]).alias("interval")) for n in columns if cuts[n]
        ]
        if not place:
            return rule
        found = rows.where(holds(rule, columns)).select("bad", F.explode(F.array(*place)).alias("at"))
        counts = found.groupBy("at.feature", "at.interval").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
        table: dict[str, dict[int, tuple[int, int]]] = {}
        for r in counts.collect():  # a row for each feature and interval
            table.setdefault(r["feature"], {})[r["interval"]] = (r["p"], r["n"])
        if not table:
            return rule
        total = [sum(c[i] for c in next(iter(table.values())).values()) for i in (0, 1)]
        best, gain = None, 1e-9
        for name in sorted(table):
            below = [0, 0]
            for k, cut in enumerate(cuts[name]):
                below = [below[i] + table[name].get(k, (0, 0))[i] for i in (0, 1)]
                for at_least, (p, n) in ((False, below), (True, [total[i] - below[i] for i in (0, 1)])):
                    if p >= s.least_covered and total[0] and n < total[1]:
                        g = p * (log2(p / (p + n)) - log2(total[0] / (total[0] + total[1])))
                        if g > gain:
                            best, gain = Condition(name, at_least, cut), g
        if best is None:
            return rule
        rule = (*rule, best)
    return rule


def _interval(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted cut points are at most ``value``."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value))


def _prune(rows: DataFrame, rule: Rule, columns: dict[str, Column], s: Settings) -> Rule:
    """The beginning of the rule with the best (p - n) / (p + n), if that is precise enough."""
    counts = []
    for k in range(1, len(rule) + 1):
        inside = holds(rule[:k], columns)
        counts += [F.count_if(inside & F.col("bad")).alias(f"p{k}"), F.count_if(inside & ~F.col("bad")).alias(f"n{k}")]
    got = rows.agg(*counts).first()
    worth = [((got[f"p{k}"] - got[f"n{k}"]) / max(1, got[f"p{k}"] + got[f"n{k}"]), k) for k in range(1, len(rule) + 1)]
    score, k = max(worth, key=lambda w: (w[0], -w[1]))
    return rule[:k] if score >= 2 * s.least_precision - 1 else ()
