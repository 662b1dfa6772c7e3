"""Quality rules as a short-circuit cascade (operator 1).

A rule is a condition on a text that rejects it. The cascade measures on a sample how often each rule
rejects and how long it takes, sorts the rules by rejections per second, and evaluates them in that order
in one ``CASE``: a text that one rule rejects is not looked at by the next. The order changes the cost
and which rule is named as the reason, never the verdict.

Everything is a Spark expression on the row. Null texts have no words; rows are judged one by one, so
repeated rows, ties and null ids change nothing, an empty table gives an empty result, and other columns
are kept as they are.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import BLANKS, WORD, column, fresh_name, let, text_or_empty, total
from tradewind.operators.lineage import written

WINDOW = 3
# Rows (about) of the sample on which the order of the rules is found.
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a text's measures by name, see ``MEASURES``; each is computed when it is used."""
    name: str
    rejects: Callable[[Mapping[str, Column]], Column]


def words_of(text: Column) -> Column:
    spaced = text
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def duplicate_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows_of(words: Column) -> Column:
    """64-bit hashes of every three consecutive words."""
    def windows(words: Column) -> Column:
        return F.when(F.size(words) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda at: F.xxhash64(*[F.get(words, at + k) for k in range(WINDOW)]))).otherwise(
                F.array().cast("array<bigint>"))

    return let(words, windows)


def _covered(windows: Column) -> Column:
    """Number of positions covered by the windows that occur more than once.

    Windows sorted by hash have their equals beside them, and the positions of those, sorted, each add
    what the next one does not cover. Linear in the text but for the two sorts.
    """
    def repeated(pairs: Column) -> Column:
        def same(pair: Column, at: Column) -> Column:
            return (F.get(pairs, at - 1)["hash"].eqNullSafe(pair["hash"])
                    | F.get(pairs, at + 1)["hash"].eqNullSafe(pair["hash"]))
        return F.filter(pairs, same)

    def cover(places: Column) -> Column:
        def gain(place: Column, at: Column) -> Column:
            following = F.get(places, at + 1)
            return F.when(following.isNull(), F.lit(WINDOW)).otherwise(
                F.least(F.lit(WINDOW), following - place))
        return total(F.transform(places, gain))

    pairs = F.sort_array(F.transform(
        windows, lambda hash_, at: F.struct(hash_.alias("hash"), at.alias("at"))))
    return let(pairs, lambda sorted_: let(
        F.sort_array(F.transform(repeated(sorted_), lambda pair: pair["at"])), cover))


def repeated_words(windows: Column) -> Column:
    """Words inside windows that the text holds twice or more, from the text's windows."""
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        _covered(windows))


# What rules may use, from the text and its words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words).cast("long"),
    "word_chars": lambda text, words: F.length(F.array_join(words, "")).cast("long"),
    "n_symbols": lambda text, words: F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
    "n_capitals": lambda text, words: F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
    "n_lines": lambda text, words: F.size(lines_with_words(text)).cast("long"),
    "n_dup_lines": lambda text, words: let(lines_with_words(text), duplicate_lines),
    "n_repeat_words": lambda text, words: let(windows_of(words), repeated_words),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BASE_RULES = (
    Rule("too_short", lambda m: m["n_words"] < 50),
    Rule("repetitive", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
)
RULES = (
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("capitals", lambda m: 10 * m["n_capitals"] > 3 * m["word_chars"]),
    Rule("word_length", lambda m: ~m["word_chars"].between(2 * m["n_words"], 15 * m["n_words"])),
    Rule("duplicate_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
)


class _Measures(Mapping):
    """Measures of a text: those already there as columns, the others as expressions."""

    def __init__(self, text: Column, words: Column, ready: Mapping[str, Column] = MappingProxyType({})):
        self.text, self.words, self.ready = text, words, ready

    def __getitem__(self, name: str) -> Column:
        return self.ready[name] if name in self.ready else MEASURES[name](self.text, self.words)

    def __iter__(self):
        return iter(MEASURES)

    def __len__(self):
        return len(MEASURES)


def _seconds(sample: DataFrame, rejects: Column) -> tuple[float, int]:
    started = time.perf_counter()
    rejected = sample.agg(F.count_if(rejects)).first()[0]
    return time.perf_counter() - started, rejected


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejections per second on a sample of about ``sample_rows`` rows, the best first.

    The sample bounds what the ordering costs; every rule is applied to every row afterwards.
    """
    rows = docs.count()
    if not rows:
        return list(rules)
    body = text_or_empty(column(text))
    sample = written(
        docs.select(body.alias("text")).sample(min(1.0, sample_rows / rows), seed=7)
        .withColumn("words", words_of(F.col("text"))), "rule-sample")
    measures = _Measures(F.col("text"), F.col("words"))
    empty = min(_seconds(sample, F.size("words") < 0)[0] for _ in range(2))  # the job itself, and warm-up
    yields = {}
    for rule in rules:
        cost, rejected = min(_seconds(sample, rule.rejects(measures)) for _ in range(2))
        yields[rule.name] = rejected / max(cost - empty, 1e-3)
    return sorted(rules, key=lambda rule: -yields[rule.name])


def _first_reason(measures: Mapping[str, Column], rules: Sequence[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects; null if none does."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(measures), F.lit(rule.name)).otherwise(verdict)
    return verdict


def keep_good(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + RULES, text: str = "text",
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns unchanged."""
    ordered = order_rules(docs, rules, text, sample_rows)
    body = text_or_empty(column(text))
    # Bound by ``let``: a filter on a column of words would compute them anew at every use.
    reason = let(words_of(body), lambda words: _first_reason(_Measures(body, words), ordered))
    return docs.filter(reason.isNull())


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, str]:
    """All rows of ``docs`` with a struct, and its name: the base numbers of the text, ``base_failed`` and
    ``reason``, the cascade's verdict on texts that pass the base (null: kept)."""
    ordered = order_rules(docs, rules, text, sample_rows)
    name, words, windows = (fresh_name(docs, n) for n in ("quality", "words", "windows"))
    own = {m: fresh_name(docs, m) for m in BASE}
    body = text_or_empty(column(text))
    # Step by step and in columns of their own, so that each is computed once for all that use it.
    measures = _Measures(body, column(words), {"n_repeat_words": repeated_words(column(windows))})
    measured = (
        docs.withColumn(words, words_of(body)).withColumn(windows, windows_of(column(words)))
        .withColumns({own[m]: measures[m] for m in BASE}))
    found = {m: column(own[m]) for m in BASE}
    failed = (found["n_words"] < 50) | (100 * found["n_repeat_words"] > 50 * found["n_words"])
    reason = F.when(~failed, _first_reason(_Measures(body, column(words), found), ordered))
    judged = measured.withColumn(name, F.struct(
        *[found[m].alias(m) for m in BASE], failed.alias("base_failed"), reason.alias("reason")))
    return judged.drop(words, windows, *own.values()), name
