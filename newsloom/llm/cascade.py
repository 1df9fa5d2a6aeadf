"""Quality rules as a short-circuit cascade, ordered by rejections per cost as measured on a sample.

A rule looks at one text and says whether to reject it. Rules share what they derive from the text (words, lines),
and derive it only when they run. ``rule_order`` runs every rule alone on a sample, in Spark tasks, and orders
the rules by rejected rows per second; ``quality_rules`` then runs them in that order and stops a text's cascade
at the first rejection. A text is kept if no rule rejects it, so the order changes the cost and never the verdict.

Defined results: a null text has no words, like an empty one; texts of any length are judged whole; repeated rows
each get their own equal verdict; other columns, whatever their names, pass through untouched; an empty table
gives no rows, and its rules keep the order in which they are listed.
"""

import re
import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
SIGNS_ONLY = re.compile(r"[\W\d_]+")
SAMPLE_ROWS = 2000


class View:
    """What rules may ask of a text; each part is derived when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return WORD.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(SYMBOL.findall(self.text))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if WORD.search(line)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a three-word window that the text has at least twice."""
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        total = covered = 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                total += i + 3 - max(i, covered)
                covered = i + 3
        return total

    @cached_property
    def n_shouted(self) -> int:
        return sum(word.endswith("!!") for word in self.words)

    @cached_property
    def n_wordless(self) -> int:
        return sum(SIGNS_ONLY.fullmatch(word) is not None for word in self.words)

    @cached_property
    def n_stuttered(self) -> int:
        return sum(a == b for a, b in zip(self.words, self.words[1:]))


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a module-level function, so that tasks can import it."""

    name: str
    rejects: Callable[[View], bool]


def too_short(v: View) -> bool:
    return v.n_words < 50


def repeats_itself(v: View) -> bool:
    return 100 * v.n_repeat_words > 50 * v.n_words


def symbol_laden(v: View) -> bool:
    return 10 * v.n_symbols > v.n_words


def odd_word_length(v: View) -> bool:
    return not 2 * v.n_words <= v.word_chars <= 15 * v.n_words


def line_copies(v: View) -> bool:
    return 2 * v.n_dup_lines > len(v.lines)


def shouting(v: View) -> bool:
    return 5 * v.n_shouted > v.n_words


def few_letters(v: View) -> bool:
    return 5 * v.n_wordless > v.n_words


def stutters(v: View) -> bool:
    return 5 * v.n_stuttered > v.n_words


BASE_RULES = (Rule("too_short", too_short), Rule("repeats_itself", repeats_itself))
RULES = (
    *BASE_RULES, Rule("symbol_laden", symbol_laden), Rule("odd_word_length", odd_word_length),
    Rule("line_copies", line_copies), Rule("shouting", shouting), Rule("few_letters", few_letters),
    Rule("stutters", stutters),
)
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rule_order(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> list[Rule]:
    """The rules by rejections per cost on a uniform sample of about ``sample_rows`` rows; ties as listed.

    A task sends one row per rule and batch, the driver gets one row per rule.
    """
    rules = list(rules)
    rows = docs.count()
    if not rows:
        return rules

    def trial(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            spent, rejected = [], []
            for rule in rules:
                began = time.perf_counter()
                rejected.append(sum(rule.rejects(View(t)) for t in texts))
                spent.append(time.perf_counter() - began)
            yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "spent": spent, "rejected": rejected})

    sample = docs.select(F.col(text).alias("text")).sample(min(1.0, sample_rows / rows), seed)
    tried = sample.mapInArrow(trial, "rule string, spent double, rejected long").groupBy("rule")
    sums = {r["rule"]: r for r in tried.agg(F.sum("spent").alias("spent"), F.sum("rejected").alias("rejected")).collect()}

    def gain(rule):
        return sums[rule.name]["rejected"] / max(sums[rule.name]["spent"], 1e-9) if rule.name in sums else 0.0

    return sorted(rules, key=gain, reverse=True)


def quality_rules(
    docs: DataFrame,
    order: Sequence[Rule],
    text: str = "text",
    verdict: str = "kept",
    metrics: Sequence[str] = (),
) -> DataFrame:
    """``docs`` with a boolean column ``verdict`` and, if asked for, columns of ``View`` counts.

    The added columns take the place of columns of the same name. Counts that are asked for cost their derivation
    for every row; the cascade alone derives only what its rules reach.
    """
    order, metrics = list(order), list(metrics)
    added = [T.StructField(m, T.LongType(), False) for m in metrics] + [T.StructField(verdict, T.BooleanType(), False)]
    names = {f.name.lower() for f in added} - {text.lower()}
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    place = [c.lower() for c in base.columns].index(text.lower())

    def judge(batches):
        for batch in batches:
            columns = {m: [] for m in metrics}
            kept = []
            for value in batch.column(place).to_pylist():
                view = View(value)
                for m in metrics:
                    columns[m].append(getattr(view, m))
                kept.append(not any(rule.rejects(view) for rule in order))
            arrays = [*batch.columns, *[pa.array(columns[m], pa.int64()) for m in metrics], pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *metrics, verdict])

    return base.mapInArrow(judge, T.StructType(base.schema.fields + added))
