"""Quality rules as a short-circuit cascade.

Each rule is a condition on features of the text, and each feature is one DataFrame expression. On a bounded sample of
rows every rule is timed alone and the share of rows that it rejects is counted; the rules then run in descending order
of rejection per cost inside one CASE expression, which stops at the first rule that rejects. The order changes what a
rejected row is said to have failed first and how long it takes, never which rows are kept.

The sample is the first ``sample_rows`` rows that Spark reads whose text has at most ``SAMPLE_CHARS`` characters; it
serves to estimate costs only. A rule over columns that exist already costs next to nothing, so costs are taken as they
are in the cascade. Rules with equal estimates keep the order in which they are given.

Behaviour: null text is one without words, which fails; empty tables give empty results; repeated rows, ties and null
ids are judged row by row; all columns of the input are kept, whatever their names.
"""

from __future__ import annotations

import time
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS, SAMPLE_CHARS = 256, 65536
LEAST_SECONDS, MOST_COPIES = 0.03, 4096  # a rule is timed until it takes so long, or on so many copies of the sample
SPACE = "[\\x20\\x09-\\x0D]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``rejects``: SQL over the names of features."""

    name: str
    rejects: str
    needs: tuple[str, ...]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def repeat_words(w: Column) -> Column:
    """Words inside windows of five words that occur twice or more."""
    size = lambda x: F.size(x)
    at = lambda x, i: F.get(x, i)
    hashes = F.transform(
        F.sequence(F.lit(0), size(w) - WINDOW), lambda i: F.xxhash64(*(at(w, i + k) for k in range(WINDOW)))
    )

    def counted(s):
        indexes = F.sequence(F.lit(0), size(s) - 1)
        same = lambda i, j: F.coalesce(at(s, i)["h"] == at(s, j)["h"], F.lit(False))
        starts = F.sort_array(
            F.transform(
                F.filter(indexes, lambda i: F.when(i > 0, same(i, i - 1)).otherwise(False) | same(i, i + 1)),
                lambda i: at(s, i)["i"],
            )
        )
        return _let(
            starts,
            lambda p: F.lit(WINDOW)
            + F.aggregate(
                F.sequence(F.lit(1), size(p) - 1), F.lit(0),
                lambda a, i: a + F.least(F.lit(WINDOW), at(p, i) - at(p, i - 1)),
            ),
        )

    def repeated(h):
        pairs = F.transform(F.sequence(F.lit(0), size(h) - 1), lambda i: F.struct(at(h, i).alias("h"), i.alias("i")))
        return F.when(size(F.array_distinct(h)) == size(h), F.lit(0)).otherwise(_let(F.sort_array(pairs), counted))

    return F.when(size(w) <= WINDOW, F.lit(0)).otherwise(_let(hashes, repeated)).cast("bigint")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


FEATURES = {
    "n_words": lambda t: F.regexp_count(t, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint"),
    "word_chars": lambda t: F.length(F.regexp_replace(t, f"{SPACE}+", "")).cast("bigint"),
    "n_symbols": lambda t: F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("bigint"),
    "n_dup_lines": dup_lines,
    "n_repeat_words": lambda t: _let(words(t), repeat_words),
    "n_lines": lambda t: F.regexp_count(t, F.lit("(?m)^.*[^\\x20\\x09-\\x0D].*$")).cast("bigint"),
    "n_capitals": lambda t: F.regexp_count(t, F.lit("[A-Z]")).cast("bigint"),
    "n_marks": lambda t: F.regexp_count(t, F.lit("!")).cast("bigint"),
}

#: Features of one pass over the text, which may be computed before they are needed.
CHEAP = frozenset(["n_words", "word_chars", "n_symbols", "n_capitals", "n_marks"])

BASE = (
    Rule("few_words", "n_words < 10", ("n_words",)),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", ("n_repeat_words", "n_words")),
)
RULES = (
    Rule("symbols", "10 * n_symbols > n_words", ("n_symbols", "n_words")),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words", ("word_chars", "n_words")),
    Rule("capitals", "10 * n_capitals > 3 * word_chars", ("n_capitals", "word_chars")),
    Rule("exclamations", "5 * n_marks > n_words", ("n_marks", "n_words")),
    Rule("repeated_lines", "n_lines > 3 and 10 * n_dup_lines > 5 * n_lines", ("n_dup_lines", "n_lines")),
)


def _condition(rule: Rule, text: Column, known: dict[str, Column]) -> Column:
    """The rule over ``known`` columns and else the features' own expressions, as one expression."""
    values = F.struct(*(known.get(n, FEATURES[n](text)).alias(n) for n in rule.needs))
    # the features of one rule are bound together, and computed only when the rule's turn comes
    def body(v):
        out = rule.rejects
        return _over(out, {n: v[n] for n in rule.needs})

    return F.coalesce(_let(values, body), F.lit(False))


def _over(sql: str, columns: dict[str, Column]) -> Column:
    """A rule's condition (comparisons of integer polynomials, joined by and/or) on columns."""
    python = sql.replace(" and ", ") & (").replace(" or ", ") | (")
    return eval(f"({python})", {"__builtins__": {}}, dict(columns))  # noqa: S307 - rules are part of the program


def estimate_order(
    docs: DataFrame, rules: tuple[Rule, ...], text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
    known: tuple[str, ...] = (),
) -> list[Rule]:
    """``rules`` by rejections per second on the sample, best first.

    A rule costs what it costs in the cascade: ``known`` features are columns already, and so they are in the sample.
    The sample is repeated within a job until the rule shows against the job itself, which is timed with a constant rule.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    small = docs.select(text.alias("text"), *known).where(F.length("text") <= SAMPLE_CHARS).limit(sample_rows)
    rows = small.collect()
    if not rows:
        return list(rules)
    sample = spark.createDataFrame(rows, small.schema).coalesce(1)
    have = {n: F.col(n) for n in known}

    def seconds(condition: Column, copies: int) -> tuple[float, int]:
        many = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy"))
        count = many.agg(F.count_if(condition & (F.col("_copy") > 0)).alias("n"))
        rejected = count.first()["n"]  # compiles
        start = time.perf_counter()
        count.first()
        return time.perf_counter() - start, rejected

    idle: dict[int, float] = {}
    rates = []
    for rule in rules:
        condition, copies = _condition(rule, F.col("text"), have), 1
        while True:
            if copies not in idle:
                idle[copies] = min(seconds(F.lit(False), copies)[0] for _ in range(2))
            took, rejected = seconds(condition, copies)
            if took >= idle[copies] + LEAST_SECONDS or copies >= MOST_COPIES:
                break
            copies *= 16
        rates.append(rejected / max(took - idle[copies], 1e-6))  # both grow with the copies
    return [r for _, r in sorted(zip(rates, rules), key=lambda x: -x[0])]


def cascade(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES, text_col: str = "text", known: tuple[str, ...] = (),
    output: str = "failed_rule", ordered: bool = True,
) -> DataFrame:
    """``docs`` with the first rule that rejects each row (null: kept). ``known``: features that are columns already.

    Features that several rules need are computed once, before the first rule.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    have = {n: F.col(n) for n in known}
    order = estimate_order(docs, rules, text_col, known=known) if ordered else rules
    uses = Counter(n for rule in rules for n in rule.needs if n not in have)
    shared = [n for n, k in uses.items() if k > 1 and n in CHEAP]

    def verdict(given: dict[str, Column]) -> Column:
        out = None
        for rule in order:
            holds = _condition(rule, text, given)
            out = F.when(holds, rule.name) if out is None else out.when(holds, rule.name)
        return F.lit(None).cast("string") if out is None else out

    if not shared:
        return docs.withColumn(output, verdict(have))
    once = F.struct(*(FEATURES[n](text).alias(n) for n in shared))
    return docs.withColumn(output, _let(once, lambda v: verdict(have | {n: v[n] for n in shared})))


def kept(docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    mark = "_failed_rule"
    while mark in docs.columns:
        mark += "_"
    return cascade(docs, rules, text_col, output=mark).where(F.col(mark).isNull()).drop(mark)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, the text and the base features of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = _let(words(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    return docs.select(F.col(id_col), F.col(text_col), counted.alias("_w")).select(
        id_col, text_col, "_w.*", *(FEATURES[n](text).alias(n) for n in ("word_chars", "n_symbols", "n_dup_lines"))
    )
