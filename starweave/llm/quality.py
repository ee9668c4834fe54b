"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` names, for each rule, a ratio and the range that a kept document
must lie in.  ``judge`` adds one struct column with the counts, the ratios,
the names of the rules that fail and the verdict, all from built-in
functions.  Words are runs of other characters than \\x20 and \\x09-\\x0D.

Counts: n_words; word_chars (code points in words); n_symbols (characters of
``#*$%&|<>``); n_dup_lines (\\n-split lines with a word that equal an earlier
line); n_repeat_words (words inside 3-word windows that occur twice or more in
the text, the first time included); n_lines (lines with a word); n_stop_words
(words of ``STOP_WORDS``); n_upper (A-Z).

Repeated windows are found by sorting a document's windows and comparing
neighbours, so a text of n words takes n log n steps.

Null text counts as empty; a text without words has ratios of zero and fails
the length rule; repeated and null doc_ids are judged like any row; an empty
table gives no rows; all input columns are kept, and if one has the new
column's name, that gets an underscore more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, free_name, named_again, plain_names

SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Very common words of the corpus languages (English, French, German, Spanish), any one letter case.
STOP_WORDS = (
    "the of and to in a is that it for on was with be as this by are at from an "
    "de la le les des et un une en que du pour par dans est qui sur "
    "der die das und den von zu mit ist im ein eine sich nicht für auf "
    "el los las y se del con para por su una es al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """Kept if low <= part / whole <= high (a bound of None is open)."""

    name: str
    part: str
    whole: str | None
    low: float | None = None
    high: float | None = None


# The table: length, repetition, symbol, letter, stop-word and line ratios.
RULES = (
    Rule("enough_words", "n_words", None, low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
    Rule("word_length", "word_chars", "n_words", low=2, high=12),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("upper_case", "n_upper", "word_chars", high=0.4),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
)
# The first two are the base: a document that fails one is rejected whatever the others say.
BASE = ("enough_words", "repeated_words")


def _count_of(text: Column, chars: str) -> Column:
    return (F.octet_length(text) - F.octet_length(F.translate(text, chars, ""))).cast("long")


def _stop_forms() -> list[str]:
    return sorted({f for w in STOP_WORDS for f in (w, w.capitalize())})


def counts(text: Column, hidden: str) -> tuple[list[tuple[str, Column]], Column]:
    """Steps (name, column) to add one after another, each used by later
    ones, and the struct of counts that they lead to."""
    t, words, lines, windows, pairs = (f"{hidden}{x}" for x in ("t", "w", "l", "g", "p"))
    n = F.size(words)
    size = F.greatest(n - 2, F.lit(0))

    def shifted(k: int) -> Column:
        return F.slice(words, k, size)

    same = F.filter(pairs, lambda p: (p["a"]["x"] == p["b"]["x"]) & (p["a"]["y"] == p["b"]["y"])
                    & (p["a"]["z"] == p["b"]["z"]))
    covered = F.flatten(F.transform(same, lambda p: F.array(
        *[p[k]["at"] + i for k in ("a", "b") for i in range(3)])))
    steps = [
        (t, F.coalesce(text, F.lit(""))),
        (words, F.array_remove(F.split(F.translate(t, SPACE, " " * len(SPACE)), " "), "")),
        (lines, F.filter(F.split(t, "\n"),
                         lambda x: F.octet_length(F.btrim(x, F.lit(SPACE))) > 0)),
        # The windows in order, then each with its neighbour.
        (windows, F.when(n >= 4, F.sort_array(F.arrays_zip(
            shifted(1).alias("x"), shifted(2).alias("y"), shifted(3).alias("z"),
            F.sequence(F.lit(1), size).alias("at"))))),
        (pairs, F.arrays_zip(F.slice(windows, 1, F.greatest(F.size(windows) - 1, F.lit(0))).alias("a"),
                             F.slice(windows, 2, F.greatest(F.size(windows) - 1, F.lit(0))).alias("b"))),
    ]
    found = F.struct(
        n.cast("long").alias("n_words"),
        F.char_length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
        _count_of(F.col(t), SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.greatest(F.size(F.array_distinct(covered)), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(words, lambda w: w.isin(*_stop_forms()))).cast("long").alias("n_stop_words"),
        _count_of(F.col(t), _UPPER).alias("n_upper"))
    return steps, found


def _fails(rule: Rule, c: Column) -> Column:
    """Ratios are compared as products, so no rounding decides."""
    part = c[rule.part].cast("double")
    whole = c[rule.whole].cast("double") if rule.whole else F.lit(1.0)
    failed = F.lit(False)
    if rule.low is not None:
        failed = failed | (part < whole * rule.low)
    if rule.high is not None:
        failed = failed | (part > whole * rule.high)
    return failed


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[str, ...] = BASE
          ) -> DataFrame:
    """``docs`` with a struct ``quality``: the counts, ``failed`` (names of
    failed rules), ``base_failed`` and ``kept``.  To filter by it, use
    ``good_documents``."""
    docs, old = plain_names(docs, "text")
    name = free_name(docs, "quality", old)
    hidden = free_name(docs, "q_")
    while any(c.lower().startswith(hidden.lower()) for c in docs.columns):
        hidden += "_"
    plain = [F.col(f"`{c}`") for c in docs.columns]
    steps, found = counts(F.col("text"), hidden)
    df = docs
    for k, step in steps:
        df = df.withColumn(k, step)
    df = df.select(*plain, found.alias(name))
    c = F.col(name)
    failed = F.filter(F.array(*[F.when(_fails(r, c), F.lit(r.name)) for r in rules]),
                      lambda x: x.isNotNull())
    base_failed = F.lit(False)
    for r in rules:
        if r.name in base:
            base_failed = base_failed | _fails(r, c)
    df = df.withColumn(name, c.withField("failed", failed).withField("base_failed", base_failed))
    df = df.withColumn(name, c.withField("kept", F.size(c["failed"]) == 0))
    return named_again(df, old)


def good_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass every rule, unchanged."""
    docs, old = plain_names(docs, "text")
    judged = judge(docs, rules)
    verdict, mark = judged.columns[-1], free_name(judged, "mark")
    # The optimizer would move a filter below the projection and so evaluate
    # the rules once more for every column that they use; it moves none past
    # a value that depends on the row's place, such as this mark.
    marked = judged.withColumn(mark, F.monotonically_increasing_id())
    kept = marked.where(F.col(verdict)["kept"] & (F.col(mark) >= 0))
    return named_again(kept.drop(verdict, mark), old)
