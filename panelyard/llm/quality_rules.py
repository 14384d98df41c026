"""Quality rules: a threshold table compiled into one projection of text ratios.

The counts of a text are one built-in expression; ``compiled`` turns the rows of a
threshold table into one boolean column per rule, and ``apply_rules`` returns both
with the verdict. No user function is involved.

Defined results: a null text has no words and counts as empty; an empty text fails
the base rule (fewer than 50 words); repeated rows are judged one by one; a rule
whose denominator is zero passes; an empty table gives an empty result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.llm.frames import SPACE_RUN, SPACES, or_empty, pick

SYMBOLS = "#*$%&|<>"

# Common words of the languages of the corpus; a text of prose has some of them.
STOP_WORDS = (
    # English
    "the be to of and that have with in is was a for it as on by this an at from are or not "
    # German
    "der die und das den von mit zu dem des ist auf im sich ein eine als auch es nicht "
    # French
    "le la les de et un une du que qui en pour dans est au pas par sur avec ce il elle "
    # Spanish
    "el los las y se del con una su para es al lo como por no"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= part / whole <= most``, tested without division."""

    name: str
    part: str
    whole: str | None = None
    least: float | None = None
    most: float | None = None


BASE_WORDS = 50
BASE_REPEATED = 50  # per cent of the words

THRESHOLDS = (
    Rule("mean_word_length", "word_chars", "n_words", least=2.0, most=12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", least=2),
    Rule("words_with_letters", "n_letter_words", "n_words", least=0.6),
    Rule("exclamation_marks_per_word", "n_exclamations", "n_words", most=0.3),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=0.3),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words",
            "n_letter_words", "n_exclamations", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def _apply(value: Column, function) -> Column:
    """``function`` of a value that is worked out once although it is used often.

    A column of its own would not do: a filter above the projection would be pushed
    below it with the whole expression in place of every mention.
    """
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _next_equal(values: Column, key) -> Column:
    """For each element of a sorted array but the last, whether the next has its key."""
    more = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), more), F.slice(values, F.lit(2), more),
                      lambda a, b: key(a) == key(b))


def _meeting(values: Column, same: Column) -> Column:
    """The elements whose key is also that of a neighbour."""
    no = F.array(F.lit(False))
    marks = F.zip_with(F.concat(same, no), F.concat(no, same), lambda a, b: a | b)
    return F.filter(F.zip_with(values, marks, lambda v, m: F.when(m, v)), lambda v: v.isNotNull())


def _covered(starts: Column) -> Column:
    """Words in the 3-word windows that start at these sorted places."""
    more = F.greatest(F.size(starts) - 1, F.lit(0))
    steps = F.zip_with(F.slice(starts, F.lit(1), more), F.slice(starts, F.lit(2), more),
                       lambda a, b: F.least(b - a, F.lit(3).cast("long")))
    return F.aggregate(steps, F.when(F.size(starts) > 0, F.lit(3)).otherwise(0).cast("long"),
                       lambda total, step: total + step)


PLACE_BITS = 31


def _repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice.

    Each window is a number of 33 hash bits and its place, so a sort of numbers
    brings equal windows together. Those that met are sorted once more by their
    words, which decide. The effort is n log n for any text.
    """
    def window(i: Column) -> tuple[Column, ...]:
        return F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)

    def checked(codes: Column) -> Column:
        exact = F.array_sort(F.transform(codes, lambda c: _apply(
            c.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"),
            lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.cast("long").alias("at")))))
        return _apply(exact, lambda e: _covered(F.sort_array(F.transform(
            _meeting(e, _next_equal(e, lambda x: x["w"])), lambda x: x["at"]))))

    codes = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.shiftleft(
        F.xxhash64(*window(i)), PLACE_BITS).bitwiseOR(i.cast("long"))))
    found = _apply(codes, lambda c: _apply(
        _next_equal(c, lambda x: F.shiftrightunsigned(x, PLACE_BITS)),
        lambda same: F.when(F.array_contains(same, True), checked(_meeting(c, same))).otherwise(0)))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(found)


def _measures(text: Column) -> Column:
    """A struct of ``MEASURES`` of one text."""
    bare = F.trim(text, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")

    def counted(v: Column) -> Column:
        w, line = v["words"], v["lines"]
        counts = {
            "n_words": F.size(w),
            "word_chars": F.length(F.array_join(w, "")),
            "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")),
            "n_dup_lines": F.size(line) - F.size(F.array_distinct(line)),
            "n_repeat_words": _repeated_words(w),
            "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))),
            "n_letter_words": F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))),
            "n_exclamations": F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))),
            "n_lines": F.size(line),
            "n_bullet_lines": F.size(F.filter(line, lambda x: F.ltrim(x).rlike("^[-*•]"))),
            "n_ellipsis_lines": F.size(F.filter(
                line, lambda x: x.endswith("...") | x.endswith("…"))),
        }
        return F.struct(*[counts[name].cast("long").alias(name) for name in MEASURES])

    return _apply(F.struct(words.alias("words"), lines.alias("lines")), counted)


def compiled(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """One boolean column per row of the threshold table."""
    def passes(rule: Rule) -> Column:
        part = F.col(rule.part)
        whole = F.lit(1) if rule.whole is None else F.col(rule.whole)
        tests = [F.lit(True)]
        if rule.least is not None:
            tests.append(part >= whole * F.lit(rule.least))
        if rule.most is not None:
            tests.append(part <= whole * F.lit(rule.most))
        return (whole == 0) | reduce(Column.__and__, tests)

    return {f"ok_{rule.name}": passes(rule) for rule in rules}


def apply_rules(documents: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, all counts, one column per rule, ``base_failed`` and ``kept``."""
    counts = pick(documents, id_col, text_col).select(
        id_col, _measures(or_empty(F.col(text_col))).alias("m")).select(id_col, "m.*")
    verdicts = compiled(rules)
    base = (F.col("n_words") < BASE_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEATED * F.col("n_words"))
    every = reduce(Column.__and__, verdicts.values(), F.lit(True))
    return counts.select(
        id_col, *MEASURES, *[v.alias(k) for k, v in verdicts.items()],
        base.alias("base_failed"), (~base & every).alias("kept"))
