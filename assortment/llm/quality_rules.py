"""Quality rules as a short-circuit cascade.

A rule is a Spark expression that says whether a text fails. On a sample, each rule's rate of rejection is
counted and its cost timed; rules are then asked in the order of rejection per cost, and CASE stops at the first
one that fails, so that dear rules see only the texts that cheap ones let pass. The order changes the cost and
which rule is named first, never the verdict. All is one pass over the texts without a shuffle.
"""

import math
import time
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment.llm.texts import let
from assortment.sources.lineage import cut

SAMPLE_ROWS = 2000
SAMPLE_PART = 16
#: Seconds that a rule is asked for at least, the most times, and the step in which its cost counts.
MEASURABLE = 0.05
MOST_TIMES = 64
COST_STEP = 4
WINDOW = 8
BLANKS = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), "")


def _repeated(own: Column, window: int) -> Column:
    """Words inside windows of `window` words that occur twice or more, for an array of words."""
    nothing = F.lit(0).cast("long")

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - window)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(window))))

    def covered(at: Column) -> Column:
        """`at`: sorted starts of the windows that occur again."""
        begin = F.struct(nothing.alias("words"), nothing.alias("end"))

        def grown(done: Column, start: Column) -> Column:
            end = (start + window).cast("long")
            return F.struct((done["words"] + end - F.greatest(done["end"], start.cast("long"))).alias("words"), end.alias("end"))

        return F.aggregate(at, begin, grown, lambda done: done["words"])

    def again(prints: Column) -> Column:
        by_print = F.sort_array(F.transform(prints, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(sorted_: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(sorted_) - 1)
            alike = lambda a, b: F.get(sorted_, a)["h"].eqNullSafe(F.get(sorted_, b)["h"])
            inside = F.filter(places, lambda k: alike(k, k + 1) | ((k > 0) & alike(k, k - 1)))
            return F.sort_array(F.transform(inside, lambda k: F.get(sorted_, k)["i"]))

        found = covered(let(by_print, starts))
        return F.when(F.size(F.array_distinct(prints)) == F.size(prints), nothing).otherwise(found)

    hashed = F.transform(own, lambda w: F.xxhash64(w))
    return F.when(F.size(own) <= window, nothing).otherwise(let(let(hashed, windows), again))


def measures(text: Column, window: int = WINDOW) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), all long, of whole texts.

    Words lie between ASCII blanks; a null text has none. Windows are compared by 64-bit hashes of hashes.
    """
    body = F.coalesce(text, F.lit(""))
    of_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated(w, window).alias("n_repeat_words"),
    ))
    lines = F.filter(F.split(body, "\n"), lambda line: F.rlike(line, F.lit(BLANKS.replace("[", "[^", 1))))
    repeated_lines = let(lines, lambda own: (F.size(own) - F.size(F.array_distinct(own))).cast("long"))
    return F.struct(
        of_words.alias("w"), F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        repeated_lines.alias("n_dup_lines"),
    )


def base_fails(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


@dataclass(frozen=True)
class Rule:
    """`fails`: a Boolean expression over `text` and the measured columns; null counts as not failing."""

    name: str
    fails: str


# Thresholds are wide: they are to catch what is no prose at all.
RULES = (
    Rule("symbols", "20 * n_symbols > word_chars"),
    Rule("word_length", "word_chars > 20 * n_words or word_chars < 2 * n_words"),
    Rule("repeated_lines", r"n_dup_lines > 3 and 10 * n_dup_lines > 3 * (regexp_count(text, '\n') + 1)"),
    Rule("capitals", r"2 * regexp_count(text, '[A-Z]') > word_chars"),
    Rule("shouting", r"10 * regexp_count(text, '[!?]') > word_chars"),
    Rule("digits", r"2 * regexp_count(text, '[0-9]') > word_chars"),
    Rule("list_marks", r"4 * regexp_count(text, '(?md)^[\\x20\\t]*[-*\\u2022|]') > 3 * (regexp_count(text, '\\n') + 1) and n_words > 40"),
)


def ordered(sample: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules by rejection per cost on a sample, equal ones by name.

    Only rows that pass the base rule count: the others never reach the rules. A rule is asked again and again of the
    sample inside one job, until that takes MEASURABLE seconds more than a job which reads the same rows; rules that do
    not take as long in MOST_TIMES rounds cost the same. Costs count in powers of COST_STEP, so that the noise of a clock
    seldom changes the order.
    """
    own = sample.where(~base_fails(F.col("n_words"), F.col("n_repeat_words")))
    failing = [F.count_if(F.expr(rule.fails)).alias(rule.name) for rule in rules]
    rejected = own.agg(F.count(F.lit(1)).alias("rows"), *failing).first()
    if not rejected["rows"]:
        return list(rules)

    def seconds(found: Column, times: int) -> float:
        start = time.perf_counter()
        own.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(times)))).agg(found).collect()
        return time.perf_counter() - start

    @cache
    def idle(times: int) -> float:
        return min(seconds(F.sum(F.octet_length("text")), times) for _ in range(2))

    def cost(rule: Rule) -> int:
        times, taken = 1, 0.0
        while taken < MEASURABLE and times < MOST_TIMES:
            times *= 8
            taken = min(seconds(F.count_if(F.expr(rule.fails)), times) for _ in range(2)) - idle(times)
        return round(math.log(max(taken, MEASURABLE) / times, COST_STEP))

    costs = {rule.name: cost(rule) for rule in rules}
    return sorted(rules, key=lambda r: (-rejected[r.name] / float(COST_STEP) ** costs[r.name], costs[r.name], r.name))


def cascade(rules: list[Rule]) -> Column:
    """The first rule that fails, null if none does; later ones are not computed."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        out = out.when(F.expr(rule.fails), rule.name)
    return out


def judged(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(key, measures, base_failed, first_failed, kept) for each row of `docs`, repeated rows included.

    A null or empty text has no words, so it fails the base rule. Rows with a null key are judged like any
    other. An empty table gives no rows. Other columns are ignored. At most `sample_rows` rows are measured
    beforehand, for the order of the rules alone.
    """
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    part = own.where(F.pmod(F.xxhash64("_key", F.length("text")), F.lit(SAMPLE_PART)) == 0).limit(sample_rows)
    order = ordered(cut(_measured(part)), rules)
    base = base_fails(F.col("n_words"), F.col("n_repeat_words"))
    out = _measured(own).withColumn("base_failed", base)
    out = out.withColumn("first_failed", F.when(F.col("base_failed"), "base").otherwise(cascade(order)))
    return out.withColumn("kept", F.col("first_failed").isNull()).withColumnRenamed("_key", key).drop("text")


def _measured(own: DataFrame) -> DataFrame:
    found = own.withColumn("_m", measures(F.col("text")))
    return found.select("_key", "text", "_m.w.*", "_m.n_symbols", "_m.n_dup_lines")
