"""Measures and verdicts of the rules against plain Python."""

import re
from collections import Counter

from assortment.llm import quality_rules
from assortment.llm.queries import QUERIES
from assortment.sources.lineage import cut

from .helpers import HARD_TEXTS, documents

DATA = "/root/testdata/sf0.001"
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts, inside = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)
    )


def plain_fails(text, m):
    n, chars, symbols, dup, _ = m
    marks = len(re.findall(r"(?m)^[\x20\t]*[-*•|]", text))
    lines = text.count("\n") + 1
    return {
        "symbols": 20 * symbols > chars, "word_length": chars > 20 * n or chars < 2 * n,
        "repeated_lines": dup > 3 and 10 * dup > 3 * lines, "capitals": 2 * len(re.findall("[A-Z]", text)) > chars,
        "shouting": 10 * len(re.findall("[!?]", text)) > chars, "digits": 2 * len(re.findall("[0-9]", text)) > chars,
        "list_marks": 4 * marks > 3 * lines and n > 40,
    }


def plain_row(key, text):
    m = plain_measures(text)
    base = m[0] < 20 or 100 * m[4] > 30 * m[0]
    return (key, *m, base, not base and not any(plain_fails(text or "", m).values()))


def test_query_against_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    expected = {plain_row(*r) for r in docs}
    assert {tuple(r) for r in QUERIES["op5_rules"](spark, DATA).collect()} == expected
    assert {r[-1] for r in expected} == {True, False}


def test_hard_rows(spark):
    prose = "Some words that make a sentence, and no window comes again in it at all; so it is kept by every rule here."
    texts = [
        *HARD_TEXTS, (20, prose), (21, prose + "\n" + prose + "\nshort\nshort\n\n \n \n"), (22, prose.upper()),
        (23, "1234 5678 " * 12 + prose), (24, "- a line\n" * 3 + "\n".join(f"- {w} x{i}" for i, w in enumerate(prose.split()))),
        (25, prose.replace(" ", "!! ")), (26, "\x0b".join(prose.split()) + "\x85   end"),
    ]
    got = quality_rules.judged(documents(spark, texts)).collect()
    rows = sorted(((r["doc_id"], *(r[c] for c in COLUMNS), r["base_failed"], r["kept"]) for r in got), key=repr)
    assert rows == sorted((plain_row(*t) for t in texts), key=repr)
    assert {r["first_failed"] for r in got if r["doc_id"] in (20, 22)} == {None, "capitals"}
    assert quality_rules.judged(documents(spark, [])).count() == 0


def test_order_does_not_change_the_verdict(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = lambda rules: {(r["doc_id"], r["kept"]) for r in quality_rules.judged(docs, rules=rules).collect()}
    assert kept(quality_rules.RULES) == kept(quality_rules.RULES[::-1])


def test_rules_are_ordered_by_rejection_per_cost(spark):
    sample = cut(spark.range(2000).selectExpr("repeat(string(id), 200) text", "id + 20 n_words", "0L n_repeat_words"))
    rules = (
        quality_rules.Rule("never", "n_words < 0"), quality_rules.Rule("dear", "regexp_count(text, '(1|2)+3') > 10 or n_words < 1500"),
        quality_rules.Rule("often", "n_words < 1500"), quality_rules.Rule("also", "n_words < 1500"),
    )
    for given in (rules, rules[::-1], rules):
        assert [r.name for r in quality_rules.ordered(sample, given)] == ["also", "often", "dear", "never"]


def test_only_rows_that_reach_the_rules_count(spark):
    """Texts that fail the base rule would make `short` the best rule."""
    sample = cut(spark.range(2000).selectExpr("string(id) text", "if(id < 1900, 5L, 100L) n_words", "0L n_repeat_words"))
    rules = (quality_rules.Rule("short", "n_words < 20"), quality_rules.Rule("some", "n_words = 100"))
    assert [r.name for r in quality_rules.ordered(sample, rules)] == ["some", "short"]
    assert quality_rules.ordered(sample.where("n_words = 5"), rules) == list(rules)


def test_native_plan(spark):
    plan = quality_rules.judged(spark.read.parquet(f"{DATA}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
