"""Chat formatting in budgeted windows.

Prefix sums of turn tokens, taken by a window function, choose spans of whole turns that fit a token budget. Each
span after the first starts again with the system turns and as much of the turns before it as the history budget
allows; those repeated turns are masked, so every assistant text is a target once. A turn is

    <turn ROLE>TEXT</turn>\\n

and inside roles and texts a backslash is written \\s, < is \\l and > is \\g, so that no text can hold a mark and
what was written can be read back. A token stands for four bytes of a formatted turn, rounded up; another measure
can be handed in. A conversation is one training example whose turns are gathered into one row.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assortment.llm.texts import let

BUDGET = 1024
HISTORY = 256
OPEN, CLOSE = "<turn ", "</turn>\n"
SYSTEM, TARGET = "system", "assistant"


def escaped(text: Column) -> Column:
    for plain, written in (("\\", "\\s"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in ((">", "\\g"), ("<", "\\l"), ("\\", "\\s")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def four_bytes(turn: Column) -> Column:
    return F.ceil(F.octet_length(turn) / 4).cast("long")


def formatted(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    budget: int = BUDGET, history: int = HISTORY, tokens: Callable[[Column], Column] = four_bytes,
) -> DataFrame:
    """(conversation, window, formatted, loss, n_turns, n_repeated, n_tokens), a row per window.

    `loss` holds spans (start, stop) of code points in `formatted`: the texts of the assistant turns that are new
    in the window. The first `n_repeated` turns are repeated ones.

    A window is over the budget only if the system turns and a single turn are; such a turn stands alone. Turns
    are ordered by number (null first), then role and text; repeated rows are repeated turns. Null texts and
    roles count as empty; a null conversation is a conversation. Leading system turns are retained, later ones
    are turns like others. An empty table gives no rows. Other columns are ignored.
    """
    own = turns.select(
        F.col(conversation).alias("_c"), F.col(turn).alias("_n"), F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    head = F.concat(F.lit(OPEN), escaped(F.col("_role")), F.lit(">"))
    body = F.concat(head, escaped(F.col("_text")), F.lit(CLOSE))
    own = own.withColumns({
        "_tokens": F.greatest(F.lit(1), tokens(body)).cast("long"), "_head": F.char_length(head), "_chars": F.char_length(body),
    })
    running = Window.partitionBy("_c").orderBy("_n", "_role", "_text").rowsBetween(Window.unboundedPreceding, 0)
    # The formatted turn is made again above the window, so that the shuffle holds each text once.
    turn_row = F.struct(
        F.sum("_tokens").over(running).alias("upto"), "_tokens", body.alias("body"),
        (F.col("_role") == TARGET).alias("target"), F.col("_head").alias("head"),
        F.sum("_chars").over(running).alias("chars"), F.col("_chars").alias("own_chars"),
        F.min((F.col("_role") == SYSTEM).cast("int")).over(running).alias("lead"),
    )
    gathered = own.select("_c", turn_row.alias("_t")).groupBy("_c").agg(F.array_sort(F.collect_list("_t")).alias("_turns"))
    made = let(F.col("_turns"), lambda t: let(
        F.size(F.filter(t, lambda x: x["lead"] == 1)), lambda lead: _windows(t, lead, budget, history)
    ))
    return gathered.select(F.col("_c").alias(conversation), F.explode(made).alias("_w")).select(conversation, "_w.*")


def _upto(turns: Column, at: Column, field: str = "upto") -> Column:
    """The prefix sum of the first `at` turns."""
    return F.when(at > 0, F.get(turns, at - 1)[field]).otherwise(F.lit(0)).cast("long")


def _windows(turns: Column, lead: Column, budget: int, history: int) -> Column:
    n, fixed = F.size(turns), _upto(turns, lead)
    numbers = F.when(n > lead, F.sequence(lead + 1, n)).otherwise(F.array().cast("array<int>"))
    start = F.struct((lead + 1).alias("first"), (lead + 1).alias("shown"), F.lit(0).cast("long").alias("base"))

    def grown(done: Column, i: Column) -> Column:
        """Turn i joins the last window while its prefix sum stays within the budget, or opens the next one."""
        last, own = F.element_at(done, -1), F.get(turns, i - 1)
        fits = (i == last["first"]) | (own["upto"] - last["base"] <= budget)
        room = F.greatest(F.lit(0), F.least(F.lit(history), F.lit(budget) - fixed - own["_tokens"]))
        before = _upto(turns, i - 1)
        back = F.filter(F.slice(turns, lead + 1, i - 1 - lead), lambda x: before - x["upto"] + x["_tokens"] <= room)
        shown = i - F.size(back)
        opened = F.struct(i.alias("first"), shown.alias("shown"), (_upto(turns, shown - 1) - fixed).alias("base"))
        return F.when(fits, done).otherwise(F.concat(done, F.array(opened)))

    def laid_out(starts: Column) -> Column:
        def one(w: Column, at: Column) -> Column:
            stop = F.coalesce(F.get(starts, at + 1)["first"] - 1, n)
            repeated = w["first"] - w["shown"] + F.when(at > 0, lead).otherwise(0)
            shift = F.when(at > 0, _upto(turns, w["shown"] - 1, "chars") - _upto(turns, lead, "chars")).otherwise(F.lit(0))
            begin = F.when(at > 0, w["first"]).otherwise(F.lit(1))
            new = F.slice(turns, begin, stop - begin + 1)
            shown = F.concat(
                F.when(at > 0, F.slice(turns, 1, lead)).otherwise(F.slice(turns, 1, 0)),
                F.slice(turns, w["shown"], w["first"] - w["shown"]), new,
            )
            loss = F.transform(F.filter(new, lambda x: x["target"]), lambda x: F.struct(
                (x["chars"] - x["own_chars"] + x["head"] - shift).cast("long").alias("start"),
                (x["chars"] - len(CLOSE) - shift).cast("long").alias("stop"),
            ))
            size = _upto(turns, stop) - w["base"]
            return F.struct(
                at.alias("window"), F.array_join(F.transform(shown, lambda x: x["body"]), "").alias("formatted"),
                loss.alias("loss"), F.size(shown).alias("n_turns"), repeated.alias("n_repeated"), size.alias("n_tokens"),
            )

        return F.transform(starts, one)

    return let(F.aggregate(numbers, F.array(start), grown), laid_out)


def read_back(windows: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """(conversation, n_turns, turns, loss_text, formatted_chars) from formatted windows alone: every turn once
    as role, newline, text, newline, and all text under the loss mask."""
    parts = F.slice(F.split("formatted", OPEN), F.col("n_repeated") + 2, F.col("n_turns"))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, ">", 1)
        body = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(CLOSE))
        return F.concat(unescaped(role), F.lit("\n"), unescaped(body), F.lit("\n"))

    lost = F.transform("loss", lambda s: unescaped(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    own = windows.select(
        conversation, "window", (F.col("n_turns") - F.col("n_repeated")).cast("long").alias("new"),
        F.array_join(F.transform(parts, turn), "").alias("turns"), F.array_join(lost, "").alias("loss_text"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    joined = F.array_sort(F.collect_list(F.struct("window", "turns", "loss_text")))
    whole = own.groupBy(conversation).agg(
        F.sum("new").alias("n_turns"), joined.alias("_all"), F.sum("chars").alias("formatted_chars")
    )
    of = lambda name: F.array_join(F.transform("_all", lambda x: x[name]), "")
    return whole.select(conversation, "n_turns", of("turns").alias("turns"), of("loss_text").alias("loss_text"), "formatted_chars")
