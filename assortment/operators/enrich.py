"""Product descriptions: prompts, generation, costs."""

import datetime as dt
from collections.abc import Callable, Iterator
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.text import fill, strip
from assortment.operators.calls import REPLIES, Ledger, in_groups, reply_key, retried
from assortment.operators.embed import token_count
from assortment.operators.numbering import with_position
from assortment.sources.lineage import cut, shuffled
from assortment.sources.tables import Catalogue

CALL_ROWS = 20
TASK_CALLS = 16
GROUP_ROWS = 1280
TEMPLATE_MODEL = "template"
CUSTOM_MODEL = "custom"

# prompts -> one (text, tokens in, tokens out) per prompt
Generator = Callable[[list[str]], list[tuple[str, int, int]]]


def pending_enrichment(clean: DataFrame, clustered: DataFrame, enriched: DataFrame) -> DataFrame:
    """Products without a description, with their cluster if they have one."""
    products = clean.select("product_id", "name", "brand", "category", "department")
    waiting = products.join(enriched.select("product_id"), "product_id", "left_anti")
    clusters = clustered.select("product_id", "cluster_id", "cluster_label")
    return waiting.join(shuffled(clusters), "product_id", "left")


def description_prompt(rows: DataFrame) -> DataFrame:
    """Add `prompt`; the cluster sentence appears for a filled label only."""
    label = F.col("cluster_label")
    sentence = F.when(
        label.isNotNull() & (label != ""), fill(fixed.CLUSTER_SENTENCE, cluster_label=label)
    ).otherwise("")
    prompt = fill(
        fixed.DESCRIPTION_PROMPT, name=F.col("name"), brand=F.col("brand"), category=F.col("category"),
        department=F.col("department"), cluster=sentence,
    )
    return rows.withColumn("prompt", prompt)


def template_text(prompt: Column) -> Column:
    """A plain description made of the product, brand and category lines of a prompt."""

    def line(mark: str) -> Column:
        return F.regexp_extract(prompt, rf"(?m)^{mark}: (.*)$", 1)

    return F.concat(line("Product"), F.lit(" by "), line("Brand"), F.lit(", "), line("Category"))


def generate_text(
    rows: DataFrame, generator: Generator | None = None, ledger: Ledger | None = None, model: str | None = None
) -> DataFrame:
    """Add `text`, `tokens_input`, `tokens_output` for the `prompt` column.

    Without a generator the template text is made by columns. A generator gets up to CALL_ROWS prompts at a
    time; a failing call is tried again, then fails its task. With a `ledger` the replies of a call are stored before the
    next call is made, and prompts of `model` that have a stored reply are not asked again.
    """
    if generator is None:
        out = rows.withColumn("text", template_text(F.col("prompt")))
        return out.withColumns({
            "tokens_input": token_count(F.col("prompt")), "tokens_output": token_count(F.col("text")),
        })
    added = {"text": "string", "tokens_input": "bigint", "tokens_output": "bigint"}
    names = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema]
    schema = ", ".join(names + [f"{n} {t}" for n, t in added.items()])

    generate = retried(generator)
    if ledger is not None:
        return _remembered(rows, generate, ledger, model or CUSTOM_MODEL)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b.iloc[at:at + CALL_ROWS] for b in batches for at in range(0, len(b), CALL_ROWS)):
            replies = generate(list(batch.prompt))
            yield batch.assign(**{n: [r[i] for r in replies] for i, n in enumerate(added)})

    return rows.mapInPandas(call, schema)


def _remembered(rows: DataFrame, generate: Callable, ledger: Ledger, model: str) -> DataFrame:
    """`generate_text` through a ledger: replies are joined by key, the other prompts are asked once each.

    Only distinct prompts without a reply reach the generator, by key in tasks of some TASK_CALLS calls, as many as that
    takes: adaptive execution would merge them by bytes. What they are told is joined again.
    """
    keyed = rows.withColumn("_key", reply_key(model, F.col("prompt")))
    known = cut(ledger.known(rows.sparkSession))
    asked = keyed.select("_key", "prompt").dropDuplicates(["_key"]).join(known, F.col("_key") == F.col("reply_key"), "left_anti")
    page_of = ledger.book()

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        page = page_of()
        for batch in (b.iloc[at:at + CALL_ROWS] for b in batches for at in range(0, len(b), CALL_ROWS)):
            new = batch[~batch._key.isin(list(page.replies))]
            if len(new):
                page.add(list(new._key), generate(list(new.prompt)))
            replies = [(key, *page.replies[key]) for key in batch._key]
            yield pd.DataFrame(replies, columns=["reply_key", "text", "tokens_input", "tokens_output"])

    asked = cut(asked)
    tasks = max(1, ceil(asked.count() / (CALL_ROWS * TASK_CALLS)))
    told = cut(asked.repartition(tasks, "_key").mapInPandas(call, REPLIES))
    replies = known.unionByName(told)
    return keyed.join(replies, F.col("_key") == F.col("reply_key")).drop("_key", "reply_key")


def generation_cost(tokens_input: Column, tokens_output: Column) -> Column:
    return (
        tokens_input * fixed.GENERATION_USD_PER_TOKEN_IN + tokens_output * fixed.GENERATION_USD_PER_TOKEN_OUT
    )


def enriched_rows(
    products: DataFrame, at: dt.datetime, generator: Generator | None = None, model: str | None = None,
    keep_cluster_id: bool = True, ledger: Ledger | None = None,
) -> DataFrame:
    """`products_enriched` rows for (product columns, cluster_id, cluster_label)."""
    made = generate_text(description_prompt(products), generator, ledger, model)
    cluster_id = F.col("cluster_id") if keep_cluster_id else F.lit(None)
    return made.select(
        "product_id", cluster_id.cast("long").alias("cluster_id"), "cluster_label",
        strip(F.col("text")).alias("description_enriched"),
        F.lit(model or (TEMPLATE_MODEL if generator is None else CUSTOM_MODEL)).alias("description_model"),
        F.lit(fixed.DESCRIPTION_TONE).alias("description_tone"),
        F.col("tokens_input").alias("description_tokens_input"),
        F.col("tokens_output").alias("description_tokens_output"),
        generation_cost(F.col("tokens_input"), F.col("tokens_output")).alias("description_cost_usd"),
        F.lit(at).cast("timestamp").alias("description_created_at"),
    )


def _totals() -> list[Column]:
    cost = F.round(F.coalesce(F.sum("description_cost_usd"), F.lit(0.0)), 4)
    return [F.count(F.lit(1)).alias("enriched"), cost.alias("total_cost_usd")]


def total_cost(rows: DataFrame) -> DataFrame:
    """Rows and their cost, four decimals."""
    return rows.agg(*_totals())


def enrich_incremental(
    catalogue: Catalogue, at: dt.datetime, generator: Generator | None = None, model: str | None = None,
    group_rows: int = GROUP_ROWS, ledger: Ledger | None = None,
) -> dict:
    """Describe the products that have no description and append them; returns counts.

    With a generator, `group_rows` products are described side by side and appended before the next ones are, so a
    failure keeps what was paid for before it; with a `ledger` it keeps each call that came back, also those of the
    group that failed.
    """
    pending = pending_enrichment(
        catalogue.read("products_clean"), catalogue.read_reloaded("products_clustered"),
        catalogue.read("products_enriched"),
    )
    groups = [pending] if generator is None else in_groups(cut(with_position(pending, "product_id")), "position", group_rows)
    figures = {"enriched": 0, "total_cost_usd": 0.0}
    for group in groups:
        written = Observation()
        catalogue.append(enriched_rows(group, at, generator, model, ledger=ledger).observe(written, *_totals()), "products_enriched")
        figures = {name: value + written.get[name] for name, value in figures.items()}
    return figures | {"total_cost_usd": round(figures["total_cost_usd"], 4)}


def enrich_selected(
    catalogue: Catalogue, ids: DataFrame, at: dt.datetime, generator: Generator | None = None,
    model: str | None = None,
) -> DataFrame:
    """Describe the given products, also those that have a description; unknown ids are an error.

    Returns the appended rows. Their cluster id stays NULL; the label is kept.
    """
    wanted = ids.select("product_id").distinct()
    clean = catalogue.read("products_clean")
    unknown = wanted.join(clean.select("product_id"), "product_id", "left_anti").first()
    if unknown:
        raise ValueError(f"product {unknown.product_id} not found")
    products = clean.select("product_id", "name", "brand", "category", "department")
    clusters = catalogue.read_reloaded("products_clustered").select("product_id", "cluster_id", "cluster_label")
    chosen = products.join(wanted, "product_id", "left_semi").join(clusters, "product_id", "left")
    rows = cut(enriched_rows(chosen, at, generator, model, keep_cluster_id=False))
    catalogue.append(rows, "products_enriched")
    return rows
