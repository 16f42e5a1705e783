"""Cluster labels from product samples."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.text import fill, tidy_label, title_case, tokens
from assortment.operators.enrich import generate_text
from assortment.operators.views import real_clusters
from assortment.sources.lineage import cut, shuffled

LABEL_WORDS = 3
PHRASE_WORDS = 3


def label_samples(clustered: DataFrame, clean: DataFrame) -> DataFrame:
    """(cluster_id, samples): `NAME (CATEGORY)` of the first products of each cluster.

    The first twenty ids are taken, those without a product dropped, and fifteen used. The filter on
    the row number lets map tasks keep twenty rows per cluster.
    """
    by_id = Window.partitionBy("cluster_id").orderBy("product_id")
    first = (
        real_clusters(clustered).select("cluster_id", "product_id")
        .withColumn("_rn", F.row_number().over(by_id)).where(F.col("_rn") <= fixed.LABEL_SAMPLE_IDS)
    )
    text = F.concat(F.col("name"), F.lit(" ("), F.col("category"), F.lit(")"))
    products = clean.select("product_id", text.alias("sample"))
    found = first.join(products, "product_id", "left")
    known = F.collect_list(F.when(F.col("sample").isNotNull(), F.struct("product_id", "sample")))
    samples = F.transform(F.array_sort(known), lambda s: s["sample"])
    return found.groupBy("cluster_id").agg(
        F.slice(samples, 1, fixed.LABEL_SAMPLE_USED).alias("samples")
    )


def label_prompt(samples: DataFrame) -> DataFrame:
    """Add the `prompt` that asks for a label."""
    lines = F.array_join(F.transform("samples", lambda s: F.concat(F.lit("- "), s)), "\n")
    return samples.withColumn("prompt", fill(fixed.LABEL_PROMPT, samples=lines))


def word_labels(clustered: DataFrame, clean: DataFrame) -> DataFrame:
    """(cluster_id, cluster_label): the three most frequent words of all members, most distinctive first.

    Counts are made in the map tasks, so a hot cluster or word sends one row per task and word.
    """
    members = shuffled(real_clusters(clustered).select("cluster_id", "product_id"))
    texts = clean.select("product_id", "name", "category")
    words = members.join(texts, "product_id").select(
        "cluster_id", F.explode(tokens(F.concat_ws(" ", "name", "category"))).alias("word")
    )
    counts = words.groupBy("cluster_id", "word").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("word").agg(F.sum("n").alias("total"))
    most = Window.partitionBy("cluster_id").orderBy(F.desc("n"), "word")
    top = counts.withColumn("_rn", F.row_number().over(most)).where(F.col("_rn") <= LABEL_WORDS)
    ranked = top.join(totals, "word").groupBy("cluster_id").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("n") / F.col("total")).alias("share"), (-F.col("n")).alias("n"), "word")
    )).alias("words"))
    label = F.array_join(F.transform("words", lambda w: w["word"]), " ")
    return ranked.select("cluster_id", tidy_label(title_case(label)).alias("cluster_label"))


def _phrases(words: Column) -> Column:
    """The distinct runs of one to PHRASE_WORDS words."""

    def runs(length: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (length - 1))
        found = F.transform(starts, lambda at: F.array_join(F.slice(words, at, length), " "))
        return F.when(F.size(words) >= length, found).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*(runs(n) for n in range(1, PHRASE_WORDS + 1))))


def phrase_contrast(clustered: DataFrame, clean: DataFrame) -> DataFrame:
    """(cluster_id, phrase, n, contrast): how clearly a phrase of one to three words sets the products of a cluster apart.

    `n` counts products of the cluster, `contrast` is the log-likelihood ratio of the phrase inside against all other
    clusters, negative where it is rarer inside; six decimals. Counts are made in the map tasks, and the totals of a
    phrase from its counts per cluster, so neither a hot cluster nor a hot phrase meets in one task.
    """
    members = real_clusters(clustered).select("cluster_id", "product_id")
    texts = clean.select("product_id", tokens(F.concat_ws(" ", "name", "category")).alias("words"))
    found = members.join(texts, "product_id")
    sizes = found.groupBy("cluster_id").agg(F.count(F.lit(1)).cast("double").alias("size"))
    counts = (
        found.select("cluster_id", F.explode(_phrases(F.col("words"))).alias("phrase"))
        .groupBy("cluster_id", "phrase").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = cut(counts)
    totals = counts.groupBy("phrase").agg(F.sum("n").cast("double").alias("total"))
    all_rows = sizes.agg(F.sum("size")).scalar()
    rows = counts.join(totals, "phrase").join(sizes, "cluster_id").withColumn("rows", all_rows)
    n, total, size, every = F.col("n").cast("double"), F.col("total"), F.col("size"), F.col("rows")

    def part(cell: Column, with_phrase: Column, inside: Column) -> Column:
        return F.when(cell > 0, cell * F.log(cell * every / (with_phrase * inside))).otherwise(0.0)

    ratio = 2 * (
        part(n, total, size) + part(total - n, total, every - size)
        + part(size - n, every - total, size) + part(every - size - total + n, every - total, every - size)
    )
    sign = F.when(n * every >= total * size, 1.0).otherwise(-1.0)
    return rows.select("cluster_id", "phrase", "n", F.round(sign * ratio, 6).alias("contrast"))


def contrast_labels(clustered: DataFrame, clean: DataFrame) -> DataFrame:
    """(cluster_id, cluster_label) of up to five words: the phrase that sets a cluster apart most, and the one or two
    words that come next and share no word with it.

    A phrase counts as much as its weakest word, so that words that all clusters share do not come in beside one that is
    a cluster's own. Of equal phrases the more frequent, longer, then first in order counts. The filters on row numbers
    let map tasks keep one phrase per cluster.
    """
    found = cut(phrase_contrast(clustered, clean).withColumn("words", F.split("phrase", " ")))
    own = found.where(F.size("words") == 1).select("cluster_id", F.col("phrase").alias("word"), F.col("contrast").alias("of_word"))
    spread = found.withColumn("word", F.explode("words")).join(own, ["cluster_id", "word"])
    weakest = F.least(F.col("contrast"), F.min("of_word")).alias("weakest")
    ranked = cut(spread.groupBy("cluster_id", "phrase", "words", "n", "contrast").agg(weakest))
    order = Window.partitionBy("cluster_id").orderBy(F.desc("weakest"), F.desc("n"), F.desc(F.size("words")), "phrase")

    def first(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")

    best = first(ranked).select("cluster_id", F.col("phrase").alias("best"), F.col("words").alias("taken"))
    others = ranked.where(F.size("words") < PHRASE_WORDS).join(best, "cluster_id")
    second = first(others.where(~F.arrays_overlap("words", "taken"))).select("cluster_id", F.col("phrase").alias("second"))
    label = tidy_label(title_case(F.concat_ws(" ", "best", "second")))
    return best.join(second, "cluster_id", "left").select("cluster_id", label.alias("cluster_label"))


def label_clusters(
    clustered: DataFrame, clean: DataFrame, generator: Callable | None = None, contrast: bool = False
) -> DataFrame:
    """(cluster_id, cluster_label) from the words of all members, or from a text generator that sees samples. With
    `contrast` the words are phrases that set a cluster apart from the others."""
    if generator is None:
        return contrast_labels(clustered, clean) if contrast else word_labels(clustered, clean)
    prompts = label_prompt(label_samples(clustered, clean)).select("cluster_id", "prompt")
    return generate_text(prompts, generator).select("cluster_id", tidy_label(F.col("text")).alias("cluster_label"))
