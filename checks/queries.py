"""One callable per operator: (spark, sf_dir) -> DataFrame over the whole given tables."""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions import numbers, text, vectors
from assortment.operators import (
    calls, clusters, dashboard, embed, enrich, labels, quality, retrieval, staging, transform, vector, views,
)
from assortment.plans import requests, run
from assortment.sources import fixtures, lineage, tables
from assortment.sources.fixtures import AS_OF
from assortment.streaming import incremental


class Inputs:
    """The catalogue tables of one data folder, derived lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def derive(self, sql: str, **values: str) -> DataFrame:
        return fixtures.derive(self.spark, self.sf_dir, sql, **values)

    @cached_property
    def source(self):
        return self.derive(fixtures.SOURCE_PRODUCTS)

    @cached_property
    def raw(self):
        return staging.stage_products(self.source, AS_OF.date())

    @cached_property
    def normalised(self):
        return transform.normalise_strings(self.raw)

    @cached_property
    def imputed(self):
        return transform.impute_price(self.normalised, transform.category_median(self.raw))

    @cached_property
    def clean(self):
        return transform.clean_products(self.raw, AS_OF)

    @cached_property
    def clustered(self):
        return self.derive(fixtures.PRODUCTS_CLUSTERED)

    @cached_property
    def embedded(self):
        return self.derive(fixtures.PRODUCTS_EMBEDDED, vector="ARRAY<DOUBLE>")

    @cached_property
    def enriched(self):
        return self.derive(fixtures.PRODUCTS_ENRICHED)

    @cached_property
    def planted(self):
        return lineage.cut(self.derive(fixtures.PLANTED_SPARK))

    @cached_property
    def order_items(self):
        return staging.source_order_items(self.derive(fixtures.ORDER_ITEMS))

    @cached_property
    def report(self):
        """Two snapshots: prices imputed by the normalised, then by the raw category."""
        older = transform.clean_products(self.raw, AS_OF, median_key="normalised")
        return quality.quality_snapshot(older, AS_OF.replace(year=2000)).unionByName(
            quality.quality_snapshot(self.clean, AS_OF)
        )

    @cached_property
    def catalogue(self):
        return views.clustered_catalogue(self.clean, self.clustered)

    @cached_property
    def all_views(self):
        clean = lineage.cut(self.clean)
        return views.all_views(clean, self.clustered, self.order_items, self.report, AS_OF)


QUERIES = {}


def query(fn):
    """Register a function of the inputs under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    return fn


NO_TIMES = ("created_at", "cleaned_at", "source_created_at", "report_timestamp")


# --- staging and cleaning ---------------------------------------------------------

@query
def dedupe_products(i):
    return staging.dedupe_products(staging.source_products(i.source)).drop(*NO_TIMES)


@query
def stage_products(i):
    return i.raw.withColumn("ingestion_date", F.col("ingestion_date").cast("string")).drop(*NO_TIMES)


@query
def staging_checks(i):
    return staging.staging_checks(i.raw)


@query
def normalise_strings(i):
    return i.normalised.drop(*NO_TIMES)


@query
def category_median(i):
    return transform.category_median(i.raw)


@query
def category_median_normalised(i):
    return transform.category_median(i.raw, median_key="normalised")


@query
def impute_price(i):
    return i.imputed.select("product_id", "category", "retail_price", "cost")


@query
def repair_cost(i):
    return transform.repair_cost(i.imputed).select("product_id", "retail_price", "cost")


@query
def margin_pct(i):
    return i.clean.select("product_id", "retail_price", "cost", "margin_pct")


@query
def is_valid(i):
    return i.clean.select("product_id", "is_valid")


@query
def validation_errors(i):
    return i.clean.select("product_id", "validation_errors")


@query
def clean_products(i):
    return i.clean.drop(*NO_TIMES)


@query
def transform_checks(i):
    return transform.transform_checks(i.clean)


@query
def run_sql_layers(i):
    """The job itself: source rows to written layers, and their counts read back."""
    catalogue = tables.Catalogue(i.spark, lineage.work_path(i.spark, "catalogue"))
    return run.run_sql_layers(catalogue, i.source, AS_OF)


@query
def title_case_names(i):
    return i.table("part").select("p_partkey", text.title_case(F.upper("p_name")).alias("title"))


# --- quality ----------------------------------------------------------------------

@query
def quality_snapshot(i):
    return quality.quality_snapshot(i.clean, AS_OF).drop(*NO_TIMES)


@query
def data_quality_latest(i):
    return views.data_quality_latest(i.report).drop(*NO_TIMES)


@query
def layer_counts(i):
    return quality.layer_counts(i.clean, i.embedded, i.clustered, i.enriched)


@query
def table_counts(i):
    names = ("part", "lineitem", "embeddings", "events", "documents", "conversations")
    return tables.table_counts({n: i.table(n) for n in names})


@query
def rule_unique_ids(i):
    return quality.unique_ids_rule(i.clean)


@query
def rule_mandatory_fields(i):
    return quality.row_rules(i.clean, "ASSERT_02")


@query
def rule_no_negative_amounts(i):
    return quality.row_rules(i.clean, "ASSERT_03")


@query
def rule_cost_below_price(i):
    return quality.row_rules(i.clean, "ASSERT_04")


@query
def rule_price_range(i):
    return quality.row_rules(i.clean, "ASSERT_05")


@query
def rule_embedding_coverage(i):
    return quality.coverage_rule(i.clean, i.embedded, "ASSERT_06")


@query
def rule_vector_length(i):
    return quality.vector_length_rule(i.embedded)


@query
def rule_vector_present(i):
    return quality.vector_present_rule(i.embedded)


@query
def rule_clustering_coverage(i):
    return quality.coverage_rule(i.clean, i.clustered, "ASSERT_09")


@query
def rule_cluster_size(i):
    return quality.cluster_size_rule(i.clustered)


@query
def rule_cluster_count(i):
    return quality.cluster_count_rule(i.clustered)


@query
def rule_enrichment_coverage(i):
    return quality.coverage_rule(i.clean, i.enriched, "ASSERT_12")


@query
def run_rules(i):
    return quality.run_rules(i.clean, i.embedded, i.clustered, i.enriched)


@query
def latest_runs(i):
    """Run log over the event stream: a user is a run, an error a failure, a purchase a finish."""
    events = i.derive(fixtures.RUN_EVENTS)
    run, at = F.col("run_id"), F.col("event_at")
    log = tables.run_event(
        events.where("event_type NOT IN ('error', 'purchase')"), at, "IN_PROGRESS", at, run
    ).unionByName(
        tables.run_event(
            events.where("event_type = 'purchase'"), at, "COMPLETE", at, run,
            products=F.col("event_id"), clusters=F.floor("value"),
        )
    ).unionByName(
        tables.run_event(
            events.where("event_type = 'error'"), at, "FAILED", at, run,
            error=F.concat(F.lit("can't read "), F.col("props")),
        )
    )
    return tables.latest_runs(log).drop("started_at", "completed_at")


# --- views and dashboard ----------------------------------------------------------

@query
def cluster_distribution(i):
    return views.cluster_distribution(i.catalogue)


@query
def brands_per_cluster(i):
    return views.brands_per_cluster(i.catalogue)


@query
def pricing_per_cluster(i):
    return views.pricing_per_cluster(i.catalogue)


def _money_and_days(df):
    return df.withColumns({
        "sale_date": F.col("sale_date").cast("string"), "sales_revenue": numbers.round2("sales_revenue"),
    })


@query
def sales_timeline(i):
    return _money_and_days(views.sales_timeline(i.order_items, i.catalogue, AS_OF))


@query
def heatmap_cat_dept(i):
    return views.heatmap_cat_dept(i.clean)


@query
def top_clusters_chart(i):
    return dashboard.top_clusters_chart(views.cluster_distribution(i.catalogue))


@query
def top_pricing_chart(i):
    return dashboard.top_pricing_chart(views.pricing_per_cluster(i.catalogue))


@query
def heatmap_chart(i):
    return dashboard.heatmap_chart(views.heatmap_cat_dept(i.clean))


@query
def quality_chart(i):
    return dashboard.quality_chart(i.all_views["data_quality"])


@query
def timeline_chart(i):
    return dashboard.timeline_chart(i.all_views["sales_timeline"])


@query
def brands_chart(i):
    return dashboard.brands_chart(views.brands_per_cluster(i.catalogue))


@query
def brand_cards(i):
    return dashboard.brand_cards(dashboard.brands_chart(views.brands_per_cluster(i.catalogue)))


@query
def timeline_daily(i):
    daily = dashboard.timeline_daily(views.sales_timeline(i.order_items, i.catalogue, AS_OF))
    return daily.withColumn("sale_date", F.col("sale_date").cast("string"))


@query
def heatmap_matrix(i):
    return dashboard.heatmap_matrix(views.heatmap_cat_dept(i.clean))


@query
def heatmap_intensity(i):
    return dashboard.heatmap_intensity(views.heatmap_cat_dept(i.clean))


@query
def kpi_cards(i):
    return dashboard.kpi_cards(views.data_quality_latest(i.report))


@query
def cluster_products(i):
    return dashboard.cluster_products(i.clean, i.clustered, i.enriched, 3)


@query
def cluster_header(i):
    return dashboard.cluster_header(dashboard.cluster_products(i.clean, i.clustered, i.enriched, 3))


@query
def clusters_list(i):
    return dashboard.clusters_list(i.catalogue)


@query
def cluster_page(i):
    return dashboard.cluster_page(dashboard.clusters_list(i.catalogue), "FAMILY")


def _as_text(frames, name):
    """(name, line): the columns of each row in order of their names, fractions as hundredths."""
    out = None
    for key, df in frames.items():
        kinds = dict(df.dtypes)
        parts = [F.floor(F.col(c) * 100 + 0.5) if kinds[c] == "double" else F.col(c) for c in sorted(df.columns)]
        line = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts))
        rows = df.select(F.lit(key).alias(name), line.alias("line"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def dashboard_bundle(i):
    """Every row of every chart as text."""
    return _as_text(dashboard.dashboard_bundle(i.all_views), "chart")


@query
def registered_views(i):
    """Every row of every registered view as text."""
    names = views.register_views(i.all_views, prefix="assortment_")
    return _as_text({n: i.spark.table(n) for n in names}, "view")


# --- vectors and retrieval --------------------------------------------------------

DIM = 64


def _first_vector(i) -> list[float]:
    return i.embedded.orderBy("product_id").first().embedding


def _six(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def cosine_distance(i):
    """Distance of every raw vector to its planted one."""
    both = i.embedded.join(i.planted.select("product_id", F.col("embedding").alias("other")), "product_id")
    distance = vectors.cosine_distance(F.col("embedding"), F.col("other"))
    return both.select("product_id", F.round(distance, 6).alias("distance"))


@query
def vector_top_k(i):
    return _six(vector.vector_top_k(i.embedded, _first_vector(i), 25), "distance")


@query
def vector_top_k_batch(i):
    """Every planted vector against all raw vectors."""
    asked = i.planted.select(F.col("product_id").alias("query_id"), "embedding")
    return _six(vector.vector_top_k_batch(i.embedded, asked, 5), "distance")


@query
def ivf_build(i):
    """Whether each vector lies in the list of its nearest stored centroid."""
    index = _written_index(i)
    centroids = index.spark_centroids()
    distance = F.round(vectors.cosine_distance(F.col("embedding"), F.col("centroid")), 9)
    best = Window.partitionBy("product_id")
    each = index.rows.join(F.broadcast(centroids)).withColumn("distance", distance)
    each = each.withColumn("least", F.min("distance").over(best)).where(F.col("list_id") == F.col("number"))
    return each.select("product_id", (F.col("distance") == F.col("least")).alias("in_nearest_list"))


def _written_index(i):
    path = lineage.work_path(i.spark, "index")
    vector.write_index(vector.ivf_build(i.planted.select("product_id", "embedding"), lists=16), path)
    return vector.read_index(i.spark, path)


@query
def ivf_search(i):
    """Whether the answer from the two nearest lists is that of a plain join over their rows, rank by rank."""
    index, query = _written_index(i), _first_vector(i)
    asked = F.array(*map(F.lit, query))
    near = index.spark_centroids().orderBy(vectors.cosine_distance(asked, F.col("centroid")), "number").limit(2)
    plain = index.rows.join(F.broadcast(near), F.col("list_id") == F.col("number"), "left_semi").select(
        "product_id", F.round(vectors.cosine_distance(F.col("embedding"), asked), 9).alias("distance")
    )
    by = Window.orderBy("distance", "product_id")
    ranked = lambda df, name: df.select(F.row_number().over(by).alias("rank"), F.col("product_id").alias(name))
    plain = ranked(plain.orderBy("distance", "product_id").limit(10), "plain")
    found = vector.ivf_search(index, query, 10, nprobe=2).withColumn("distance", F.round("distance", 9))
    both = ranked(found, "found").join(plain, "rank", "full")
    return both.select("rank", F.col("plain").eqNullSafe(F.col("found")).alias("same"))


@query
def ivf_search_all_lists(i):
    """With every list probed the index gives the exact answer."""
    return _six(vector.ivf_search(_written_index(i), _first_vector(i), 25, nprobe=16), "distance")


@query
def ivf_search_batch(i):
    """Every planted vector, all stored lists probed: exact neighbours."""
    path = lineage.work_path(i.spark, "index")
    vector.write_index(vector.ivf_build(i.planted.select("product_id", "embedding"), lists=4), path)
    index = vector.read_index(i.spark, path)
    asked = i.planted.select(F.col("product_id").alias("query_id"), "embedding")
    return _six(vector.ivf_search_batch(index, asked, 5, nprobe=4), "distance")


@query
def index_coverage(i):
    """Products of the clean table that have an indexed vector."""
    return vector.index_coverage(i.clean, _written_index(i), "vector_lists", "products_clean")


@query
def search_products(i):
    found = retrieval.search_products(
        _first_vector(i), i.clean, i.embedded, i.clustered, i.enriched, 20, min_price=905, max_price=990
    )
    return _six(found, "distance")


@query
def search_products_indexed(i):
    """The search through a stored index: a third of the vectors indexed, a third appended to its lists, a third beside
    it. All lists are probed, so that the answer is exact."""
    catalogue = tables.Catalogue(i.spark, lineage.work_path(i.spark, "catalogue"))
    rows = i.embedded.select(
        "product_id", F.lit("").alias("embedding_text"), "embedding", F.lit("given").alias("embedding_model"),
        F.lit(0).alias("embedding_tokens"), F.lit(0.0).alias("embedding_cost_usd"), F.lit(AS_OF).alias("embedding_created_at"),
    )
    for part in range(3):
        catalogue.append(rows.where(F.col("product_id") % 3 == part), "products_embedded")
        if part == 0:
            run.build_index(catalogue, min_rows=1)
        elif part == 1:
            run.follow_index(catalogue)
    index = run.stored_index(catalogue)
    found = retrieval.search_products(
        _first_vector(i), i.clean, catalogue.read("products_embedded"), i.clustered, i.enriched, 20,
        min_price=905, max_price=990, index=index, nprobe=len(index.centroids),
    )
    return _six(found, "distance")


@query
def index_recall(i):
    """Every vector divisible by 50 against an index with its own lists and probes: entries found, and whether nine in
    ten are true neighbours."""
    index = vector.ivf_build(i.embedded.select("product_id", "embedding"))
    asked = i.embedded.where("product_id % 50 = 0").select(F.col("product_id").alias("query_id"), "embedding")
    exact = vector.vector_top_k_batch(i.embedded, asked, 20).select("query_id", "product_id", F.lit(1).alias("true_one"))
    found = vector.ivf_search_batch(index, asked, 20).join(exact, ["query_id", "product_id"], "left")
    return found.agg(F.count(F.lit(1)).alias("entries"), (F.sum("true_one") >= 0.9 * F.count(F.lit(1))).alias("enough"))


@query
def index_codes(i):
    """Per number of wanted rows, whether nine in ten of those that a coded index finds are true neighbours."""
    path, rows = lineage.work_path(i.spark, "index"), i.embedded.select("product_id", "embedding")
    vector.write_index(vector.ivf_build(rows, codes=True), path)
    index, asked = vector.read_index(i.spark, path), _first_vector(i)
    found = []
    for wanted in (10, 50):
        exact = vector.vector_top_k(rows, asked, wanted).select("product_id", F.lit(1).alias("true_one"))
        near = vector.ivf_search(index, asked, wanted).join(exact, "product_id", "left")
        found.append(near.agg(
            F.lit(wanted).alias("wanted"), F.count(F.lit(1)).alias("entries"),
            (F.sum("true_one") >= 0.9 * F.count(F.lit(1))).alias("enough"),
        ))
    return found[0].unionByName(found[1])


@query
def search_products_prefilter(i):
    found = retrieval.search_products(
        _first_vector(i), i.clean, i.embedded, i.clustered, i.enriched, 20, min_price=905, max_price=990,
        prefilter=True,
    )
    return _six(found, "distance")


def _hits(i):
    return retrieval.intent_hits(_first_vector(i), i.clean, i.embedded, i.clustered)


@query
def intent_hits(i):
    return _six(_hits(i), "distance")


@query
def intent_clusters(i):
    return _six(retrieval.intent_clusters(_hits(i)), "nearest_distance")


@query
def intent_stats(i):
    chosen = retrieval.intent_clusters(_hits(i))
    return retrieval.intent_stats(chosen, i.clean, i.clustered).drop("mean_price")


def _briefs(i):
    return retrieval.intent_briefs(_hits(i), i.clean, i.clustered)


@query
def intent_briefs(i):
    """One row per sample product of each brief."""
    rows = _briefs(i).withColumn("sample", F.explode("sample_products"))
    return rows.select("cluster_id", "cluster_label", "hit_count", "products_total", "avg_price", "sample.*")


@query
def brief_prompt(i):
    return retrieval.brief_prompt(F.lit("a gift under 50"), _briefs(i)).select("cluster_id", "prompt")


@query
def analyze_intent(i):
    """Briefs with the texts of a model's replies."""
    replies = requests.intent_replies(_briefs(i), "a gift under 50", _strategist)
    return replies.drop("sample_products")


def _strategist(prompts):
    """A model stand-in whose replies can be told from the prompts."""
    replies = [f'{{"positioning": "{len(p)}", "price_range": "{p.count("€")}", "buyer_action": "ok"}}' for p in prompts]
    return [(r, len(p), 3) for p, r in zip(prompts, replies)]


@query
def parse_brief(i):
    return retrieval.parse_brief(i.derive(fixtures.REPLIES)).drop("reply")


@query
def price_constraints(i):
    return retrieval.price_constraints(i.derive(fixtures.SEARCH_TEXTS)).drop("query")


def _product_vectors(i):
    return lineage.cut(embed.embed_texts(embed.embedding_text(i.clean), "embedding_text", DIM))


@query
def search_log(i):
    """Every search text against the hashed vectors of all products."""
    asked = lineage.cut(embed.embed_texts(i.derive(fixtures.SEARCH_TEXTS), "query", DIM))
    found = retrieval.search_log(asked, _product_vectors(i), i.clean, i.clustered, i.enriched, top_k=3)
    return _six(found, "distance")


# --- texts, batches, generation ---------------------------------------------------

@query
def embedding_text(i):
    return embed.embedding_text(i.clean)


@query
def pending_embedding(i):
    return embed.pending_embedding(i.clean, i.embedded)


def _batches(i):
    texts = embed.embedding_text(embed.pending_embedding(i.clean, i.embedded))
    return embed.assign_batches(texts)


@query
def assign_batches(i):
    return _batches(i).select("product_id", "position", "batch")


def _split(i):
    total = F.sum(embed.token_count(F.col("embedding_text"))).over(Window.partitionBy("batch"))
    return embed.split_batch_tokens(_batches(i).withColumn("batch_tokens", total))


@query
def split_batch_tokens(i):
    return _split(i).select("product_id", "batch", "batch_tokens", "embedding_tokens")


@query
def embedding_cost(i):
    cost = embed.embedding_cost(F.col("embedding_tokens"))
    return _split(i).select("product_id", F.round(cost, 12).alias("embedding_cost_usd"))


@query
def embed_texts(i):
    """Hashed vectors of whole documents, one row per value."""
    rows = embed.embed_texts(i.table("documents").select("doc_id", "text"), "text", DIM)
    return _six(rows.select("doc_id", F.posexplode("embedding").alias("place", "value")), "value")


def _catalogue(i):
    catalogue = tables.Catalogue(i.spark, lineage.work_path(i.spark, "catalogue"))
    for name in run.LAYERS:
        catalogue.create(name)
    catalogue.overwrite(i.clean, "products_clean")
    return catalogue


def _checksum():
    """Places times values of the vector, summed."""
    return F.round(F.aggregate(F.transform("embedding", lambda x, p: x * (p + 1)), F.lit(0.0), lambda s, x: s + x), 6) + F.lit(0.0)


@query
def embed_incremental(i):
    """Two runs over the same products; the second finds nothing to do."""
    catalogue = _catalogue(i)
    for _ in range(2):
        embed.embed_incremental(catalogue, AS_OF, dim=DIM)
    return catalogue.read("products_embedded").select(
        "product_id", "embedding_text", "embedding_model", "embedding_tokens",
        F.round("embedding_cost_usd", 12).alias("embedding_cost_usd"), _checksum().alias("checksum"),
    )


@query
def incremental_stream(i):
    """The embedding step as a stream over the files of the clean table, started twice."""
    catalogue = _catalogue(i)
    for _ in range(2):
        job = incremental.incremental_stream(
            catalogue, catalogue.path("products_clean"), catalogue.path("progress"), AS_OF, dim=DIM
        )
        job.awaitTermination()
    return catalogue.read("products_embedded").select("product_id", "embedding_text", _checksum().alias("checksum"))


@query
def pending_enrichment(i):
    return enrich.pending_enrichment(i.clean, i.clustered, i.enriched)


def _prompts(i):
    return enrich.description_prompt(enrich.pending_enrichment(i.clean, i.clustered, i.enriched))


@query
def description_prompt(i):
    return _prompts(i).select("product_id", "prompt")


@query
def generate_text(i):
    """Texts of a function that is handed in."""

    def writer(prompts):
        return [(f" {p[-12:]}\t", len(p), 7) for p in prompts]

    return enrich.generate_text(_prompts(i), writer).select("product_id", "text", "tokens_input", "tokens_output")


@query
def generate_text_once(i):
    """Prompts through a ledger: products of even ids are described first; then all are, and only prompts without a stored
    reply are asked."""

    def writer(mark):
        return lambda prompts: [(f"{mark} {p[-12:]}", len(p), mark) for p in prompts]

    ledger = calls.Ledger(lineage.work_path(i.spark, "ledger"))
    enrich.generate_text(_prompts(i).where("product_id % 2 = 0"), writer(1), ledger, "model").count()
    found = enrich.generate_text(_prompts(i), writer(2), ledger, "model")
    return found.select("product_id", "text", "tokens_input", "tokens_output")


@query
def generation_cost(i):
    products = enrich.pending_enrichment(i.clean, i.clustered, i.enriched)
    return enrich.total_cost(enrich.enriched_rows(products, AS_OF))


def _with_layers(i):
    catalogue = _catalogue(i)
    named = i.clustered.select("cluster_id", "cluster_label").distinct()
    found = i.clustered.select("product_id", "cluster_id", F.lit(1.0).alias("cluster_probability"))
    catalogue.reload(clusters.assign_clusters(found, named, AS_OF), "products_clustered")
    old = i.enriched.select(
        "product_id", F.lit(None).alias("cluster_id"), F.lit(None).alias("cluster_label"), "description_enriched",
        F.lit("given").alias("description_model"), F.lit(fixed.DESCRIPTION_TONE).alias("description_tone"),
        F.lit(0).alias("description_tokens_input"), F.lit(0).alias("description_tokens_output"),
        F.lit(0.0).alias("description_cost_usd"), "description_created_at",
    )
    catalogue.append(old, "products_enriched")
    return catalogue


def _described(catalogue):
    return catalogue.read("products_enriched").select(
        "product_id", "cluster_id", "cluster_label", "description_enriched", "description_model",
        "description_tokens_input", "description_tokens_output",
    )


@query
def enrich_incremental(i):
    """Two runs; the second finds nothing to do."""
    catalogue = _with_layers(i)
    for _ in range(2):
        enrich.enrich_incremental(catalogue, AS_OF)
    return _described(catalogue)


@query
def enrich_selected(i):
    """Describe all products of the clean table, also those described before."""
    catalogue = _with_layers(i)
    enrich.enrich_selected(catalogue, i.clean.select("product_id"), AS_OF)
    return _described(catalogue)


# --- clusters ---------------------------------------------------------------------

EPS = 0.4


def _graph(i):
    return clusters.knn_graph(i.planted.select("product_id", "embedding"))


def _edges(i):
    graph = lineage.cut(_graph(i))
    cores = clusters.core_distance(graph)
    return clusters.reachability_edges(graph, cores), cores


@query
def reduce_dims(i):
    """Places and values of the shorter vectors; tests hold them against another decomposition."""
    reduced = clusters.reduce_dims(i.planted.select("product_id", "embedding"), 50)
    return reduced.select("product_id", F.posexplode("embedding").alias("place", "value"))


@query
def knn_graph(i):
    return _six(_graph(i), "distance")


@query
def knn_graph_descent(i):
    """Neighbour descent over all vectors: of the products divisible by 50, how many entries lists have, and whether at
    least nine in ten of them are true neighbours."""
    rows = i.planted.select("product_id", "embedding")
    few = rows.where("product_id % 50 = 0").select(F.col("product_id").alias("query_id"), "embedding")
    exact = vector.vector_top_k_batch(rows, few, 16).where("product_id <> query_id").where("rank <= 16")
    order = Window.partitionBy("query_id").orderBy("rank")
    exact = exact.withColumn("place", F.row_number().over(order)).where("place <= 15")
    exact = exact.select("query_id", "product_id", F.lit(1).alias("true_one"))
    found = clusters.knn_graph(rows, descent=True).where("product_id % 50 = 0")
    found = found.select(F.col("product_id").alias("query_id"), F.col("neighbour_id").alias("product_id"))
    both = found.join(exact, ["query_id", "product_id"], "left")
    return both.agg(F.count(F.lit(1)).alias("entries"), (F.sum("true_one") >= 0.9 * F.count(F.lit(1))).alias("enough"))


@query
def core_distance(i):
    return _six(clusters.core_distance(_graph(i)), "core")


@query
def reachability_edges(i):
    return _six(_edges(i)[0], "weight")


@query
def components_at_level(i):
    edges, cores = _edges(i)
    return clusters.components_at_level(lineage.cut(edges), cores, EPS)


@query
def select_clusters(i):
    edges, cores = _edges(i)
    return _six(clusters.select_clusters(lineage.cut(edges), cores), "cluster_probability")


@query
def assign_clusters(i):
    """Vectors to `products_clustered` rows with word labels."""
    found = lineage.cut(clusters.cluster_vectors(i.planted.select("product_id", "embedding")))
    named = labels.label_clusters(found, i.clean)
    return _six(clusters.assign_clusters(found, named, AS_OF), "cluster_probability").drop("clustering_created_at")


@query
def cluster_stats(i):
    return clusters.cluster_stats(i.clustered)


@query
def label_samples(i):
    rows = labels.label_samples(i.clustered, i.clean)
    return rows.select("cluster_id", F.posexplode("samples").alias("place", "sample"))


@query
def label_prompt(i):
    return labels.label_prompt(labels.label_samples(i.clustered, i.clean)).select("cluster_id", "prompt")


@query
def label_clusters(i):
    return labels.label_clusters(i.clustered, i.clean)


@query
def phrase_contrast(i):
    return labels.phrase_contrast(i.clustered, i.clean)


@query
def contrast_labels(i):
    return labels.label_clusters(i.clustered, i.clean, contrast=True)


@query
def catalogue_run(i):
    """Source rows to described clusters in one logged run; returns the cluster rows."""
    catalogue = tables.Catalogue(i.spark, lineage.work_path(i.spark, "catalogue"))
    run.run_sql_layers(catalogue, i.source, AS_OF)
    run.run_catalogue(catalogue, AS_OF, embedding={"dim": DIM})
    return catalogue.read_reloaded("products_clustered").drop("clustering_created_at")
