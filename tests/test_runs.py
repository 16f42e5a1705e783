"""Tables, run log, incremental jobs, streaming."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from assortment.operators import calls, clusters, embed, enrich, numbering
from assortment.plans import run
from assortment.sources import schemas, tables
from assortment.sources.fixtures import AS_OF
from assortment.sources.lineage import cut
from assortment.streaming.incremental import incremental_stream
from checks.queries import Inputs

SMALL = "/root/testdata/sf0.001"


def with_clean(spark, catalogue):
    run.run_sql_layers(catalogue, Inputs(spark, SMALL).source, AS_OF)
    for name in run.LAYERS:
        catalogue.create(name)


def test_schema_is_enforced(spark, catalogue):
    rows = spark.createDataFrame(
        [(1, "t", [1.0], "m", 3, 0.1, AS_OF)],
        "product_id int, embedding_text string, embedding array<float>, embedding_model string, embedding_tokens int, "
        "embedding_cost_usd double, embedding_created_at timestamp",
    )
    catalogue.append(rows.select(*reversed(rows.columns)), "products_embedded")
    assert catalogue.read("products_embedded").first().product_id == 1
    with pytest.raises(Exception, match="embedding_text is NULL"):
        catalogue.append(rows.withColumn("embedding_text", F.lit(None)), "products_embedded")
    assert catalogue.read("products_embedded").count() == 1
    assert [f.name for f in schemas.TABLES["products_raw"]][:2] == ["product_id", "name"]


def test_reload_switches_snapshots_and_may_read_itself(spark, catalogue):
    found = spark.createDataFrame([(1, 0, 1.0), (2, -1, 0.0)], "product_id long, cluster_id long, cluster_probability double")
    names = spark.createDataFrame([(0, "A")], "cluster_id long, cluster_label string")
    catalogue.reload(clusters.assign_clusters(found, names, AS_OF), "products_clustered")
    now = catalogue.read_reloaded("products_clustered")
    assert {(r.product_id, r.cluster_label, r.is_noise) for r in now.collect()} == {(1, "A", False), (2, None, True)}
    later = AS_OF + dt.timedelta(hours=1)
    catalogue.reload(now.where("product_id = 2"), "products_clustered")
    assert [r.product_id for r in catalogue.read_reloaded("products_clustered").collect()] == [2]


def test_run_log(spark):
    one = spark.range(1)
    start, done = F.lit(AS_OF), F.lit(AS_OF + dt.timedelta(minutes=5))
    log = tables.run_event(one, start, "IN_PROGRESS", start, F.lit("a"))
    log = log.unionByName(tables.run_event(one, done, "COMPLETE", start, F.lit("a"), F.lit(7), F.lit(2)))
    log = log.unionByName(tables.run_event(one, start, "IN_PROGRESS", start, F.lit("b")))
    log = log.unionByName(tables.run_event(one, done, "FAILED", start, F.lit("b"), error=F.lit("it's " + "x" * 600)))
    got = {r.run_id: r for r in tables.latest_runs(log).collect()}
    assert (got["a"].status, got["a"].products_processed, got["a"].clusters_created) == ("COMPLETE", 7, 2)
    assert got["b"].status == "FAILED" and len(got["b"].error_message) == 500
    assert got["b"].error_message.startswith("it\\'s x") and got["b"].completed_at is not None


def test_positions(spark):
    rows = spark.range(0, 5000, 3).select(((F.col("id") * 7919) % 5003).alias("product_id")).repartition(6)
    ordered = sorted(r.product_id for r in rows.collect())
    placed = embed.assign_batches(rows, 250).collect()
    assert {r.product_id: (r.position, r.batch) for r in placed} == {
        p: (n, n // 250) for n, p in enumerate(ordered)
    }
    assert numbering.with_position(rows.where("product_id < 0"), "product_id").count() == 0


def test_embedding_batches_and_injected_embedder(spark, catalogue):
    with_clean(spark, catalogue)

    def embedder(texts):
        return [[float(len(t)), 1.0] for t in texts], 10 * len(texts) + 3

    options = {"model": "test", "batch_size": 50}
    first = embed.embed_incremental(catalogue, AS_OF, embedder, **options)
    assert first["embedded"] == 195 and first["total_tokens"] == 1950 + 4 * 3
    assert embed.embed_incremental(catalogue, AS_OF, embedder, **options)["embedded"] == 0
    rows = catalogue.read("products_embedded").orderBy("product_id").collect()
    assert len(rows) == 195 and {r.embedding_model for r in rows} == {"test"}
    assert [n for n, r in enumerate(rows) if r.embedding_tokens != 10] == [49, 99, 149, 194]
    assert all(r.embedding[0] == len(r.embedding_text) for r in rows)
    assert abs(sum(r.embedding_cost_usd for r in rows) - first["total_cost_usd"]) < 1e-12


def test_selected_products_get_another_description(spark, catalogue):
    with_clean(spark, catalogue)
    found = spark.createDataFrame([(1, 4, 1.0)], "product_id long, cluster_id long, cluster_probability double")
    names = spark.createDataFrame([(4, "Rings")], "cluster_id long, cluster_label string")
    catalogue.reload(clusters.assign_clusters(found, names, AS_OF), "products_clustered")
    seen = []

    def generator(prompts):
        return [(" text ", 100, 50) for _ in prompts]

    for at in (AS_OF, AS_OF + dt.timedelta(days=1)):
        ids = spark.createDataFrame([(1,), (2,), (2,)], "product_id long")
        seen += enrich.enrich_selected(catalogue, ids, at, generator, "test").collect()
    assert len(seen) == 4 == catalogue.read("products_enriched").count()
    assert {(r.product_id, r.cluster_id, r.cluster_label) for r in seen} == {(1, None, "Rings"), (2, None, None)}
    assert {r.description_enriched for r in seen} == {"text"}
    assert abs(seen[0].description_cost_usd - (100 * 0.15 + 50 * 0.6) / 1e6) < 1e-15
    with pytest.raises(ValueError, match="999999"):
        enrich.enrich_selected(catalogue, spark.createDataFrame([(999999,)], "product_id long"), AS_OF)
    assert enrich.enrich_incremental(catalogue, AS_OF)["enriched"] == 193


def test_whole_run_twice(spark, catalogue):
    with_clean(spark, catalogue)

    def by_department(texts):
        """Vectors that differ by department, with a little spread."""
        out = []
        for text in texts:
            place = ["WOMEN", "MEN", "KIDS", "GENERAL"].index(text.split(" | ")[3])
            spread = [int(hashlib.md5(f"{i}{text}".encode()).hexdigest()[:4], 16) / 65536 * 0.3 for i in range(4)]
            out.append([s + 2.0 * (i == place) for i, s in enumerate(spread)])
        return out, len(texts)

    first = run.run_catalogue(catalogue, AS_OF, by_department)
    assert first["embedded"] == 195 == first["total_products"] and first["enrichment"]["enriched"] == 195
    later = AS_OF + dt.timedelta(days=1)
    second = run.run_catalogue(catalogue, later, by_department)
    assert second["embedded"] == 0 and second["enrichment"]["enriched"] == 0
    assert second["clusters"] == first["clusters"] >= 3
    runs = tables.latest_runs(catalogue.run_events()).orderBy("started_at").collect()
    assert [(r.status, r.products_processed) for r in runs] == [("COMPLETE", 195), ("COMPLETE", 0)]
    assert catalogue.read_reloaded("products_clustered").count() == 195
    run.append_quality_report(catalogue, AS_OF)
    run.append_quality_report(catalogue, later)
    assert tables.latest_snapshot(catalogue.read("quality_report")).first().report_timestamp == later


def test_failed_run_is_logged_and_raised(spark, catalogue):
    with_clean(spark, catalogue)

    def broken(texts):
        raise RuntimeError("model is away")

    with pytest.raises(Exception, match="model is away"):
        run.run_catalogue(catalogue, AS_OF, embedder=broken)
    last = tables.latest_runs(catalogue.run_events()).first()
    assert last.status == "FAILED" and last.error_message and len(last.error_message) <= 500
    assert catalogue.read("products_embedded").count() == 0


def test_failure_keeps_earlier_groups_and_later_run_calls_for_the_rest(spark, catalogue, tmp_path):
    with_clean(spark, catalogue)
    made = tmp_path / "calls"
    made.mkdir()

    def embedder(broken):
        def call(texts):
            (made / f"{broken}-{hashlib.md5(texts[0].encode()).hexdigest()}").write_text(str(len(texts)))
            if broken and any("ZZ-AWAY" in t for t in texts):
                raise RuntimeError("model is away")
            return [[1.0, 2.0] for _ in texts], len(texts)

        return call

    clean = catalogue.read("products_clean")
    last = clean.agg(F.max("product_id")).first()[0]
    name = F.when(F.col("product_id") == last, "ZZ-AWAY").otherwise(F.col("name"))
    clean.withColumn("name", name).write.parquet(str(tmp_path / "named"))
    catalogue.overwrite(spark.read.parquet(str(tmp_path / "named")), "products_clean")
    options = {"batch_size": 20, "group_batches": 2}
    with pytest.raises(Exception, match="model is away"):
        embed.embed_incremental(catalogue, AS_OF, embedder(True), **options)
    assert catalogue.read("products_embedded").count() == 160
    assert embed.embed_incremental(catalogue, AS_OF, embedder(False), **options)["embedded"] == 35
    assert sum(int(p.read_text()) for p in made.glob("False-*")) == 35

    def writer(prompts):
        if any("ZZ-AWAY" in p for p in prompts):
            raise RuntimeError("model is away")
        return [("text", 1, 1) for _ in prompts]

    clean = catalogue.read("products_clean")
    found = clean.select("product_id", F.lit(-1).cast("long").alias("cluster_id"), F.lit(0.0).alias("cluster_probability"))
    none = spark.createDataFrame([], "cluster_id long, cluster_label string")
    catalogue.reload(clusters.assign_clusters(found, none, AS_OF), "products_clustered")
    with pytest.raises(Exception, match="model is away"):
        enrich.enrich_incremental(catalogue, AS_OF, writer, group_rows=50)
    assert catalogue.read("products_enriched").count() == 150


@pytest.mark.parametrize("end", ["killed", "raised"])
def test_paid_replies_are_never_asked_again(spark, catalogue, tmp_path, end):
    """A run that ends within its only group: the next one asks for the rest, a third one for nothing."""
    with_clean(spark, catalogue)
    named = catalogue.read("products_clean").withColumn("name", F.concat("name", F.lit(" "), F.col("product_id")))
    named.write.parquet(str(tmp_path / "named"))
    named = spark.read.parquet(str(tmp_path / "named"))
    catalogue.overwrite(named, "products_clean")
    paid = tmp_path / "paid"
    paid.mkdir()

    def writer(breaks):
        def call(prompts):
            if breaks and len(list(paid.glob("*"))) == 4:
                if end == "killed":
                    os._exit(1)
                raise RuntimeError("model is away")
            (paid / hashlib.md5("".join(prompts).encode()).hexdigest()).write_text("\0".join(prompts))
            return [(f" {p[-40:]} ", 7, 3) for p in prompts]

        return call

    ledger = calls.Ledger(str(tmp_path / "ledger"))
    with pytest.raises(Exception):
        enrich.enrich_incremental(catalogue, AS_OF, writer(True), ledger=ledger)
    assert catalogue.read("products_enriched").count() == 0 and ledger.known(spark).count() == 80
    assert enrich.enrich_incremental(catalogue, AS_OF, writer(False), ledger=ledger)["enriched"] == 195
    asked = [p for f in paid.glob("*") for p in f.read_text().split("\0")]
    assert len(asked) == len(set(asked)) == 195
    assert catalogue.read("products_enriched").agg(F.sum("description_tokens_input")).first()[0] == 7 * 195
    before = len(list(paid.glob("*")))
    prompts = enrich.description_prompt(named.withColumn("cluster_label", F.lit(None).cast("string")))
    again = enrich.generate_text(prompts.unionByName(prompts), writer(True), ledger)
    assert again.count() == 2 * 195 and len(list(paid.glob("*"))) == before
    other = enrich.generate_text(prompts.limit(3), writer(False), ledger, "another model").collect()
    assert len(other) == 3 and len(list(paid.glob("*"))) == before + 1


def test_an_attempt_finds_what_the_one_before_it_stored(tmp_path):
    first = calls._Page(str(tmp_path / "ledger"), 3)
    first.add(["a", "b"], [("one", 1, 2), (None, 0, 0)])
    (tmp_path / "ledger" / "task-3" / "_half").write_bytes(b"PAR1")
    assert calls._Page((tmp_path / "ledger").as_uri(), 3).replies == {"a": ("one", 1, 2), "b": (None, 0, 0)}
    assert calls._Page(f"file:{tmp_path}/ledger", 3).replies == first.replies
    assert calls._Page(str(tmp_path / "ledger"), 4).replies == {}


def test_reload_may_be_repeated_with_any_clock(spark, catalogue):
    found = lambda *ids: spark.createDataFrame([(i, 0, 1.0) for i in ids], "product_id long, cluster_id long, cluster_probability double")
    names = spark.createDataFrame([(0, "A")], "cluster_id long, cluster_label string")
    assert catalogue.read_reloaded("products_clustered").count() == 0
    for at, ids in ((AS_OF, (1, 2)), (AS_OF, (1, 2)), (AS_OF - dt.timedelta(days=9), (3,))):
        catalogue.reload(clusters.assign_clusters(found(*ids), names, at), "products_clustered")
        assert sorted(r.product_id for r in catalogue.read_reloaded("products_clustered").collect()) == sorted(ids)


def test_stored_index_serves_searches_without_writing(spark, catalogue, tmp_path):
    from pathlib import Path

    from assortment.plans import requests

    with_clean(spark, catalogue)
    embed.embed_incremental(catalogue, AS_OF, dim=16)
    assert run.build_index(catalogue, 5) is None and run.stored_index(catalogue) is None
    query = "large brushed tin"
    exact = requests.search(catalogue, query, 10, dim=16).collect()
    index = run.build_index(catalogue, 5, min_rows=100)
    assert index.rows.count() == catalogue.read("products_embedded").where("embedding IS NOT NULL").count()
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = sorted(shared.glob("*/*"))
    assert requests.search(catalogue, query, 10, dim=16, nprobe=5).collect() == exact
    for _ in range(3):
        near = requests.search(catalogue, query, 10, dim=16, nprobe=1)
        assert near.count() <= 10
    assert sorted(shared.glob("*/*")) == before


def test_stream_adds_only_what_is_new(spark, catalogue, tmp_path):
    with_clean(spark, catalogue)
    clean = catalogue.read("products_clean")
    source, progress = str(tmp_path / "incoming"), str(tmp_path / "progress")

    def feed(low, high):
        rows = clean.where(F.col("product_id").between(low, high))
        rows.write.mode("append").parquet(source)
        incremental_stream(catalogue, source, progress, AS_OF, dim=16, max_files=1).awaitTermination()
        stored = catalogue.read("products_embedded")
        return stored.count(), stored.select("product_id").distinct().count(), rows.count()

    one = feed(0, 50)
    assert one[0] == one[1] == one[2]
    both = clean.where("product_id <= 80").count()
    assert feed(30, 80)[:2] == (both, both)
    assert feed(30, 80)[:2] == (both, both)


def test_searches_find_what_a_stream_adds_after_the_index(spark, catalogue, tmp_path):
    from assortment.operators import retrieval
    from assortment.plans import requests

    with_clean(spark, catalogue)
    clean = catalogue.read("products_clean")
    source = str(tmp_path / "incoming")

    def feed(rows):
        rows.write.mode("append").parquet(source)
        incremental_stream(catalogue, source, str(tmp_path / "progress"), AS_OF, dim=16).awaitTermination()

    feed(clean.where("product_id % 2 = 0"))
    held = run.build_index(catalogue, 5, min_rows=50).rows.count()
    feed(clean.where("product_id % 2 = 1"))
    embedded, index = catalogue.read("products_embedded"), run.stored_index(catalogue)
    assert held < index.rows.count() == embedded.where("embedding IS NOT NULL").count()
    assert index.rows.select("product_id").distinct().count() == index.rows.count()
    assert retrieval._not_held(embedded, index) is None

    query = "large brushed tin"
    vector = requests.query_vector(catalogue, query, dim=16)
    exact = [tuple(r) for r in retrieval.vector_top_k(embedded, vector, 10).collect()]
    assert {k % 2 for k, _ in exact} == {0, 1}
    found = requests.search(catalogue, query, 10, dim=16, nprobe=5)
    assert [(r.product_id, r.distance) for r in found.collect()] == exact

    groups = clean.select("product_id", F.lit(1).cast("long").alias("cluster_id"), F.lit("a").alias("cluster_label"))
    hits = retrieval.intent_hits(vector, clean, embedded, groups, 10, index, 5)
    assert sorted((r.distance, r.product_id) for r in hits.collect()) == [(d, k) for k, d in exact]
    asked = spark.createDataFrame([(1, query, vector)], "query_id long, query string, embedding array<double>")
    logged = retrieval.search_log(
        asked, embedded.select("product_id", "embedding"), clean, groups, catalogue.read("products_enriched"), 10,
        index=index, nprobe=5,
    )
    assert [r.product_id for r in logged.orderBy("rank").collect()] == [k for k, _ in exact]


def test_racing_reloads_get_numbers_of_their_own(spark, catalogue, monkeypatch):
    """Both runs read the same newest number; one creates the next file, the other goes on to the one after."""
    from concurrent.futures import ThreadPoolExecutor
    from pathlib import Path

    assert catalogue._newest("products_clustered") is None and not Path(catalogue.folder, "commits").exists()
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: catalogue._commit("t", f"run-{i}"), range(40)))
    assert sorted(numbers) == list(range(1, 41))
    assert catalogue._newest("t") == (40, f"run-{numbers.index(40)}")
    stale = [7, 3, 1]
    monkeypatch.setattr(catalogue, "_numbers", lambda table: stale)
    assert catalogue._commit("t", "late") == 41
    monkeypatch.undo()
    assert catalogue._newest("t") == (41, "late")
    Path(catalogue.folder, "commits/t/000000000042").write_text("half a na")
    assert catalogue._newest("t") == (41, "late") and catalogue._commit("t", "next") == 43
    reader = sorted(Path(catalogue.folder).rglob("*"))
    assert catalogue.read_reloaded("products_clustered").count() == 0 and sorted(Path(catalogue.folder).rglob("*")) == reader


def test_rows_beside_the_index_are_found_and_taken_in(spark, catalogue):
    """Appends that no step followed are searched by their files; parts without a manifest entry are not read."""
    from assortment.operators import retrieval, vector
    from assortment.plans import requests

    with_clean(spark, catalogue)
    clean = cut(catalogue.read("products_clean"))
    parts = [clean.where(f"product_id % 3 = {n}") for n in range(3)]

    def embedded_with(rows):
        text = embed.assign_batches(embed.embedding_text(rows))
        catalogue.append(embed.embed_rows(text, AS_OF, dim=16), "products_embedded")
        return catalogue.read("products_embedded")

    embedded_with(parts[0])
    index = run.build_index(catalogue, 5, min_rows=20)
    everything = embedded_with(parts[1])
    beside = retrieval._not_held(everything, index)
    assert {r.product_id % 3 for r in beside.collect()} == {1} and beside.count() == parts[1].count()
    query = "large brushed tin"
    vector_of = requests.query_vector(catalogue, query, dim=16)

    def same_as_exact():
        exact = retrieval.vector_top_k(catalogue.read("products_embedded"), vector_of, 30).collect()
        found = requests.search(catalogue, query, 30, dim=16, nprobe=5).collect()
        assert [(r.product_id, r.distance) for r in found] == [tuple(r) for r in exact]

    same_as_exact()
    vector._assign(
        everything.selectExpr("product_id id", "embedding").where("embedding IS NOT NULL"), index.centroids
    ).write.partitionBy("list_id").parquet(f"{index.path}/vectors/part=failed")
    same_as_exact()
    for _ in range(2):
        held = run.follow_index(catalogue)
        assert held.rows.count() == everything.where("embedding IS NOT NULL").count()
    embedded_with(parts[2])
    same_as_exact()
    # Two thirds were held, so the third joins them; a table that more than doubles is indexed anew.
    assert run.refresh_index(catalogue, lists=5, min_rows=20).path == index.path
    more = clean.withColumn("product_id", F.col("product_id") + 100_000)
    embedded_with(more.unionByName(clean.withColumn("product_id", F.col("product_id") + 200_000)))
    fresh = run.refresh_index(catalogue, lists=5, min_rows=20)
    everything = catalogue.read("products_embedded")
    assert fresh.path != index.path and retrieval._not_held(everything, fresh) is None
    near = retrieval._nearest(vector_of, everything, 30, fresh, len(fresh.centroids)).collect()
    assert near == retrieval.vector_top_k(everything, vector_of, 30).collect()
    groups = clean.select("product_id", F.lit(1).cast("long").alias("cluster_id"), F.lit(1.0).alias("cluster_probability"))
    names = spark.createDataFrame([(1, "All")], "cluster_id long, cluster_label string")
    catalogue.reload(clusters.assign_clusters(groups, names, AS_OF), "products_clustered")
    exact = retrieval.intent_hits(vector_of, clean, catalogue.read("products_embedded"), catalogue.read_reloaded("products_clustered"))
    assert requests.analyze_intent(catalogue, query, 1, dim=16, nprobe=5).first().hit_count == exact.count()


def test_short_lists_and_price_ranges_search_on(spark, catalogue):
    from assortment.operators import retrieval
    from assortment.plans import requests

    with_clean(spark, catalogue)
    embed.embed_incremental(catalogue, AS_OF, dim=16)
    query = "large brushed tin"

    def searches():
        every = requests.search(catalogue, query, 100, dim=16, nprobe=1).collect()
        return every, requests.search(catalogue, query, 20, 905, 930, dim=16, nprobe=1, prefilter=True).collect()

    exact = searches()
    index = run.build_index(catalogue, 5, min_rows=100)
    assert searches() == exact and len(exact[0]) == 100

    clean, embedded = catalogue.read("products_clean"), catalogue.read("products_embedded")
    groups = clean.select("product_id", F.lit("a").alias("cluster_label"))
    asked = spark.createDataFrame(
        [(1, query, requests.query_vector(catalogue, query, dim=16))], "query_id long, query string, embedding array<double>"
    )
    enriched = catalogue.read("products_enriched")
    logged = retrieval.search_log(asked, embedded, clean, groups, enriched, 100, index=index, nprobe=1)
    assert [r.product_id for r in logged.orderBy("rank").collect()] == [r.product_id for r in exact[0]]


def test_work_folder_is_removed(spark, tmp_path, monkeypatch):
    from assortment.sources import lineage

    monkeypatch.setattr(lineage, "shared_folder", lambda _: str(tmp_path))
    assert lineage.cut(spark.range(3)).count() == 3
    assert len(list(tmp_path.glob("assortment-*/*"))) == 1
    lineage.remove_work(spark)
    assert not list(tmp_path.glob("assortment-*"))


def test_the_whole_run_against_plain_python(spark, tmp_path):
    """Every row of `catalogue_run`: hashed vectors, principal components and the hierarchy once more without Spark."""
    import re

    import numpy as np

    from assortment import fixed
    from assortment.operators import labels
    from checks.queries import DIM, QUERIES

    from test_clusters import level_clusters, whole_tree

    folder = "/root/testdata/sf0.001"
    clean = cut(Inputs(spark, folder).clean)
    ids, rows = [], []
    for p in clean.orderBy("product_id").collect():
        vector = np.zeros(DIM)
        text = " | ".join((p.name, p.brand, p.category, p.department)).lower()
        for token in filter(None, re.split(r"[\W_]+", text)):
            digest = hashlib.md5(token.encode()).hexdigest()
            vector[int(digest[:8], 16) % DIM] += 1 if digest[8] < "8" else -1
        if vector.any():
            ids.append(p.product_id)
            rows.append(vector / np.linalg.norm(vector))
    rows = np.array(rows)
    _, axes = np.linalg.eigh(np.cov(rows.T))
    short = rows @ axes[:, ::-1][:, : fixed.REDUCED_DIM]
    # The texts have no groups of fifteen; small ones show more.
    for size, samples in ((fixed.MIN_CLUSTER_SIZE, fixed.MIN_SAMPLES), (4, 2)):
        want = level_clusters(whole_tree(ids, short, min_samples=samples), ids, size)
        found = spark.createDataFrame([(i, want.get(i, (-1, 0.0))[0]) for i in ids], "product_id long, cluster_id long")
        names = {r.cluster_id: r.cluster_label for r in labels.label_clusters(found, clean).collect()}
        catalogue = tables.Catalogue(spark, str(tmp_path / f"run-{size}"))
        run.run_sql_layers(catalogue, Inputs(spark, folder).source, AS_OF)
        figures = run.run_catalogue(
            catalogue, AS_OF, embedding={"dim": DIM}, clustering={"min_cluster_size": size, "min_samples": samples}
        )
        got = catalogue.read_reloaded("products_clustered").collect()
        assert len(got) == len(ids) and figures["clusters"] == len({c for c, _ in want.values()})
        for r in got:
            cluster, probability = want.get(r.product_id, (-1, 0.0))
            assert (r.cluster_id, round(r.cluster_probability, 5)) == (cluster, round(probability, 5))
            assert (r.is_noise, r.cluster_label) == (cluster < 0, names.get(cluster))
            assert (r.clustering_algorithm, r.min_cluster_size_param) == (clusters.ALGORITHM, size)
    assert figures["clusters"] >= 3
    registered = QUERIES["catalogue_run"](spark, folder).collect()
    assert {(r.product_id, r.cluster_id) for r in registered} == {(i, -1) for i in ids}
