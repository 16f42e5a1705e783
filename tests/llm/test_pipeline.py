"""The whole pipeline against plain Python, stage by stage."""

import numpy as np

import corpus_pipeline
from assortment.llm import quality_gam
from assortment.sources.lineage import cut

from .helpers import documents
from .test_decontaminate import plain as plain_hits
from .test_packing import check
from .test_secret_scan import plain as plain_secrets
from .test_simhash import plain_components, plain_fingerprint

DATA = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def masked(text):
    parts, done = [], 0
    for _, a, b in plain_secrets(text):
        if a >= done:
            parts += [text[done:a], "[SECRET]"]
        done = max(done, b)
    return "".join([*parts, text[done:]])


def test_every_stage_and_the_whole_against_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    model = quality_gam.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))

    scores = model.scores(np.array([quality_gam.features_of((r[1] or "").encode()) for r in rows.values()]))
    expected = [{k: r for (k, r), s in zip(rows.items(), scores) if s >= 0.7}]
    prints = [(k, plain_fingerprint(r[1])) for k, r in expected[-1].items()]
    firsts = {c for c in plain_components(prints, 2)}
    expected.append({k: r for k, r in expected[-1].items() if k in firsts})
    clean = {}
    for k, r in expected[-1].items():
        n, hit, _ = plain_hits(r[1], items)
        if not (hit and 20 * hit >= n):
            clean[k] = r
    expected.append(clean)
    expected.append({k: (k, masked(r[1]), *r[2:4], len(masked(r[1]))) for k, r in clean.items()})

    assert [len(rows), *map(len, expected)] == sorted([len(rows), *map(len, expected)], reverse=True)
    assert len(expected[0]) < len(rows) and len(expected[2]) < len(expected[1]) < len(expected[0])
    assert expected[3] != expected[2]
    for (_, stage), after in zip(corpus_pipeline.STAGES, expected):
        docs = cut(stage(spark, docs, DATA))
        assert docs.columns == COLUMNS
        assert {r["doc_id"]: tuple(r) for r in docs.collect()} == after
        assert docs.count() == len(after)
    packed = corpus_pipeline.run(spark, DATA).collect()
    check(packed, [(k, r[1]) for k, r in expected[3].items()])


def test_hard_rows_and_extra_columns(spark):
    prose = " ".join(f"word{i} and" for i in range(40))
    rows = [(1, None), (2, ""), (3, prose), (3, prose), (4, prose), (None, prose + " more"), (None, "other " + prose), (5, prose[::-1])]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        columns = [c for c in docs.columns if c not in ("text", "n_chars")]
        given = {tuple(r) for r in docs.select(columns).collect()}
        assert {tuple(r) for r in stage(spark, docs, DATA).select(columns).collect()} <= given, name
        out = cut(stage(spark, docs, DATA))
        assert out.columns == docs.columns, name
        assert out.where("doc_id = 3").count() == (1 if name == "simhash_near_dedup" else 2)
    good = cut(corpus_pipeline.good_quality(spark, docs, DATA))
    model = quality_gam.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    want = [k for k, t in rows if model.scores(np.array([quality_gam.features_of((t or "").encode())]))[0] >= 0.7]
    assert good.columns == docs.columns and sorted(map(repr, (r["doc_id"] for r in good.collect()))) == sorted(map(repr, want))
    check(corpus_pipeline.sequences(spark, docs, DATA).collect(), rows)
    one = [r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, DATA).collect()]
    assert sorted(x for x in one if x is not None) == [1, 3, 5]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), DATA).count() == 0


def test_null_and_repeated_ids_are_judged_row_by_row(spark):
    def prose(name):
        return " ".join(f"{name}{i} and" for i in range(60))

    item = spark.read.parquet(f"{DATA}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(None, prose(f"n{i}x")) for i in range(8)]
    rows += [(7, prose(f"r{i}x")) for i in range(8)]
    rows += [(1, prose("a")), (9, prose("a")), (9, prose("b")), (None, prose("b")), (None, prose("c")), (None, prose("c"))]
    one = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.one_of_each(spark, documents(spark, rows), DATA).collect())
    kept = [*rows[:16], (1, prose("a")), (9, prose("b")), (None, prose("c"))]
    assert one == sorted((k or 0, t) for k, t in kept)

    dirty = [(None, item), (7, item)]
    clean = corpus_pipeline.uncontaminated(spark, documents(spark, rows + dirty), DATA)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in clean.collect()) == sorted((k or 0, t) for k, t in rows)
