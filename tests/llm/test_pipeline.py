"""The pipeline's stages, each on what the one before it kept."""

import corpus_pipeline
from quillspark.llm import toxicity
from quillspark.llm.common import durable, table
from tests.llm import samples as B


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns, name
        counts.append(docs.rows)
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1] > 0.6 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.rows
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()


def test_run_gives_the_last_stage(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert corpus_pipeline.ORACLE_SQL is None


def small(spark):
    """Nulls, empty and long texts, copies, repeated rows, and columns with the names that stages use for themselves."""
    rows = B.documents(seed=4)
    extra = [(*r, r[0], r[1], i) for i, r in enumerate(rows)]
    return spark.createDataFrame(extra, B.SCHEMA + ", hit_id long, `own version` string, runs int"), rows


def placed(rows):
    return sorted((r[0] is not None, r[0] or 0, r[1] or "", r[1] is not None) for r in rows)


def bench(spark, path, rows):
    items = [(1, " ".join(rows[12][1].split()[:15])), (2, None), (None, "x"), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(r[0], int((r[0] or 0) % 9 == 0)) for r in rows], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return [(i, t) for i, t in items if i is not None and t]


def test_stages_match_brute_force(spark, tmp_path):
    """Each stage on the whole small table, against its brute-force version."""
    docs, rows = small(spark)
    items = bench(spark, str(tmp_path), rows)
    stage = dict(corpus_pipeline.STAGES)
    d = str(tmp_path)

    out = stage["line_dedup"](spark, docs, d)
    known = [r for r in rows if r[0] is not None]
    assert out.columns == docs.columns
    want = {r[0]: r for r in B.removed_lines(known, corpus_pipeline.MIN_WORDS)}
    cut = stage["line_dedup"](spark, docs.where("doc_id is not null"), d).collect()
    kept = [r for r in known if not want[r[0]][2] or want[r[0]][4]]
    assert placed((r.doc_id, r.text) for r in cut) == placed((r[0], want[r[0]][4] if r[1] is not None else None) for r in kept)
    assert all(r.n_chars == (len(r.text) if want[r.doc_id][2] else r.n_chars) for r in cut)

    near = stage["minhash_near_dedup"](spark, docs, d)
    group, _ = B.components(rows, corpus_pipeline.PERCENT, corpus_pipeline.SHINGLE_WORDS)
    assert near.columns == docs.columns
    assert placed((r.doc_id, r.text) for r in near.collect()) == placed(r for r in rows if r[0] is None or group[r[0]] == r[0])

    clean = stage["benchmark_decontamination"](spark, docs, d)
    assert clean.columns == docs.columns
    assert placed((r.doc_id, r.text) for r in clean.collect()) == placed(r for r in rows if not B.phrase_hits(r[1], items)[1] and not B.near_items(r[1], items))

    civil = stage["toxicity"](spark, docs, d)
    lexicon = toxicity.learn(docs, toxicity.learnable(table(spark, d, "labels")))
    scores = toxicity.score(docs, lexicon).collect()
    assert civil.columns == docs.columns and len(scores) == len(rows)
    assert civil.count() == sum(r.score < 0.5 for r in scores)

    pieces = stage["best_fit_packing"](spark, docs, d).collect()
    assert sum(r.piece == 0 for r in pieces) == len(rows)


def test_toxicity_stage_takes_effect(spark, tmp_path):
    """Documents with a word of the lexicon go, whether or not they were learnt from, and all others stay."""
    words = lambda i: " ".join(f"w{i}x{k}" for k in range(20))
    rows = [(i, words(i) + (" grumpf" if i % 5 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.civil(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i in range(400) if i % 5}


def test_stages_take_empty_tables(spark, tmp_path):
    docs, rows = small(spark)
    bench(spark, str(tmp_path), rows)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).isEmpty(), name
