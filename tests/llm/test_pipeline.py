"""Each stage on its own input against the operators' brute-force checks, and the whole run."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from ferrywright.llm import common, mixing, quality, simhash  # noqa: E402

from .test_simhash import plain_components, plain_fingerprint  # noqa: E402
from .test_tokens import library_rows  # noqa: E402


def test_stages_and_run(spark, data):
    docs = common.table(spark, data, "documents")
    columns, outs = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        outs.append(common.stage(stage(spark, outs[-1], data), f"pipeline-test-{name}"))
    rows = [[tuple(r) for r in o.collect()] for o in outs]
    assert all(o.columns == columns for o in outs[:-1])
    start, good, single, clean, mixed, encoded = rows

    weights = quality.fit(docs)
    assert sorted(good) == sorted(r for r in start if quality.score(r[1], weights) >= quality.KEEP_FROM) and len(good) < len(start)

    parts = {}
    for d, _, c in plain_components([(r[0], plain_fingerprint(r[1])) for r in good]):
        parts.setdefault(c, []).append(d)
    assert sorted(r[0] for r in single) == sorted(parts) and len(single) < len(good)

    held = {r.text for r in common.table(spark, data, "benchmark").collect()}
    dropped = set(single) - set(clean)
    assert set(clean) <= set(single) and dropped
    assert not [r for r in clean if any(t in r[1] for t in held)]
    assert all(any(t[:40] in r[1] or t[-40:] in r[1] for t in held) for r in dropped)

    taken = {r.doc_id: r.taken for r in mixing.mix_sizes(outs[3]).collect()}
    words = {r[0]: len(r[1].split()) for r in clean}
    for d in taken:
        assert sum(len(r[1].split()) for r in mixed if r[0] == d) == taken[d] <= 2 * words[d]

    texts = sorted((r[0], r[1]) for r in mixed)
    assert sorted(encoded, key=lambda r: r[1]) == library_rows(texts)
    assert sorted(map(tuple, corpus_pipeline.run(spark, data).collect())) == sorted(encoded)


def test_names_follow_the_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "source_mix", "token_ids"]
    assert simhash.RADIUS == 3


def test_empty_table(spark, data, tmp_path):
    docs = common.table(spark, data, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(spark, docs, data), f"pipeline-empty-{name}")
    assert docs.collect() == []


def test_edge_rows_pass_every_stage(spark, data):
    from pyspark.sql import functions as F

    docs = common.table(spark, data, "documents")
    text = docs.orderBy(F.desc(F.length("text"))).first().text
    edge = [(None, text, None, None, None), (None, None, None, None, None), (900001, None, "en", "s", 1), (900001, None, "en", "s", 1), (900002, "", "en", None, None), (900003, text * 20, "en", "s", 2), (900004, text, "en", "s", 3), (900004, text, "en", "s", 3)]
    both = docs.unionByName(spark.createDataFrame(edge, docs.schema)).withColumns({"key": F.lit(1), "_row": F.col("text"), "Copies": F.lit(None).cast("int"), "cell": F.lit("x"), "_c0": F.lit(2)})
    counts = [both.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, both, data)
        if name != "token_ids":
            assert out.columns == both.columns
        before, both = both, common.stage(out, f"pipeline-edge-{name}")
        counts.append(both.count())
        if name == "simhash_near_dedup":
            ids = [r.doc_id for r in both.collect()]
            assert len(ids) == len(set(ids)) and 900004 not in ids
        if name in ("quality_classifier", "benchmark_decontamination"):
            assert both.exceptAll(before).isEmpty()
    assert counts[5] == counts[4] and counts[1] <= counts[0] and counts[3] <= counts[2] <= counts[1]
