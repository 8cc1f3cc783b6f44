"""The pipeline's stages against plain versions of them, each on its own input."""

import collections

import corpus_pipeline
from llm import brute
from llm.test_operators import SF, _hash

from veilframe.llm import tokens


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {"documents": {r.doc_id: r.text for r in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert len(kept["language_id"]) >= 0.98 * len(kept["documents"])
    lines = brute.line_dedup(list(kept["language_id"].items()), _hash, distance_bits=None)
    assert kept["line_dedup"] == {k: t for k, t in lines.items() if t.strip()}
    groups = brute.jaccard(list(kept["line_dedup"].items()), 5, 80)
    assert set(kept["near_duplicates"]) == {k for k, _, first in groups if k == first}
    assert not any(n for _, _, n, _ in brute.contamination(kept["benchmark_decontamination"].items(), items))
    clean = {k for k, _, n, _ in brute.contamination(kept["near_duplicates"].items(), items) if not n}
    assert all(kept["benchmark_decontamination"][k] == kept["near_duplicates"][k] for k in clean)
    lengths = collections.Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        lengths[r.doc_id] += r.length
    assert lengths == {k: len(tokens.token_ids("byte_bpe_50k.json", t)) + 1 for k, t in kept["benchmark_decontamination"].items()}


def test_empty_and_odd_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, None), (1, "", "en", "s", 0), (None, "the cat sat on a mat", "en", "s", 20)] * 2, docs.schema)
    for frame in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF)
        frame.collect()


def test_near_duplicates_move_few_texts(spark, tmp_path):
    words = [[f"w{k}x{i}" for i in range(20)] for k in range(400)]
    rows = [(k, " ".join(w), "kept") for k, w in enumerate(words)]
    rows += [(1000 + k, " ".join([*words[k], "more"]), "gone") for k in (3, 50)]
    rows += [(7, " ".join(words[7]), "kept"), (None, " ".join(words[9]), "null"), (-5, "alone", "kept"), (1 << 40, "far off", "kept")]
    spark.createDataFrame(rows, "doc_id long, text string, fate string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with more groups than a broadcast may hold
    try:
        found = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, SF)
        moved = found.collect()
        lines = found._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.doc_id or 0, r.fate) for r in moved) == sorted([(k, "kept") for k in [*range(400), -5, 1 << 40]] + [(0, "null")])
    assert _most_texts_shuffled(lines) < 20


def _most_texts_shuffled(plan):
    """Rows of the largest exchange that carries texts, as the plan's run counted them."""
    most, left = 0, [plan]
    while left:
        node = left.pop()
        kind = node.nodeName()
        if kind == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStage"):
            left.append(node.plan())
        else:
            if kind == "Exchange" and "text#" in node.output().mkString(","):
                most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
            left += [node.children().apply(i) for i in range(node.children().size())]
    return most


def test_texts_go_to_python_in_small_batches(spark):
    before = {key: spark.conf.get(key) for key in corpus_pipeline.BATCH_ROWS}
    docs = spark.range(6000, numPartitions=1).selectExpr("id as doc_id", "'some text' as text")

    def most(asked):
        for key in before:
            spark.conf.set(key, asked)
        corpus_pipeline.in_small_batches(lambda spark, docs, sf_dir: docs)(spark, docs, SF)
        return docs.mapInArrow(lambda batches: (b.slice(b.num_rows - 1) for b in batches), docs.schema).count()  # a row a batch

    try:
        assert [most(asked) for asked in ("10000", "500")] == [3, 12]
        assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
