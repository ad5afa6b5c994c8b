from __future__ import annotations

import os
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from llm.test_exact_dedup import expected as exact
from llm.test_jaccard import expected as similar
from llm.test_mixing import brute
from llm.test_packing import best_fit, check_places
from tokenizers import Tokenizer

from tripmill.llm import mixing, packing, toxicity
from tripmill.llm.catalogue import TOKENIZER


def labelled(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0), (3, 0), (5, 1), (8, None)], "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("rows", ["edges", "nothing"])
def test_stages_of_awkward_rows(spark, tmp_path, request, rows):
    docs = request.getfixturevalue(rows)
    folder = str(tmp_path)
    labelled(spark, folder, docs)
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, spark.read.parquet(os.path.join(folder, "documents.parquet" if not k else f"s{k - 1}")), folder)
        made.write.parquet(f"{folder}/s{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == columns, name
    sizes = [spark.read.parquet(f"{folder}/s{k}").count() for k in range(5)]
    if rows == "nothing":
        assert sizes == [0] * 5
        return
    assert sizes[0] >= sizes[1] >= sizes[2] > 0
    left = spark.read.parquet(f"{folder}/s2")
    plan = {(r["doc_id"], r["source"]): r["epochs"] for r in mixing.mix(left).collect()}
    assert sizes[3] == sum(plan.values())
    check_places(spark.read.parquet(f"{folder}/s4").collect())


def test_every_stage_by_brute_force(spark, sf):
    """Each stage's rows, from the rows of the one before, by the plain versions of the operators' tests."""
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    frame = lambda rows: spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)
    steps = [stage for _, stage in corpus_pipeline.STAGES]

    def ids(rows):
        return Counter(r["doc_id"] for r in rows)

    model = toxicity.train(frame(docs), spark.read.parquet(f"{sf}/labels.parquet"))
    machine, coefficients = toxicity.finder(model["lexicon"]), np.array(model["coefficients"])
    clean = [r for r in docs if toxicity.probability(toxicity.features(r["text"], model["lexicon"], machine), coefficients) < 0.7]
    assert ids(steps[0](spark, frame(docs), sf).collect()) == ids(clean) and 0 < len(clean) < len(docs)
    kept = {k[0] for k in exact(clean) if k[3]}
    single = [r for r in clean if r["doc_id"] in kept]
    assert ids(steps[1](spark, frame(clean), sf).collect()) == ids(single)
    first = {k[0] for k in similar(single) if k[0] == k[2]}
    apart = [r for r in single if r["doc_id"] in first]
    assert ids(steps[2](spark, frame(single), sf).collect()) == ids(apart)
    mix = [r for r, n in zip(apart, brute(apart), strict=True) for _ in range(n)]
    assert ids(steps[3](spark, frame(apart), sf).collect()) == ids(mix)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    pieces = Counter()
    for r in mix:
        n = len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        pieces.update((r["doc_id"], k, start, length) for k, (start, length) in enumerate(packing.cut(n, 1024)))
    rows = steps[4](spark, frame(mix), sf).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in rows) == pieces
    assert check_places(rows) <= best_fit([r["length"] for r in rows], 1024) + 1


def test_run_follows_the_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf).collect()
    assert check_places(rows) > 0
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near duplicates", "mixing", "packing"]
