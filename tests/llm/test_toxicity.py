from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from tripmill.llm import toxicity
from tripmill.llm.catalogue import QUERIES

LEXICON = {"idiot": 5.0, "scum$": 4.0}


def contexts(clause):
    return dict(zip(toxicity.CONTEXTS, toxicity.clause_weights(clause, LEXICON), strict=True))


def test_clauses_not_words_are_weighed():
    assert contexts("what an idiot he is") == {"plain": 5, "aimed": 0, "negated": 0, "reported": 0}
    assert contexts("you are an idiot")["aimed"] == 5
    assert contexts("that is not an idiot")["negated"] == 5
    assert contexts("they said idiot")["reported"] == 5
    assert contexts('the word "idiot" is short')["reported"] == 5
    assert contexts("not one of those four idiot things")["plain"] == 5
    assert contexts("they will kill you") == {"plain": toxicity.THREAT, "aimed": 0, "negated": 0, "reported": 0}
    assert sum(contexts("they will not kill you").values()) == 0
    assert sum(contexts("a scummy place").values()) == 0 and sum(contexts("scum").values()) == 4


def test_features_find_every_clause():
    machine = toxicity.finder(LEXICON)
    assert toxicity.features("Fine. Idiots here; you scum\nnot scum", LEXICON, machine).round(3).tolist() == (1 - 2.718281828**-toxicity.np.array([5.0, 4, 4, 0])).round(3).tolist()
    for text in (None, "", " \n", "kill", "xidiot"):
        assert not toxicity.features(text, LEXICON, machine).any()


def corpus(spark, n=900):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = [f"w{(i * 7 + k * k) % 301}x" for k in range(40)]
        if toxic:
            words[5 + i % 30] = f"grumble{'abc'[i % 3]}" if i % 12 else "fiend"
        rows.append((i, " ".join(words) + ".", "en"))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_words_are_learned_from_the_other_rows(spark):
    docs, labels = corpus(spark)
    # Labels of held-out rows are turned round: they must not matter.
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model = toxicity.train(docs, turned)
    assert model == toxicity.train(docs.repartition(5), labels)
    assert any(w.startswith("grumbl") for w in model["lexicon"]) and any(w.startswith("fien") for w in model["lexicon"])
    rows = toxicity.score(docs, model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert all(r["predicted"] == int(r["doc_id"] % 6 == 0) for r in held) and len(held) > 200
    kept = toxicity.keep(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if not r["predicted"]}


def test_awkward_rows(edges, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, 0), (99, 1), (2, None), (3, 0)], "doc_id bigint, toxic int")
    for docs in (edges, nothing):
        model = toxicity.train(docs, labels)
        assert toxicity.score(docs, model).count() == docs.count()
        assert toxicity.keep(docs, model).count() <= docs.count()
    none = toxicity.train(edges, labels.limit(0))
    assert none["lexicon"] == toxicity.SEED
    rows = {r["doc_id"]: r for r in toxicity.score(edges, none).collect()}
    assert 0 < rows[5]["score"] == rows[6]["score"] < 0.5 and rows[5]["predicted"] == 0


@pytest.mark.parametrize("name", ["op5_toxicity"])
def test_held_out_rows_are_told_apart(spark, name):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES[name](spark, sf).join(labels, "doc_id").where("held_out").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hits > 0.85 * sum(r["toxic"] for r in rows) and hits > 0.85 * sum(r["predicted"] for r in rows)
