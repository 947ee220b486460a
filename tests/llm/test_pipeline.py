"""The classifier on held-out documents, and the pipeline on a small corpus with planted cases."""

import random

import pytest
from pyspark.ml.functions import array_to_vector

import corpus_pipeline
from ensemblage.llm import cotraining
from ensemblage.llm.common import plain_words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
INSULTS = ("fool", "crook", "liar")


def corpus(n):
    """Clean prose, prose with insults, and shouting; a label says which."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(60, 120))]
        quality, toxic = 1, 0
        if i % 5 == 3:
            text[rng.randrange(60)] = rng.choice(INSULTS)
            toxic = 1
        if i % 5 == 4:
            text = [w.upper() + "!!" for w in text]
            quality = 0
        docs.append((i, " ".join(text) + ".", "en", f"s{i % 3}", sum(map(len, text)) + len(text)))
        labels.append((i, quality, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(900)
    frame = spark.createDataFrame(docs, DOCS)
    known = spark.createDataFrame([label for label in labels if label[0] < 600] + [(3, None, None), (3, 1, 0), (99999, 0, 0)], LABELS)
    return frame, labels, cotraining.fit(frame, known, rounds=1)


def test_held_out_documents_are_judged(fitted):
    docs, labels, model = fitted
    rows = {r["doc_id"]: r for r in cotraining.score(docs, model).collect()}
    assert len(rows) == 900 and all(0 <= r["p_bad"] <= 1 for r in rows.values())
    right = sum(rows[i]["kept"] == (quality == 1 and not toxic) for i, quality, toxic in labels[600:])
    assert right >= 0.97 * 300
    assert {r["doc_id"] for r in cotraining.kept(docs, model).collect()} == {i for i, r in rows.items() if r["kept"]}


def test_odd_documents_and_missing_labels(spark, fitted):
    _, _, model = fitted
    odd = [(1, None, None, None, None), (2, "", "en", "", 0), (3, " \n", "xx", "s", 2), (4, "w " * 100_000, "en", "s", 200_000), (2, "", "en", "", 0)]
    docs = spark.createDataFrame([(*row, "clash") for row in odd], DOCS + ", label string")
    rows = cotraining.score(docs, model).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2, 2, 3, 4] and all(r["p_bad"] is not None for r in rows)
    assert cotraining.score(docs.limit(0), model).count() == 0
    nothing = cotraining.fit(docs, spark.createDataFrame([(1, 1, 0)], LABELS))
    assert nothing is None and all(r["kept"] and r["p_bad"] is None for r in cotraining.score(docs, nothing).collect())


def test_pipeline(spark, tmp_path):
    docs, labels = corpus(300)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    clean = [row for row in docs if row[0] % 5 < 3]
    passage = " ".join(f"shared{i}" for i in range(55))
    more = [
        (1000, clean[0][1], "en", "s0", 1), (1001, clean[1][1].replace(" ", "  ", 1) + " end", "en", "s1", 1),
        (1002, clean[2][1] + " own words here " + item, "en", "s1", 1),
        *[(1003 + i, f"{clean[3 + i][1][::-1]}\n{passage}", "en", "s2", 1) for i in range(3)],
    ]
    folder = str(tmp_path)
    spark.createDataFrame(docs + more, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]
    at = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, at, folder).write.parquet(out)
        at = spark.read.parquet(out)
        if "text" in at.columns:
            assert at.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            texts[name] = {r["doc_id"]: r["text"] for r in at.collect()}
    bad = {i for i, quality, toxic in labels if quality == 0 or toxic}
    assert len(bad & set(texts["quality"])) <= 3 and len({row[0] for row in clean} - set(texts["quality"])) <= 3
    assert 1000 in texts["quality"] and 1000 not in texts["lines"]
    assert sum(passage in t for t in texts["lines"].values()) == 1
    assert 1001 not in texts["near_duplicates"] and clean[1][0] in texts["near_duplicates"]
    assert not any(item in t for t in texts["decontamination"].values())
    assert set(texts["near_duplicates"]) - set(texts["decontamination"]) == set()
    packed = at.collect()
    assert {r["doc_id"] for r in packed} == set(texts["decontamination"]) and all(len(plain_words(t)) for t in texts["decontamination"].values())
    ends = {}
    for r in packed:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in ends.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and held[-1][0] + held[-1][1] <= 2048


def test_fitting_many_partitions_shuffles_little(spark):
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        executors = store.executorList(True)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    rows = spark.range(0, 400, 1, 40).selectExpr("CAST(id % 2 AS DOUBLE) AS label", "array(CAST(id % 2 + id % 5 AS DOUBLE)) AS x")
    rows = rows.select("label", array_to_vector("x").alias("x"))
    before = written()
    model = cotraining._fit(rows, "x", 1e-4)
    assert written() - before < 100_000 and model.coefficients[0] > 0
