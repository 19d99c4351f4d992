import random

import numpy as np
from pyspark.sql import functions as F

from sentrylake.llm import grammar, toxicity
from sentrylake.llm.queries import op3_toxicity


def kinds(text, stems=None):
    reader = toxicity.Reader(toxicity.Model(stems=stems or {}))
    found = reader.features(text.encode())
    return {name for name, weight in zip(grammar.KINDS, found, strict=False) if weight}


def test_grammar_tells_clauses_apart():
    assert kinds("What a loser.") == {"insult"}
    assert kinds("You are a LOSER!") == {"targeted insult"}
    assert kinds("a loser, you") == {"insult", "named after"}
    assert kinds("you are not a loser") == {"negated insult"}
    assert kinds("not one of the many words is loser") == {"insult"}
    assert kinds("she said what a loser") == {"reported insult"}
    assert kinds("she said so. a loser") == {"insult"}
    assert kinds("he said so\na loser") == {"insult"}
    assert kinds("I will kill you") == {"threat", "named after"}
    assert kinds("you I kill") == {"targeted threat"}
    assert kinds("never kill them") == {"excused threat", "named after"}
    assert kinds("xlowered xlow", {"xlow": 5.0}) == {"insult"}
    assert kinds("xlowered", {"xlow ": 5.0}) == set()
    assert kinds("") == kinds(" \t") == kinds("nothing here, not even a word said to you") == set()


def test_composed_machine_equals_its_parts():
    table, names = grammar.compose()
    rng, state, parts = random.Random(5), 0, [0] * len(grammar.MACHINES)
    for token in rng.choices(grammar.CLASSES, k=5000):
        symbol = (token, frozenset())
        for i, (step, _) in enumerate(grammar.MACHINES):
            parts[i], symbol = step(parts[i], symbol)
        state, out = table[state][token]
        assert out == symbol and names[state] == tuple(parts)


def make_rows(spark, n=1200):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = rng.choices(words, k=60)
        for _ in range(3 * toxic):
            text[rng.randrange(60)] = "zorq" + rng.choice(["", "a", "en", "ist"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_stems_and_holds_out(spark):
    docs, labels = make_rows(spark)
    out = toxicity.held_out()
    model = toxicity.train(docs, labels, ~out, positives=300, negatives=600)
    assert any("zorq".startswith(s) or s == "zorq" for s in model.stems)
    scored = toxicity.score(docs.withColumn("h", out), model).join(labels, "doc_id").where("h").collect()
    right = [(r.toxicity >= 0.5) == bool(r.toxic) for r in scored]
    assert len(right) > 150 and np.mean(right) > 0.97
    assert toxicity.train(docs, labels, ~out, positives=300, negatives=600) == model


def test_edge_rows_and_missing_labels(spark):
    docs, labels = make_rows(spark, 60)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "You idiot " * 20_000, 3)], "doc_id long, text string, score int")
    for none in (labels.limit(0), labels.where("toxic = 0"), spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")):
        model = toxicity.train(docs, none, F.lit(True))
        got = {r.score: r.toxicity for r in toxicity.score(odd, model).collect()}
        assert got[1] == got[2] < 0.5 < got[3] <= 1
    assert toxicity.score(odd.limit(0), toxicity.Model()).count() == 0
    assert toxicity.score(odd, toxicity.Model(), out="score").columns == ["doc_id", "text", "score"]


def test_query_shape(spark):
    rows = op3_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_the_sample_is_bounded_where_an_id_repeats(spark):
    docs = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 90).alias("text"))
    docs = docs.unionByName(spark.range(200).select(F.col("id").alias("doc_id"), F.lit("other").alias("text")))
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    rows = toxicity.labelled(docs, labels, F.lit(True), 100, 100)
    assert rows.count() == 200
    assert rows.where("text <> 'other'").count() <= 1


def plain_score(text, model):
    """The score from the features of one text, without Spark."""
    found = np.array(toxicity.Reader(model).features(text.encode() if text is not None else None))
    bias, *weights = model.weights
    return 1 / (1 + np.exp(-(bias + sum(w * np.log1p(x) for w, x in zip(weights, found, strict=True)))))


def test_scores_are_the_logistic_of_the_features(spark):
    model = toxicity.Model()
    texts = ["", None, "you are an idiot", "He said you are an idiot.", "you are not stupid", "the weather is fine", "I will kill you"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r.doc_id: r.s for r in toxicity.score(docs, model, out="s").collect()}
    for i, text in enumerate(texts):
        assert abs(got[i] - plain_score(text, model)) < 1e-9
