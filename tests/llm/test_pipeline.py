"""Mixing against a direct solution, the pipeline's stages, and every query with SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, duck
from tallyhouse.llm import chat, linededup, mixing, queries

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, rate string, tokens string, domain string, quality string"
LABELS = "doc_id long, quality int, toxic int"


def corpus(spark):
    rows = [(i, ("fine words here " if i % 3 else "rough bad lines ") * (1 + i % 17)) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "..."), (None, "fine words"), (503, "rough " * 50_000), (0, rows[0][1])]
    table = spark.createDataFrame([(d, t, "r", "t", "x", "q") for d, t in rows], DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 30 == 0)) for i in range(0, 120, 2)] + [(None, 1, 0), (4, None, None), (9999, 0, 0)], LABELS)
    return table, labels


def solved(tokens, posteriors, targets):
    """The same least squares by many plain projected steps."""
    rates = np.ones(len(tokens))
    gram = (posteriors * tokens[:, None]).T @ posteriors
    wanted = tokens.sum() * np.array(targets) / sum(targets)
    for _ in range(5000):
        residual = (rates * tokens) @ posteriors - wanted
        rates = np.maximum(0, rates - posteriors @ np.linalg.solve(gram + 1e-9 * np.trace(gram) * np.eye(len(targets)), residual))
    return rates, ((rates * tokens) @ posteriors - wanted) / tokens.sum()


@pytest.mark.parametrize("targets", [(0.5, 0.4, 0.1), mixing.TARGETS, (1.0, 0.0, 0.0)])
def test_rates_meet_the_targets(spark, targets):
    table, labels = corpus(spark)
    out = mixing.mixed(table, labels, targets)
    assert set(out.columns) == {"doc_id", "text", "domain", "quality", "tokens", "posteriors", "rate"}
    rows = out.select("tokens", "posteriors", "rate").collect()
    tokens, posteriors, rates = (np.array([r[i] for r in rows], float) for i in range(3))
    assert len(rows) == table.count() and (rates >= 0).all() and np.allclose(posteriors.sum(axis=1), 1)
    _, left = solved(tokens, posteriors, targets)
    ours = ((rates * tokens) @ posteriors) / tokens.sum() - np.array(targets) / sum(targets)
    start = tokens @ posteriors / tokens.sum() - np.array(targets) / sum(targets)
    if np.abs(left).max() < 1e-6:  # within what the posteriors span
        assert np.abs(ours).max() < 1e-4
    assert np.abs(ours).max() <= max(1e-4, min(np.abs(start).max(), 2 * np.abs(left).max()))


def test_reachable_targets_are_met(spark):
    """Posteriors as they come from a corpus; a third of the documents has to go to rate 0 or nearly."""
    draw = np.random.default_rng(1)
    posteriors, tokens = draw.dirichlet([0.8, 0.1, 0.1], 3000), draw.integers(1, 500, 3000)
    table = spark.createDataFrame([(int(n), [float(x) for x in p]) for n, p in zip(tokens, posteriors, strict=True)], "tokens long, posteriors array<double>")
    targets = (0.96, 0.03, 0.01)
    rates = np.ones(3000)
    for g in mixing.fit_rates(table, targets):
        rates = np.maximum(0, rates - posteriors @ np.array(g))
    got = (rates * tokens) @ posteriors / tokens.sum()
    assert np.abs(got - targets).max() < 1e-4 and (rates == 0).any()


def test_posteriors_follow_the_labels(spark):
    table, labels = corpus(spark)
    rows = {r.doc_id: r for r in mixing.rates(table, labels).collect()}
    assert rows[17].p_sound > 0.8 and rows[9].p_sound < 0.2
    assert rows[500].tokens == rows[501].tokens == 0 and rows[502].tokens == 1 and rows[503].tokens == 50_000
    assert rows[500].p_sound == rows[501].p_sound == pytest.approx(41 / (60 + 1 + 3), abs=0.05)


def test_mixing_nothing(spark):
    table, labels = corpus(spark)
    assert mixing.rates(table.limit(0), labels).collect() == []
    unlabelled = mixing.rates(table, labels.limit(0)).collect()
    assert {round(r.p_toxic, 6) for r in unlabelled} == {round(1 / 3, 6)} and all(math.isfinite(r.rate) for r in unlabelled)


def test_native_operators_run_no_python(spark):
    table, labels = corpus(spark)
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    for frame in (mixing.rates(table, labels), linededup.line_report(table), linededup.without_repeated_lines(table), chat.conversation_report(turns)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_stages_keep_their_columns_and_act(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kinds = docs.dtypes
    seen = docs.count()
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SMALL)
        assert (out.dtypes == kinds) == (name != "mixture")
        many = out.count()
        assert 0.5 * seen < many <= seen
        assert many < seen if name in ("near_copies", "decontamination") else True
        docs, seen = out, many
    assert {"tokens", "posteriors", "rate"} <= set(docs.columns)


def test_stages_with_nulls_and_nothing(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    known = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, None, "en", "s", 0), (None, "The and of that was in it.", None, None, None)], kind)
    some, none = known.unionByName(odd), known.limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, some, SMALL).count() > 0, name
        assert step(spark, none, SMALL).count() == 0, name


def test_run_is_the_stages_in_a_row(spark):
    out = corpus_pipeline.run(spark, SMALL)
    total = out.agg(F.sum("tokens"), F.sum(F.col("rate") * F.col("tokens"))).first()
    assert total[1] == pytest.approx(total[0], rel=1e-3)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, SMALL)
    if name in queries.SQL:
        same, note = compare(frame, con, queries.SQL[name])
        assert same, note
    else:
        assert frame.count() > 0


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and len(queries.QUERIES) == 13


def test_words_are_what_white_space_separates(spark):
    texts = [None, "", " \t\r\n\x0b\f", "  One two\n", "a", "\u00a0x y\x0bz "]
    found = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING").select("id", mixing._pairs(F.col("text")).alias("pairs"))
    sizes = {r.id: len(r.pairs) for r in found.collect()}
    assert [sizes[i] for i in range(len(texts))] == [0, 0, 0, 2, 1, 3]


def test_mixing_stages_no_text_and_scores_every_row(spark):
    """Rows equal in all columns included: scores are those of the words one by one, and rates need no text again."""
    table, labels = corpus(spark)
    out = mixing.rates(table, labels)
    held = spark.read.parquet(*out.inputFiles())
    assert "text" not in held.schema.simpleString() and held.count() == table.count()

    twice = table.unionByName(table)
    weights, priors = mixing.word_weights(twice, labels, 3)
    rows = mixing.numbered(twice, F.col("doc_id"), F.col("text"), mixing._pairs(F.col("text")).alias("pairs"))
    found = mixing.with_posteriors(rows.drop("pairs"), weights, priors).collect()
    pairs = {r.number: r.pairs for r in rows.collect()}
    assert len(found) == len(pairs) == 2 * table.count()
    for r in found:
        of_row = pairs[r.number]
        pull = min(1, mixing.PATIENCE / max(1, len(of_row)))
        scores = [pull * sum(weights[d][p.begins] + weights[d][p.ends] for p in of_row) + priors[d] for d in range(3)]
        raised = np.exp(np.array(scores) - max(scores))
        assert r.tokens == len(of_row) and np.allclose(r.posteriors, raised / raised.sum(), atol=1e-4)
