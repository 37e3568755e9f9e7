"""Quality and toxicity: parts against brute force, defined results, held-out accuracy."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import LARGER, SMALL, empty, near_copies, table, with_clashes
from tests.llm.test_words import expected
from tidemark.llm import catalog, quality, quality_rules, toxicity
from tidemark.llm.boosting import fit_trees
from tidemark.llm.learning import labelled_ids, sample
from tidemark.llm.statistics import COUNTS, count_table
from tidemark.llm.words import blocks


def held_out(spark, df, target):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = df.join(labels, "doc_id").toPandas()
    return rows[target].to_numpy(), rows


@pytest.mark.parametrize(("name", "target", "least"), [("op1_quality_classifier", "quality", 0.95), ("op10_toxicity", "toxic", 0.95)])
def test_held_out_accuracy(spark, name, target, least):
    df = {q.name: q for q in catalog.QUERIES}[name].run(spark, LARGER)
    labels, rows = held_out(spark, df, target)
    held = rows.held_out.to_numpy()
    assert held.any() and np.mean(labels[held] == rows.predicted[held]) >= least
    assert rows.score.between(0, 1).all()
    assert df.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()


def test_rules_keep_good_texts(spark):
    df = catalog.op2_quality_rules(spark, LARGER)
    labels, rows = held_out(spark, df, "quality")
    held = (pd.util.hash_array(rows.doc_id.to_numpy()) >= 0) & ~rows.base_failed
    assert np.mean(labels[held] == rows.kept[held]) > 0.95


def test_base_rules_equal_a_plain_loop(spark):
    texts = [*near_copies(), None, "a b c " * 30, "# ~ " * 60]
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    rows = quality_rules.quality_rules(with_clashes(table(spark, texts)), labels).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = expected(texts[row.doc_id] or "")
        assert {name: row[name] for name in want} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert row.base_failed == failed and not (failed and row.kept)


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = table(spark, ["a", None, "word " * 60], [1, None, 1])
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity_scores(docs, none).collect()} == {0.5}
    assert {r.score for r in quality_rules.quality_rules(docs, none).collect()} == {0.5}
    some = spark.createDataFrame([(1, 0, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    for scores in (quality.quality_scores, toxicity.toxicity_scores, quality_rules.quality_rules):
        assert scores(empty(spark), some).count() == 0


def test_labels_with_nulls_and_repeats(spark):
    rows = [(1, 0), (1, 1), (2, None), (None, 1), (3, 7), (4, 0)]
    labels = labelled_ids(spark.createDataFrame(rows, "doc_id long, quality int"), "quality")
    assert sorted(map(tuple, labels.collect())) == [(1, 1), (4, 0)]
    assert sample(labels, 1).count() <= 1 and sample(labels, 2).count() == 2
    many = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert 800 < sample(many, 1000).count() <= 1000


def test_moments_equal_numpy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labelled = count_table(docs).withColumn("label", (F.col("doc_id") % 3 == 0).cast("int")).select("label", *COUNTS)
    model = quality.fit_discriminant(labelled)
    rows = labelled.toArrow()
    features, labels = quality.transformed(rows)[:, 1:], rows.column("label").to_numpy()
    scores = []
    pooled = sum(np.cov(features[labels == c].T, bias=True) * (labels == c).sum() for c in (0, 1)) / len(labels)
    for c in (0, 1):
        own = features[labels == c]
        covariance = (1 - quality.POOLED) * np.cov(own.T, bias=True) + quality.POOLED * pooled
        size = len(covariance)
        covariance = (1 - quality.ROUND) * covariance + (quality.ROUND * np.trace(covariance) / size + quality.FLOOR) * np.eye(size)
        away = features - own.mean(0)
        distance = (away * np.linalg.solve(covariance, away.T).T).sum(1)
        scores.append(np.log(len(own) / len(labels)) - np.linalg.slogdet(covariance)[1] / 2 - distance / 2)
    assert np.allclose(model.scores(features), 1 / (1 + np.exp(np.clip(scores[0] - scores[1], -500, 500))))


def test_one_class_or_constant_features(spark):
    docs = table(spark, ["same text"] * 6)
    for marks in ([(i, 1) for i in range(4)], [(i, i % 2) for i in range(4)]):
        labels = spark.createDataFrame(marks, "doc_id long, quality int")
        scores = [r.score for r in quality.quality_scores(docs, labels).collect()]
        assert np.allclose(scores, 0.5)


def test_trees_learn_and_keep_the_order():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3000, 4))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.5) ^ (rng.random(3000) < 0.02)).astype(float)
    free = fit_trees(rows, labels)
    assert np.mean((free.scores(rows) > 0.5) == labels) > 0.93
    noisy = (rows[:, 2] + np.sin(3 * rows[:, 2]) + rng.normal(size=3000) > 0).astype(float)
    for sign in (1, -1):
        trees = fit_trees(rows, noisy, {2: sign})
        grid = np.repeat(rows[:50], 40, 0)
        grid[:, 2] = np.tile(np.linspace(-3, 3, 40), 50)
        assert (np.diff(trees.margins(grid).reshape(50, 40), axis=1) * sign >= -1e-12).all()


def test_trees_equal_a_walk_down_each_tree():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 5, size=(200, 3)).astype(float)
    trees = fit_trees(rows, (rows[:, 0] > rows[:, 1]).astype(float), rounds=7)
    for row, margin in zip(rows[:30], trees.margins(rows[:30]), strict=True):
        total = trees.base
        for node in trees.roots:
            while not trees.leaf[node]:
                node = trees.left[node] + int(row[trees.feature[node]] > trees.threshold[node])
            total += trees.value[node]
        assert abs(total - margin) < 1e-9


@pytest.mark.parametrize("n", [0, 1])
def test_trees_of_no_or_one_row(n):
    trees = fit_trees(np.zeros((n, 2)), np.zeros(n))
    assert len(trees.margins(np.ones((3, 2)))) == 3


def test_isotonic_is_rising_and_keeps_the_mean():
    rng = np.random.default_rng(2)
    scores = np.round(rng.normal(size=500), 1)
    labels = (rng.random(500) < 1 / (1 + np.exp(-scores))).astype(float)
    places, values = toxicity.isotonic(scores, labels)
    assert (np.diff(places) > 0).all() and (np.diff(values) >= 0).all()
    assert abs(np.interp(scores, places, values).mean() - labels.mean()) < 1e-9


def test_learned_words_explain_toxic_texts(spark):
    copied = "alpha beta gamma grumpf delta"
    rows = [(copied, 1)] * 20 + [(f"filler{i} grumpf words", 1) for i in range(20)] + [(f"the quiet filler{i} words", 0) for i in range(60)]
    rows += [("a vile town", 0)] * 2
    learned, insults = toxicity.learn_words(spark.createDataFrame(rows, "text string, label int"))
    assert learned == ["grumpf"] and "vile" not in insults and "idiot" in insults
    none = toxicity.learn_words(spark.createDataFrame([("a", 1)], "text string, label int"))
    assert none == ([], toxicity.INSULTS)


def test_copies_do_not_crowd_out_learned_words(spark):
    letters = "bcdfghjkmn"
    rare = [f"q{letters[i // 100]}{letters[i // 10 % 10]}{letters[i % 10]}" for i in range(500)]
    clean = [(f"the quiet {a}{b} words", 0) for a in letters for b in letters]
    insulting = [(f"{a}{b} grumpf vile words", 1) for a in letters for b in letters[:2]]
    frame = lambda rows: spark.createDataFrame(rows, "text string, label int")
    # Exact copies: the rare words of one text, and one clean text that quotes an insult.
    copied = [(" ".join(rare), 1)] * 40 + [("they said vile there", 0)] * 60
    learned, insults = toxicity.learn_words(frame(clean + insulting + copied))
    assert learned[0] in ("grumpf", "vile") and "grumpf" in learned and "vile" in insults and not set(rare) & set(learned)
    # Near copies are texts of their own, with more candidates than any fixed number of places.
    near = [(" ".join([*rare, "x" * i]), 1) for i in range(1, 26)]
    assert "grumpf" in toxicity.learn_words(frame(clean * 5 + [(f"{t} too", y) for t, y in clean] + insulting + near))[0]


def test_cover_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    held = [np.unique(rng.integers(0, 30, rng.integers(0, 9))) for _ in range(60)]
    taken, rows = [], [(set(h.tolist()), toxicity.EXPLAINED) for h in held]
    while True:
        times = np.bincount([i for h, _ in rows for i in h], minlength=30)
        if times[best := int(times.argmax())] < 3:
            break
        taken.append(best)
        rows = [(h - {best}, left - (best in h)) for h, left in rows if left > (best in h)]
    assert toxicity.cover(held, 30, 3) == taken and len(taken) > 3
    assert toxicity.cover([], 0, 3) == []


def test_toxic_features():
    (block,) = blocks(pa.array(["You are an IDIOT!", "1d1ot b4d", "calm text", "", None, "an idiot " + "x " * 20 + "you"]))
    values = pd.DataFrame(toxicity.Features(["bad"])(block), columns=toxicity.FEATURES)
    assert values.insults_any.tolist() == [1, 0, 0, 0, 0, 1]
    assert values.undone[1] > 0 and values.odd_words[1] == 1
    assert values.near[0] > 0 and values.near[5] == 0
    assert (values.iloc[3:5].to_numpy() == 0).all()


def plain_features(text, learned, insults):
    """Each feature of one text by a loop over its words."""
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    letters = r"(?:[a-z]|[^\x00-\x7f])+"
    words, spaced = re.findall(letters, low), re.findall(r"[^\x20\x09-\x0d]+", text)
    undo = str.maketrans("0134578@$", "oieastbas")
    undone = [w for w in re.findall(letters, low.translate(undo))]
    bad, own = [w in insults for w in words], [w in learned for w in words]
    you = [w in toxicity.ADDRESS for w in words]
    near = sum((bad[i] or own[i]) and any(you[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i in range(len(words)))
    n, m, size = max(len(words), 1), max(len(spaced), 1), max(len(text.encode()), 1)
    count = lambda s, chars: sum(c in chars for c in s)
    inside = lambda w: len([b for b in w.encode() if chr(b).isascii() and chr(b).isalpha() or b >= 128])
    upper = lambda w: sum("A" <= c <= "Z" for c in w)
    odd = "0123456789@$*#!"
    return [
        sum(bad) / n, min(sum(bad), 3), sum(own) / n, min(sum(own), 3), max(sum(w in insults for w in undone) - sum(bad), 0) / n,
        near / n, sum(you) / n, upper(text) / size, sum(upper(w) > 1 and 2 * upper(w) > inside(w) for w in spaced) / m,
        count(text, "!?.,;:*#%&$@") / size, text.count("!") / size,
        sum(count(w, odd) > (w[-1] in odd) and inside(w) > 1 for w in spaced) / m, np.log1p(len(spaced)), len(text.encode()) / m,
    ]


def hostile_texts():
    rng = np.random.default_rng(4)
    pieces = ["you", "IDIOT", "id1ot", "moron", "grumpf", "Grumpf!", "du", "a", "$tupid", "ÉTÉ", "été", "x9", "!!!", "the", "tree", "SCUM.", "12", "*", "\n", "日本"]
    return [" ".join(rng.choice(pieces, size=n)) for n in (1, 2, 3, 5, 8, 13, 40, 200) for _ in range(6)] + ["", " \n", "!" * 50, "you" * 90_000]


def test_features_equal_a_plain_loop():
    texts = hostile_texts()
    features = toxicity.Features(["grumpf", "été"])
    got = np.concatenate([features(block) for block in blocks(pa.array(texts), size=3000)])
    want = np.array([plain_features(t, {"grumpf", "été"}, set(toxicity.INSULTS)) for t in texts])
    assert got.shape == want.shape
    for at, name in enumerate(toxicity.FEATURES):
        assert got[:, at] == pytest.approx(want[:, at], abs=1e-12), name


def test_scores_equal_plain_features_trees_and_calibration(spark):
    """Whole scores from a plain loop over texts, the trees that are fitted on it, and linear steps between pools."""
    rng = np.random.default_rng(5)
    texts = [t for t in hostile_texts() if t.strip()] + [" ".join(rng.choice(["you", "tree", "idiot", "house", "moron"], size=12)) for _ in range(120)]
    labels = [int("idiot" in t.lower() or "moron" in t) for t in texts]
    docs = with_clashes(table(spark, texts + [None])).repartition(4)
    training = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, training).collect()}
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(zip(texts, labels, strict=True))], "doc_id long, text string, label int")
    learned, insults = toxicity.learn_words(rows)
    values = np.array([plain_features(t, set(learned), set(insults)) for t in [*texts, ""]])
    part = np.array([r.p for r in rows.orderBy("doc_id").select(F.pmod(F.xxhash64("doc_id"), F.lit(toxicity.PARTS)).alias("p")).collect()])
    trees, (places, heights) = toxicity._fit(values[:-1], np.array(labels, float), part)
    for at, row in enumerate(values):
        margin = trees.margins(row[None, :])[0]
        if margin <= places[0] or margin >= places[-1]:
            want = heights[0] if margin <= places[0] else heights[-1]
        else:
            after = int(np.searchsorted(places, margin, "right"))
            share = (margin - places[after - 1]) / (places[after] - places[after - 1])
            want = heights[after - 1] + share * (heights[after] - heights[after - 1])
        assert got[at if at < len(texts) else len(texts)] == pytest.approx(want, abs=1e-9)


def test_repeated_ids_teach_with_one_text(spark):
    """The sample is the same however the rows lie, and has one text of each id."""
    from tidemark.llm.learning import one_text

    docs = table(spark, ["b", "a", "c", "a", "d"], [1, 1, 1, 2, 3]).select("doc_id", "text")
    first = sorted(map(tuple, one_text(docs).collect()))
    assert first == sorted(map(tuple, one_text(docs.orderBy(F.desc("text")).repartition(3)).collect())) and [r[0] for r in first] == [1, 2, 3]
