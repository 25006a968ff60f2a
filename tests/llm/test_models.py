"""Language identification, quality rules and the quality classifier."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tarmac.llm import langid, quality, rules

SF = "/root/testdata/sf0.01"
KINDS = {"en": ["the", "and", "thing", "with", "over"], "de": ["der", "schön", "ungeheuer", "ich", "keit"], "fr": ["le", "oiseau", "été", "que", "dans"]}


def held(doc_id, by, rest):
    return zlib.crc32(str(doc_id).encode()) % by == rest


def words(draw, lang, n):
    return " ".join(draw.choices(KINDS[lang], k=n))


@pytest.fixture(scope="module")
def languages(spark):
    draw = random.Random(2)
    rows = [(i, words(draw, lang, draw.randint(3, 40)), lang) for i, lang in enumerate(draw.choices(list(KINDS), k=300))]
    rows += [(1000, None, "en"), (1001, "12 -- 34", "de"), (1002, "der schön", None), (1003, "", "fr"), (None, "the thing and", "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_held_out_rows(languages):
    model = langid.train(languages)
    assert model.languages == ["de", "en", "fr"]
    rows = langid.identify(languages, model, ["doc_id", "lang"]).collect()
    assert len(rows) == 305
    told = {r.doc_id: r for r in rows}
    assert all(r.lang_pred == r.lang for r in rows if r.doc_id is not None and r.doc_id < 1000 and held(r.doc_id, 4, 2))
    assert [(told[i].lang_pred, told[i].score) for i in (1000, 1001, 1003)] == [("und", 0.0)] * 3
    assert told[1002].lang_pred == "de" and all(0 <= r.score <= 1 for r in rows)


def test_every_language_is_learned(spark):
    rows = [(1000 * n + i, f"{chr(0x4E00 + n)}{chr(0x3400 + n)} " * 4, f"l{n:03}") for n in range(250) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert len(model.languages) == 250
    told = langid.identify(docs, model, ["doc_id", "lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in told) > 0.95 * len(told)


def test_held_out_rows_teach_nothing(spark, languages):
    from pyspark.sql import functions as F

    wrong = languages.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    a, b = langid.train(languages), langid.train(wrong)
    assert a.languages == b.languages and np.allclose(a.weights, b.weights) and a.temperature == b.temperature


def test_language_counts_do_not_depend_on_slices(monkeypatch):
    text = "Ab  c1d, é Straße -- x" * 9
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "TEXT_AT_ONCE", 10)
    assert (langid.counts(text) == whole).all()


def test_elastic_net_leaves_weights_at_zero_and_temperature_calibrates():
    rows = [(np.array([i % 2, 5]), np.array([0.8, 0.6]), i % 2) for i in range(200)]
    weights, _ = langid.fit_ftrl(rows, 2)
    assert (weights != 0).sum() <= 6 and weights[0, 0] > 0 > weights[1, 0]
    logits = np.array([[4.0, 0.0]] * 100)
    labels = np.array([0] * 75 + [1] * 25)
    t = langid.fit_temperature(logits, labels)
    assert abs(1 / (1 + np.exp(-4 / t)) - 0.75) < 0.01


def test_no_training_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.train(empty)
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert langid.identify(empty, model, ["doc_id"]).count() == 0
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, model, ["doc_id"]).collect()] == [("und", 0.0)]


def test_stage_keeps_what_has_a_language(languages, cluttered):
    docs = cluttered(languages)
    out = langid.keep_identified(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in out.collect()} == {1000, 1001, 1003}


def plain_repeated(tokens, n=8):
    runs = Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))
    return len({j for i in range(len(tokens) - n + 1) if runs[tuple(tokens[i : i + n])] > 1 for j in range(i, i + n)})


def test_repeated_words_equal_brute_force():
    draw = random.Random(6)
    for size in (1, 2, 3, 50):
        for _ in range(40):
            tokens = [b"%d" % draw.randrange(size) for _ in range(draw.randint(0, 60))]
            assert rules.repeated_words(tokens) == plain_repeated(tokens)


def test_statistics_by_hand():
    text = "a# b c\n  \na# b c\n\na# b c\x0bd"
    assert rules.statistics(text)[0] == [7, 16, 3, 1, 0]
    assert rules.statistics(None)[0] == [0] * 5


def test_score_is_high_for_what_few_splits_part():
    rng = np.random.default_rng(1)
    forest = rules.grow(np.concatenate([np.zeros((400, 2)), rng.uniform(1, 2, (8, 2))]))
    inner, outer = forest.score(np.array([[0.0, 0.0], [1.9, 1.9]]))
    assert inner < 0.5 < outer


@pytest.fixture(scope="module")
def judged(spark):
    draw = random.Random(9)
    good = [(i, " ".join(f"word{draw.randrange(5000)}" for _ in range(draw.randint(30, 200)))) for i in range(300)]
    junk = [(1000 + i, " ".join(f"w{draw.randrange(5000)}***" for _ in range(60))) for i in range(40)]
    docs = [*good, *junk, (2000, None), (2001, ""), (2002, "few words"), (2003, "one two three four five six seven eight " * 9), (None, good[0][1]), (5, good[5][1])]
    labels = [(i, 1) for i, _ in good[::2]] + [(i, 0) for i, _ in junk[::2]] + [(4, 0), (4, 1), (None, 0), (6, None)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_keep_good_and_reject_junk(judged, cluttered):
    docs, labels = judged
    rows = rules.judge(docs, rules.train(docs, labels), ["doc_id"]).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert sum(kept[i] for i in range(300)) >= 295 and not any(kept[1000 + i] for i in range(40))
    assert not any(kept[i] for i in (2000, 2001, 2002, 2003)) and kept[None]
    assert {r.doc_id for r in rows if r.base_failed} == {2000, 2001, 2002, 2003}
    out = rules.keep_good(cluttered(docs), labels)
    assert out.columns == cluttered(docs).columns and out.count() == sum(r.kept for r in rows)


def test_rules_without_labels_are_the_base_rules(judged, spark):
    docs, labels = judged
    rows = rules.judge(docs, rules.train(docs, labels.limit(0)), ["doc_id"]).collect()
    assert all(r.kept != r.base_failed for r in rows)
    assert rules.judge(docs.limit(0), rules.train(docs.limit(0), labels), ["doc_id"]).count() == 0


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality.classify(docs, model, ["doc_id"]).collect()}
    held_out = [(scores[r.doc_id], r.quality) for r in labels.collect() if held(r.doc_id, 3, 1)]
    good, bad = [s for s, q in held_out if q == 1], [s for s, q in held_out if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.5 for s in good]) > 0.97 and np.mean([s < 0.5 for s in bad]) > 0.7


def test_quality_held_out_labels_teach_nothing(judged):
    from pyspark.sql import functions as F

    docs, labels = judged
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert np.allclose(a.scores, b.scores) and a.bias == b.bias


def test_quality_edges(judged, spark):
    docs, labels = judged
    model = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality.classify(docs, model, ["doc_id"]).collect()}
    assert scores[2000] == scores[2001] and all(0 <= s <= 1 for s in scores.values())
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.classify(docs, none, ["doc_id"]).collect()} == {0.5}
    assert quality.classify(docs.limit(0), model, ["doc_id"]).count() == 0


def test_quality_counts_of_a_long_text_are_whole(spark, monkeypatch):
    seen, fit = [], quality.fit_sgd
    monkeypatch.setattr(quality, "fit_sgd", lambda rows, *a: (seen.extend(rows), fit(rows, *a))[1])
    long = next(i for i in range(8) if not held(i, 3, 1))
    docs = spark.createDataFrame([(i, "w " * 70_000 if i == long else f"é text {i}") for i in range(8)], "doc_id long, text string")
    quality.train(docs, spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int"))
    parts = np.concatenate(list(quality.features("w " * 70_000)))
    want = np.bincount(parts, minlength=quality.BUCKETS)
    assert want.max() > 65_535
    assert any(np.allclose(share, want[at] / want.sum()) for at, share, _ in seen if len(at) == np.count_nonzero(want))


def test_quality_ngrams_are_of_characters():
    one, other = (set(np.concatenate(list(quality.features(t))).tolist()) for t in ("é", "éé"))
    assert len(one) == 1 + 1 and one != other  # " é " has one n-gram of 3 characters and one word


def test_a_step_of_the_vectors_is_the_gradient_times_the_features(monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 8)
    rows = [(np.array([1, 4]), np.array([0.25, 0.75]), 1), (np.array([2]), np.array([1.0]), 0)]
    def loss(vectors, layer, bias, row):
        at, share, label = row
        x = share @ vectors[at] @ layer + bias
        return np.log(np.exp(x).sum()) - x[label]
    start = quality.fit_sgd([], 0)[0]
    layer, bias = np.random.default_rng(1).normal(size=(quality.DIMENSION, 2)), np.zeros(2)
    for row in rows:
        at, share, label = row
        x = share @ start[at] @ layer + bias
        p = np.exp(x) / np.exp(x).sum()
        p[label] -= 1
        step = np.minimum(share * len(at), 4.0)[:, None] * (layer @ p) / len(at)
        for i, n in enumerate(at):
            for d in range(3):
                moved = start.copy()
                moved[n, d] += 1e-6
                assert abs((loss(moved, layer, bias, row) - loss(start, layer, bias, row)) / 1e-6 - step[i, d]) < 1e-4


def test_quality_features_do_not_depend_on_slices_at_blanks(monkeypatch):
    text = "some words and some words again " * 40
    whole = Counter(np.concatenate(list(quality.features(text))).tolist())
    monkeypatch.setattr(quality, "TEXT_AT_ONCE", 200)
    parts = Counter(np.concatenate(list(quality.features(text))).tolist())
    assert sum((whole - parts).values()) < 0.05 * sum(whole.values())


def test_a_repeated_id_enters_a_fit_once(spark, monkeypatch):
    draw = random.Random(4)
    own = [(i, words(draw, "en" if i % 2 else "de", 30), "en" if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame(own + [(None, words(draw, "fr", 30), "fr") for _ in range(200)] + [own[1]] * 200, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    seen = {}
    for module, name in ((langid, "fit_ftrl"), (quality, "fit_sgd")):
        fit = getattr(module, name)
        monkeypatch.setattr(module, name, lambda rows, *a, fit=fit, name=name: (seen.update({name: len(rows)}), fit(rows, *a))[1])
    grow = rules.fit
    monkeypatch.setattr(rules, "fit", lambda sample, labelled, q: (seen.update(forest=len(sample), labelled=len(labelled)), grow(sample, labelled, q))[1])
    langid.train(docs), quality.train(docs, labels), rules.train(docs, labels)
    assert seen["fit_ftrl"] <= 61 and seen["fit_sgd"] <= 60 and seen["forest"] == 61 and seen["labelled"] <= 60


def test_a_rare_kind_of_junk_is_scored_in_a_large_table(spark):
    words = "array_join(transform(sequence(1, 40), i -> concat('word', pmod(hash(id, i), 5000))), ' ')"
    docs = spark.range(12_000).selectExpr("id AS doc_id", f"{words} AS text")
    rare = " ".join(f"{c}" * 60 for c in "abcdefghijklmnopqrstuvwxyz")
    odd = spark.createDataFrame([(20_000 + i, " ".join(f"w{j}***" for j in range(30 + i))) for i in range(60)], docs.schema)
    labels = docs.selectExpr("doc_id", "1 AS quality").limit(900).union(odd.selectExpr("doc_id", "0 AS quality"))
    for doc_id in range(30_000, 30_003):
        all_docs = docs.union(odd).union(spark.createDataFrame([(doc_id, rare)], docs.schema))
        forest = rules.train(all_docs, labels)
        plain, alone = forest.anomaly(np.array([rules.statistics(t)[1] for t in (docs.first()["text"], rare)]))
        assert alone > plain + 0.01 and alone > forest.threshold


def test_limits_and_threshold_come_from_all_labelled_rows(spark):
    draw = np.random.default_rng(12)
    good, bad = np.round(draw.beta(1, 30, 9_000), 4), draw.uniform(0.05, 1, 7_000)
    rows = [(1, float(x)) for x in good] + [(0, float(x)) for x in bad]
    scored = spark.createDataFrame(rows, "quality int, anomaly double").repartition(5)
    least = np.sort(good)[len(good) - 1 - int(np.ceil(rules.GOOD_LOST * len(good)))]
    assert rules.calibrate(scored) == (least + bad[bad > least].min()) / 2
    for n in (0, 1, 17, 4_500, 8_999):
        assert rules.nth_largest(scored.filter("quality = 1"), "anomaly", n) == np.sort(good)[::-1][n]
    ratios = draw.beta(1, 30, (9_000, len(rules.RATIOS))) * (draw.random((9_000, len(rules.RATIOS))) < 0.3)
    ratios[:, 0] = 0
    limits = rules.find_limits(spark.createDataFrame([(r.tolist(),) for r in ratios], "ratios array<double>"))
    assert np.allclose(limits, rules.MARGIN * np.quantile(ratios, rules.GOOD_WITHIN, axis=0) + rules.LEEWAY, rtol=1e-12)


def test_training_reads_every_labelled_row(spark, monkeypatch):
    words = "array_join(transform(sequence(1, 25), i -> concat('word', pmod(hash(id, i), 5000))), ' ')"
    docs = spark.range(10_000).selectExpr("id AS doc_id", f"IF(id % 2 = 0, {words}, replace({words}, 'word', '***')) AS text")
    seen, limits, calibrate = {}, rules.find_limits, rules.calibrate
    monkeypatch.setattr(rules, "find_limits", lambda good: (seen.update(good=good.count()), limits(good))[1])
    monkeypatch.setattr(rules, "calibrate", lambda scored: (seen.update(scored=scored.count()), calibrate(scored))[1])
    assert np.isfinite(rules.train(docs, docs.selectExpr("doc_id", "int(1 - doc_id % 2) AS quality")).threshold)
    assert seen == {"good": 5_000, "scored": 10_000}
