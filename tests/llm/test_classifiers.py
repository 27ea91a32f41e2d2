import random

import pytest
from pyspark.sql import functions as F

from sheafline.llm.language import fit_languages, identify, letter_grams
from sheafline.llm.quality import fit_quality, score_quality
from sheafline.llm.toxicity import fit_toxicity, score_toxicity

SYLLABLES = {"aa": "ba be bi bo bu".split(), "bb": "kra kre kri kro kru".split(),
             "cc": "zla zlo zlu zli zle".split()}


def prose(rng, lang, n):
    word = lambda: "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))
    return " ".join(word() for _ in range(n))


def odd_texts():
    return [None, "", " \n ", "12 34 !!", "x", "bab " * 40_000]


def test_language(spark):
    rng = random.Random(4)
    rows = [(prose(rng, lang, rng.randint(3, 60)), lang) for lang in SYLLABLES for _ in range(60)]
    rows += [(None, "aa"), ("", "bb"), ("baba", None), ("12", "cc")] + rows[:20]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    new = [(i, prose(rng, lang, 12), lang) for i, lang in enumerate(list(SYLLABLES) * 30)]
    docs = spark.createDataFrame(new, "doc_id long, text string, score string")
    got = identify(docs, model, ["doc_id"]).collect()
    assert [r.lang_pred for r in sorted(got)] == [lang for _, _, lang in new]
    assert not any(r.rejected for r in got) and all(0 < r.score <= 1 for r in got)


def test_language_edges(spark):
    rows = [("baba bebe bubu", "aa"), ("kra kre kri", "bb")]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    docs = spark.createDataFrame([(t,) for t in [*odd_texts(), "жжж"]], "text string")
    got = [tuple(r)[1:] for r in identify(docs, model, ["text"]).collect()]
    assert got[:4] == [("und", 0.0, True)] * 4
    assert got[4][0] in ("aa", "bb") and got[5][0] == "aa" and got[6][2]
    empty = fit_languages(spark.createDataFrame([], "text string, lang string"))
    assert identify(docs, empty, ["text"]).first().lang_pred == "und"
    assert identify(docs.limit(0), model, ["text"]).collect() == []


def test_unlearned_languages_are_rejected(spark):
    rng = random.Random(8)
    rows = [(prose(rng, lang, rng.randint(4, 120)), lang) for lang in ("aa", "bb") for _ in range(300)]
    rows += [("qq ww " * 20, "aa"), ("yy " * 40, "bb")]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.owner) >= 4 and len(model.languages) == 2
    letters = lambda n: " ".join("".join(rng.choice("cdfghjmnpqstvwxyz") for _ in range(5)) for _ in range(n))
    texts = [(prose(rng, lang, n), True) for lang in ("aa", "bb") for n in (4, 8, 60) for _ in range(40)]
    texts += [(prose(rng, "cc", n), False) for n in (30, 90) for _ in range(20)]
    texts += [(letters(40), False) for _ in range(20)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in identify(docs, model, ["doc_id"]).collect()}
    kept = [i for i, (_, known) in enumerate(texts) if known]
    assert sum(got[i].rejected for i in kept) <= 1
    assert all(got[i].rejected for i, (_, known) in enumerate(texts) if not known)


def test_language_equals_all_cosines(spark):
    import numpy as np
    rng = random.Random(9)
    rows = [(prose(rng, lang, rng.randint(4, 50)), lang) for lang in SYLLABLES for _ in range(40)]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    docs = [(i, prose(rng, lang, 9)) for i, lang in enumerate([*SYLLABLES] * 10)]
    got = identify(spark.createDataFrame(docs, "doc_id long, text string"), model, ["doc_id"]).collect()
    for r in got:
        dense = np.zeros(len(model.weights))
        buckets, counts = letter_grams(docs[r.doc_id][1])
        dense[buckets] = np.log1p(counts) * model.weights[buckets]
        cosines = dense @ model.centroids / np.linalg.norm(dense)
        assert r.lang_pred == model.languages[model.owner[cosines.argmax()]]
        assert abs(r.score - cosines.max()) < 1e-5


def test_kept_columns_named_like_new_ones(spark):
    rows = spark.createDataFrame([("ba be", "aa", 1), ("kra kre", "bb", 0)], "text string, lang string, y int")
    docs = spark.createDataFrame([(1, "ba bi", "old", 7)], "doc_id long, text string, score string, rejected int")
    got = identify(docs, fit_languages(rows), ["doc_id", "score", "rejected"])
    assert got.columns == ["doc_id", "lang_pred", "score", "rejected"] and got.first().lang_pred == "aa"
    for fit, score, label in ((fit_quality, score_quality, "quality"), (fit_toxicity, score_toxicity, "toxic")):
        model = fit(rows.select("text", F.col("y").alias(label)))
        got = score(docs, model, ["score", "doc_id"])
        assert got.columns == ["doc_id", "score"] and 0 <= got.first().score <= 1


def test_language_grams_do_not_depend_on_runs():
    rng = random.Random(1)
    text = prose(rng, "bb", 20_000)
    import numpy as np
    from sheafline.llm import language
    whole = np.zeros(language.DIMENSIONS, int)
    codes = f" {text} "
    buckets, counts = letter_grams(text)
    whole[buckets] = counts
    assert whole.sum() == 3 * len(codes) - 3


def test_toxicity(spark):
    rng = random.Random(5)

    def text(bad):
        words = prose(rng, "aa", rng.randint(2, 80)).split()
        if bad:
            words.insert(rng.randint(0, len(words)), "grumf" + prose(rng, "aa", 1))
        return " ".join(words)
    rows = [(text(i % 2), i % 2) for i in range(400)] + [(None, 1), ("x", None)]
    model = fit_toxicity(spark.createDataFrame(rows, "text string, toxic int"))
    new = [(i, text(i % 2), "s") for i in range(200)]
    got = score_toxicity(spark.createDataFrame(new, "doc_id long, text string, score string"),
                         model, ["doc_id"]).collect()
    right = sum((r.score >= 0.7) == bool(r.doc_id % 2) for r in got)
    assert right >= 190


@pytest.mark.parametrize("rows", [[], [("only this", 1)], [("a b", 0), ("c", 1)]])
def test_toxicity_edges(spark, rows):
    model = fit_toxicity(spark.createDataFrame(rows, "text string, toxic int"))
    docs = spark.createDataFrame([(t,) for t in odd_texts()], "text string")
    got = score_toxicity(docs, model, ["text"]).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert score_toxicity(docs.limit(0), model, ["text"]).collect() == []


def test_quality(spark):
    rng = random.Random(6)

    def text(good):
        words = prose(rng, "bb", rng.randint(20, 80)).split()
        if not good:
            words = [w + "##" for w in words] if rng.random() < 0.5 else words[:2] * 30
        return " ".join(words)
    rows = [(text(i % 3), int(i % 3 > 0)) for i in range(450)] + [(None, 1), ("x", None)]
    model = fit_quality(spark.createDataFrame(rows, "text string, quality int"))
    new = [(i, text(i % 3), "s") for i in range(150)]
    got = score_quality(spark.createDataFrame(new, "doc_id long, text string, score string"),
                        model, ["doc_id"]).collect()
    assert sum((r.score >= 0.3) == bool(r.doc_id % 3) for r in got) >= 147


@pytest.mark.parametrize("rows", [[], [("only this", 1)], [("a b", 0), ("c", 1), ("", 0)]])
def test_quality_edges(spark, rows):
    model = fit_quality(spark.createDataFrame(rows, "text string, quality int"))
    docs = spark.createDataFrame([(t,) for t in odd_texts()], "text string")
    got = score_quality(docs, model, ["text"]).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert score_quality(docs.limit(0), model, ["text"]).collect() == []


def test_quality_votes_equal_all_neighbours(spark):
    import numpy as np
    from sheafline.llm.quality import NEIGHBOURS
    rng = random.Random(10)
    text = lambda good: prose(rng, "bb" if good else "cc", rng.randint(5, 40))
    model = fit_quality(spark.createDataFrame([(text(i % 2), i % 2) for i in range(120)], "text string, quality int"))
    docs = [(i, text(rng.random() < 0.5) + " " + text(rng.random() < 0.5)) for i in range(40)]
    got = score_quality(spark.createDataFrame(docs, "doc_id long, text string"), model, ["doc_id"]).collect()
    for r in got:
        vector = np.zeros(len(model.weights))
        buckets, values = model.tfidf(docs[r.doc_id][1])
        vector[buckets] = values
        latent = vector @ model.projection
        cosines = [float(latent @ v / np.linalg.norm(latent)) for v in model.vectors]
        best = sorted(range(len(cosines)), key=lambda i: -cosines[i])[:NEIGHBOURS]
        votes = [max(cosines[i], 1e-6) ** 4 for i in best]
        expected = sum(v for v, i in zip(votes, best) if model.labels[i] == 1) / sum(votes)
        assert abs(r.score - expected) < 1e-3


def test_toxicity_equals_the_worst_window(spark):
    import math
    from sheafline.llm.toxicity import WINDOW, word_grams, words_of
    rng = random.Random(11)
    text = lambda bad: prose(rng, "aa", 9) + (" grumfo " if bad else " ") + prose(rng, "aa", 9)
    model = fit_toxicity(spark.createDataFrame([(text(i % 2), i % 2) for i in range(200)], "text string, toxic int"))
    docs = [(i, text(i % 2) if i else "ba") for i in range(30)]
    got = score_toxicity(spark.createDataFrame(docs, "doc_id long, text string"), model, ["doc_id"]).collect()
    for r in got:
        values = []
        for word in words_of(docs[r.doc_id][1]):
            grams, _ = word_grams([word])
            values.append(sum(model.weights[g] for g in grams) / len(grams))
        width = min(WINDOW, len(values))
        worst = max(sum(values[i:i + width]) / width for i in range(len(values) - width + 1))
        assert abs(r.score - 1 / (1 + math.exp(-max(-40, min(40, worst + model.bias))))) < 1e-9
