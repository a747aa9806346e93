import random

import numpy as np
import pytest

from footfall.llm import language
from footfall.llm.language import Centroids, fit_rows, identify, learn

WORDS = {"de": "der die das und nicht keit schön über lich ung".split(),
         "fr": "le la les et être où ment tion eau aux".split(),
         "en": "the and of with this that ing ness ould is".split()}


def text(lang, n):
    return " ".join(random.choices(WORDS[lang], k=n))


@pytest.fixture(scope="module")
def model(spark):
    random.seed(4)
    rows = [(i, text(lang, random.randint(5, 80)), lang) for i, lang in enumerate(list(WORDS) * 120)]
    rows += [(900, None, "de"), (901, "", "fr"), (902, "12", "en"), (903, "etwas", None)]
    return learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_held_out_accuracy(spark, model):
    random.seed(9)
    rows = [(i, text(lang, random.randint(3, 60)), lang) for i, lang in enumerate(list(WORDS) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify(docs, model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in got) and not any(r.rejected for r in got)
    assert sorted(set(model.langs)) == ["de", "en", "fr"] and len(model.langs) > 3
    assert np.allclose(np.linalg.norm(model.vectors, axis=1), 1, atol=1e-5)


def test_undetermined_rejected_long_and_repeated(spark, model):
    texts = [None, "", "12 !", "Привет как дела друзья", "the " * 60_000, "die", "die"]
    docs = spark.createDataFrame([(t, 1, "x") for t in texts], "text string, _text int, score string")
    out = identify(docs, model)
    assert out.columns == ["text", "_text", "lang_pred", "score", "rejected"]
    got = out.collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and all(r.rejected for r in got[:4])
    assert got[4].lang_pred == "en" and not got[4].rejected
    assert got[5] == got[6] and got[5].lang_pred == "de"
    assert identify(docs.limit(0), model).count() == 0


def test_ties_go_to_the_first_name_and_no_model_to_und(spark, model):
    twin = Centroids(["aa", "bb"], np.vstack([model.vectors[0]] * 2), model.idf, 0.0)
    docs = spark.createDataFrame([("der die das",)], "text string")
    assert identify(docs, twin).first().lang_pred == "aa"
    none = learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    row = identify(docs, none).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)


def test_unlearned_languages_and_random_letters_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = learn(docs.where("doc_id % 2 = 0"))
    random.seed(3)
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
        "Bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar",
    ]
    foreign += [" ".join(f.split() * 10) for f in foreign]
    foreign += ["".join(random.choices("abcdefghijklmnopqrstuvwxyz    ", k=n)) for n in (150, 600, 5000)]
    judged = identify(spark.createDataFrame([(f,) for f in foreign], "text string"), model).collect()
    assert [r.text[:20] for r in judged if not r.rejected] == []
    clean = identify(docs.where("doc_id % 2 = 1"), model, keep=["text"])
    assert clean.where("rejected").count() <= 0.01 * clean.count()
    short = docs.where("doc_id % 2 = 1").selectExpr("substring_index(text, ' ', 8) AS text")
    assert identify(short, model).where("rejected").count() <= 0.02 * short.count()


def plain_vector(text, idf):
    """Counts of n-grams by a loop over characters, weighted and of length 1."""
    chars, letters = [" "], "".join(c if c.isalpha() else " " for c in text.lower())
    chars = " " + " ".join(letters.split()) + " " if letters.split() else " "
    counts = np.zeros(language.DIMENSIONS)
    for n in language.ORDERS:
        for at in range(len(chars) - n + 1):
            key = n
            for char in chars[at:at + n]:
                key = (key * 0x100000001B3 + ord(char)) % 2**64
            counts[key * 0x9E3779B97F4A7C15 % 2**64 >> 52] += 1
    vector = np.log1p(counts) * idf
    return vector / max(np.linalg.norm(vector), 1e-12)


def test_vectors_and_nearest_centroids_equal_plain_loops(spark, model):
    random.seed(6)
    texts = [text(random.choice(list(WORDS)), random.randint(1, 30)) for _ in range(40)] + ["a1b  c,é", "ŒUVRE x"]
    got = identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    for row in got:
        vector = plain_vector(row.text, model.idf)
        cosines = model.vectors.astype(float) @ vector
        assert row.lang_pred == model.langs[int(np.argmax(cosines))]
        assert row.score == pytest.approx(min(max(cosines.max(), 0), 1), abs=1e-4)


def test_clusters_equal_a_plain_loop():
    rng = np.random.default_rng(2)
    own = rng.random((60, 8))
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    unit = lambda v: [x / sum(y * y for y in v) ** 0.5 for x in v]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    centers = [unit([sum(column) / len(own) for column in own.T])]
    for _ in range(2):
        near = [max(dot(v, c) for c in centers) for v in own]
        centers.append(list(own[near.index(min(near))]))
    for _ in range(language.STEPS):
        nearest = [max(range(3), key=lambda i, v=v: dot(v, centers[i])) for v in own]
        centers = [unit([sum(v[d] for v, m in zip(own, nearest) if m == i) for d in range(8)])
                   if i in nearest else centers[i] for i in range(3)]
    assert np.allclose(language._cluster(own, 3), centers, atol=1e-6)


def test_fitted_rows_are_bounded_whatever_repeats(spark):
    rows = [(1, "same text", "de")] * 500 + [(None, f"text {i}", "de") for i in range(300)]
    rows += [(i, "x y", f"l{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = fit_rows(docs, "text", "lang", "doc_id", 40).groupBy("lang").count().collect()
    assert len(found) == 31 and all(r["count"] == 1 for r in found)  # 40 // 31 a language
    again = [fit_rows(docs.repartition(n), "text", "lang", "doc_id", 310).collect() for n in (2, 5)]
    assert sorted(map(repr, again[0])) == sorted(map(repr, again[1])) and len(again[0]) <= 310


def test_query_gives_no_null_for_a_missing_id(spark, tmp_path):
    from footfall.llm.queries import QUERIES

    random.seed(8)
    rows = [(None if i % 7 == 0 else i, text(lang, 30), lang, "s", 1) for i, lang in enumerate(list(WORDS) * 30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    out = QUERIES["op8_language"](spark, str(tmp_path))
    assert out.where("held_out IS NULL").count() == 0 and out.where("doc_id IS NULL AND NOT held_out").count() == 13
