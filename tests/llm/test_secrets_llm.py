import random
import re
import time

from pyspark.sql import functions as F

from footfall.llm.secrets import (
    KINDS, labelled_samples, likelihood_ratios, redacted, scan_secrets, spans_text, transition_counts,
)

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII)


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def texts():
    random.seed(5)
    parts = ["password", "Token", "api_key", "APIKEY", "=", ": ", '"', "'", " ", "AKIA", "ABCDEF0123456789",
             "abc", "0123456789abcdef", "deadbeef", "é", "🙂", "\n", "secret", "a.b", "x", "==", "ſecret"]
    made = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(400)]
    return [*made, None, "", "token=" + "a" * 50_000, "é" * 20_000 + "AKIA" + "Z" * 16]


def test_base_spans_equal_the_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    found = scan_secrets(docs, labelled_samples(docs)).select(
        "doc_id", "text", F.filter("spans", lambda s: s["kind"] < 3).alias("spans"),
        spans_text(F.filter("spans", lambda s: s["kind"] < 3)).alias("line")).collect()
    assert len(found) == len(texts())
    for row in found:
        want = brute(row.text)
        assert [(s.start, s.kind, s.end) for s in row.spans] == want
        assert row.line == ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in want)


def samples(spark):
    random.seed(1)
    hexes = ["".join(random.choices("0123456789abcdef", k=40)) for _ in range(200)]
    words = ["".join(random.choices(["tion", "ment", "ing", "er", "able", "con", "the"], k=6)) for _ in range(200)]
    return spark.createDataFrame([(h, True) for h in hexes] + [(w, False) for w in words],
                                 "value string, is_random boolean"), words


def test_markov_models_add_random_runs_only(spark):
    known, words = samples(spark)
    docs = spark.createDataFrame([
        (1, "key 7f3a9c0e1d2b4a6f8091 end"), (2, f"plain {words[0]} {words[1]}"),
        (3, "token=7f3a9c0e1d2b4a6f8091"), (4, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in scan_secrets(docs, known).withColumn(
        "clean", redacted(F.col("text"), F.col("spans"))).collect()}
    assert [(s.start, s.kind, s.end) for s in found[1].spans] == [(4, 3, 24)]
    assert found[1].clean == "key [secret] end"
    assert found[2].spans == [] and found[2].clean == docs.collect()[1].text
    assert [s.kind for s in found[3].spans] == [0] and found[3].clean == "[secret]"
    assert found[4].spans == [] and found[4].clean is None


def test_overlapping_spans_are_redacted_together(spark):
    text = 'a token = "' + "0123456789abcdef" * 2 + '" 🙂 AKIA' + "Q" * 16 + " z"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = scan_secrets(docs, labelled_samples(docs)).select(
        redacted(F.col("text"), F.col("spans")).alias("clean")).first()
    assert row.clean == 'a [secret]" 🙂 [secret] z'


def test_empty_table_repeated_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "secret: abcdef", "t", [1])] * 2,
                                 "doc_id long, text string, _text string, spans array<int>")
    out = scan_secrets(docs, labelled_samples(docs))
    assert out.columns == ["doc_id", "text", "_text", "spans"]
    assert [len(r.spans) for r in out.collect()] == [1, 1]
    none = docs.limit(0)
    assert scan_secrets(none, labelled_samples(none)).count() == 0


def free(text):
    """Runs of 16 or more that touch no base span."""
    spans = brute(text)
    return [(m.start(), m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", text or "")
            if all(m.end() <= a or b <= m.start() for a, _, b in spans)]


def test_markov_spans_equal_a_plain_loop(spark):
    random.seed(9)
    known, words = samples(spark)
    ratios = likelihood_ratios(transition_counts(known))
    hexes = "0123456789abcdef"
    parts = [*words[:20], *("".join(random.choices(hexes, k=n)) for n in (15, 16, 20, 23, 24, 40)), "AKIA" + "Q" * 20,
             "token=", "password: ", " ", " ", ".", "é", "\n"]
    made = ["".join(random.choices(parts, k=random.choice([3, 30, 300]))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: r for r in scan_secrets(docs, known).withColumn("clean", redacted(F.col("text"), F.col("spans"))).collect()}
    n_random = 0
    for i, text in enumerate(made):
        want = brute(text)
        for a, b, run in free(text):
            steps = [ratios[ord(x) * 128 + ord(y)] for x, y in zip(run, run[1:])]
            if sum(steps) / len(steps) >= 0.5:
                want.append((a, 3, b))
                n_random += 1
        assert [(s.start, s.kind, s.end) for s in got[i].spans] == sorted(want)
        clean, at = "", 0
        for a, _, b in sorted(want):
            if a >= at:
                clean += text[at:a] + "[secret]"
            at = max(at, b)
        assert got[i].clean == clean + text[at:]
    assert n_random > 8


def test_a_long_text_with_very_many_hits(spark):
    text = " ".join(f"é token={i:08d} plainidentifier{i % 10}words" for i in range(80_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    known, _ = samples(spark)
    started = time.time()
    row = scan_secrets(docs, known).withColumn("clean", redacted(F.col("text"), F.col("spans"))).first()
    seconds = time.time() - started
    assert [(s.start, s.kind, s.end) for s in row.spans] == brute(text) and len(row.spans) == 80_000
    assert row.clean == re.sub(r"token=\d+", "[secret]", text)
    assert labelled_samples(docs).where("is_random").count() == 80_000
    assert seconds < 60
