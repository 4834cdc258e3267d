import random
import zlib

import pytest

from tierflow.llm import quality, toxicity


def corpus(spark, n=400):
    rng = random.Random(2)
    syllables = ["ba", "ro", "ti", "len", "mos", "ka", "du"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(8, 60))]
        toxic, junk = i % 5 == 1, i % 7 == 2
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zogvile", "qwexnasty"]))
        text = " ".join(w + "$$$" if junk else w for w in words)
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(not junk), int(toxic)))
    extra = [(n, None, "en", "s", 0), (n + 1, "", "en", "s", 0), (n + 2, "zogvile " * 30000, "en", "s", 0)]
    return (spark.createDataFrame(docs + extra, "doc_id long, text string, lang string, score string, held_out long"),
            spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("module,column", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy_and_edge_rows(spark, module, column):
    docs, labels = corpus(spark)
    got = {r.doc_id: r for r in module.predictions(docs, labels).collect()}
    assert len(got) == 403
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    known = {r.doc_id: r[column] for r in labels.filter(f"{column} is not null and doc_id is not null").collect()}
    held = [i for i in known if got[i].held_out]
    assert sum(got[i].predicted == known[i] for i in held) >= 0.95 * len(held)
    assert got[400].score == got[401].score
    if module is toxicity:
        assert got[402].predicted == 1 and got[400].predicted == 0


@pytest.mark.parametrize("module", [toxicity, quality])
def test_no_labels_and_no_documents(spark, module):
    docs, labels = corpus(spark, 20)
    assert {r.predicted for r in module.predictions(docs, labels.limit(0)).collect()} == {0}
    assert module.predictions(docs.limit(0), labels).count() == 0


def test_without_toxic_keeps_columns_and_clean_rows(spark):
    docs, labels = corpus(spark)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.schema.names == docs.schema.names
    ids = {r.doc_id for r in kept.collect()}
    toxic = {r.doc_id for r in labels.filter("toxic = 1 and doc_id is not null").collect()}
    assert not ids & toxic and len(ids) >= 403 - len(toxic) - 2


def test_prior_is_estimated(spark):
    docs, labels = corpus(spark)
    rows = quality.staged(quality.feature_table(docs).join(labels.filter("quality = 1").select("doc_id"), "doc_id", "left")
                          .selectExpr("x", "doc_id % 2 = 0 and doc_id % 7 != 2 as trusted"), "t")
    assert abs(quality.fit(rows).prior - 6 / 7) < 0.08


def test_quality_of_one_long_token_null_ids_and_repeated_rows(spark):
    docs, labels = corpus(spark)
    plain = {r.doc_id: r.predicted for r in quality.predictions(docs, labels).collect()}
    more = docs.limit(0).unionByName(spark.createDataFrame(
        [(9001, "x" * 2_000_000, "en", "s", 0), (None, "ba ro ti len", "en", "s", 0), (None, None, "en", "s", 0)], docs.schema))
    got = quality.predictions(docs.unionByName(more).unionByName(docs.filter("doc_id = 4")), labels).collect()
    assert len(got) == 407 and sum(r.doc_id == 4 for r in got) == 2 and sum(r.doc_id is None for r in got) == 2
    assert len({r.score for r in got if r.doc_id == 4}) == 1 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.predicted != plain[r.doc_id] for r in got if r.doc_id in plain) <= 4


def test_class_counts_equal_brute_force(spark):
    from collections import Counter

    texts = ["abcabc", "ABC abd", "", None, "xyabc", "abcabc", "\tabc  d", "日本語日本"]
    rows = spark.createDataFrame([(i, t, i % 2, 2.0 if i % 2 else 1.0) for i, t in enumerate(texts)], "doc_id long, text string, label int, weight double")
    want = {}
    for i, t in enumerate(texts):
        t = (t or "").lower().replace("\t", " ")
        for gram in {t[k:k + n] for n in toxicity.ORDERS for k in range(len(t) - n + 1)}:
            want.setdefault(gram, [0, 0])[1 - i % 2] += 2.0 if i % 2 else 1.0
    got = toxicity.class_counts(rows.repartition(3)).collect()
    assert Counter((r.pos, r.neg) for r in got) == Counter(map(tuple, want.values()))
    for gram in ("abc", "日本語", " abc"):
        key = int(toxicity.ngrams([gram])[0][-1 if len(gram) > 3 else 0])
        assert [[r.pos, r.neg] for r in got if r.gram == key] == [want[gram]]


def test_repeated_documents_and_null_ids_of_toxicity(spark):
    docs, labels = corpus(spark)
    more = spark.createDataFrame([(None, "zogvile qwexnasty zogvile", "en", "s", 0), (None, None, "en", "s", 0)], docs.schema)
    got = toxicity.predictions(docs.unionByName(more).unionByName(docs.filter("doc_id in (1, 2)")), labels).collect()
    assert len(got) == 407 and all(len({r.score for r in got if r.doc_id == i}) == 1 for i in (1, 2))
    assert sorted(r.predicted for r in got if r.doc_id is None) == [0, 1]
