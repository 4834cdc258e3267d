import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tierflow.llm import variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(counts):
    """{word: (form, root, n, n_near, form_n)} by comparing all words."""
    listed = sorted(counts)
    best, many = {}, Counter()
    for w in listed:
        others = [x for x in listed if near(w, x)]
        many[w] = len(others)
        if others:
            best[w] = min(others, key=lambda x: (-counts[x], x))
    form = {w: best[w] if w in best and counts[best[w]] >= 2 * counts[w] else None for w in listed}
    out = {}
    for w in listed:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], many[w], counts[form[w]] if form[w] else None)
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def counted(spark, tmp_dir, counts):
    spark.createDataFrame(sorted(counts.items()), "word string, n long").write.mode("overwrite").parquet(f"{tmp_dir}/words")
    return spark.read.parquet(f"{tmp_dir}/words")


def made(n, seed=3):
    rnd = random.Random(seed)
    out = Counter()
    while len(out) < n:
        w = "".join(rnd.choice(["th", "er", "an", "é", "ï", "Ø", "s", "in"]) for _ in range(rnd.randint(3, 5)))
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + "e" + w[i:], w[:i] + "a" + w[i + 1:]])
        out[w] = rnd.choice([1, 2, 2, 4, 9, 30])
    return out


def test_box_search_reaches_every_row_in_range():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 4, size=(900, variants.DIMS)).astype(np.int16)
    rows[:, 6:] = 0
    for tight in (True, False):
        tree = variants.Tree(rows.copy(), 8, tight)
        leaf_of = np.empty(len(rows), np.int64)
        for node in np.flatnonzero(tree.dim < 0):
            leaf_of[tree.order[tree.first[node]:tree.first[node] + tree.size[node]]] = node
        assert (tree.home(rows) == leaf_of).all()
        for more, less in ((1, 1), (1, 0)):
            got = set(zip(*(x.tolist() for x in tree.reached(rows, more, less))))
            apart = rows[None, :, :].astype(int) - rows[:, None, :]
            want = (np.maximum(apart, 0).sum(2) <= more) & (np.maximum(-apart, 0).sum(2) <= less)
            assert all((i, leaf_of[j]) in got for i, j in zip(*np.nonzero(want)))
            if tight:
                assert len(got) < len(rows) * (tree.dim < 0).sum() / 3  # boxes are left out


@pytest.mark.parametrize("step", [variants.PAIR_CHARS, 40])
def test_cell_equals_brute_force_in_small_parts(step, monkeypatch):
    monkeypatch.setattr(variants, "PAIR_CHARS", step)
    listed = sorted(w for w in made(1200) if len(w) == 8)
    shorter = sorted(w for w in made(1200) if len(w) == 7)
    cell = variants.Cell(listed, [1] * len(listed))
    for asked in (listed, shorter):
        got = sorted((q, w) for a, b in cell.pairs(variants.letters(asked, len(asked[0]))) for q, w in zip(a.tolist(), b.tolist()))
        assert got == [(i, j) for i, a in enumerate(asked) for j, b in enumerate(listed) if a != b and near(a, b)]


def test_equals_brute_force(spark, tmp_dir):
    counts = made(900)
    assert result(variants.variants(counted(spark, tmp_dir, counts))) == expected(counts)


def test_small_cells_and_chunks_lose_nothing(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(variants, "CELL_WORDS", 20)
    rnd = random.Random(1)
    counts = made(500, seed=9)
    for _ in range(150):  # anagrams cannot be parted by any cut
        w = "".join(rnd.sample("abcdefgh", 8))
        counts[w] = 5
        counts[w.replace("a", "z")] = 11
    assert result(variants.variants(counted(spark, tmp_dir, counts))) == expected(counts)


def test_sample_does_not_change_results(spark, tmp_dir, monkeypatch):
    counts = made(300, seed=4)
    monkeypatch.setattr(variants, "SAMPLE_WORDS", 30)
    monkeypatch.setattr(variants, "CELL_WORDS", 25)
    assert result(variants.variants(counted(spark, tmp_dir, counts))) == expected(counts)


def test_very_long_words(spark, tmp_dir):
    long = "abcdefghij" * 40_000
    counts = {long: 3, long[:7] + long[8:]: 4, long[:-1] + "k": 9, "short": 2}
    got = result(variants.variants(counted(spark, tmp_dir, counts)))
    assert got[long] == (long[:-1] + "k", long[:-1] + "k", 3, 2, 9)
    assert got["short"] == (None, "short", 2, 0, None)
    assert got[long[:7] + long[8:]][3] == 1


def test_query_on_documents(spark, parquet_dir):
    rnd = random.Random(2)
    vocabulary = ["sample", "simple", "Sample", "ÉCOLE", "école", "ÉCOLe", "colour", "color", "colours", "tiny", "abc"]
    docs = [(i, " ".join(rnd.choice(vocabulary) for _ in range(60)) + " x1y2colour_color", "en") for i in range(60)]
    docs += [docs[3], (None, "sample sample sample", "en"), (900, None, "en"), (901, "", "en")]
    folder = parquet_dir(documents=spark.createDataFrame(docs, "doc_id long, text string, word string"))
    counts = Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text, _ in docs:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                w = run.translate(low)
                h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
                counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
            run = ""
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert result(variants.op12_spelling_variants(spark, folder)) == expected(counts)


def test_empty_table(spark, parquet_dir):
    folder = parquet_dir(documents=spark.createDataFrame([], "doc_id long, text string"))
    assert variants.op12_spelling_variants(spark, folder).collect() == []
