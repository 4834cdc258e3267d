import random
import re

import pytest

from tierflow.llm import neardup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, width):
    sets, part = {}, {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        k = min(width, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
        part[i] = i

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                part[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("width", [4, 5])
def test_groups_equal_brute_force(spark, docs_of, width):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", " \n\t", "One two", "one TWO", "one  two\n"]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([3, 12, 60, 200]))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(8)):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    common = " ".join(rng.choice(words) for _ in range(50))
    texts += [common + " " + " ".join(rng.choice(words) for _ in range(60)) for _ in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(docs_of(texts), width).collect()}
    assert got == brute(list(enumerate(texts)), width)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(5, "a b c d e f", 1, "x"), (5, "a b c d e f", 1, "x"), (3, "A b c d e f", 1, "x"), (None, "a b c d e f", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int, digest string")
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in neardup.groups(df).collect())
    assert got == [(-1, None, True), (3, 3, True), (5, 3, False), (5, 3, False)]
    assert neardup.groups(df.limit(0)).count() == 0


def test_parity_bits_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 500).astype(np.uint64)
    b = np.concatenate([a[:400], rng.integers(0, 2**63, 90).astype(np.uint64)])
    bits = [np.bincount((x >> np.uint64(55)).astype(int), minlength=neardup.PARITIES) & 1 for x in (a, b)]
    assert (bits[0] ^ bits[1]).sum() <= 190


@pytest.fixture(params=["8 partitions", "211 partitions"])
def partitions(spark, request):
    """The number of partitions must not matter: also with more partitions than most regions have rows."""
    changed = {} if request.param.startswith("8 ") else {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_links_inside_a_crowded_template(spark, docs_of, monkeypatch, partitions):
    # Strangers share 87 of 111 shingles (0.784), planted pairs 88 of 110 (0.8), and stand far apart.
    # Narrow windows make few documents as crowded as many thousand are under the usual ones.
    monkeypatch.setattr(neardup, "WINDOW", 4)
    monkeypatch.setattr(neardup, "WIDE_WINDOW", 16)
    template = " ".join(f"t{i}" for i in range(90))
    many, planted = 600, 100
    texts = [f"{template} " + " ".join(f"o{d}x{k}" for k in range(12)) for d in range(many)]
    for d in range(planted):
        texts[many - 1 - d] = texts[many - 1 - d].replace(f"o{many - 1 - d}x0 ", f"o{d}x0 ")
    got = {r.doc_id: r.component_id for r in neardup.groups(docs_of(texts), 4).collect()}
    assert got == {d: min(d, many - 1 - d) if min(d, many - 1 - d) < planted else d for d in range(many)}


def test_rare_shingle_join_meets_every_link(spark, docs_of):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for _ in range(150):
        words = base[rng.randrange(6):len(base) - rng.randrange(6)] + [f"r{rng.randrange(40)}" for _ in range(rng.randrange(22))]
        if rng.random() < 0.4:
            words[rng.randrange(len(words))] = "x"
        texts.append(" ".join(words))
    docs = docs_of(texts)
    rows = docs.selectExpr("doc_id", "doc_id as part")
    sets = [set(map(int, s)) for s in neardup.shingle_sets(texts, 4)]
    want = {(a, b) for a in range(150) for b in range(a + 1, 150) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert want and want <= {(r.a, r.b) for r in neardup.sharing(docs, rows, 4).collect()}


def test_sketch_keeps_links_with_unlucky_labels():
    import numpy as np

    sketch = np.zeros((2, neardup.SKETCH_BYTES), np.uint8)
    sketch[1, :5] = 255  # 40 of 200 label bits differ: 1 in 10,000 links at 0.8 has 37 or more
    rows = (np.zeros(2, np.int32), np.zeros((2, 2 * neardup.DEPTH), np.uint8), np.arange(2), np.full(2, 100), sketch, np.array([-1, -2]), np.zeros(2, bool))
    a, b = neardup.pairs(rows, np.zeros(2, np.int64), 0, 64, None)
    assert (a.tolist(), b.tolist()) == ([0], [1])


def test_counting_shingles_makes_few_rows_in_a_task(spark, docs_of, monkeypatch):
    frames, plain = [], neardup.arrow_map
    monkeypatch.setattr(neardup, "arrow_map", lambda df, run, schema: frames.append(plain(df, run, schema)) or frames[-1])
    docs = docs_of([" ".join(f"t{i}" for i in range(90)) + " " + " ".join(f"o{d}x{k}" for k in range(200)) for d in range(200)])
    neardup.sharing(docs, docs.selectExpr("doc_id", "doc_id as part"), 4)
    assert 0 < frames[0].count() <= 64 * frames[0].rdd.getNumPartitions()
