import hashlib
import zlib

import pytest

from tierflow.llm import merkle

LEAF = "grp string, id long, digest string, tampered string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(values):
    """All levels of the tree over these digests, from the definition."""
    out = [list(values)]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([sha("".join(below[i:i + 16])) for i in range(0, len(below), 16)])
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 16 * 16
        out.append((level[start:i], level[i + 1:start + 16]))
        i //= 16
    return out


def expected(rows):
    """{(grp, id, leaf)} to the result's columns, over (grp, id, leaf, tampered)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees[g] = levels_of([r[2] for r in groups[g]])
    top = levels_of([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (_, key, leaf, tampered) in enumerate(groups[g]):
            way = siblings(trees[g], i) + siblings(top, k)
            back = tampered or leaf
            for left, right in way:
                back = sha("".join([*left, back, *right]))
            proof = sha("".join("".join(a + b) for a, b in way))
            out.append((key, leaf, trees[g][-1][0], top[-1][0], proof, back, back == top[-1][0]))
    return sorted(out, key=repr)


def many(counts):
    rows = []
    for g, n in counts.items():
        for i in range(n):
            leaf = sha(f"{g}:{i}")
            rows.append((g, i, leaf, sha("other" + leaf) if i % 5 == 0 else None))
    return rows


def staged_leaves(spark, tmp_dir, rows, name="leaves"):
    spark.createDataFrame(rows, LEAF).repartition(5).write.mode("overwrite").parquet(f"{tmp_dir}/{name}")
    return spark.read.parquet(f"{tmp_dir}/{name}")


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257, 4095, 4096])
def test_open_subtrees_equal_the_definition(n):
    values = [sha(str(i)) for i in range(n)]
    tree = merkle.OpenSubtrees()
    nodes = [tree.append(v) for v in values]
    levels = levels_of(values)
    assert tree.finish(True) == levels[-1][0]
    for i in {0, n // 2, n - 1}:
        want = siblings(levels, i)
        assert merkle.witness(nodes[i]) == "".join(f"{''.join(a)},{''.join(b)};" for a, b in want)
        assert merkle.folded(values[i], merkle.witness(nodes[i])) == levels[-1][0]


def test_hot_source_over_many_blocks(spark, tmp_dir):
    rows = many({"hot": 2 * 4096 + 17, None: 1, "b": 16, "ü": 17, "Z": 4096, "": 3} | {f"s{i:02d}": 1 for i in range(20)})
    got = result(merkle.witnessed(merkle.manifest(staged_leaves(spark, tmp_dir, rows))))
    assert got == expected(rows)


def test_many_partitions_and_repeated_rows(spark, tmp_dir):
    rows = many({"a": 300, "b": 40}) + [("a", 7, sha("a:7"), None)] * 200 + [("a", None, sha("x"), None), ("a", None, sha("y"), None)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 61)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = result(merkle.witnessed(merkle.manifest(staged_leaves(spark, tmp_dir, rows))))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    strip = lambda out: sorted((r[:4] for r in out), key=repr)
    assert strip(got) == strip(expected(rows))
    # Equal rows may trade places: as a set their proofs are those of the definition.
    assert {r[4] for r in got} == {r[4] for r in expected(rows)}


def test_append_equals_the_build_of_all(spark, tmp_dir):
    rows = many({"hot": 4096 + 900, "b": 30, "c": 1, "d": 5})
    cut = {"hot": 4096 + 20, "b": 16, "c": 0, "d": 5}
    first = staged_leaves(spark, tmp_dir, [r for r in rows if r[1] < cut[r[0]]], "first")
    later = staged_leaves(spark, tmp_dir, [r for r in rows if r[1] >= cut[r[0]]], "later")
    tree = merkle.appended(merkle.manifest(first), later)
    assert result(merkle.witnessed(tree)) == expected(rows)
    with pytest.raises(ValueError, match="come after"):
        merkle.appended(tree, staged_leaves(spark, tmp_dir, [("b", 3, sha("late"), None)], "late"))


def test_query_on_documents(spark, parquet_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, pos long, grp string"
    docs = [(i, None if i % 7 == 0 else f"Text Ünd {i}" * (i % 3), "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, i, 1, "x") for i in range(90)]
    docs += [docs[5], (None, "No Id", None, None, None, 1, "y"), (200, "A" * 1_000_000, "en", "s1", 1, 1, "z")]
    folder = parquet_dir(documents=spark.createDataFrame(docs, schema))

    def leaf(d, text):
        parts = [d[0], d[3], d[2], d[4], text]
        return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))

    rows = []
    for d in docs:
        changed = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
        low = d[1] and d[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        rows.append((d[3], d[0], leaf(d, d[1]), leaf(d, low) if changed else None))
    got = result(merkle.op13_merkle_manifest(spark, folder))
    assert got == expected(rows)
    assert {r[-1] for r in got} == {True, False}


def test_empty_table(spark, parquet_dir):
    folder = parquet_dir(documents=spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"))
    assert merkle.op13_merkle_manifest(spark, folder).collect() == []
