import base64
import hashlib
import random

import numpy as np
import pytest

from tierflow.llm import bpe


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.default_vocabulary(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_blocks_equal_the_library_on_random_text(library):
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "'s", "'re", "'ll", " 'd", "x", "don't", "é", "日本", "123", "²", "!!", "　", "😀", "'", "\x00", "\r\n", "\x1c", "a'sword"]
    texts = ["", "a", " ", "''s", "\n's"] + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    vocab = bpe.vocabulary(bpe.default_vocabulary())
    flat, count = vocab.encode_block(texts)
    at = np.append(0, np.cumsum(count))
    for i, t in enumerate(texts):
        assert flat[at[i]:at[i + 1]].tolist() == library.encode_ordinary(t), repr(t)


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    slots = bpe.MinimalPerfectHash(keys).slot(keys)
    assert sorted(slots.tolist()) == list(range(5000))


def test_round_trip_with_nulls_long_texts_and_clashing_columns(spark, library, monkeypatch):
    long = "wordy " * 60_000 + "x" * 5000 + "\n\n  end"
    texts = [None, "", "same text", "same text", long]
    rows = [(i, t, 7, "c") for i, t in enumerate(texts)] + [(None, "no id", 7, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids_sha256 string")
    got = {r.doc_id: r for r in bpe.round_trip(df, bpe.default_vocabulary()).collect()}
    assert len(got) == 6
    for i, t in [*enumerate(texts), (None, "no id")]:
        ids = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_pieces_cut_at_boundaries_only(library):
    text = "ab  cd\n ef'll gh " * 50
    cut = bpe.pieces(text, 20)
    assert "".join(cut) == text and len(cut) > 10
    assert sum((library.encode_ordinary(x) for x in cut), []) == library.encode_ordinary(text)


def test_encode_decode_and_empty_table(spark, library):
    df = spark.createDataFrame([(1, "Héllo wörld"), (2, None)], "doc_id long, text string")
    encoded = bpe.encode(df, bpe.default_vocabulary())
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    assert ids[1] == library.encode_ordinary("Héllo wörld") and ids[2] == []
    assert {r.doc_id: r.text for r in bpe.decode(encoded, bpe.default_vocabulary()).collect()} == {1: "Héllo wörld", 2: ""}
    assert bpe.round_trip(df.limit(0), bpe.default_vocabulary()).count() == 0


def test_long_words_of_the_vocabulary_come_from_the_perfect_hash(monkeypatch):
    import public_tokenizers
    import regex

    vocab = bpe.Vocabulary(bpe.default_vocabulary())
    long = [w for w in vocab.ranks if len(w) > 16 and regex.fullmatch(public_tokenizers.PATTERN, w.decode("utf-8", "replace"))
            and b"\xef\xbf\xbd" not in w.decode("utf-8", "replace").encode()]
    assert long
    monkeypatch.setattr(vocab, "merged", lambda word: (_ for _ in ()).throw(AssertionError(word)))
    ids, counts = vocab.encode_block([w.decode() for w in long])
    assert ids.tolist() == [vocab.ranks[w] for w in long] and set(counts.tolist()) == {1}
