"""Byte-level BPE encoding and decoding (operator 3).

A text is cut into pre-tokens by the vocabulary's pattern. Each distinct
pre-token of a block is resolved in two tiers:

1. a minimal perfect hash over the vocabulary (levels of bit arrays; a key's
   rank among the set bits is its slot) answers whole pre-tokens that are in
   the vocabulary. A slot always exists, so the stored bytes are compared;
2. a miss is merged with a heap of (rank, position) over a doubly linked list
   of its bytes: the lowest rank first, the leftmost among equals.

Pre-tokenising, hashing, lookup and decoding are array operations over a block
of texts; only misses not seen lately reach the heap. The job has no shuffle:
each task reads its rows and writes one row per document.

Null text counts as empty: no tokens, digests of the empty string. Ties do not
arise (a rank is unique); repeated rows give repeated results; null ids stay
null; other columns of the input are not read. An empty table gives an empty
result. A long text is worked through in pieces, cut where white space begins
after other text, which is always a boundary between pre-tokens.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tierflow.llm.common import arrow_map, gather_ranges, mix64, table, text_blocks

BLOCK_CHARS = 400_000
CACHE_ENTRIES = 250_000
LETTER, NUMBER, OTHER, SPACE, BREAK = range(5)

# Code points that \s matches.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Endings that the pattern cuts off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    import regex

    points = np.arange(0x110000, dtype="<u4")
    points[0xD800:0xE000] = 0  # surrogates are no characters
    every = points.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = kind
    out[list(WHITE)] = SPACE
    return out


def pretoken_starts(points: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every pre-token, and the class of each code point.

    ``breaks`` are the positions of separators between texts; each comes out
    as a pre-token of class BREAK.
    """
    kind = char_classes()[points]
    kind[breaks] = BREAK
    n = len(points)
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[breaks] = True
    after = breaks[breaks + 1 < n] + 1
    start[after] = True
    runs = np.flatnonzero(start)
    # White space before other text gives its last character away: a blank
    # joins the text, any other character stands alone.
    head = runs[1:]
    head = head[(kind[head - 1] == SPACE) & (kind[head] < SPACE)]
    start[head - 1] = True
    start[head[points[head - 1] == 0x20]] = False
    # An apostrophe that begins a pre-token takes an ending with it.
    marks = runs[points[runs] == 0x27]
    marks = marks[start[marks] & (marks + 1 < n)]
    marks = marks[kind[np.minimum(marks + 1, n - 1)] == LETTER]
    if len(marks):
        padded = np.append(points, [0, 0, 0])
        for ending in ENDINGS:
            hit = marks
            for k, c in enumerate(ending, 1):
                hit = hit[(padded[hit + k] == ord(c)) & (np.append(kind, [BREAK] * 3)[hit + k] == LETTER)]
            start[hit + 1] = False
            end = hit + 1 + len(ending)
            start[end[end < n]] = True
    return np.flatnonzero(start), kind


class MinimalPerfectHash:
    """Maps n distinct 64-bit keys one to one onto 0..n-1.

    Level by level, keys that are alone in their cell of a bit array are set
    there; the others go on to the next level. Other keys map to any slot or -1.
    """

    def __init__(self, keys: np.ndarray, load: float = 2.0):
        self.levels, base, left, level = [], 0, np.asarray(keys, np.uint64), 0
        while len(left):
            size = max(8, int(load * len(left)))
            cell = self._cell(left, level, size)
            bits = np.bincount(cell, minlength=size) == 1
            self.levels.append((size, bits, base + np.cumsum(bits) - 1))
            base += int(bits.sum())
            left = left[~bits[cell]]
            level += 1
            if level > 200:
                raise ValueError("keys are not distinct")

    @staticmethod
    def _cell(keys, level, size):
        salt = np.uint64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        return (mix64(keys ^ salt) % np.uint64(size)).astype(np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, bits, rank) in enumerate(self.levels):
            if not len(left):
                break
            cell = self._cell(keys[left], level, size)
            hit = bits[cell]
            out[left[hit]] = rank[cell[hit]]
            left = left[~hit]
        return out


MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def pack(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """First 16 bytes of each range as two words; ``buffer`` has 16 spare bytes at its end."""
    words = np.ndarray((len(buffer) - 8,), np.dtype("<u8"), buffer, 0, (1,))
    low = words[starts] & MASKS[np.minimum(lengths, 8)]
    long = lengths > 8
    high = np.zeros(len(starts), np.uint64)
    high[long] = words[starts[long] + 8] & MASKS[np.minimum(lengths[long] - 8, 8)]
    return low, high


def key_of(low, high, lengths):
    return mix64(low ^ mix64(high + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


class Vocabulary:
    """Ranks of a byte-level vocabulary with both tiers of lookup."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.tokens = {r: t for t, r in self.ranks.items()}
        words = list(self.ranks)
        self.ids = np.array([self.ranks[w] for w in words], np.int64)
        size = int(self.ids.max()) + 1
        by_id = [self.tokens.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(w) for w in by_id], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(by_id) + bytes(16), np.uint8)
        low, high = pack(self.bytes, self.starts[self.ids], self.lengths[self.ids])
        long = np.flatnonzero(self.lengths[self.ids] > 16)
        keys = key_of(low, high, self.lengths[self.ids])
        keys[long] = self.long_keys([words[i] for i in long])
        self.hash = MinimalPerfectHash(keys)
        at = self.hash.slot(keys)
        self.at, self.low, self.high = np.empty_like(self.ids), np.empty_like(low), np.empty_like(high)
        self.at[at], self.low[at], self.high[at] = self.ids, low, high
        self.cache: dict[bytes, bytes] = {}

    @staticmethod
    def long_keys(words: list[bytes]) -> np.ndarray:
        import xxhash

        return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)

    def whole(self, keys, low, high, lengths) -> np.ndarray:
        """Ids of pre-tokens in the vocabulary by key, first 16 bytes and length, else -1."""
        slot = self.hash.slot(keys)
        found = np.maximum(slot, 0)
        same = (slot >= 0) & (self.low[found] == low) & (self.high[found] == high)
        ids = self.at[found]
        return np.where(same & (self.lengths[ids] == lengths), ids, -1)

    def merged(self, word: bytes) -> bytes:
        """Ids (little-endian 32 bit) of a word, by merges; remembered for a while."""
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            got = np.array(merge(word, self.ranks), "<u4").tobytes()
            if len(word) <= 64:
                self.cache[word] = got
        return got

    def encode_block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many belong to each."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        breaks = np.cumsum(sizes + 1) - 1
        starts, kind = pretoken_starts(points, breaks)
        width = (1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
        offset = np.zeros(len(points) + 1, np.int64)
        np.cumsum(width, out=offset[1:])
        raw = joined.encode("utf-8") + bytes(16)
        buffer = np.frombuffer(raw, np.uint8)
        ends = np.append(starts[1:], len(points))
        real = kind[starts] != BREAK
        starts, ends = starts[real], ends[real]
        owner = np.searchsorted(breaks, starts)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        begin = offset[starts]
        length = offset[ends] - begin
        low, high = packed = pack(buffer, begin, length)
        keys = key_of(low, high, length)
        long = np.flatnonzero(length > 16)
        if len(long):
            words = [raw[b:b + k] for b, k in zip(begin[long].tolist(), length[long].tolist())]
            keys[long] = self.long_keys(words)
            number = {w: i for i, w in enumerate(dict.fromkeys(words))}
            low, high = low.copy(), high.copy()
            low[long] = np.fromiter((number[w] for w in words), np.uint64, len(words))
            high[long] = 0
        code, unique = pd.factorize(keys)
        first = np.empty(len(unique), np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        if not ((low[first][code] == low).all() and (high[first][code] == high).all() and (length[first][code] == length).all()):
            code, first = self._distinct(raw, begin, length)  # two words share a key: compare them as bytes
        b, k = begin[first], length[first]
        ids = self.whole(keys[first], packed[0][first], packed[1][first], k)
        for i in np.flatnonzero((k > 16) & (ids >= 0)).tolist():
            if self.tokens[int(ids[i])] != raw[b[i]:b[i] + k[i]]:
                ids[i] = -1
        parts: list = [None] * len(first)
        known = np.flatnonzero(ids >= 0)
        count = np.ones(len(first), np.int64)
        for i, x, y in zip((miss := np.flatnonzero(ids < 0)).tolist(), b[miss].tolist(), k[miss].tolist()):
            parts[i] = got = self.merged(raw[x:x + y])
            count[i] = len(got) >> 2
        at = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), np.uint32)
        flat[at[known]] = ids[known]
        if len(miss):
            flat[gather_ranges(at[miss], count[miss])] = np.frombuffer(b"".join(parts[i] for i in miss.tolist()), "<u4")
        out = flat[gather_ranges(at[code], count[code])]
        return out, np.bincount(owner, count[code], len(texts)).astype(np.int64)

    @staticmethod
    def _distinct(raw, begin, length):
        words = [raw[b:b + k] for b, k in zip(begin.tolist(), length.tolist())]
        code, unique = pd.factorize(np.array(words, object))
        first = np.empty(len(unique), np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        return code, first

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and how many belong to each id."""
        ids = ids.astype(np.int64)
        return self.bytes[gather_ranges(self.starts[ids], self.lengths[ids])], self.lengths[ids]


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one word: a heap of pairs over linked pieces.

    Piece i begins at byte i and ends where the next living piece begins. An
    entry of the heap is ``rank << 32 | i``; it counts only while the pair at i
    still has that rank.
    """
    n = len(word)
    get = ranks.get
    if n < 2:
        return [ranks[word]] if n else []
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    pair = [-1] * n
    heap = []
    for i in range(n - 1):
        r = get(word[i:i + 2])
        if r is not None:
            pair[i] = r
            heap.append(r << 32 | i)
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        e = pop(heap)
        i = e & 0xFFFFFFFF
        if pair[i] != e >> 32:
            continue
        j = after[i]
        k = after[j]
        after[i] = k
        pair[j] = -2
        if k < n:
            before[k] = i
            r = get(word[i:after[k]])
            if r is None:
                pair[i] = -1
            else:
                pair[i] = r
                push(heap, r << 32 | i)
        else:
            pair[i] = -1
        h = before[i]
        if h >= 0:
            r = get(word[h:k])
            if r is None:
                pair[h] = -1
            else:
                pair[h] = r
                push(heap, r << 32 | h)
    out, i = [], 0
    while i < n:
        j = after[i]
        out.append(ranks[word[i:j]])
        i = j
    return out


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker and file."""
    return Vocabulary(path)


def pieces(text: str, most: int) -> list[str]:
    """Cut a long text before white space that follows other text."""
    out, at = [], 0
    while len(text) - at > most:
        cut = at + most
        while cut < len(text) and not (text[cut] in WHITE_CHARS and text[cut - 1] not in WHITE_CHARS):
            cut += 1
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out


WHITE_CHARS = frozenset(map(chr, WHITE))


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): the token ids of every text."""

    def run(batches):
        vocab = vocabulary(vocab_path)
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            cut = [pieces(t, BLOCK_CHARS) for t in texts]
            groups = [[x for c in cut for x in c]] if len(texts) > 1 else [[p] for p in cut[0]]
            got = [vocab.encode_block(g) for g in groups]
            flat = np.concatenate([g[0] for g in got])
            count = np.concatenate([g[1] for g in got])
            owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
            n = np.bincount(owner, count, len(texts)).astype(np.int64)
            offsets = np.append(0, np.cumsum(n)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(n), pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))],
                names=[id_col, "n_tokens", "ids"])

    kind, name = _id_type(docs, id_col)
    return arrow_map(docs.select(id_col, text_col), run, f"`{id_col}` {name}, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the texts of lists of token ids; bytes that are no UTF-8 are replaced."""

    def run(batches):
        vocab = vocabulary(vocab_path)
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                got = np.array(ids.as_py() or [], np.int64)
                texts.append(vocab.decode(got)[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind, name = _id_type(encoded, id_col)
    return arrow_map(encoded.select(id_col, ids_col), run, f"`{id_col}` {name}, text string")


def round_trip(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, decoded_bytes) of every text.

    The ids of a text exist only within its block, so a text of any length
    needs the memory of one piece.
    """

    def run(batches):
        vocab = vocabulary(vocab_path)
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            cut = [pieces(t, BLOCK_CHARS) for t in texts]
            groups = [[x for c in cut for x in c]] if len(texts) > 1 else [[p] for p in cut[0]]
            owner = iter(np.repeat(np.arange(len(texts)), [len(c) for c in cut]).tolist())
            n, size = [0] * len(texts), [0] * len(texts)
            encoded = [hashlib.sha256() for _ in texts]
            decoded = [hashlib.sha256() for _ in texts]
            for group in groups:
                flat, count = vocab.encode_block(group)
                data, widths = vocab.decode(flat)
                flat = flat.astype("<u4")
                at = np.append(0, np.cumsum(count))
                byte_at = np.append(0, np.cumsum(widths))[at].tolist()
                at = at.tolist()
                for p in range(len(group)):
                    i = next(owner)
                    encoded[i].update(flat[at[p]:at[p + 1]])
                    decoded[i].update(data[byte_at[p]:byte_at[p + 1]])
                    n[i] += at[p + 1] - at[p]
                    size[i] += byte_at[p + 1] - byte_at[p]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(n, pa.int64()), pa.array([x.hexdigest() for x in encoded], pa.string()),
                 pa.array([x.hexdigest() for x in decoded], pa.string()), pa.array(size, pa.int64())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "decoded_bytes"])

    kind, name = _id_type(docs, id_col)
    return arrow_map(
        docs.select(id_col, text_col), run, f"`{id_col}` {name}, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_bytes long")


def _id_type(df: DataFrame, id_col: str):
    from pyspark.sql.pandas.types import to_arrow_type

    t = df.schema[id_col].dataType
    return to_arrow_type(t), t.simpleString()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), default_vocabulary())
