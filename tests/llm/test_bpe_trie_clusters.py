"""Byte-level BPE against the tokenizer library, prefix trie and clustering
against brute force, with the edge cases of their docstrings."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from ratelake.llm import byte_bpe, prefix_trie, queries, subvector_kmeans


def _key(r):
    return tuple((v is None, str(v)) for v in r)


# --- byte-level BPE


@pytest.fixture(scope="module")
def vocab():
    return byte_bpe.vocabulary(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(queries.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _bpe_texts():
    rnd = random.Random(3)
    marks = list("aZé09 \t\n\r'.,!?#$ß日本語ด้🙂  \u0085\x00\x1c​﻿") + ["'ll", "'S", "  ", "<|endoftext|>", "▁", "Ā", "á"]
    texts = ["".join(rnd.choice(marks) for _ in range(rnd.randint(0, 200))) for _ in range(150)]
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{chr(c)}a {chr(c)}1" for c in every[i : i + 4000]) for i in range(0, len(every), 4000)]
    long = " ".join(rnd.choice(["word", "été", "x" * 300, "12", "\n\n"]) for _ in range(150_000))
    return [*texts, None, "", " ", "\n" * 5000, "ab" * 40_000, "!" * 40_000, long]


def test_bpe_equals_the_library(spark, vocab, reference):
    rows = [(None if i == 3 else i // 2, t, 7, b"x", 1) for i, t in enumerate(_bpe_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded binary, model int").repartition(3)
    got = sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in byte_bpe.round_trip(df, vocab).collect()), key=_key)
    want = sorted(((d, reference.encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in rows), key=_key)
    assert got == want
    encoded = byte_bpe.encode(df, vocab)
    assert sorted(((r["doc_id"], r["ids"]) for r in encoded.collect()), key=_key) == sorted((w[:2] for w in want), key=_key)
    assert sorted((bytes(r["decoded"]) for r in byte_bpe.decode(encoded.where("doc_id < 20"), vocab).collect())) == sorted(w[2] for w in want if w[0] is not None and w[0] < 20)


def test_bpe_cuts_long_texts_where_no_token_crosses(vocab, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART", 7)
    codec = byte_bpe.Codec(vocab)
    for text in _bpe_texts()[:60]:
        assert "".join(byte_bpe.parts(text)) == text
        assert [w for p in byte_bpe.parts(text) for w in codec.pre_tokens(p)] == codec.pre_tokens(text)


def test_bpe_forgets_and_still_agrees(vocab, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 5)
    monkeypatch.setattr(byte_bpe, "CACHE_CHARS", 4)
    codec = byte_bpe.Codec(vocab)
    for text in _bpe_texts()[:40]:
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)


def test_bpe_asks_the_model_once_for_a_group_of_texts(vocab, reference, monkeypatch):
    asked = []
    encode = byte_bpe.sentencepiece.SentencePieceProcessor.encode
    monkeypatch.setattr(byte_bpe.sentencepiece.SentencePieceProcessor, "encode", lambda self, x, **kw: asked.append(len(x)) or encode(self, x, **kw))
    monkeypatch.setattr(byte_bpe, "_codec", [])
    texts = [f"qzx{i}jvw textkq{i}" for i in range(300)] + [None, "", "été" * 4000]
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(t))), "text": pa.array(t, pa.string())}) for t in (texts, [None, ""], texts[:9])]
    out = list(byte_bpe._encoder(SimpleNamespace(value=vocab), True)(iter(batches)))
    assert len(asked) < 5
    every = [*texts, None, "", *texts[:9]]
    got = [(r["ids"], r["decoded"]) for b in out for r in b.to_pylist()]
    assert got == [(reference.encode_ordinary(x or ""), (x or "").encode()) for x in every]
    # lists without any id, and results that leave after each text
    codec = byte_bpe.Codec(vocab)
    assert codec.decode_all(np.zeros(0, np.int32), np.array([0, 0, 0])).to_pylist() == [b"", b""]
    assert codec.decode(np.zeros(0, np.int64)) == b""
    monkeypatch.setattr(byte_bpe, "PART", 5)
    assert [k.tolist() for k in codec.encode_all(x or "" for x in every)] == [reference.encode_ordinary(x or "") for x in every]


def test_bpe_takes_whole_tokens_that_no_merge_reaches(tmp_path):
    # "abc" is a token, but neither "ab" nor "bc" is
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"zz": 257}
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()))
    codec = byte_bpe.Codec(byte_bpe.vocabulary(str(path), public_tokenizers.PATTERN))
    library = tiktoken.Encoding("small", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "xabc", "abcabc", "abc abc", "zzz", "zzzz"):
        assert codec.encode(text).tolist() == library.encode_ordinary(text)
    with pytest.raises(IndexError):
        codec.decode(np.array([99999]))
    with pytest.raises(ValueError):
        codec.decode(np.array([-1]))
    path.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.vocabulary(str(path), public_tokenizers.PATTERN)


def test_bpe_empty_table(spark, vocab):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.round_trip(empty, vocab).collect() == []


# --- prefix trie


def _trie_rows():
    rnd = random.Random(11)
    say = lambda: "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 6)))
    hot = [("user" if t % 2 == 0 else "assistant", f"hot {t}") for t in range(12)]
    rows = []
    for c in [*range(-12, 60), 10**15, 10**15 + 2]:
        n = rnd.choice([0, 1, 2, 3, 9, 14])
        own = hot[: rnd.randint(1, 12)] if rnd.random() < 0.4 else [(rnd.choice(["user", "bot"]), say()) for _ in range(n)]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(own)]
    rows += [(200 + c, t, "user", f"copy {t}") for c in range(60) for t in range(4)]  # exact copies
    rows += [(300, t, "user", f"long {t}") for t in range(700)] + [(305, t, "user", f"long {t}") for t in range(650)]
    rows += [(400, None, "a", "null turn"), (400, 0, None, "null role"), (400, 1, "a", None), (400, 1, "a", None), (400, 2, "b", "tie"), (400, 2, "a", "tie")]
    rows += [(None, 0, "user", "no id"), (401, 5, "user", "base absent")]
    return rows


def _trie_by_hand(rows):
    convs: dict[int, list] = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs.setdefault(c, []).append(((t is not None, t or 0), hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest(), r, x))
    told = {c: [k[2:] for k in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        seqs[c] = tuple(told.get(base, [])[:h] + own[h:])
    members: dict[tuple, list[int]] = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids: dict[tuple, list[tuple]] = {n: [] for n in members}
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] = sum(saved[k] for k in kids[n]) + (len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0)
    out = []
    for n, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if seqs[c] == n)))
        parent = min(members[n[:-1]]) if n else None
        out.append((min(m), len(n), parent, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=_key)


_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _trie(df, **sizes):
    out = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(df)), **sizes)
    assert out.columns == _NODE
    return sorted((tuple(r) for r in out.collect()), key=_key)


@pytest.fixture()
def spread(spark):
    """Partitions as they fall, so that conversations cross their borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("slots", [prefix_trie.SLOTS, 1 << 16])
def test_trie_equals_brute_force(spread, slots):
    rows = _trie_rows()
    data = [(*r, 1, b"x", True, 3) for r in rows]
    df = spread.createDataFrame(data, "conv_id long, turn long, role string, text string, depth int, key binary, last boolean, pid int").repartition(5)
    assert _trie(df, slots=slots, piece=7) == _trie_by_hand(rows)


def test_trie_by_exact_grouping_alone(spread, monkeypatch):
    """A sketch that proves nothing leaves all prefixes to the exact way."""
    full = np.full(prefix_trie.ROWS * prefix_trie.SLOTS, 2, np.uint8)
    monkeypatch.setattr(prefix_trie, "_sketch", lambda *a: full)
    monkeypatch.setattr(prefix_trie, "HOT", 1)
    rows = _trie_rows()
    assert _trie(spread.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)) == _trie_by_hand(rows)


def test_trie_screens_most_single_prefixes(spread):
    rows = [(c, t, "user", f"{c} {t}") for c in range(0, 500, 5) for t in range(6)]
    df = spread.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seen = prefix_trie.screened(prefix_trie.rebuilt(prefix_trie.turns(df)))
    assert seen.where("NOT single AND depth > 0").count() <= 3
    assert seen.where("border").count() >= 97


def test_trie_of_no_and_one_conversation(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert _trie(spark.createDataFrame([], schema)) == []
    rows = [(7, 0, "user", "alone"), (7, 1, "bot", "yes")]
    assert _trie(spark.createDataFrame(rows, schema)) == _trie_by_hand(rows)


# --- clustering


def _vectors():
    rnd = random.Random(2)
    vec = lambda: [float(np.float32(rnd.gauss(0, 0.2))) for _ in range(64)]
    hot = vec()
    rows = [(i, hot if i % 3 == 0 else vec()) for i in range(400)]
    rows += [(5, rows[7][1]), (5, rows[8][1]), (None, vec()), (900, None), (901, []), (902, vec()[:63]), (903, vec() + [0.0])]
    rows += [(904, [None, *vec()[1:]]), (905, [math.nan, *vec()[1:]]), (906, [math.inf, *vec()[1:]]), (907, [-math.inf, *vec()[1:]])]
    rows += [(908, [3e38, *vec()[1:]]), (909, [-3e38] * 64), (910, [-0.0] * 64)]
    return rows


def _clusters_by_hand(rows, k=16, rounds=3, limit=1 << 27):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-limit, min(limit, math.floor(64 * float(np.float32(x))))) for x in v]))
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    mid = [v for _, v in starts[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(mid)) for _, v in kept]

    for _ in range(rounds):
        at = nearest()
        for c in range(len(mid)):
            own = [v for (_, v), (_, x) in zip(kept, at) if x == c]
            if own:
                mid[c] = [sum(x) // len(own) for x in zip(*own)]
    at = nearest()
    inertia = [sum(d for d, x in at if x == c) for c in range(len(mid))]
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in mid]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, at)), key=_key)


_VECTORS = "vec_id long, embedding array<float>, label int, ids int, n int, codes int, h int"


def _clusters(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], _VECTORS).repartition(4)
    out = subvector_kmeans.with_inertia(*subvector_kmeans.cluster(df))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=_key)


def test_clusters_equal_brute_force(spark):
    rows = _vectors()
    # the huge vectors make sums beyond a long: they are tested by themselves
    tame = [r for r in rows if r[0] not in (908, 909)]
    assert _clusters(spark, tame) == _clusters_by_hand(tame)


def test_clusters_of_few_equal_or_huge_vectors(spark):
    assert _clusters(spark, []) == []
    assert _clusters(spark, [(1, None), (None, [0.0] * 64)]) == []
    for rows in ([(1, [0.5] * 64)], [(i, [0.25] * 64) for i in range(40)], [r for r in _vectors() if r[0] in (908, 909, 910)]):
        assert _clusters(spark, rows) == _clusters_by_hand(rows)


def test_dictionaries_are_lossless():
    v = np.random.default_rng(1).integers(-5, 5, (300, 63))
    codes, books = subvector_kmeans.encode_blocks(v)
    assert np.array_equal(np.concatenate([b[codes[:, j]] for j, b in enumerate(books)], axis=1), v)
    assert all(b.shape[0] == np.unique(b, axis=0).shape[0] < 300 for b in books)
