"""Repeated byte strings and word sequences next to a count of all windows."""

import collections
import random

import numpy as np
import pytest

from tradelake.llm import repeats, substring, suffix_dedup
from tradelake.session import RELEASE


def plain(texts, size, split):
    parts = [split(t or "") for t in texts]
    seen = collections.Counter(p[i : i + size] for p in parts for i in range(len(p) - size + 1))
    out = []
    for p in parts:
        covered = np.zeros(len(p), bool)
        for i in range(len(p) - size + 1):
            if seen[p[i : i + size]] > 1:
                covered[i : i + size] = True
        out.append((len(p), int(covered.sum()), [x for x, c in zip(p, covered, strict=True) if not c]))
    return out


def texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randrange(1, 9)))
    common = " ".join(word() for _ in range(120))
    out = [None, "", " ", "a", "ab " * 900, "ab " * 300, "x" * 2500, "é" * 450, common]
    for _ in range(25):
        own = [word() for _ in range(rng.randrange(1, 250))]
        cut = common.split()[rng.randrange(60) :][: rng.randrange(30, 120)]
        at = rng.randrange(len(own))
        out.append(" ".join(own[:at] + (cut if rng.random() < 0.7 else []) + own[at:]))
    out += out[-5:]  # whole copies
    base = out[-7].split(" ")
    for _ in range(6):  # near copies
        edited = list(base)
        edited[rng.randrange(len(edited))] = word()
        out.append((" " if rng.random() < 0.5 else "\n\t").join(edited))
    rng.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, 1, 2, "a", "b", 3) for i, t in enumerate(rows)], "doc_id long, text string, no int, k1 int, f string, raw string, kept int"
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    rows = texts(seed)
    got = {r.doc_id: r for r in suffix_dedup.deduplicate(frame(spark, rows)).collect()}
    for i, (n, removed, kept) in enumerate(plain(rows, 400, lambda t: t.encode())):
        r = got[i]
        assert (r.n, sum(s.end - s.start for s in r.spans), bytes(r.kept)) == (n, removed, bytes(kept))
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


@pytest.mark.parametrize(("seed", "hot", "shard"), [(1, 2000, 300_000), (2, 2000, 500), (3, 1, 300_000)])
def test_words(spark, monkeypatch, seed, hot, shard):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "SHARD_WORDS", shard)
    rows = texts(seed)
    got = {r.doc_id: r for r in substring.deduplicate(frame(spark, rows)).collect()}
    for i, (n, removed, kept) in enumerate(plain(rows, 35, lambda t: tuple(t.encode().split()))):
        r = got[i]
        assert (r.n, sum(s.end - s.start for s in r.spans), bytes(r.kept)) == (n, removed, b" ".join(kept))


@pytest.mark.parametrize("operator", [suffix_dedup.deduplicate, substring.deduplicate])
def test_odd_tables(spark, operator):
    assert operator(frame(spark, [])).collect() == []
    out = operator(frame(spark, [None, "", "a"]))
    assert out.columns == ["doc_id", "text", "no", "k1", "f", "raw", "kept", "n", "spans"]
    assert sorted((bytes(r.kept), r.spans) for r in out.collect()) == [(b"", []), (b"", []), (b"a", [])]


def test_long_copies(spark):
    rng = random.Random(5)
    long = " ".join(str(rng.random()) for _ in range(40_000))
    rows = [long, "x " + long[:300_000] + " y", long[500_000:]]
    for operator, size, split in (
        (suffix_dedup.deduplicate, 400, lambda t: t.encode()),
        (substring.deduplicate, 35, lambda t: tuple(t.encode().split())),
    ):
        got = {r.doc_id: r for r in operator(frame(spark, rows)).collect()}
        for i, t in enumerate(rows):
            assert got[i].n == len(split(t))
        # the middle of the first is in no other text
        (a, b), (c, d) = [(s.start, s.end) for s in got[0].spans]
        kept = bytes(got[0].kept)
        assert long.encode()[300_000 + size * 20 : 500_000 - size * 20] in kept and a == 0 and d == got[0].n
        assert len(bytes(got[2].kept)) <= 40


def test_anchor_is_inside_and_local():
    rng = np.random.Generator(np.random.PCG64(1))
    data = rng.integers(97, 100, 3000, np.uint8).tobytes()
    one, _ = suffix_dedup.split(data)
    two, _ = suffix_dedup.split(b"qqq" + data[500:2000])
    a, b = repeats.anchors(one, suffix_dedup.SHAPE), repeats.anchors(two, suffix_dedup.SHAPE)
    windows = np.arange(len(a))
    assert ((a >= windows) & (a + suffix_dedup.SHAPE.core <= windows + 400)).all()
    assert (a[500:1601] - 500 == b[3:] - 3).all()


def test_index_counts():
    rng = np.random.Generator(np.random.PCG64(4))
    symbols = np.concatenate((rng.integers(1, 6, 399), [0]))  # ends with a separator
    index = substring.Index(symbols, 400)
    for _ in range(200):
        size = int(rng.integers(1, 5))
        at = int(rng.integers(0, 399 - size))
        low, high = np.array([0]), np.array([400])
        for s in symbols[at : at + size][::-1]:
            low, high = index.step(np.array([s]), low, high)
        want = sum((symbols[i : i + size] == symbols[at : at + size]).all() for i in range(401 - size))
        assert high[0] - low[0] == want


def test_edges_fall_out_as_blocks(spark, monkeypatch):
    # passages of a common text, each with own text on both sides: runs share a core, not a whole
    rng = random.Random(5)
    common = "".join(rng.choices("abcdefgh", k=3000))
    rows = []
    for _ in range(40):
        own = ["".join(rng.choices("ijklmnop", k=500)) for _ in range(2)]
        a = rng.randrange(2400)
        rows.append(own[0] + common[a : a + rng.randrange(330, 600)] + own[1])
    written, released = {}, set()

    def stored(df, name, keep=repeats.stored):
        released.add(spark.conf.get(RELEASE))
        out = keep(df, name)
        written.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(repeats, "stored", stored)
    got = {r.doc_id: r for r in suffix_dedup.deduplicate(frame(spark, rows)).collect()}
    for i, (n, removed, kept) in enumerate(plain(rows, 400, lambda t: t.encode())):
        r = got[i]
        assert (r.n, sum(s.end - s.start for s in r.spans), bytes(r.kept)) == (n, removed, bytes(kept))
    edges = written["kinds"][0].where("kinds > 1")
    windows = sum(r.t - r.s + 1 for r in edges.collect())
    assert windows > 2000
    assert written["rank-pairs"][0].count() * 3 < windows  # they were all written one by one
    assert released == {"true"} and spark.conf.get(RELEASE, None) != "true"
