"""Aligned tokens, centroids and similar texts next to plain implementations, and odd inputs."""

import hashlib
import math
import random
import re

import pytest

from tradelake.llm import alignment, clusters, parity

# --- centroids


def plain_clusters(rows, size, n, rounds):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    by = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [list(v) for _, v in sorted(kept, key=by)[:n]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((far(v, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for k, vs in groups.items():
            centroids[k] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = {}
    for _, d, k in found:
        inertia[k] = inertia.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, k, d, inertia[k], sum(inertia.values()), digest[k]) for i, d, k in found]


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, "a", "b", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, near string, v int"
    )


def shown(df):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 3, 60])
def test_clusters(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.choice((-1, 1)) * (i % 4) + rng.random() for _ in range(5)]) for i in range(n)]
    rows += [rows[0], rows[0], (900, rows[0][1]), (None, rows[-1][1])] if rows else []
    odd = [(5, None), (6, []), (7, [1.0] * 4), (8, [1.0, None, 1.0, 1.0, 1.0]), (9, [float("nan")] * 5), (None, [float("-inf")] * 5)]
    out, centroids = clusters.cluster(vectors(spark, rows + odd), size=5, clusters=6, rounds=3)
    want = plain_clusters(rows + odd, 5, 6, 3)
    assert shown(out) == sorted(want, key=str)
    assert out.columns == ["vec_id", "embedding", "near", "v", *("cluster distance cluster_inertia inertia centroid_sha256".split())]
    assert len(centroids) == min(6, len(want))


def test_components_too_large_fail(spark):
    with pytest.raises(Exception, match="magnitude"):
        clusters.cluster(vectors(spark, [(1, [1e9, 0.0])]), size=2)[0].collect()


# --- similar texts


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def plain_similar(rows):
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                group[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted((str(i), len(s), str(least.get(root(k)))) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


def similar_texts(seed, copies):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    common = [word() for _ in range(60)]
    out = []
    for size in (1, 2, 3, 8, 10, 11, 12, 19, 30, 60, 100, 200, 420):
        base = [word() for _ in range(size)]
        if size == 100:
            base[:60] = common
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randrange(1 + size // 20)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice(([], [word()], [copy[at].upper(), word()]))
            out.append(" ".join(copy))
    out += [" ".join(common + [word() for _ in range(rng.randrange(12))]) for _ in range(copies)]
    out += [" ".join(["a b c d"] * 300), "A b\tC d " * 299 + "a b c d", "Ä ö ü", "ä ö ü"]
    rng.shuffle(out)
    rows = [(300 - k if k % 9 else None, t) for k, t in enumerate(out)]
    return rows + [(None, None), (1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (6, "ONE"), (7, "two")]


@pytest.mark.parametrize(("seed", "copies", "few", "tile"), [(1, 6, 64, 1024), (2, 20, 3, 5)])
def test_similar(spark, monkeypatch, seed, copies, few, tile):
    monkeypatch.setattr(parity, "FEW", few)
    monkeypatch.setattr(parity, "TILE", tile)
    rows = similar_texts(seed, copies)
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n_shingles int, c string, k1 int")
    out = parity.similar(docs)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out.collect()) == plain_similar(rows)
    assert out.columns == ["doc_id", "text", "c", "k1", "n_shingles", "component_id"]


def test_similar_without_rows(spark):
    assert parity.similar(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert parity.similar(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()[0].component_id == 1


def test_pigeonhole_holds():
    """Sets at the very edge of a link share enough parts, in every band and across bands."""
    rng = random.Random(5)
    raws = []
    for n in [*range(9, 60), 90, 171, 400, 1000]:
        words = [f"x{rng.randrange(10**9)}" for _ in range(n + 2)]
        raws += [" ".join(words).encode(), " ".join(words[: 2 + math.ceil(n * 0.9)]).encode()]
    hashed, sizes = parity.shingle_sets(raws)
    starts = [0, *sizes.cumsum().tolist()]
    for p in range(0, len(raws), 2):
        pair = [hashed[starts[k] : starts[k + 1]] for k in (p, p + 1)]
        shared = len({*pair[0].tolist()} & {*pair[1].tolist()})
        assert 100 * shared >= 90 * len({*pair[0].tolist(), *pair[1].tolist()})
        for b, (low, high) in enumerate(parity.bands(1200)):
            near = low * 90 // 100 if low > parity.FIRST else low
            if all(near <= len(x) <= high for x in pair):
                keys = [set(parity.part_keys(x, sizes[k : k + 1], b, parity.parts((low, high)))[0].tolist()) for x, k in zip(pair, (p, p + 1), strict=True)]
                bound = min(parity.most(len(x)) for x in pair)
                assert len(keys[0] & keys[1]) >= parity.parts((low, high)) - bound
                a, b2 = (parity.sketches(x, sizes[k : k + 1], parity.sketch_words((low, high))) for x, k in zip(pair, (p, p + 1), strict=True))
                assert sum(int(w).bit_count() for w in (a ^ b2)[0]) <= bound
                break
        else:
            assert min(len(x) for x in pair) < parity.FIRST


# --- aligned tokens

FILES = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


def plain_alignment(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(FILES[0]), SentencePieceProcessor(model_file=FILES[1])
    first.encode_special_tokens = True
    alphabet = {c: b for c, b in alignment._letters().items()}
    rows, holders = [], {}
    for t in texts:
        a_ids = first.encode(" " + t, add_special_tokens=False).ids if t else []
        b_ids = second.encode(t) if t else []
        a = [bytes(alphabet[c] for c in first.id_to_token(i)) for i in a_ids]
        b = []
        for i in b_ids:
            piece = second.id_to_piece(i)
            b.append(bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("\u2581", " ").encode())
        if not t or b"".join(a) != (" " + t).encode() or b"".join(b) != (" " + t).encode():
            rows.append(([], [], [], []))
            continue
        ends = [[sum(map(len, side[: k + 1])) for k in range(len(side))] for side in (a, b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [[[i for i, e in zip(ids, es, strict=True) if lo < e <= hi] for ids, es in zip((a_ids, b_ids), ends, strict=True)] for lo, hi in zip([0, *cuts], cuts, strict=False)]
        starts = [[0, *e[:-1]] for e in ends]
        pairs = [
            (x, y)
            for x, s, e in zip(a_ids, starts[0], ends[0], strict=True)
            for y, u, v in zip(b_ids, starts[1], ends[1], strict=True)
            if s < v and u < e
        ]
        for p in set(pairs):
            holders[p] = holders.get(p, 0) + 1
        rows.append((a_ids, b_ids, groups, pairs))
    top = {}
    for (x, _), n in holders.items():
        top[x] = max(n, top.get(x, 0))
    out = []
    for a_ids, b_ids, groups, pairs in rows:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        best = sum(holders[p] == top[p[0]] for p in pairs)
        out.append((len(a_ids), len(b_ids), len(groups), len(pairs), text, best, sum(holders[p] for p in pairs)))
    return out


TEXTS = [
    None, "", " ", "a", "  two  spaces\n\n\ttabs ", "The quick brown fox doesn't jump.", "The quick brown fox", "the quick brown fox",
    "<|endoftext|> <s> x </s> <unk> <0x41>", "\u2581 is a mark", "nul \x00 here", "日本語のテキスト", "na\u00efve caf\u00e9 \u00b2 \u00bd", "😀 emoji 👩‍👩‍👧",
    "e\u0301 combined", "\u00a0\u2003blank\u0085", "12345678901234567890", "x" * 700, " " * 300, "unbelievably antidisestablishmentarianism", "The quick brown fox",
]


@pytest.mark.parametrize("head", [1 << 20, 16, 0])
def test_alignment(spark, monkeypatch, head):
    if head == 16:
        monkeypatch.setattr(alignment, "HELD", 8)
    docs = spark.createDataFrame([(i, t, "z", 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, groups string, no int")
    out = alignment.align(docs, *FILES, head=head)
    assert out.columns == "doc_id no n_a n_b n_groups n_links groups n_best count_sum".split()
    got = [tuple(r)[2:] for r in sorted(out.collect())]
    assert got == plain_alignment(TEXTS)
    assert sum(x[0] > 0 for x in got) > 12


def test_quick_tokens_are_those_of_the_file():
    side = alignment.ByteTokens(FILES[0])
    assert side.quick is not None
    rng = random.Random(4)
    chars = [chr(c) for c in range(1, 0x250)] + [" ", "e", "'s", "\n", "1"] * 150
    for _ in range(300):
        t = "".join(rng.choices(chars, k=rng.randrange(60)))
        assert side.encode(t) == side.slow.encode(t, add_special_tokens=False).ids


def test_alignment_without_rows(spark):
    docs = spark.createDataFrame([], "text string")
    out = alignment.align(docs, *FILES, digest=True)
    assert out.collect() == [] and out.columns == "n_a n_b n_groups n_links groups n_best count_sum".split()


def test_pointers_follow_long_chains():
    """Tokens of two and three bytes cross for six bytes at a time; of shifted twos, for ever."""
    np = alignment.np
    a, b = alignment.terminals(np.array([2, 4, 6, 8, 10, 12]), np.array([3, 6, 9, 12]))
    assert a.tolist() == [1, 1, 1, 3, 3, 3] and b.tolist() == [1, 1, 3, 3]
    ends = np.arange(2, 20_001, 2)
    a, b = alignment.terminals(np.append(ends, 20_001), np.append(ends - 1, 20_001))
    assert set(a.tolist()) == set(b.tolist()) == {len(ends)}


def test_words_are_aligned_once(monkeypatch):
    import pyarrow as pa

    texts = [*TEXTS, "a  b\n\n c \t d\n e ", "\nx it's 12 ab  \r\n c", "one two three\none two"]
    texts += ["one two three", "two three one " * 50 + "one"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["_row", "text"])
    words = alignment._tokenizers(*FILES)[-1]
    assert words.usable
    whole = []
    both = alignment._both
    monkeypatch.setattr(alignment, "_both", lambda a, b, text: (whole.append(text), both(a, b, text))[1])
    cut = pa.Table.from_batches(alignment._aligned([batch], *FILES))
    assert not {"one two three", texts[-1]} & set(whole)
    assert {" one", " two", " three", "\none"} <= set(words.held)
    monkeypatch.setattr(words, "usable", False)
    assert pa.Table.from_batches(alignment._aligned([batch], *FILES)).equals(cut)
    assert texts[-1] in whole
