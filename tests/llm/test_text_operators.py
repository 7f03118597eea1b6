"""Decontamination, toxicity and SimHash next to plain implementations, and their odd inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.compare import difference, duck, duck_table, spark_table
from tests.conftest import SF_SMALL
from tradelake.llm import decontaminate, queries, simhash, toxicity

DOCS = "doc_id long, text string, n_words string, score string, _text int, k1 int, spans int"


def frame(spark, rows):
    """Documents with columns whose names operators also use."""
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, 3) for i, t in rows], DOCS)


ODD = [(None, None), (None, "a b"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "ähm ÄHM é" * 3)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    got = spark_table(queries.queries()[name](spark, SF_SMALL))
    assert difference(got, duck_table(duck(SF_SMALL), queries.oracle_sql()[name])) is None


# --- decontamination

ITEM = "The quick-brown fox jumps over a lazy dog while Zoë reads all of it again"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, n_hit int")


def plain_hits(text, benchmark, size=13):
    split = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
    w, hit, found = split(text), set(), set()
    for item, s in benchmark:
        b = split(s)
        for i in range(max(1, len(b) - size + 1) if b else 0):
            win = b[i : i + size]
            for j in range(len(w) - len(win) + 1):
                if w[j : j + len(win)] == win:
                    hit |= set(range(j, j + len(win)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 10])
def test_hits_of_odd_texts(spark, block_bytes):
    benchmark = [(10, ITEM), (9, "short one"), (9, "short one"), (8, None), (7, ""), (6, "fox"), (11, ITEM + " x y z")]
    texts = ODD + [(20, f"x, {ITEM.upper()}! y"), (21, "a short; one. " * 40), (22, "foxes fox_fox " + "w " * 500), (23, ITEM[:60])]
    docs = frame(spark, texts)
    out = decontaminate.decontaminate(docs, items(spark, [(*b, 0) for b in benchmark]), block_bytes=block_bytes)
    got = sorted((r.doc_id or -1, r.text or "", r.n_words, r.n_hit, r["items"]) for r in out.collect())
    want = sorted((i or -1, t or "", *plain_hits(t, benchmark)) for i, t in texts)
    assert got == want
    assert out.columns == ["doc_id", "text", "score", "_text", "k1", "n_words", "n_hit", "items", "spans", "contaminated"]
    for r in out.where("n_hit > 0").collect():
        cut = " ".join(r.text[s.start : s.end] for s in r.spans)
        assert plain_hits(cut, benchmark)[0] == r.n_hit


def test_spans_point_into_the_text_as_it_came(spark):
    docs = frame(spark, [(1, f"ÄÖ… {ITEM.upper().replace('Ë', 'ë')} ü")])
    (r,) = decontaminate.decontaminate(docs, items(spark, [(1, ITEM, 0)])).collect()
    assert [r.text[s.start : s.end].lower() for s in r.spans] == [ITEM.lower()] and r.contaminated


def test_one_word_in_twenty(spark):
    docs = frame(spark, [(1, "fox " + "w " * 19), (2, "fox " + "w " * 20)])
    out = decontaminate.clean(docs, items(spark, [(1, "fox", 0)]))
    assert [r.doc_id for r in out.collect()] == [2] and out.columns == docs.columns


def test_empty_tables(spark):
    none = items(spark, [])
    assert decontaminate.decontaminate(frame(spark, []), none).collect() == []
    out = decontaminate.decontaminate(frame(spark, ODD), none).collect()
    assert len(out) == len(ODD) and not any(r.contaminated for r in out)


# --- toxicity


def test_machine_learns_pairs():
    """Two terms that are harmless alone and toxic together: no additive weights can tell."""
    rng = random.Random(1)
    lists, labels = [], []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        lists.append([t for t, on in ((0, a), (1, b)) if on] + sorted(rng.sample(range(2, 30), 5)))
        labels.append(float(a == b))
    machine = toxicity.Machine(30)
    machine.fit(lists[:3000], np.array(labels[:3000]))
    right = (machine.scores(lists[3000:]) >= 0.5) == (np.array(labels[3000:]) > 0)
    assert right.mean() > 0.95


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op2_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    assert right > 0.95 and all(0 <= r.score <= 1 for r in rows)
    assert not [r for r in rows if r.predicted and not r.toxic]


def test_scores_do_not_depend_on_labels_held_out(spark):
    texts = [(i, ("vile rat " if i % 3 == 0 else "kind cat ") + f"w{i % 7}") for i in range(300)]
    labels = [(i, 1 if i % 3 == 0 else 0) for i in range(300)]
    held = {r.id for r in spark.range(300).where(toxicity.is_held_out(F.col("id"))).collect()}
    assert 30 < len(held) < 90
    turned = [(i, 1 - y if i in held else y) for i, y in labels]
    docs = frame(spark, texts + ODD)
    outs = []
    for rows in (labels, turned):
        model = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        outs.append(sorted((r.doc_id or -1, r.text or "", r.score) for r in toxicity.score(docs, model).collect()))
    assert outs[0] == outs[1]
    assert all((s >= 0.5) == t.startswith("vile") for i, t, s in outs[0] if len(t) > 8 and t[4] == " ")


@pytest.mark.parametrize("labels", [[], [(1, None)], [(None, 1)], [(4, 0), (4, 0)]])
def test_no_labels_to_learn_from(spark, labels):
    docs = frame(spark, ODD)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = toxicity.score(docs, model)
    assert out.count() == len(ODD) and out.where("predicted = 1").count() == 0
    assert toxicity.accepted(docs, model).columns == docs.columns
    assert toxicity.score(frame(spark, []), model).collect() == []


# --- near copies


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def near_texts():
    rng = random.Random(3)
    out = []
    for _ in range(12):
        base = [f"w{rng.randrange(50)}" for _ in range(rng.choice((5, 60, 300)))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(99)}"
            out.append(" ".join(copy))
    rng.shuffle(out)
    return [(100 - k, t) for k, t in enumerate(out)] + ODD


@pytest.mark.parametrize("tile", [2048, 3])
def test_components(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash.links, "__defaults__", (tile,))
    texts = near_texts()
    prints = [plain_print(t) for _, t in texts]
    roots = plain_components(prints)
    least = {}
    for (i, _), r in zip(texts, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), f"{p:016x}", str(least.get(r))) for (i, _), p, r in zip(texts, prints, roots, strict=True))
    out = simhash.near_duplicates(frame(spark, texts))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in out.collect()) == want


def test_one_of_each(spark):
    texts = near_texts()
    roots = plain_components([plain_print(t) for _, t in texts])
    docs = frame(spark, texts)
    out = simhash.one_of_each(docs)
    kept = out.collect()
    assert len(kept) == len(set(roots)) and out.columns == docs.columns
    members = [[i for (i, _), r in zip(texts, roots, strict=True) if r == x and i is not None] for x in set(roots)]
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(min(m, default=None)) for m in members)
    assert simhash.one_of_each(frame(spark, [])).collect() == []
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_bit_slices_agree_with_counting():
    rng = np.random.Generator(np.random.PCG64(2))
    a = rng.integers(0, 2**63, 300, np.int64).view(np.uint64)
    b = a ^ np.array([sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 7), False)) for _ in a], np.uint64)
    near = simhash._unpack(simhash._within(simhash.bit_planes(a) ^ simhash.bit_planes(b), (5,)))[:300]
    assert (near == (np.bitwise_count(a ^ b) <= 3)).all()


def test_long_text_is_read_whole():
    text = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(70_000))
    assert simhash.fingerprint(text.encode()) != simhash.fingerprint(text[: len(text) // 2].encode())
