"""WARC archives, nearest neighbours, pseudonyms, mixing and licences, and their odd inputs."""

import collections
import datetime
import gzip
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tradelake.llm import ann, licenses, mixing, pii, queries, warc

# --- archives


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, type string, digest int")


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.Example.com:80/a?b=1#c", "com,example)/a?b=1"),
        ("https://u:p@m.x.org:8443/Ä b", "org,x,m:8443)/%C3%84%20b"),
        ("https://x.org", "org,x)/"),
        ("no url", "no%20url"),
        (None, ""),
        ("http://[bad", "http://[bad"),
    ],
)
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_round_trip_of_odd_pages(spark):
    big = "é<p>\r\n\r\n</p>" * 40
    rows = [
        (5, "http://a.org/x", big), (3, "http://a.org/x", big), (9, None, big), (None, "http://b.org", big),
        (7, "http://c.org/\r\nWARC-Type: x", "small"), (8, "http://c.org/", "small"), (10, "", None), (11, "http://d/", ""),
        (3, "http://a.org/x", big), (12, "http://long/", "x y\n" * 200_000), (-4, "http://n.org/", "WARC/1.1\r\n\r\n" * 30),
    ]
    out = warc.round_trip(pages(spark, [(*r, "t", 1) for r in rows])).collect()
    got = sorted(str(tuple(r)) for r in out)
    import hashlib

    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = 3 if html == big and page != 3 else None
        want.append(str((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if first else "response", first)))
    assert got == sorted(want)
    assert warc.round_trip(pages(spark, [])).collect() == []


def test_archive_files_are_plain_gzip(spark):
    folder = warc.write_archive(
        pages(spark, [(1, "http://a/", "<p>ü</p>", "t", 1)]), id_col="page_id", url_col="url", html_col="html"
    )
    (row,) = spark.read.format("binaryFile").load(folder).collect()
    headers, payload = warc.parse(gzip.decompress(bytes(row.content)))
    assert headers["warc-type"] == "response" and payload.decode() == "<p>ü</p>"


def test_lookup_finds_all_captures_of_a_hot_url(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    monkeypatch.setattr(warc, "PART_LINES", 20)
    rows = [(i, "http://hot.org/" if i % 3 else f"http://h{i}.org/", f"page {i}", "t", 1) for i in range(150)]
    folder = warc.write_archive(pages(spark, rows), id_col="page_id", url_col="url", html_col="html")
    archive = warc.build_index(spark, folder)
    wanted = spark.createDataFrame([(r[1], r[0]) for r in rows[:100]] + [("http://none.org/", 1)], "url string, page long")
    found = warc.lookup(spark, archive, wanted)
    records = warc.read_records(spark, archive, found).collect()
    assert sorted((r.page, bytes(r.payload).decode()) for r in records) == [(i, f"page {i}") for i in range(100)]


# --- nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, vec string")


def plain_nearest(rows, is_query):
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[(i, tuple(np.float32(v).astype(float)))] = None
    out = []
    for i, v in good:
        if is_query(i):
            scores = []
            for j, w in good:
                if (j, w) != (i, v) and len(w) == len(v):
                    a, b = np.array(v), np.array(w)
                    scores.append((-round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 9) + 0.0, j))
            out += [(i, k + 1, j, -s) for k, (s, j) in enumerate(sorted(scores)[:5])]
    return sorted(out)


def test_nearest_of_odd_vectors(spark):
    rng = np.random.Generator(np.random.PCG64(1))
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(30)] + [(100, [1.0, 2.0, 3.0, 4.0, 5.0])]
    rows += [(200, None), (201, []), (202, [0.0] * 5), (203, [1.0, None, 1.0, 1.0, 1.0]), (204, [math.nan, 1.0, 1.0, 1.0, 1.0])]
    rows += [(205, [math.inf, 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 5), (206, [1.0, 2.0]), (207, [2.0, 1.0]), (208, [-1.0])]
    rows += [(0, [5.0, 4.0, 3.0, 2.0, 1.0])]
    out = ann.nearest(vectors(spark, [(*r, 1, "x") for r in rows]), F.col("id") % 2 == 0)
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in out.collect())
    want = [(i, k, j, round(s, 9)) for i, k, j, s in plain_nearest(rows, lambda i: i % 2 == 0)]
    hit = len({x[:1] + x[2:3] for x in got} & {x[:1] + x[2:3] for x in want}) / len(want)
    assert hit >= 0.9
    # few vectors have exact answers: copies, and rows of another number of components
    exact = lambda rows: [x for x in rows if x[0] >= 100]
    assert exact(got) == exact(want)


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = collections.defaultdict(set)
    for r in queries.op10_nearest(spark, "/root/testdata/sf0.01").collect():
        got[r.query_id].add((r.rank, r.vec_id))
    want = plain_nearest(rows, lambda i: i % 50 == 0)
    assert all(sorted(k for k, _ in x) == [1, 2, 3, 4, 5] for x in got.values())
    assert sum(j in {v for _, v in got[i]} for i, _, j, _ in want) / len(want) >= 0.9



def test_nearest_puts_all_queries_to_all_rows_when_probes_find_too_few(spark, monkeypatch):
    """One probe a table is far from the recall asked for, so the answer has to be exact."""
    monkeypatch.setattr(ann, "PROBE_AXES", 1)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 24)))]
    index = ann.build_index(vectors(spark, [(*r, 1, "x") for r in rows]), "vec_id", "embedding")
    probes, recall = ann.fit_probes(index, index, 3)
    assert probes == 1 and recall < ann.RECALL
    out = ann.nearest(vectors(spark, [(*r, 1, "x") for r in rows]), F.col("id") % 4 == 0)
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in out.collect())
    assert got == sorted((i, k, j, round(s, 9)) for i, k, j, s in plain_nearest(rows, lambda i: i % 4 == 0))


def in_small_chunks(queries):
    """Chunks of 32 queries; tasks only see that a chunk holds no more than they allow."""
    q = queries.withColumn("n", F.row_number().over(Window.orderBy("h1", "h2")) - 1)
    return q.select("h1", "h2", "vec", F.floor(F.col("n") / 32).alias("chunk"), (F.col("n") % 32).alias("place"))


def test_nearest_in_large_buckets_and_small_chunks(spark, monkeypatch):
    """Buckets dealt over several keys, queries over several chunks and rows over pieces lose no pair."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(3, 16))
    rows = [(i, (centres[i % 3] + 0.01 * rng.normal(size=16)).tolist()) for i in range(600)]
    table = vectors(spark, [(*r, 1, "x") for r in rows])
    whole = sorted(tuple(r) for r in ann.nearest(table, F.col("id") % 5 == 0).collect())
    monkeypatch.setattr(ann, "BUCKET", 16)
    monkeypatch.setattr(ann, "PIECE", 100)
    monkeypatch.setattr(ann, "_numbered", in_small_chunks)
    assert sorted(tuple(r) for r in ann.nearest(table, F.col("id") % 5 == 0).collect()) == whole
    assert len(whole) == 600


def test_nearest_of_huge_and_tiny_vectors(spark):
    """Squares of these numbers leave the range of doubles; their cosines don't."""
    rows = [(i, [s * 1.0, s * (i % 4), s * 0.5]) for i, s in enumerate([1e200, 1e-200, 1.0, 1e300, 1e-300, 3.0, 1e160, 1e-170])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.nearest(table, F.col("id") >= 0).collect()
    small = [(i, [1.0, float(i % 4), 0.5]) for i, _ in rows]
    want = {(i, j): s for i, _, j, s in plain_nearest(small, lambda i: True)}
    assert len(out) == 40 and all(abs(r.score - want.get((r.query_id, r.vec_id), r.score)) < 1e-8 for r in out)
    assert all(0 <= r.score <= 1 + 1e-12 for r in out)


def test_no_vectors(spark):
    assert ann.nearest(vectors(spark, []), F.col("id") >= 0).collect() == []
    (one,) = [vectors(spark, [(1, [1.0, 1.0], 1, "x")])]
    assert ann.nearest(one, F.col("id") >= 0).collect() == []


def test_rotation_keeps_lengths():
    x = np.eye(8)
    y = ann.rotate(x, ann._signs(8)[0, 0])
    assert np.allclose(y @ y.T, x)


# --- pseudonyms

PERSONAL = {
    "card": "4785380592391139",
    "spaced": "4785 3805 9239 1139",
    "iban": "DE89 3704 0044 0532 0130 00",
    "ip": "152.143.123.131",
    "iso": "2021-03-05",
    "german": "05.03.2021",
    "us": "03/05/2021",
    "ssn": "123-45-6789",
    "phone": "+1 (743) 555-3824",
    "local": "743-555-3824",
    "foreign": "+44 20 7946 0958",
    "mail": "hein.19@mail5.example.com",
}


def texts(spark, rows):
    return spark.createDataFrame([(i, t, "a", 1, "m") for i, t in rows], "doc_id long, text string, _t string, n_pseudonyms int, m string")


def shape(s):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s)))


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0


def test_pseudonyms_keep_format_and_link(spark):
    rows = [(k, f"see {v}, ok") for k, v in enumerate(PERSONAL.values())]
    out = {r.doc_id: r for r in pii.pseudonymise(texts(spark, rows + [(99, " / ".join(PERSONAL.values()))]), "key").collect()}
    new = {}
    for k, (name, v) in enumerate(PERSONAL.items()):
        assert out[k].n_pseudonyms == 1, name
        new[name] = out[k].text.removeprefix("see ").removesuffix(", ok")
        assert new[name] != v
        if name != "ip":
            assert shape(new[name]) == shape(v)
    assert out[99].text == " / ".join(new.values()) and out[99].n_pseudonyms == len(PERSONAL)
    assert luhn(new["card"]) and new["spaced"].replace(" ", "") == new["card"] and new["card"][0] == "4"
    turned = new["iban"].replace(" ", "")[4:] + new["iban"][:4]
    assert int("".join(str(int(c, 36)) for c in turned)) % 97 == 1
    assert all(int(x) < 256 for x in new["ip"].split("."))
    y, m, d = map(int, new["iso"].split("-"))
    assert 1800 <= datetime.date(y, m, d).year <= 2199
    assert new["german"] == f"{d:02}.{m:02}.{y}" and new["us"] == f"{m:02}/{d:02}/{y}"
    assert re.sub(r"\D", "", new["phone"])[1:] == re.sub(r"\D", "", new["local"])
    other = pii.pseudonymise(texts(spark, [(1, PERSONAL["card"])]), "other key").first()
    assert other.text != new["card"]


def test_what_is_not_valid_stays(spark):
    bad = [
        "4785380592391138", "999.1.1.1", "1.2.3.4.5", "2021-02-30", "1700-01-01", "31.13.2020", "000-12-3456", "666-12-3456",
        "DE88 3704 0044 0532 0130 00", "12345678901234567890123", "x4785380592391139", "2021-03/05", "@", "a@b", "0000000000000000",
    ]
    out = pii.pseudonymise(texts(spark, list(enumerate(bad))), "key").collect()
    assert [r.text for r in sorted(out, key=lambda r: r.doc_id)] == bad and not any(r.n_pseudonyms for r in out)


def test_valid_numbers_next_to_others(spark):
    card, iban = "4111 1111 1111 1111", "BE68 5390 0754 7034"
    forms = {
        f"{card} 12/27": (card, 1), "4111111111111111 03/28": ("4111111111111111", 1), f"{card} 123": (card, 1), f"12 {card}": (card, 1),
        f"12345 {card}": (card, 1), f"2024 {card}": (card, 1), f"{card} 2024-05-06": (card, 2), f"{card} 5500 0000 0000 0004": (card, 2),
        f"{iban} BIC": (iban, 1), "2024-01-01T10:00:00Z": ("2024-01-01", 1),
    }
    out = {r.doc_id: r for r in pii.pseudonymise(texts(spark, list(enumerate(forms))), "key").collect()}
    for k, (text, (hidden, n)) in enumerate(forms.items()):
        assert hidden not in out[k].text and out[k].n_pseudonyms == n and shape(out[k].text) == shape(text), text


def test_permutation_is_one_to_one(spark):
    sql = pii.permuted("array(cast(id div 10 as int), cast(id % 10 as int))", "array(7, 10)", "k", "t")
    got = [tuple(r[0]) for r in spark.range(70).select(F.expr(sql)).collect()]
    assert len(set(got)) == 70 and all(0 <= a < 7 and 0 <= b < 10 for a, b in got)
    days = spark.range(0, 146_097, 97).select(F.date_format(F.expr("date_add(date'1800-01-01', int(id))"), "yyyy-MM-dd").alias("text"))
    new = pii.pseudonymise(days, "k").collect()
    assert len({r.text for r in new}) == len(new) and all(r.n_pseudonyms == 1 for r in new)


def test_pseudonyms_of_odd_texts(spark):
    odd = [(None, None), (1, ""), (2, "ü\x00\x01 4785380592391139\n"), (3, "5" * 100_000), (3, "1.2.3.4"), (3, "1.2.3.4")]
    out = pii.pseudonymise(texts(spark, odd), "key")
    assert out.columns == ["doc_id", "text", "_t", "m", "n_pseudonyms"]
    rows = out.collect()
    assert [r.n_pseudonyms for r in rows if r.text is None] == [0] and len(rows) == 6
    assert len({r.text for r in rows if r.doc_id == 3}) == 2
    assert pii.pseudonymise(texts(spark, []), "key").collect() == []


def test_no_python_in_native_plans(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for df in (pii.pseudonymise(docs, "k"), queries.op7_mixing(spark, SF_SMALL), queries.op9_licenses(spark, SF_SMALL)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# --- mixing


def mixed(spark, n=400):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        kind = rng.choice(("a", "b", "c"))
        words = [rng.choice(kind * 3 + "xyz") + str(rng.randrange(5)) for _ in range(rng.randrange(1, 60))]
        rows.append((i, " ".join(words), kind, "r"))
    return rows


def test_totals_meet_targets(spark):
    rows = mixed(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, row string")
    model = mixing.fit_classifier(docs, domain_col="kind")
    weights = {"a": 0.7, "b": 0.2, "c": 0.1}
    members = mixing.memberships(docs, model).cache()
    rates, reached = mixing.fit_rates(members, [1000.0, 500.0, 300.0])
    got = rates.collect()
    totals = sum(r.tokens * r.rate * np.array(r.p) for r in got)
    assert np.allclose(totals, [1000, 500, 300], rtol=1e-3) and np.allclose(totals, reached, rtol=1e-9)
    assert min(r.rate for r in got) >= 0
    out = mixing.mix(docs, model, weights).collect()
    right = sum(r.domain == r.kind for r in out) / len(out)
    assert right > 0.9 and len(out) == len(rows)
    for r in out:
        assert r.tokens == len(r.text.split()) and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
    share = sum(r.rate * r.tokens for r in out if r.kind == "a") / sum(r.rate * r.tokens for r in out)
    assert 0.6 < share < 0.8


def test_posteriors_are_naive_bayes(spark, monkeypatch):
    rows = mixed(spark, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, row string")
    model = mixing.fit_classifier(docs, domain_col="kind")
    table = {r.bucket: r.logs for r in model.table.collect()}
    bucket = {r.w: r.b for r in docs.select(F.explode(F.split("text", " ")).alias("w")).select("w", mixing._bucket(F.col("w")).alias("b")).collect()}
    counts = collections.Counter((bucket[w], k) for _, t, k, _ in rows for w in t.split())
    sizes = collections.Counter(k for _, t, k, _ in rows for _ in t.split())
    for b, logs in table.items():
        want = [math.log((counts[b, k] + 0.5) / (sizes[k] + 0.5 * mixing.BUCKETS)) for k in "abc"]
        assert np.allclose(logs, want)
    assert len(table) == mixing.BUCKETS
    for slab in (mixing.SLAB, 2):
        monkeypatch.setattr(mixing, "SLAB", slab)
        for r in mixing.memberships(docs, model).collect():
            words = r.text.split()
            logs = np.array(model.prior) + sum(np.array(table[bucket[w]]) for w in words) / math.sqrt(len(words))
            p = np.exp(logs - logs.max())
            assert np.allclose(r.p, p / p.sum()) and r.tokens == len(words)


def test_tables_of_logs_are_not_carried_by_rows(spark):
    docs = spark.createDataFrame(mixed(spark, 40), "doc_id long, text string, kind string, row string")
    model = mixing.fit_classifier(docs, domain_col="kind")
    plan = mixing.memberships(docs, model)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "AS _slab" not in plan


def test_many_domains(spark):
    rows = [(i, f"word{i % 100} also{i % 100} the", f"d{i % 100:02}", "r") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, row string")
    model = mixing.fit_classifier(docs, domain_col="domain")
    assert len(model.domains) == 100
    out = mixing.mix(docs.drop("domain"), model, {f"d{k:02}": 1.0 + k % 3 for k in range(100)}).collect()
    kinds = {r[0]: r[2] for r in rows}
    assert sum(r.domain == kinds[r.doc_id] for r in out) > 390 and all(r.copies >= 0 for r in out)


def test_a_missed_target_is_told(spark):
    rows = [(i, "a b c" if i else "x y z", "a" if i else "x", "r") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, row string")
    model = mixing.fit_classifier(docs, domain_col="domain")
    with pytest.warns(UserWarning, match="miss the target"):
        mixing.mix(docs.where("doc_id > 0"), model, {"x": 1.0}).collect()


def test_mixing_of_odd_texts(spark):
    odd = [(None, None, "a", "r"), (1, "", "b", "r"), (2, " \n ", None, "r"), (3, "w1 w2", "a", "r"), (3, "w1 w2", "a", "r"), (4, "b1 " * 30_000, "b", "r")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, domain string, row string")
    model = mixing.fit_classifier(docs, domain_col="domain")
    out = mixing.mix(docs, model, {"a": 1.0, "b": 1.0})
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "row", "tokens", "domain", "rate", "copies"] and len(rows) == 6
    assert all(r.rate == 1 and r.copies == 1 for r in rows if not r.tokens)
    assert len({r.rate for r in rows if r.doc_id == 3}) == 1
    none = mixing.fit_classifier(docs.where("false"), domain_col="domain")
    assert {r.copies for r in mixing.mix(docs, none, {}).collect()} == {1}
    assert mixing.mix(docs.where("false"), model, {"a": 1.0}).collect() == []
    for bad in ({"z": 1.0}, {"a": -1.0}, {}):
        with pytest.raises(ValueError, match="weights"):
            mixing.mix(docs, model, bad)


# --- licences


def plain_scan(files, templates, least=licenses.LEAST):
    words = lambda s: re.findall("[a-z0-9]+", s.lower())
    docs = [words(t) for p, t in files if p is not None and t is not None]
    n, vocabulary = len(docs), {w for _, t in templates for w in words(t)}
    df = {w: sum(w in set(d) for d in docs) for w in vocabulary}
    idf = lambda w: math.log((1 + n) / (1 + df[w])) + 1 if w in vocabulary else math.log((1 + n) / 2) + 1

    def vector(ws):
        return {w: ws.count(w) * idf(w) for w in set(ws)}

    def cosine(a, b):
        dot = sum(x * b.get(w, 0) for w, x in a.items())
        return dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    known = [(name, vector(words(t))) for name, t in templates]
    own = {}
    for p, t in files:
        if p is not None and t is not None:
            for line in t.split("\n"):
                if ws := words(line):
                    for name, v in known:
                        c = round(cosine(vector(ws), v), 9)
                        if c >= least:
                            own[p] = min(own.get(p, (0, "")), (-c, name))
    folder = lambda p: p.rpartition("/")[0]
    speaks = {}
    for p in sorted(own):
        if re.search(licenses.LICENCE_FILE, p):
            speaks.setdefault(folder(p), own[p][1])
    out = []
    for p, _ in files:
        if p is None:
            out.append((None, None, None, None))
            continue
        mine = own[p][1] if p in own else None
        at = folder(p)
        while mine is None and at and at not in speaks:
            at = folder(at)
        theirs = speaks.get(at)
        out.append((p, mine, mine or theirs, p if mine else at if theirs else None))
    return sorted(out, key=str)


def test_licences(spark):
    rng = random.Random(4)
    texts_ = [t for _, t in licenses.TEMPLATES]
    files = [("LICENSE", "All rights reserved."), ("a/LICENSE.txt", "x\n" + texts_[0]), ("a/b/COPYING", "nothing here"), ("a/b/c/f.py", "code"),
             ("a/licensed", "no"), ("z", "see the license"), ("z", texts_[4]), ("z", "again"), (None, texts_[0]), ("q/w/e", None), ("q/w/r", "")]
    for k in range(60):
        words = [f"w{rng.randrange(20)}" for _ in range(20)]
        if rng.random() < 0.5:
            t = rng.choice(texts_).split()
            if rng.random() < 0.6:
                t[rng.randrange(len(t))] = "odd"
            words += ["\n", *t, "\n"] if rng.random() < 0.8 else t
        name = rng.choice(("LICENSE", "notice.md", f"f{k}", f"g{k}.txt"))
        files.append((f"r{k % 3}/s{k % 5}/{name}", " ".join(words)))
    # two texts of one path make one file
    once = {}
    for p, t in files:
        once.setdefault(p, []).append(t)
    df = spark.createDataFrame([(p, t, "l", "x") for p, t in files], "path string, text string, licence string, w string")
    out = licenses.scan(df)
    assert out.columns == ["path", "text", "w", "own_licence", "licence", "licence_from"]
    got = sorted(((r.path, r.own_licence, r.licence, r.licence_from) for r in out.collect()), key=str)
    assert got == plain_scan(files, licenses.TEMPLATES)
    assert licenses.scan(df.where("false")).collect() == []


def test_long_line(spark):
    long = "word " * 50_000 + licenses.TEMPLATES[0][1]
    df = spark.createDataFrame([("a", long), ("b", long + "\n" + licenses.TEMPLATES[0][1])], "path string, text string")
    assert {r.path: r.licence for r in licenses.scan(df).collect()} == {"a": None, "b": "MIT"}


def test_whole_licences_and_headers(spark):
    body = {name: text for name, text in licenses.BODIES}
    for name, text in licenses.BODIES:
        plain = licenses._plain(text)
        assert plain.count(licenses._opening(plain)) == 1, name
    holder = "Copyright (c) 2021, The Example Authors. All rights reserved.\n\n"
    header = "\n".join("# " + x for x in (
        "Copyright 2020 Somebody. This program is free software: you can redistribute it", "and/or modify it under the terms of the GNU General Public",
        "License as published by the Free Software Foundation, either version 3 of the", "License, or (at your option) any later version. It comes without any warranty.",
    ))
    want = {
        "LICENSE": (holder + body["MIT"], "MIT"),
        "one_line": ("The licence. " + " ".join(body["MIT"].split()), "MIT"),
        "bsd3": ("BSD\n" + holder + body["BSD-3-Clause"].replace("the copyright holder", "Example Inc."), "BSD-3-Clause"),
        "bsd2": (holder + body["BSD-2-Clause"], "BSD-2-Clause"),
        "code.c": ("/*\n" + "".join(f" * {x}\n" for x in body["ISC"].split("\n")) + " */\n" + "int main(void) { return run(); }\n" * 300, "ISC"),
        **{f"full/{x}": (body[x].replace("\n", "\r\n"), x) for x in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")},
        "header.py": (header + "\n\nx = 1\n" * 50, "GPL-3.0"),
        "header2.py": (header.replace("version 3", "version 2"), "GPL-2.0"),
        "wrapped": ("A tool for many things. This software is distributed under the\nterms of the MIT license. It has no other terms.", "MIT"),
        "title": ("MIT License", "MIT"),
        "old": ("This work is licensed under the GNU General Public License, version 1.", None),
        "prose": ("The terms of the house: nobody is granted free entry, and the above notice appears in all copies.", None),
    }
    noise = [(f"n/{k}/f", f"word{k} the tool runs and the parser reads line {k} of a file") for k in range(40)]
    df = spark.createDataFrame([(p, t) for p, (t, _) in want.items()] + noise, "path string, text string")
    got = {r.path: r.own_licence for r in licenses.scan(df).collect()}
    assert {p: got[p] for p in want} == {p: x for p, (_, x) in want.items()}
    assert not any(got[p] for p, _ in noise)


def test_nearest_takes_no_list_of_queries_apart(spark, monkeypatch):
    # a row for each pair of a query and a row it meets grows much faster than the table
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist(), 1, "x") for i in range(300)]
    plans = []

    def stored(df, name, keep=ann.stored):
        plans.append(df._jdf.queryExecution().toString().lower())
        return keep(df, name)

    monkeypatch.setattr(ann, "stored", stored)
    monkeypatch.setattr(ann, "PIECE", 100)
    out = ann.nearest(vectors(spark, rows), F.col("id") % 5 == 0).collect()
    assert len(out) == 60 * ann.NEAREST
    assert plans and not any("explode(places" in p for p in plans)
