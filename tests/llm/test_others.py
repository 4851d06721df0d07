"""Pieces, mixing, fingerprints, language, toxicity, neighbours, secrets and the pipeline."""

import base64
import hashlib
import re
import zlib

import brute
import numpy as np
import pytest
from conftest import prose
from pyspark.sql import functions as F

from tipoff.llm import fingerprints, language, mixing, neighbours, pieces, secrets, toxicity


# --- pieces


def test_pieces_round_trip(docs, fixture_rows):
    enc = pieces.encode(docs)
    assert enc.count() == docs.count() and enc.filter("not lossless").count() == 0
    back = {r.doc_id: r.text for r in pieces.decode(enc).collect()}
    assert all(back[i] == (t or "") for i, t in fixture_rows)
    again = {(r.doc_id, tuple(r.pieces)) for r in pieces.encode(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, tuple(r.pieces)) for r in enc.collect()}


def test_pieces_vary_with_key_and_follow_the_lattice():
    vocab = pieces.Pieces(pieces.read_model(pieces.MODEL))
    data = np.frombuffer(b"the" * 1, np.uint8)
    seen = {}
    for key in range(4000):
        ids, n = pieces.sample(data, np.array([0, 3]), np.array([key]), vocab)
        assert n[0] == len(ids)
        seen[tuple(ids)] = seen.get(tuple(ids), 0) + 1
    # exact path weights of a tiny lattice
    w = {}
    flat = {bytes(b): (i, x) for b, i, x in ((vocab.raw[i], i, x) for i, x in zip(vocab.ids.tolist(), vocab.weight.tolist(), strict=True))}

    def walk(at, ids, total):
        if at == 3:
            w[tuple(ids)] = np.exp(total)
            return
        for e in range(at + 1, 4):
            b = data[at:e].tobytes()
            if b in flat:
                walk(e, [*ids, flat[b][0]], total + flat[b][1])

    walk(0, [], 0.0)
    z = sum(w.values())
    for path, x in w.items():
        assert abs(seen.get(path, 0) / 4000 - x / z) < 0.03


@pytest.mark.parametrize("text", ["x" * 300_000, "".join(hashlib.sha256(str(k).encode()).hexdigest() for k in range(5000)), "漢字" * 50_000])
def test_pieces_of_long_unspaced_texts(text):
    """A text without spaces is encoded whole in seconds, and its draws don't depend on what stands beside it."""
    import time

    vocab = pieces.Pieces(pieces.read_model(pieces.MODEL))
    data = np.frombuffer(text.encode(), np.uint8)
    began = time.perf_counter()
    ids, n = pieces.sample(data, np.array([0, len(data)]), np.array([3]), vocab)
    assert time.perf_counter() - began < 20 and n.tolist() == [len(ids)] and (vocab.decode(ids) == data).all()
    both = np.frombuffer(b"a b" + text.encode(), np.uint8)
    again, n = pieces.sample(both, np.array([0, 3, len(both)]), np.array([9, 3]), vocab)
    assert (again[n[0] :] == ids).all()


def test_long_units_follow_the_same_law(monkeypatch):
    """A unit that is filtered by itself draws what the vectorised lattice draws."""
    vocab = pieces.Pieces(pieces.read_model(pieces.MODEL))
    data = np.frombuffer("thequickbrownföxthequick".encode(), np.uint8)

    def draws():
        return [pieces.sample(data, np.array([0, len(data)]), np.array([k]), vocab)[0].tolist() for k in range(300)]

    want = draws()
    monkeypatch.setattr(pieces, "LONG", 3)
    monkeypatch.setattr(pieces, "LONG_STEP", 5)
    assert draws() == want and len({tuple(x) for x in want}) > 5


def test_op1_returns_its_pieces(spark):
    out = pieces.op1_piece_sampling(spark, "/root/testdata/sf0.001").collect()
    assert all(len(r.pieces) == r.n_pieces and r.lossless and brute.sha(np.array(r.pieces, "<i4").tobytes()) == r.pieces_sha256 for r in out)


# --- mixing


def test_targets():
    t = mixing.targets([100, 10, 1000], [5.0, 2.0, 1.0])
    assert t[:2] == [300.0, 30.0] and abs(sum(t) - 1110) < 1e-9
    assert mixing.targets([], []) == [] and mixing.targets([0], [5.0]) == [0.0]


def test_permutation():
    for n in (1, 2, 3, 17, 1000):
        got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 5, np.uint64))
        assert sorted(got.tolist()) == list(range(n))


def test_mix(docs, fixture_rows, no_docs):
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(fixture_rows) + 2
    size = {i: len(brute.WORD.findall(t or "")) for i, t in fixture_rows}
    by = {}
    for r in out:
        assert r.doc_id is None or r.size == size[r.doc_id]
        assert r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in out)
    assert abs(sum(x[0].target for x in by.values()) - total) < 1e-6
    for x in by.values():
        assert x[0].source_size == sum(r.size for r in x)
        assert abs(sum(r.taken for r in x) - x[0].target) <= 0.05 * x[0].target + 2 * mixing.BLOCK
    order = sorted(by, key=lambda s: (s is None, s or ""))
    assert order == ["a", "b", None]
    again = sorted((str(r.doc_id), r.taken) for r in mixing.mix_sources(docs.repartition(7)).collect())
    assert again == sorted((str(r.doc_id), r.taken) for r in out)
    assert mixing.mix_sources(no_docs).count() == 0


# --- fingerprints


def edited(rows):
    """{doc_id: (n_chars, sha256 of the edited text)} for rows with ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        out[i] = (len(t), hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("span", [2048, 4])
def test_fingerprints(spark, fixture_rows, monkeypatch, span):
    monkeypatch.setattr(fingerprints, "RANGE_DOCS", span)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in fixture_rows], "doc_id long, text string, rng int, nth int").repartition(3)
    out = {r.doc_id: r for r in fingerprints.fingerprint(df, min_share=0.02, max_share=0.5).collect()}
    assert {i: (r.n_chars, r.edited_sha256) for i, r in out.items()} == edited(fixture_rows)
    text = {i: t or "" for i, t in fixture_rows}
    for a in out:
        assert 0 <= out[a].near_edited <= 1 and 0 <= out[a].near_next <= 1
        for b in out:
            if text[a] == text[b]:
                assert out[a].fingerprint == out[b].fingerprint
    assert out[41].near_next == 1.0 and text[41] == text[40]
    assert out[11].fingerprint != out[20].fingerprint


def test_fingerprints_odd_tables(spark, docs, no_docs):
    assert fingerprints.fingerprint(no_docs).count() == 0
    assert fingerprints.fingerprint(docs).count() == docs.count()
    one = fingerprints.fingerprint(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == brute.sha("abab") and one[0].near_next == 1.0


# --- language and toxicity


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_language(spark, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "zz").otherwise(F.col("lang")))
    out = {r.doc_id: r for r in language.identify(hidden).collect()}
    true = {r.doc_id: r.lang for r in docs.collect()}
    tested = [i for i in out if held_out(i)]
    assert tested and np.mean([out[i].lang_pred == true[i] for i in tested]) > 0.95
    assert all(0 <= r.score <= 1 and r.lang_pred != "zz" for r in out.values())
    assert language.identify(no_docs).count() == 0


def test_mixture_and_und(spark, docs):
    en, fr = "the and of with that was here ", "être dans pour avec leur cette "
    train = [(i, en * 20, "en") for i in range(0, 40, 2)] + [(i, fr * 20, "fr") for i in range(1, 40, 2)]
    test = [(100, en * 9 + fr * 3, None), (101, None, None), (102, "123 !!! 😀", None), (103, "", None), (104, fr * 5, None)]
    out = {r.doc_id: r for r in language.identify(spark.createDataFrame([*train, *test], "doc_id long, text string, lang string")).collect()}
    assert out[100].lang_pred == "en" and 0.6 < out[100].score < 0.9
    assert [out[i].lang_pred for i in (101, 102, 103)] == ["und"] * 3 and out[104].lang_pred == "fr"
    got = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert got[0] == "und" and got[44] == "und" and got[6] in ("en", "fr")


def test_maximal_segments():
    """Against the definition: peel off the best segment, then those of the two sides."""

    def best(s, lo, hi):
        top = (0.0, None)
        for a in range(lo, hi):
            for b in range(a + 1, hi + 1):
                if sum(s[a:b]) > top[0] + 1e-12:
                    top = (sum(s[a:b]), (a, b))
        return top

    def peel(s, lo, hi):
        t, at = best(s, lo, hi)
        return [] if at is None else [*peel(s, lo, at[0]), (at[0], at[1] - 1, t), *peel(s, at[1], hi)]

    r = np.random.default_rng(3)
    for _ in range(60):
        n = 14
        pos = np.flatnonzero(r.random(n) < 0.4)
        x = r.normal(1, 1.3, len(pos))
        s = [-0.25] * n
        for p, v in zip(pos, x, strict=True):
            s[p] = v
        got = toxicity.maximal_segments(pos, x, 0.25)
        want = peel(s, 0, n)
        assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])


def test_toxicity_held_out(spark, docs, no_docs):
    r = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(400):
        w = prose(1000 + i, 80)
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            w[int(r.integers(80))] = str(r.choice(["vilescum", "vilerat", "vilefool"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {x.doc_id: x.score for x in toxicity.score_toxicity(d, lab).collect()}
    test = [i for i in out if held_out(i)]
    assert np.mean([(out[i] >= 0.3) == (i % 5 == 0) for i in test]) > 0.97
    assert sorted(x.doc_id for x in toxicity.drop_toxic(d, lab).collect() if held_out(x.doc_id)) == sorted(i for i in test if out[i] < 0.3)
    both = toxicity.score_toxicity(docs, lab)
    assert both.count() == docs.count() and both.filter("score is null or score < 0 or score > 1").count() == 0
    none = lab.filter("false")
    assert {x.score for x in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    assert toxicity.score_toxicity(no_docs, lab).count() == 0


# --- neighbours


def exact(vecs, k):
    ids = sorted(vecs)
    x = np.array([vecs[i] for i in ids])
    out = {}
    for i in ids:
        s = (x * np.array(vecs[i])).sum(1)
        order = sorted((-s[j], j_id) for j, j_id in enumerate(ids) if j_id != i)
        out[i] = [(j, -v) for v, j in order[:k]]
    return out


def test_neighbours(spark):
    r = np.random.default_rng(2)
    vecs = {i: r.normal(size=16).tolist() for i in range(600)}
    vecs |= {600 + i: vecs[0] for i in range(40)}  # copies: ties go to the smaller id
    rows = [(i, v, "x") for i, v in vecs.items()]
    rows += [(900, None, "x"), (901, [0.0] * 16, "x"), (902, [float("nan")] * 16, "x"), (903, [None] * 16, "x"), (904, [1.0] * 3, "x"), (None, [1.0] * 16, "x"), rows[1]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    out = neighbours.nearest(df, df.filter("vec_id % 20 = 0"), data_block=200, query_block=10).collect()
    want = {i: x for i, x in exact(vecs, 20).items() if i % 20 == 0}
    got = {}
    for x in sorted(out, key=lambda x: (x.query_id, x.rank)):
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    assert set(got) == set(want)
    recall = np.mean([len({a for a, _ in got[i]} & {a for a, _ in want[i]}) / 20 for i in want])
    assert recall >= 0.9
    assert [a for a, _ in got[0]] == [a for a, _ in want[0]]
    for i in got:
        assert all(abs(s - float(np.dot(vecs[i], vecs[a]))) < 1e-9 for a, s in got[i])
    assert neighbours.nearest(df.filter("false"), df).count() == 0
    few = neighbours.nearest(df.filter("vec_id < 3"), df.filter("vec_id = 0")).collect()
    assert [x.rank for x in few] == [1, 2]


def test_the_stopping_test_rules_out_cells_and_vectors(spark):
    """Vectors of few real dimensions: most cells and nearly all vectors are never looked at, and the true neighbours are found."""
    g = np.random.default_rng(5)
    x = np.c_[np.sin(g.uniform(0, 2, (6000, 2)) @ g.standard_normal((2, 40))), np.ones(6000)]
    ids, q = np.arange(6000), np.arange(0, 6000, 60)
    space = neighbours.Space(41, float((x * x).sum(1).max()))
    want = np.argsort(-(x[q] @ x.T) + 1e9 * (ids == q[:, None]), axis=1, kind="stable")[:, :20]
    who, row, _, verified = neighbours.search(x, ids, x[q], q, np.full(100, -np.inf), space, 20)
    assert np.mean([len(set(want[i]) & set(row[who == i])) / 20 for i in range(100)]) >= 0.92 and verified.mean() < 0.1 * 6000
    points = space.points(x)
    space.fit(points, 64)
    cell = space.cell(points)
    low, high = (np.array([f(points[cell == c], axis=0) for c in range(64)]) for f in (np.min, np.max))
    at, scale = space.queries(x[q])
    kth = 2 * space.bound - 2 * scale * (x[q] * x[want[:, 19]]).sum(1)
    assert (neighbours.box_distance(at, low, high) <= neighbours.BEYOND * kth[:, None]).mean() < 0.4
    df = spark.createDataFrame(list(zip(ids[:2000].tolist(), x[:2000].tolist())), "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.filter("vec_id % 60 = 0"), data_block=64, query_block=16).collect()
    true = {i: x for i, x in exact(dict(enumerate(x[:2000].tolist())), 20).items() if i % 60 == 0}
    assert np.mean([len({r.vec_id for r in got if r.query_id == i} & {j for j, _ in true[i]}) / 20 for i in true]) >= 0.9


def test_chi_square():
    assert abs(neighbours.quantile(0.95, 8) - 15.507) < 1e-3 and abs(neighbours.quantile(0.92, 16) - 24.3) < 0.4
    assert abs(float(neighbours.chi_square_cdf(15.507, 8)) - 0.95) < 1e-4 and float(neighbours.chi_square_cdf(0, 8)) == 0.0


# --- secrets


KEY = base64.b64encode(bytes([0x30, 0x1B, 2, 1, 0, 0x30, 5, 6, 3, 0x2B, 0x65, 0x70, 4, 15]) + bytes(range(15))).decode()
JWT = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (b'{"alg":"HS256","typ":"JWT"}', b'{"sub":"1"}', b"sig"))
HIDDEN = base64.b64encode(b"password = hunter2hunter2").decode()


def base_by_hand(t):
    """Straight from the contract, without prefilters."""
    a = [(m.start(), m.end(), "assign") for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    a += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    a += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(a, key=lambda x: (x[0], secrets.BASE.index(x[2])))


CASES = [
    "é token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" x", "PASSWORD: short", "Password:abcdef", "ſecret=abcdefgh", "AKIA1234", "AKIA" + "A" * 16, "AKIAAKIA" + "0" * 12, "deadbeef" * 3, "deadbeef" * 2,
    f"pem {KEY}", f"jwt {JWT}", f"hid {HIDDEN}", "apikey='a'apikey=abcdefg", "token = token = abcdefgh", "x" * 40, "b" * 23, "c" * 5000, "漢字 secret: " + "s" * 3000,
]


def test_secrets(spark, docs, no_docs):
    rows = [(i, t) for i, t in enumerate(CASES)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = {r.doc_id: list(zip(r.starts, r.ends, r.kinds, strict=True)) for r in secrets.find_secrets(df).collect()}
    for i, t in rows:
        assert [x for x in out[i] if x[2] in secrets.BASE] == base_by_hand(t), t
    assert [x[2] for x in out[9]] == ["der"] and [x[2] for x in out[10]] == ["jwt"] and [x[2] for x in out[11]] == ["encoded"]
    masked = {r.doc_id: r.text for r in secrets.redact_secrets(df).collect()}
    assert masked[9] == "pem [DER]" and masked[0] == "é [ASSIGN] x" or "[ASSIGN]" in masked[0]
    assert masked[14] == "x" * 40
    got = secrets.find_secrets(docs)
    assert got.count() == docs.count()
    assert secrets.find_secrets(no_docs).count() == 0
    assert secrets.redact_secrets(docs).columns == docs.columns


def test_secret_runs_do_not_hide_across_texts(spark):
    """Neighbouring texts in one buffer: a run that starts in one text must not mask the next text's own."""
    rows = [(1, "a" * 200), (2, "d" * 30), (3, "tok"), (4, "en = abcdefgh")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r.doc_id: list(r.kinds) for r in secrets.find_secrets(df).collect()} == {1: ["hex"], 2: ["hex"], 3: [], 4: []}


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + body


INT = der(2, b"\x11" * 40)
PKCS1 = der(0x30, der(2, b"\0"), *[INT] * 8)
RSA = der(0x30, der(2, b"\0"), der(0x30, der(6, bytes.fromhex("2a864886f70d010101")), der(5)), der(4, PKCS1))
SEC1 = der(0x30, der(2, b"\1"), der(4, bytes(range(32))))
SSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + b"\0\0\0\1" + bytes(40)
LOCKED = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30)), der(4, bytes(48)))
code = lambda b: base64.b64encode(b).decode()
block = lambda label, body: f"-----BEGIN {label}-----\n{body}\n-----END {label}-----"
ADDED_CASES = [  # text, kinds and the text of each added span
    (f"see {block('RSA PRIVATE KEY', code(PKCS1))}.", [("pem", block("RSA PRIVATE KEY", code(PKCS1)))]),
    (block("PRIVATE KEY", "\n".join(code(RSA)[k : k + 64] for k in range(0, len(code(RSA)), 64))), ["pem"]),
    (block("OPENSSH PRIVATE KEY", code(SSH)), ["pem"]),
    (block("ENCRYPTED PRIVATE KEY", code(LOCKED)), ["pem"]),
    (block("RSA PRIVATE KEY", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n" + code(bytes(64))), ["pem"]),
    ("-----BEGIN PRIVATE KEY-----see docs-----END PRIVATE KEY-----", []),
    (block("PRIVATE KEY", code(b"no key in here, only text")), []),
    (block("PRIVATE KEY", code(RSA[:-3])), []),
    ("-----BEGIN PRIVATE KEY-----\n" + block("EC PRIVATE KEY", code(SEC1)), [("pem", block("EC PRIVATE KEY", code(SEC1)))]),
    (f"raw {code(RSA)}", [("der", code(RSA))]),
    (f"raw {code(SEC1)} and {code(SSH)}", [("der", code(SEC1)), ("ssh", code(SSH))]),
    (f"broken {code(der(0x30, der(2, bytes(1)), der(0x30, der(6, bytes.fromhex('2a864886f70d010101'))), der(4, PKCS1[:-1])))}", []),
    (f"HEX {SEC1.hex().upper()}", [("der", SEC1.hex().upper())]),
    (f"HEX {SSH.hex().upper()}", [("ssh", SSH.hex().upper())]),
    (f"a.{JWT}", [("jwt", JWT)]),
    (f"x{JWT} {JWT}", [("jwt", JWT), ("jwt", JWT)]),
    (".".join(JWT.split(".")[:2]) + ".", [("jwt", ".".join(JWT.split(".")[:2]) + ".")]),
    (".".join(JWT.split(".")[:2]), []),
    ("eyJub3QiOiJhIGhlYWRlciJ9.e30.sig", []),
    (code(code(b"secret=hunter2hunter2").encode()), ["encoded"]),
]


@pytest.mark.parametrize("k", range(len(ADDED_CASES)))
def test_added_spans(k):
    text, want = ADDED_CASES[k]
    got = [(kind, text[a:b]) for a, b, kind in secrets.find(text) if kind not in secrets.BASE]
    assert [x[0] for x in got] == [w if isinstance(w, str) else w[0] for w in want]
    assert all(isinstance(w, str) or g == w for g, w in zip(got, want))


@pytest.mark.parametrize("unit", ["eyJ", "eyJ.", "eyJhbGciOiJub25lIn0.", "-----BEGIN PRIVATE KEY-----\n", "-----BEGIN PRIVATE KEY-----\n-----END ", "AKIA", "password ", "deadbeefdeadbeefdeadbeefdeadbeef ", "a: b\n", f"{HIDDEN} ", "-----END PRIVATE KEY-----"])
def test_hostile_texts_take_linear_time(unit):
    import time

    text = unit * (1_000_000 // len(unit))
    began = time.perf_counter()
    secrets.find(text)
    assert time.perf_counter() - began < 10


# --- pipeline


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:4]:
        nxt = stage(spark, seen[-1], sf)
        assert nxt.columns == docs.columns and nxt.dtypes == docs.dtypes
        seen.append(spark.createDataFrame(nxt.toPandas(), docs.schema))
    ids = [{r.doc_id for r in d.collect()} for d in seen]
    want = brute.jaccard_components([(r.doc_id, r.text) for r in seen[1].collect()])
    assert ids[2] == {i for i, (_, c) in want.items() if i == c}
    assert ids[3] == ids[2] and ids[4] <= ids[3]
    for r in seen[3].collect():
        assert not base_by_hand(r.text or "")
    out = corpus_pipeline.run(spark, sf)
    assert out.filter("not lossless").count() == 0 and {r.doc_id for r in out.select("doc_id").collect()} == ids[4]


def test_pipeline_mix_meets_targets(spark):
    """Words by source after the stage against the targets on the stage's input: down-weighted sources lose words."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD))
    out = {r.source: r.w for r in corpus_pipeline.mix(spark, docs, sf).groupBy("source").agg(F.sum(words).alias("w")).collect()}
    per = {r.source: r for r in mixing.mix_sources(docs).groupBy("source").agg(F.max("target").alias("target"), F.sum("size").alias("w"), F.max("size").alias("top")).collect()}
    assert any(r.target < 0.9 * r.w for r in per.values())
    for s, r in per.items():
        assert abs(out.get(s, 0) - r.target) <= 0.05 * r.target + r.top


def test_copies_follow_words_taken(spark):
    """A fraction of a copy is one or none, also for rows that share a doc_id or have none."""
    rows = [(k if k % 5 else None, 100 + k % 7, "a", 0, 0.0, (k * 13) % 250) for k in range(400)] + [(7, 90, "b", 0, 0.0, 30)] * 3 + [(8, 0, "b", 0, 0.0, 0)]
    taken = spark.createDataFrame(rows, "doc_id long, size long, source string, source_size long, target double, taken long")
    got = {(r.doc_id, r.source, r.size): r.copies for r in mixing.copies(taken, len(rows)).collect()}
    assert (8, "b", 0) not in got and 0 in got.values() and 2 in got.values()
    share = {}
    for i, n, s, _, _, w in rows:
        share.setdefault((i, s, n), []).append(w / n if n else 0)
    for k, c in got.items():
        assert abs(c - sum(share[k]) / len(share[k])) < 1
    words = sum(n * got[i, s, n] for i, n, s, *_ in rows if n and s == "a")
    assert abs(words - sum(r[5] for r in rows if r[2] == "a")) < max(n * len(share[i, s, n]) for i, n, s, *_ in rows)
