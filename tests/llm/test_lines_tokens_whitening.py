"""Line dedup, token alignment and whitening: odd rows, brute-force twins, planted spectra."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktally.llm import queries as Q, token_alignment as ta, whitening as wh
from stocktally.llm.common import table
from stocktally.llm.line_dedup import dedup_lines

SMALL = "/root/testdata/sf0.01"
TEXTS = "doc_id long, text string"
BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SMALL, "documents")


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- line dedup


def dedup_by_force(data, least_chars=20, least_docs=3):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    holders = defaultdict(list)
    for r, (i, t) in enumerate(data):
        for k in {key(x) for x in (t or "").split("\n")}:
            holders[k].append((r, i))
    last = {k: max((i for _, i in h if i is not None), default=None) for k, h in holders.items() if len(k) >= least_chars and len(h) >= least_docs}
    out = []
    for i, t in data:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


LINE = "A line of at least twenty signs É"
SHARED = [
    (1, f"own\n{LINE}\n\nshort\nshort"), (2, f" \t{LINE.lower().replace('é', 'É')}\r\nown two"), (3, f"{LINE}\n{LINE}\x0b"), (3, f"x\n{LINE}"), (None, LINE), (None, None), (5, ""),
    (6, "short\n\x1cA line of at least twenty signs É"), (7, "only two documents hold this\n" * 2), (8, "only two documents hold this"), (9, "x" * 19), (10, "x" * 19), (11, "x" * 19 + " "),
    (None, "held by rows without an id"), (None, "held by rows without an id"), (None, "held by rows without an id\n"), (12, "é" * 20), (13, "é" * 20), (14, "é" * 20), (15, "É" * 20),
]


def test_lines_against_force(spark):
    docs = spark.createDataFrame(SHARED, TEXTS).withColumns({c: F.lit("mine") for c in ("N_LINES", "kept_text", "__text", "extra")})
    got = dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "__text", "extra", "n_lines", "n_dropped", "kept_text"]
    as_rows = lambda data: sorted(map(str, data))
    assert as_rows(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()) == as_rows(dedup_by_force(SHARED))
    assert {(r["__text"], r["extra"]) for r in rows(got)} == {("mine", "mine")}
    assert dedup_lines(docs.limit(0)).count() == 0


def test_lines_of_random_documents(spark):
    rng = np.random.default_rng(7)
    pool = [("word " * 5 + str(k)) for k in range(40)] + ["tiny", "", "  " + "Word " * 5 + "3"]
    data = [(int(rng.integers(0, 60)), "\n".join(rng.choice(pool, rng.integers(0, 9)))) for _ in range(80)]
    for least in (2, 3, 10):
        got = dedup_lines(spark.createDataFrame(data, TEXTS), least_docs=least, keep=["doc_id"])
        assert sorted(map(tuple, got.collect())) == sorted(dedup_by_force(data, least_docs=least))


def test_lines_without_a_broadcast(spark, documents, monkeypatch):
    import stocktally.llm.common as common
    import stocktally.llm.line_dedup as ld

    want = sorted(map(tuple, dedup_lines(documents, keep=["doc_id"]).collect()))
    monkeypatch.setattr(ld, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, dedup_lines(documents, keep=["doc_id"]).collect())) == want


def test_long_texts_take_linear_time_and_no_python(spark):
    data = [(k, "\n".join(f"this line is long enough {i}" for i in range(30_000))) for k in range(3)] + [(9, "word " * 100_000)]
    got = dedup_lines(spark.createDataFrame(data, TEXTS), keep=["doc_id"])
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in rows(got.drop("kept_text"))} == {0: (30_000, 30_000), 1: (30_000, 30_000), 2: (30_000, 0), 9: (1, 0)}
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# --- token alignment


@pytest.fixture(scope="module")
def sides():
    return ta.ByteBpe.read(f"{Q.TOKENIZERS}/byte_bpe_50k.json"), ta.PieceModel.read(f"{Q.TOKENIZERS}/piece_bpe_32k.model")


def align_by_force(data, sides):
    """Straight from the libraries, with sets of ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(sides[0].text)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=sides[1].model)
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in prints} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in prints)}
    per, pairs = [], Counter()
    for i, t in data:
        entry = [i, 0, 0, "", []]
        if t:
            want = (" " + t).encode()
            enc, ids = a.encode(" " + t, add_special_tokens=False), b.encode(t)
            bytes_a = [bytes(letters[c] for c in x) for x in enc.tokens]
            bytes_b = [bytes([int(p[3:-1], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(ids, b.id_to_piece(ids), strict=True)]
            if b"".join(bytes_a) == want == b"".join(bytes_b):
                ends = [list(np.cumsum([len(x) for x in s])) for s in (bytes_a, bytes_b)]
                both = sorted(set(ends[0]) & set(ends[1]))
                groups, link, x, y = [], [], 0, 0
                for e in both:
                    p, q = ends[0].index(e) + 1, ends[1].index(e) + 1
                    groups.append(",".join(map(str, enc.ids[x:p])) + "|" + ",".join(map(str, ids[y:q])))
                    link.append((enc.ids[p - 1], ids[q - 1]))
                    x, y = p, q
                entry = [i, len(enc.ids), len(ids), ";".join(groups), link]
                pairs.update(link)
        per.append(entry)
    best = defaultdict(int)
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    return [
        (i, n, m, len(link), len(link), sum(pairs[p] == best[p[1]] for p in link), sum(pairs[p] for p in link), hashlib.sha256(text.encode()).hexdigest() if link else "")
        for i, n, m, text, link in per
    ]


ODD = [
    (1, None), (2, ""), (3, " "), (4, "<|endoftext|> <s> <0x0A> </s>"), (5, "é 你好 😀́\tx\n\n  y"), (6, "a ▁ b"), (6, "a ▁ b"), (None, "no id, no id"), (None, "no id, no id"),
    (7, "\x00\x01 \x1c"), (8, "internationalization's " * 40), (9, "a"), (10, "  leading and trailing  "), (11, "ß" * 500), (12, "x" * 12_000 + " y"),
]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_against_force(spark, sides, documents):
    data = ODD + [(r.doc_id, r.text) for r in documents.limit(60).collect()]
    docs = spark.createDataFrame(data, TEXTS).repartition(5).withColumns({c: F.lit("mine") for c in ("N_A", "groups_sha256", "__a", "__row", "extra")})
    got = ta.align_tokenizers(docs, *sides, digest=True, work=7)
    assert sorted(map(str, map(tuple, got.select(*COLUMNS).collect()))) == sorted(map(str, align_by_force(data, sides)))
    assert got.select("extra").distinct().collect()[0][0] == "mine" and "text" in got.columns
    assert ta.align_tokenizers(docs.limit(0), *sides).count() == 0


def test_alignment_in_parts_without_a_whole_broadcast(spark, sides, documents, monkeypatch):
    docs = documents.select("doc_id", "text")
    want = sorted(map(tuple, ta.align_tokenizers(docs, *sides, digest=True, keep=["doc_id"]).collect()))
    monkeypatch.setattr(ta, "BROADCAST_ROWS", 50)
    assert sorted(map(tuple, ta.align_tokenizers(docs, *sides, digest=True, keep=["doc_id"]).collect())) == want


def test_groups_hold_all_ids(spark, sides):
    docs = spark.createDataFrame([(1, "Groups hold all ids of both sides.")], TEXTS)
    r = rows(ta.align_tokenizers(docs, *sides))[0]
    al = ta.Aligner(sides)
    a, b = al.tokens(["Groups hold all ids of both sides."])
    halves = [g.split("|") for g in r["groups"].split(";")]
    assert [int(x) for h in halves for x in h[0].split(",")] == a[0].tolist() and [int(x) for h in halves for x in h[1].split(",")] == b[0].tolist()
    assert len(halves) == r["n_groups"] and all(b"".join(al.a.stands[int(x)] for x in p.split(",")) == b"".join(al.b.stands[int(x)] for x in q.split(",")) for p, q in halves)


@pytest.mark.parametrize("work", [1, 2, 3, 64, 10_000])
def test_merge_pieces_of_any_size(work):
    rng = np.random.default_rng(work)
    for n, m in ((0, 0), (0, 3), (5, 0), (1, 1), (200, 300), (300, 20)):
        a, b = (np.sort(rng.choice(1000, k, replace=False)) for k in (n, m))
        i, j = ta.links(a, b, work)
        assert a[i].tolist() == sorted({*a.tolist()} & {*b.tolist()}) == b[j].tolist()


def test_diagonals_cut_equal_work():
    a, b = np.arange(0, 4000, 2), np.arange(0, 9000, 9)
    d = np.arange(0, len(a) + len(b) + 1, 100)
    i = ta.merge_path(a, b, d)
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    assert i.tolist() == [sum(side == 0 for _, side in merged[:k]) for k in d]


def test_ranked_encoder_gives_the_files_own_ids(sides):
    from tokenizers import Tokenizer

    assert sides[0]._ranked()
    own = Tokenizer.from_str(sides[0].text)
    own.encode_special_tokens = True
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(1, 0xD7FF, 40))) for _ in range(300)] + ["".join(rng.choice(list("ab 's\n\t1é"), 50)) for _ in range(300)] + [t for _, t in ODD if t]
    assert sides[0].open().encode(texts) == [e.ids for e in own.encode_batch([" " + t for t in texts], add_special_tokens=False)]


# --- whitening


@pytest.mark.parametrize("n", [1, 2, 3, 9, 40])
def test_leading_eigenpairs(n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, n))
    q = np.linalg.qr(x)[0]
    spread = [x @ x.T, np.eye(n) * 3, np.zeros((n, n)), np.outer(x[0], x[0]), -x @ x.T, q @ np.diag(np.r_[np.full(min(3, n), 5.0), np.ones(n - min(3, n))]) @ q.T,
              q @ np.diag(10.0 ** -np.arange(n).clip(0, 14)) @ q.T * 1e6, q @ np.diag(1 + 1e-9 * np.arange(n)) @ q.T]
    for a in spread:
        a = (a + a.T) / 2
        w, v = wh.leading(a, 8)
        want = np.linalg.eigvalsh(a)[::-1][:8]
        scale = max(np.abs(a).max(), 1e-300) * n
        assert np.abs(w - want).max() <= 1e-13 * scale and np.abs(v.T @ v - np.eye(len(w))).max() < 1e-12 and np.abs(a @ v - v * w).max() <= 1e-13 * scale


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 30):
        a = rng.normal(size=(n, n))
        a = a + a.T
        for shift in rng.normal(size=10) * n:
            assert wh.inertia(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert wh.inertia(np.zeros((4, 4)), 0.0) == 0 and wh.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def whiten_by_force(data, k=8):
    good = [(i, v) for i, v in data if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in good]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    y = np.array(x) - np.array(s) / n
    e, vectors = np.linalg.eigh(y.T @ y / n)
    e, vectors = e[::-1][:k], vectors[:, ::-1][:, :k]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    return [i for i, _ in good], n, deviation, y @ vectors / np.sqrt(e), e / np.trace(y.T @ y / n)


def test_whitening_against_numpy(spark):
    data = [(r.vec_id, r.embedding) for r in table(spark, SMALL, "embeddings").limit(200).collect()]
    odd = [(1000, None), (1001, [None] * 64), (1002, [float("nan")] * 64), (1003, [float("inf")] * 64), (1004, [3e38] * 64), (1005, []), (1006, [1.0]), (data[0][0], data[0][1]), (None, data[1][1])]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>").repartition(7).withColumns({c: F.lit("mine") for c in ("N", "whitened", "__vector", "extra")})
    ids, n, deviation, white, explained = whiten_by_force(data + odd[-2:])
    got = wh.whiten(df)
    assert got.select("extra").distinct().collect()[0][0] == "mine"
    by_id = defaultdict(list)
    for r in rows(wh.by_component(got, ["vec_id"])):
        by_id[r["vec_id"]].append(r)
    assert sorted(by_id, key=str) == sorted(set(ids), key=str) and sum(map(len, by_id.values())) == 8 * n
    sign = np.ones(8)
    for at, (i, want) in enumerate(zip(ids, white, strict=True)):
        for r in by_id[i]:
            c = r["component"] - 1
            if at == 0:
                sign[c] = np.sign(r["whitened"] * want[c])
            assert abs(sign[c] * r["whitened"] - want[c]) < 1e-8 and abs(r["explained"] - explained[c]) < 1e-10
            assert r["n"] == n and r["deviation"] == deviation[at] and 0 <= r["identity_error"] < 1e-9


def test_whitening_of_few_and_equal_vectors(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0, 3.0])] * 3, "vec_id long, embedding array<float>")
    assert [(r["whitened"], r["deviation"], r["n"], r["identity_error"]) for r in rows(wh.whiten(one))] == [([], 0, 3, 0.0)] * 3
    two = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 3.0])], "vec_id long, embedding array<float>")
    assert sorted(abs(r["whitened"][0]) for r in rows(wh.whiten(two))) == pytest.approx([1, 1]) and wh.by_component(wh.whiten(two), ["vec_id"]).count() == 2
    assert wh.whiten(one.limit(0)).count() == 0 and wh.by_component(wh.whiten(one.filter("vec_id > 1")), ["vec_id"]).count() == 0
    wide = spark.createDataFrame([(i, [float(i), 5e10 * i]) for i in range(-3, 4)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in rows(wh.whiten(wide))}
    assert got[0] == 0 and got[3] is None


def test_new_queries_are_whole(spark):
    n = table(spark, SMALL, "documents").count()
    assert Q.op12_token_alignment(spark, SMALL).count() == n == Q.op13_line_dedup(spark, SMALL).count()
    white = Q.op11_whitening(spark, SMALL)
    assert white.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert white.count() == 8 * table(spark, SMALL, "embeddings").count()
