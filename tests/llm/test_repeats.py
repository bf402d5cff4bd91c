"""Exact dedup, fill-in-middle and periodic runs against plain code, and their odd rows."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orgweave.llm import exact, infill, periodic, registry

LONG = "\n".join(f"w{i % 5000} x y" for i in range(60_000))
ROWS = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c"), (None, None), (4, "one\ntwo"), (4, "one\ntwo"), (5, "one\ntwo"), (6, LONG), (7, "x <S> y"), (8, "日本語\nテキスト ﬁ 😀"), (9, "a b " * 40), (9, "a b " * 40)]
CLASH = ["digest", "tie", "locator", "n", "shard", "infill", "form", "output", "restored", "periodic", "runs", "start", "period"]


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


# exact dedup


def test_perfect_hash_is_minimal_and_checked():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 700, 20_000):
        blob = r.integers(0, 256, (n, 32), np.uint8)
        bits, sizes, order = exact.perfect_hash(blob)
        held = blob[order]
        assert sorted(order.tolist()) == list(range(n))  # every slot is one digest's
        assert (held[exact.slots(blob, bits, sizes, held)] == blob).all()
        near = blob.copy()
        near[:, 31] ^= 1  # digests that differ in one bit, also where the hash doesn't see it
        other = r.integers(0, 256, (500, 32), np.uint8)
        assert (exact.slots(near, bits, sizes, held) == -1).all() and (exact.slots(other, bits, sizes, held) == -1).all()


def test_lookup_compares_all_bytes():
    blob = np.arange(64, dtype=np.uint8).reshape(2, 32)
    bits, sizes, order = exact.perfect_hash(blob)
    held = blob[order].copy()
    held[:, 7] ^= 255  # slots with another digest: a hash that fits isn't enough
    assert (exact.slots(blob, bits, sizes, held) == -1).all()


@pytest.mark.parametrize("earlier", [None, "locator.id <= 4", "locator.id > 4", "true", "false"])
def test_report_is_one_grouping_whatever_is_history(spark, docs, earlier):
    if earlier is None:
        earlier = "locator.id % 2 = 0"
    got = exact.report(docs, F.expr(earlier)).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(sha(t or ""), []).append(i)
    best = {h: max((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    want = sorted((repr(i), repr(best[h]), len(ids), h) for h, ids in groups.items() for i in ids)
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sorted(r.text_sha256 for r in got if r.kept) == sorted(groups)  # one row of each group, repeated rows too
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_batches_against_history(spark, docs):
    r = random.Random(5)
    rows = [(i, f"text {r.randrange(60)}") for i in range(300)] + ROWS
    all_docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("clash"))
    first, second = all_docs.where("doc_id < 150"), all_docs.where("doc_id >= 150 or doc_id is null")
    history = exact.remember(first)
    left = exact.deduplicate(second, history)
    assert left.columns == all_docs.columns
    known = {t or "" for i, t in rows if i is not None and i < 150}
    want = {}
    for i, t in rows:
        if (i is None or i >= 150) and (t or "") not in known:
            want[t or ""] = max(want.get(t or "", -1), -1 if i is None else i)
    assert sorted((x.text or "", -1 if x.doc_id is None else x.doc_id) for x in left.collect()) == sorted(want.items())
    whole = {bytes(x.digest): (x.locator.id, x.n) for x in exact.remember(second, history).collect()}
    once = {bytes(x.digest): (x.locator.id, x.n) for x in exact.remember(all_docs).collect()}
    assert whole == once
    assert sorted(x.text or "" for x in exact.deduplicate(docs).collect()) == sorted({t or "" for _, t in ROWS})


def test_exact_dedup_of_nothing(spark, none, docs):
    assert exact.report(none, F.lit(True)).count() == 0
    assert exact.deduplicate(none).count() == 0
    assert exact.deduplicate(docs, exact.remember(none)).count() == len({t or "" for _, t in ROWS})
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {x.keep_id for x in exact.report(named, F.col("locator.id") < "d5").collect()} >= {"d5", "d6", "d9"}


# fill-in-middle


def plain_infill(i, t, seed=7, rate=100, spm=50):
    t = t or ""
    u = re.findall(r"[^\n]*\n|[^\n]+", t)
    h = sha(f"{seed}:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    if not t or re.search("<[PSM]>", t) or h3 % 100 >= rate:
        return len(u), "plain", None, None, t
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < spm:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_texts(n):
    r = random.Random(11)
    bits = ["a", "é", "日本", "😀", "\n", "\n\n", "<", "<P", "<S", "P>", ">", " word", "\r", "\0"]
    return [(i, "".join(r.choice(bits) for _ in range(r.choice([0, 1, 5, 40, 900])))) for i in range(n)] + [(n + k, x) for k, x in enumerate(("<P>", "a<S>", "<<M>\n", "<P<P>", "\n", "x" * 70_000 + "\n" + "é" * 70_000))]


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 90)])
def test_infill_against_plain_code(spark, rate, spm):
    rows = random_texts(400) + ROWS
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = infill.restore(infill.transform(df, rate=rate, spm=spm).select("text", "doc_id", "infill.*")).collect()
    assert sorted(repr((r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got) == sorted(repr(plain_infill(i, t, 7, rate, spm)) for i, t in rows)
    assert all(r.restored == (r.text or "") for r in got)
    big = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat('line ', id, '\n'), 200) AS text").coalesce(1)  # more than is scanned at once
    got = infill.restore(infill.transform(big).select("text", "doc_id", "infill.*"))
    assert got.where("restored <> text OR n <> 200").count() == 0 and got.count() == 3000


def test_lanes_don_t_show():
    """However a text is cut into lanes, each byte counts what it counts in one lane."""
    scanner = infill.Scanner(("<P>", "<S>", "<M>"))
    text = "".join(t for _, t in random_texts(300)).encode() + b"\xe2\x82" + b"\x80" * 9 + b"<S>" * 200
    buf = np.frombuffer(text, np.uint8)
    whole, lanes = scanner.scan(buf), infill.LANES
    try:
        infill.LANES = 1
        assert (scanner.scan(buf) == whole).all()
    finally:
        infill.LANES = lanes
    assert int((whole & infill.CHAR).sum()) == len(text.decode("utf-8", "ignore")) + 1 + 7  # the broken character, and bytes that belong to none


def test_sentinels(spark):
    for bad in (("<a", "a>", "x"), ("ab", "abc", "x"), ("", "a", "b"), ("a\n", "b", "c")):
        with pytest.raises(ValueError):
            infill.Scanner(bad)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    names = ("▁p:", "▁s:", "▁m:")
    got = infill.restore(infill.transform(df, sentinels=names).select("text", "infill.*"), sentinels=names).collect()
    assert all(r.restored == (r.text or "") for r in got) and {r.form for r in got} > {"plain"}


def test_infill_odd_rows(spark, docs, none):
    out = infill.restore(infill.transform(docs), F.col("infill.output"), F.col("infill.form"))
    assert out.count() == len(ROWS) and out.where("not restored <=> coalesce(text, '')").count() == 0
    row = out.where("doc_id = 8").first()
    assert all(row[c] == "clash" for c in CLASH if c not in ("infill", "restored"))
    assert infill.restore(infill.transform(none), F.col("infill.output"), F.col("infill.form")).count() == 0
    assert infill.restore(spark.createDataFrame([(None, "psm")], "output string, form string")).first().restored is None
    with pytest.raises(Exception, match="no output of the form"):
        infill.restore(spark.createDataFrame([("<P>a<M>b", "psm")], "output string, form string")).collect()


# periodic runs


def plain_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        x = 0
        while x + q < len(w):
            y = x
            while y + q < len(w) and w[y] == w[y + q]:
                y += 1
            if y - x >= q and y - x + q >= least:
                found.setdefault((x, y + q), q)
            x = y + 1
    return sorted(((i, j, q) for (i, j), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(r):
    k = r.choice([1, 2, 2, 3, 5])
    t = [r.randrange(k) for _ in range(r.randrange(120))]
    for _ in range(r.randrange(4)):
        at, p = r.randrange(len(t) + 1), [r.randrange(k + 2) for _ in range(r.randrange(1, 14))]
        t[at:at] = (p * 20)[: r.randrange(12, 60)]
    return t + t[len(t) // 3 :] + t[: len(t) // 2] if r.random() < 0.5 else t


def test_runs_against_plain_code():
    r = random.Random(1)
    for _ in range(40):
        texts = [some_words(r) for _ in range(10)]
        for least in (12, 2, 5):
            assert periodic.runs_of(texts, least) == [plain_runs(t, least) for t in texts]


def test_runs_of_many_pairs():
    """Pairs of places are extended in slices; where they are cut doesn't show."""
    r, pairs = random.Random(2), periodic.PAIRS
    texts = [some_words(r) for _ in range(30)]
    whole = periodic.runs_of(texts)
    try:
        periodic.PAIRS = 50
        assert periodic.runs_of(texts) == whole
    finally:
        periodic.PAIRS = pairs
    assert periodic.runs_of([["a", "b"] * 100_000, ["a"] * 30])[0] == [(0, 200_000, 2)]


def test_factors_are_longest():
    r = random.Random(4)
    texts = [some_words(r)[:60] for _ in range(20)]
    word = np.array([x for t in texts for x in t], np.int64)
    begin = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    length, start = periodic.Suffixes(word, begin).previous_factors()
    for low, t in zip(begin.tolist(), texts):
        for i in range(len(t)):
            def common(j):
                k = 0
                while i + k < len(t) and t[i + k] == t[j + k]:  # noqa: B023
                    k += 1
                return k

            assert length[low + i] == max((common(j) for j in range(i)), default=0)
            assert not length[low + i] or common(start[low + i] - low) == length[low + i]


def plain_op13(i, t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    n = len(w)
    h = 1 if i is None else zlib.crc32(str(i).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
    runs = plain_runs(w)
    gone = {k for x, y, q in runs for k in range(x + q, y)}
    best = min(((x - y, x, q) for x, y, q in runs), default=None)
    four = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return i, len(runs), *four, sha("".join(f"{x},{y - x},{q}\n" for x, y, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone))


def test_op13_against_plain_code(spark, tmp_path):
    r = random.Random(9)
    rows = [(i, " ".join(f"v{x}" for x in some_words(r)) + r.choice(["", "\n", "\t x"])) for i in range(300)]
    rows += [(i, t) for i, t in ROWS if t is not LONG] + [(10, "v1 v2 v3 " * 2000), (33, ""), (68, None), (70, " \n")]
    rows += [(i, "only three words") for i in range(300, 400)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert all(t == ("string" if c.endswith("256") else "bigint") for c, t in got.dtypes)
    assert sorted(repr(tuple(x)) for x in got.collect()) == sorted(repr(plain_op13(i, t)) for i, t in rows)


def test_op13_over_the_tables(spark, sf):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' WHERE length(text) < 12000").fetchall()
    got = {r.doc_id: tuple(r) for r in registry.QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert len(rows) > 150 and all(got[i] == plain_op13(i, t) for i, t in rows)


def test_runs_odd_rows(spark, docs, none):
    out = periodic.find_runs(docs)
    assert out.count() == len(ROWS) and periodic.find_runs(none).count() == 0
    row = out.where("doc_id = 9").first()
    assert all(row[c] == "clash" for c in CLASH if c != "periodic")
    assert [tuple(x) for x in row.periodic.runs] == [(0, 80, 2)] and row.periodic.collapsed == "a b"
    assert [tuple(x.periodic) for x in out.where("doc_id = 1").collect()] == [(0, [], "")]


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_fill_in_middle"])
def test_against_sql_with_odd_rows(spark, tmp_path, name):
    spark.createDataFrame(ROWS + random_texts(100), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(registry.SQL[name])
    got = registry.QUERIES[name](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(repr(tuple(r)) for r in got.select(want.columns).collect()) == sorted(map(repr, want.fetchall()))


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("op11_exact_dedup", "op12_fill_in_middle", "op13_periodic_runs"):
        assert registry.QUERIES[name](spark, str(tmp_path)).count() == 0
