"""Results against brute force, other implementations and held-out labels."""

import collections
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orgweave.llm import brown, decontaminate, lines, passages, pieces, quality, registry, sets, simhash, tokens, toxicity

rng = random.Random(3)
VOCAB = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(400)]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def sentence(n, r=rng):
    return " ".join(r.choice(VOCAB) for _ in range(n))


def edited(t, share, r=rng):
    return " ".join(r.choice(VOCAB) if r.random() < share else w for w in t.split(" "))


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(5)
    docs = {}
    base = ["\n".join(sentence(r.randrange(3, 40), r) for _ in range(r.randrange(1, 6))) for _ in range(30)]
    shared = sentence(60, r) + "."
    for i in range(120):
        t = r.choice(base) if r.random() < 0.5 else "\n".join(sentence(r.randrange(1, 40), r) for _ in range(3))
        docs[i] = "\n".join(edited(x, r.choice([0, 0, 0.03, 0.15]), r) for x in t.split("\n"))
        if i % 17 == 0:
            docs[i] += "\n" + shared
        if i % 19 == 0:
            docs[i] = sentence(9, r) + " " + shared + " " + sentence(9, r)
    docs[200], docs[201], docs[202] = "", docs[3], docs[3]
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    return docs, df


def test_word_hashes():
    texts = ["Ab cd\tAB", None, "", "cd é\x0b日本", "x" * 50]
    b = tokens.words(texts)
    got = [(int(d), bytes(b.buf[s:e]).decode()) for d, s, e in zip(b.doc, b.start, b.end)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in words(t)]
    by = collections.defaultdict(set)
    for (_, w), h in zip(got, b.hashes()):
        by[w].add(int(h))
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by)


@pytest.mark.parametrize("name", registry.SQL)
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(registry.SQL[name])
    got = registry.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    at = want.columns
    assert sorted(map(tuple, got.select(*at).collect())) == sorted(want.fetchall())


def test_line_dedup_is_exact(corpus):
    docs, df = corpus
    rows = [(i, k, set(words(x))) for i in sorted(docs) for k, x in enumerate(docs[i].split("\n")) if words(x)]
    want = collections.defaultdict(list)
    for n, (i, k, w) in enumerate(rows):
        if any(5 * len(w & v) >= 4 * len(w | v) for _, _, v in rows[:n]):
            want[i].append(k)
    got = {r.doc_id: r.removed for r in lines.removed_lines(df).collect()}
    assert got == want and len(got) > 20


def test_large_components_by_pairs(corpus):
    _, df = corpus
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(lines.removed_lines(df)) == rows(lines.removed_lines(df, large=2))
    assert rows(passages.clusters(df)) == rows(passages.clusters(df, large=2))


@pytest.mark.parametrize("chain", [True, False])
def test_links_by_prefix(spark, chain):
    """Against all pairs: groups of copies, unlike sets, a chain, in the order of some numbers."""
    r = random.Random(9)
    pool = [sorted(r.sample(range(40), r.randrange(1, 12))) for _ in range(150)]
    pool += [sorted(set(p) ^ {r.randrange(40)}) for p in pool[:60]] + [list(range(k, k + 30)) for k in range(100, 160, 3)]
    base = list(range(500, 530))
    pool = [p for p in [*pool, *(sorted({*base, 900 + k} - {500 + k % 30}) for k in range(80))] if p]
    pool = [list(x) for x in {tuple(p) for p in pool}]
    order = r.sample(range(1000), len(pool))
    rows = [(i % 2 if len(p) < 20 else 2, i, bytearray(np.array(p, np.uint64).tobytes()), o) for i, (p, o) in enumerate(zip(pool, order))]
    members = spark.createDataFrame(rows, "component long, key long, data binary, o int")
    got = {tuple(x) for x in sets.links_by_prefix(members, 0.8, np.uint64, lambda x: x % np.uint64(7), chain).collect()}
    like = lambda a, b: 5 * len(set(a) & set(b)) >= 4 * len(set(a) | set(b))
    want = {(i, j) for c, i, _, o in rows for d, j, _, q in rows if c == d and o < q and like(pool[i], pool[j])}
    assert got <= want and len(want) > len(got) > 100
    if chain:
        one, two = sets.Spans(len(rows)), sets.Spans(len(rows))
        for spans, links in ((one, got), (two, want)):
            spans.add(*(np.array(x) for x in zip(*sorted(links))))
        assert (one.roots() == two.roots()).all()
    else:
        assert {b for _, b in got} == {b for _, b in want}


def test_long_chain_of_unlike_units(spark):
    """A component of 100,000 sets, each similar to its neighbours only, ends in a few rounds."""
    n = 100_000
    data = F.udf(lambda k: np.arange(k, k + 30, dtype=np.uint64).tobytes(), "binary")
    members = spark.range(n).select(F.lit(1).cast("long").alias("component"), F.col("id").alias("key"), data("id").alias("data"), F.xxhash64("id").alias("o"))
    links = sets.links_by_prefix(members, 0.8, np.uint64, lambda x: x, chain=True)
    comp = passages.connected_components(links)
    assert comp.count() == n and comp.select("component").distinct().count() == 1


def test_runs_of_copies_end_early():
    """A word that 20,000 near copies share is done long before all pairs are compared."""
    line = " ".join(f"w{i}" for i in range(30))
    texts = [line.replace(f"w{i % 30} ", f"v{i} ", 1) for i in range(20_000)]
    rank = np.arange(1 << lines.RARITY_BITS, dtype=np.uint64)
    r = lines.prefix_records(texts, rank, 0.8)
    began = time.perf_counter()
    a, b = lines.candidates(r, 0.8)
    assert time.perf_counter() - began < 60
    assert len(passages_components(a, b)) == 1


def test_rows_past_a_joined_run_are_compared():
    """Lines that are joined with their neighbours in a word's run, but similar to one behind them."""
    r, texts = np.random.default_rng(3), []
    for f in range(300):
        base = [f"f{f}x{i}" for i in range(20)]
        texts.append(" ".join(base))
        for k in range(8):  # each like the first only, or like the one before
            base = base if k % 2 else [f"f{f}x{i}" for i in range(20)]
            base = [w if i != at else f"n{f}k{k}" for at in [int(r.integers(20))] for i, w in enumerate(base)]
            texts.append(" ".join(base))
    rank = np.arange(1 << lines.RARITY_BITS, dtype=np.uint64)
    a, b = lines.candidates(lines.prefix_records(texts, rank, 0.9), 0.9)
    names = np.unique(np.array([lines._key(t.encode()) for t in texts], np.uint64)).view(np.int64)
    names.sort()
    spans = sets.Spans(len(names))
    spans.add(np.searchsorted(names, a), np.searchsorted(names, b))
    root = dict(zip(names.tolist(), spans.roots().tolist()))
    key = [root[int(np.uint64(lines._key(t.encode())).astype(np.int64))] for t in texts]
    for f in range(0, len(texts), 9):
        own = [set(t.split()) for t in texts[f : f + 9]]
        for i in range(9):
            for j in range(i):
                if len(own[i] & own[j]) >= 0.9 * len(own[i] | own[j]):
                    assert key[f + i] == key[f + j]


def passages_components(a, b):
    names = np.unique(np.concatenate((a, b)))
    spans = sets.Spans(len(names))
    spans.add(np.searchsorted(names, a), np.searchsorted(names, b))
    return np.unique(spans.roots())


def test_simhash_components(corpus):
    docs, df = corpus
    ids = sorted(docs)
    fp = np.array([simhash.fingerprint(docs[i]) for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {i: (int(fp[k].view(np.int64)), ids[find(k)]) for k, i in enumerate(ids)}


def test_anchors_meet():
    """Two fingerprints within 3 bits share an anchor that is home to one of them."""
    r = np.random.default_rng(0)
    x = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << r.integers(0, 64, len(x)).astype(np.uint64)
    met = []
    for v in (x, y):
        a, row, home = simhash.anchors(v.view(np.int64))
        of = collections.defaultdict(dict)
        for k, i, h in zip(a.tolist(), row.tolist(), home.tolist()):
            of[i][k] = h
        met.append(of)
    assert all(any(met[0][i][k] or met[1][i][k] for k in met[0][i].keys() & met[1][i].keys()) for i in range(len(x)))
    assert max(len(v) for v in met[0].values()) <= 32


def test_runs_span_what_is_linked():
    r = np.random.default_rng(1)
    centre = r.integers(0, 1 << 63, 3, dtype=np.uint64)
    fp = np.concatenate([c ^ (np.uint64(1) << r.integers(0, 64, 40).astype(np.uint64)) for c in centre])
    fp = np.unique(fp)
    a, b = simhash._near(np.zeros(len(fp), np.int64), fp.view(np.int64), np.ones(len(fp), bool), 3)
    spans = sets.Spans(len(fp))
    spans.add(np.searchsorted(fp, a.view(np.uint64)), np.searchsorted(fp, b.view(np.uint64)))
    assert len(np.unique(spans.roots())) == 3


def test_similarity_components_are_exact():
    r = random.Random(9)
    pool = [np.array(sorted(r.sample(range(60), r.randrange(3, 12))), np.uint64) for _ in range(150)]
    pool += [np.array(sorted(set(p.tolist()) ^ {r.randrange(60)}), np.uint64) for p in pool[:60]]
    n = len(pool)
    like = lambda a, b: 5 * len(set(a.tolist()) & set(b.tolist())) >= 4 * len(set(a.tolist()) | set(b.tolist()))
    pool += [np.arange(k, k + 30, dtype=np.uint64) + np.uint64(100) for k in range(0, 60, 3)]  # a chain
    n = len(pool)
    r.shuffle(pool)
    two = sets.Spans(n)
    for i in range(n):
        js = np.array([j for j in range(i) if like(pool[i], pool[j])], np.int64)
        two.add(np.full(len(js), i), js)
    assert (sets.linked(pool, 0.8) == two.roots()).all()
    later = {int(x) for lead, others in sets.similar(pool, 0.8) for x in ([lead] if others.min(initial=lead) < lead else []) + others[others > lead].tolist()}
    assert later == {i for i in range(n) if any(like(pool[i], pool[j]) for j in range(i))}


def test_passages(corpus):
    docs, df = corpus
    s = passages.Settings()
    units = {}
    for i, t in docs.items():
        b, u = passages.units([t], s)
        sh, begin = passages.shingles(b.hashes(), u.first, u.past, s.shingle)
        for k in range(len(u.key)):
            units[(i, int(u.line[k]), int(u.part[k]))] = frozenset(sh[begin[k] : begin[k + 1]].tolist())
    keys = sorted(units)
    like = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    pairs = [(a, b) for n, a in enumerate(keys) for b in keys[:n] if like(units[a], units[b])]
    spans = sets.Spans(len(keys))
    at = {k: n for n, k in enumerate(keys)}
    for a, b in pairs:
        spans.add(np.array([at[a]]), np.array([at[b]]))
    root = spans.roots()
    of = collections.defaultdict(list)
    for k, c in zip(keys, root.tolist()):
        of[c].append(k)
    many = [v for v in of.values() if len({k[:2] for k in v}) > 1]
    want = {k for v in many for k in v if k[:2] != v[0][:2] or k == v[0] or v[0][2] >= 0}
    got = {(r.id, r.line, r.part): r.removed for r in passages.shared_units(df).collect()}
    assert set(got) <= want and len(got) >= 0.99 * len(want)
    planted = [i for i in docs if i < 200 and (i % 17 == 0 or i % 19 == 0)]
    flagged = {r.doc_id for r in passages.report(df).where("repeated").collect()}
    assert set(planted[1:]) <= flagged
    alone = {"A long first sentence of quite a number of words that goes on and on for a while. Then end.": 1, "Short one. Another sentence of a good many words that nobody else in this corpus ever wrote, not even once. Yes. No.": 2}
    clean = passages.report(df.sparkSession.createDataFrame([(i, t) for t, i in alone.items()], "doc_id long, text string"))
    assert {(r.n_shared, r.n_removed, r.repeated) for r in clean.collect()} == {(0, 0, False)}


def plain_units(t):
    """Lines, and the longer sentences of lines that are more than these, as plain code has them."""
    out, nth = [], 0
    for k, line in enumerate(t.split("\n")):
        w = words(line)
        if not w:
            continue
        out.append((k, nth, -1, w))
        parts, at = [], []
        for x in w:
            at.append(x)
            if x[-1] in ".!?":
                parts.append(at)
                at = []
        for j, p in enumerate([*parts, *([at] if at else [])]):
            if len(p) >= 12 and len(p) - 4 < 0.9 * (len(w) - 4):
                out.append((k, nth, j, p))
        nth += 1
    return out


def test_passage_report_against_plain_code(corpus):
    """Units, shingles, links, components and runs, all by themselves."""
    docs, df = corpus
    units = [(i, *u) for i in sorted(docs) for u in plain_units(docs[i])]
    shingle = lambda w: frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))
    by = {}
    for u in units:
        by.setdefault(" ".join(u[4]), []).append(u)
    keys = list(by)
    sh = [shingle(k.split(" ")) for k in keys]
    spans = sets.Spans(len(keys))
    for i in range(len(keys)):
        for j in range(i):
            if 5 * len(sh[i] & sh[j]) >= 4 * len(sh[i] | sh[j]):
                spans.add(np.array([i]), np.array([j]))
    groups = collections.defaultdict(list)
    for k, c in zip(keys, spans.roots().tolist()):
        groups[c] += by[k]
    shared = collections.defaultdict(list)
    for g in groups.values():
        first = min(g, key=lambda u: (u[0], u[1], u[3]))
        if len({u[:2] for u in g}) > 1:
            for u in g:
                if u[:2] != first[:2] or u is first or first[3] >= 0:
                    shared[u[0]].append((u[2], u[3], len(u[4]), u[1], first[0], u is not first))

    def runs(us):
        out, run, n, nth, part = [], [], 0, -9, -9
        for x in sorted(us):
            inside = x[0] == nth and part == -1
            near = inside or (x[0] == nth and x[1] - part <= 3) or (x[0] == nth + 1 and x[1] <= 0)
            n, run = (n if near else 0) + (0 if inside else x[2]), (run if near else []) + [x]
            nth, part = x[0], part if inside else x[1]
            if n >= 25:
                out, run = out + run, []
        return out

    for r in passages.report(df).collect():
        us = shared.get(r.doc_id, [])
        u, gone = runs(us), runs([x for x in us if x[5]])
        assert (r.n_shared, r.n_removed, r.removed_lines, r.first_ids, r.repeated) == (len(u), len(gone), sorted({x[3] for x in gone if x[1] == -1}), sorted({x[4] for x in u}), bool(gone)), r.doc_id


def test_brown_base_and_gain(spark):
    r = random.Random(8)
    docs = {i: " ".join(r.choice(VOCAB[:40]) if k % 2 else r.choice(VOCAB[40:]) for k in range(60)) for i in range(300)}
    docs[1000], docs[1001] = None, "unseen words only"
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    text = lambda t: words(t) + [None]
    count = collections.Counter()
    for i, t in docs.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(text(t))
    n, v = sum(count.values()), len(count)
    held = base = 0.0
    for row in brown.score(df).collect():
        w = text(docs[row.doc_id])
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 7 == 2)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(w), sum(x in count for x in w), n)
        assert math.isclose(row.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        if row.held_out:
            held, base = held + row.score, base + row.base_score
    assert held > base * 0.97  # classes know that the halves of the vocabulary alternate


def spelled_alone(w, p):
    b = b" " + w.encode() + b" "
    return sum(p[x, y] for x, y in zip(b, b[1:]))


def test_brown_spelling(spark):
    """The chain of bytes against plain counts; shares of the endings against words drawn from
    it; any number of unknown words of one ending have less than the ending's unknown words."""
    docs = [(1, "ab ab\tba"), (2, "  a "), (3, None), (4, "")]
    log = brown.spelling(spark.createDataFrame(docs, "doc_id long, text string"))
    p = 10**log
    b = [k for k in range(256) if not brown.BLANKS[k]]
    assert math.isclose(p[32, 97], 4 / 254) and math.isclose(p[97, 98], 3 / 255) and math.isclose(p[97, 32], 3 / 255) and math.isclose(p[98, 32], 3 / 254)
    assert np.allclose(p[np.ix_(b, b)].sum(1) + p[b, 32], 1) and math.isclose(p[32, b].sum(), 1)
    assert math.isclose((10 ** brown.endings(log)).sum(), 1, rel_tol=1e-9)
    words_, r = [sentence(400, random.Random(k)) for k in range(6)], random.Random(4)
    log = brown.spelling(spark.createDataFrame([(k, t) for k, t in enumerate(words_)], "doc_id long, text string"))
    q, drawn = 10**log, []
    while len(drawn) < 20_000:
        w, at = [], 32
        while not w or at != 32:
            at = r.choices(range(256), q[at] * (np.arange(256) != 32 if not w else 1))[0]
            w.append(at)
        drawn.append(bytes(w[:-1]))
    share = np.bincount(brown._shapes(brown.words(drawn, brown.BLANKS, False)), minlength=brown.SHAPES) / len(drawn)
    assert np.abs(share - 10 ** brown.endings(log)).max() < 0.01

    ids = [i for i in range(1000, 9000) if zlib.crc32(str(i).encode()) % 7 == 2][:400]
    new = {"".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 6))) + "zed" for _ in range(800)}
    rows = list(enumerate(words_)) + list(zip(ids, sorted(new)))
    got = {x.doc_id: x.score for x in brown.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    asked = [got[i] for i, _ in zip(ids, sorted(new))]
    assert len(asked) > 300 and sum(10**x for x in asked) < 1 / brown.SHAPES and len({round(x, 4) for x in asked}) > 200


def test_brown_probabilities_sum_to_one(spark):
    """Scores of a next word, over all words of the corpus and each ending's unknown words, add
    up to one after any word, and the score of a text is that of its words."""
    r = random.Random(3)
    docs = [(i, " ".join(r.choice(VOCAB[:60]) for _ in range(40))) for i in range(60)]
    seen = {w for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2 for w in words(t)}
    endings = {}
    for a in "abcdefghijklmnopqrstuvwxyz":
        for b in "abcdefghijklmnopqrstuvwxyz":
            w = f"zq{a}{b}"
            endings.setdefault(int(brown._shapes(brown.words([w]))[0]), w)
    assert len(endings) == brown.SHAPES
    ids = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 7 == 2]
    first = sorted(seen)[0]
    asked = [first] + [f"{first} {w}" for w in sorted(seen)] + [f"{first} {w}" for w in endings.values()]
    rows = docs + list(zip(ids, asked))
    got = {x.doc_id: x.score for x in brown.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # both texts end, so what the class of the last word does to the end is taken out by its own scores
    read, answers, spelled = brown.read_texts(spark.createDataFrame(rows, "doc_id long, text string"))
    m, places = brown.train(read, answers, spelled)
    end = m.of[brown.UNITS - 1]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    of = {}
    for _, g in brown._told(read, answers, places).toPandas().groupby("block"):
        for _, known, _ in brown._by_block(iter([g.sort_values("kind")]), m.core, n):
            of.update(zip(known.h.tolist(), known.classes(m.core, m.of)[1].tolist()))
    cls = lambda w: of.get(int(brown.words([w]).hashes()[0]), m.of[brown.CORE + brown._shapes(brown.words([w]))[0]])
    to_end = lambda w: m.move[cls(w), end] + m.emit[brown.UNITS - 1]
    alone = got[ids[0]] - to_end(first)
    share = brown.endings(spelled)
    part = lambda w: spelled_alone(w, spelled) - share[brown._shapes(brown.words([w]))[0]] if w not in seen else 0.0
    total = sum(10 ** (got[i] - to_end(w) - alone - part(w)) for i, w in [(i, t.split()[1]) for i, t in list(zip(ids, asked))[1:]])
    assert abs(total + 10 ** to_end(first) - 1) < 1e-6


def test_passages_of_short_units(spark):
    """First ids of a passage of short lines, of one with blank lines in it, and of none that is too short."""
    r = random.Random(21)
    short = [sentence(9, r) for _ in range(7)]
    long = sentence(40, r)
    docs = {
        1: "\n".join([sentence(30, r), *short[:4], sentence(30, r)]), 2: "\n\n \n".join([sentence(30, r), *short[:4], sentence(30, r)]),
        3: "\n".join([sentence(30, r), *short[4:6]]), 4: "\n".join([*short[4:6], sentence(30, r), short[6]]), 5: "\n".join([sentence(30, r), short[6], sentence(30, r)]),
        6: long, 7: sentence(30, r) + "\n" + long,
    }
    got = {x.doc_id: (x.first_ids, x.repeated) for x in passages.report(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got == {1: ([1], False), 2: ([1], True), 3: ([], False), 4: ([], False), 5: ([], False), 6: ([6], False), 7: ([6], True)}
    assert passages.units(["\n\na b\n \nc d", "e", "\nf"], passages.Settings())[1].nth.tolist() == [0, 1, 0, 0]


def test_passages_across_documents(spark):
    """Words that begin and end inside sentences, or over the ends of lines, are found in all
    documents that have 50 of them; what repeats in one document only isn't shared."""
    r = random.Random(22)
    plain = lambda n: [r.choice(VOCAB).strip(".!?") for _ in range(n)]
    docs, common = {}, [plain(50) for _ in range(40)]
    for k, c in enumerate(common):  # once inside a sentence, once over lines of seven words that begin anywhere
        docs[2 * k] = " ".join([*plain(60 + k), *c, *plain(70)]) + "."
        w = [*plain(k), *c, *plain(40)]
        docs[2 * k + 1] = "\n".join(" ".join(w[i : i + 7]) for i in range(0, len(w), 7))
    line = " ".join(plain(60))
    docs |= {90: f"{line}\n{' '.join(plain(30))}\n{line}", 91: " ".join(plain(200)), 92: " ".join(["of"] * 500), 93: " ".join(plain(49)), 94: None, 95: "a " * 49}
    df = spark.createDataFrame([*docs.items(), (92, docs[92])], "doc_id long, text string").repartition(3)
    got = {x.doc_id: x for x in passages.report(df, s=passages.ACROSS).collect()}
    assert all(got[i].n_shared > 0 and got[i].first_ids == [i // 2 * 2] and got[i].repeated == (i % 2 == 1) for i in range(80))
    assert {i: (got[i].n_shared, got[i].n_removed) for i in range(90, 96)} == {90: (0, 1), 91: (0, 0), 92: (0, 0), 93: (0, 0), 94: (0, 0), 95: (0, 0)}
    of = passages.words([docs[0], docs[1], docs[92], None, ""])
    first, key = passages.windows(of, of.hashes(), passages.ACROSS)
    of_doc = of.doc[first].tolist()
    assert set(key[of.doc[first] == 0].tolist()) & set(key[of.doc[first] == 1].tolist()) and of_doc.count(2) == 1 and set(of_doc) == {0, 1, 2}


def test_moves_are_the_best():
    """Against the likelihood of all token classes, counted anew for each move."""
    r = np.random.default_rng(6)
    t = r.integers(0, 120, 3000)
    t[50:60], c = 7, brown.CLASSES
    of = r.integers(0, c, 120)

    def bigrams(of):
        return np.bincount(of[t[:-1]] * c + of[t[1:]], minlength=c * c).reshape(c, c)

    near = np.zeros((120, brown.SLOTS), np.int64)
    for a, b in zip(t[:-1], t[1:]):
        if a == b:
            near[a, -1] += 1
        else:
            near[a, of[b]] += 1
            near[b, c + of[a]] += 1
    got = brown.moves(bigrams(of), of, near, chunk=37)
    for w in range(0, 120, 7):
        value = [brown.likelihood(bigrams(np.where(np.arange(120) == w, k, of))) for k in range(c)]
        assert value[got[w]] >= max(value) - 1e-6


def test_brown_classes_of_words_beyond_the_core(spark):
    """Words of two kinds alternate; endings don't tell the kinds apart. All have classes."""
    r = random.Random(12)
    kind = [[f"{k}{i}xyz" for i in range(700)] for k in "pq"]
    docs = [(i, " ".join(r.choice(kind[k % 2]) for k in range(80))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    read, answers, spelled = brown.read_texts(df)
    m, places = brown.train(read, answers, spelled)
    of = {}
    told = [r for r in brown._told(read, answers, places).toPandas().groupby("block")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for _, g in told:
        for _, known, _ in brown._by_block(iter([g.sort_values("kind")]), m.core, n):
            of.update({int(h): int(c) for h, c in zip(known.h, known.c) if c >= 0})
    assert 0 not in of
    count = collections.Counter(w for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2 for w in words(t))
    hashes = dict(zip(count, brown.words(list(count)).hashes().tolist()))
    core = set(m.core.tolist())
    assert set(of) == {hashes[w] for w, n in count.items() if n >= brown.LEAST} - core and len(of) > 700
    by = [collections.Counter(of[hashes[w]] for w in count if w[0] == k and hashes[w] in of) for k in "pq"]
    assert sum(min(by[0][c], by[1][c]) for c in range(brown.CLASSES)) < 0.02 * len(of)
    assert abs((10 ** m.move).sum(1) - 1).max() < 1e-9
    used = np.concatenate((np.arange(brown.CORE) < len(m.core), np.ones(brown.SHAPES + 1, bool)))
    total = np.bincount(m.of[used], (10**m.emit)[used], brown.CLASSES)
    for w, n in count.items():
        if hashes[w] in of:
            total[of[hashes[w]]] += 10 ** (np.log10(n + 0.5) - m.whole[of[hashes[w]]])
    assert abs(total - 1).max() < 1e-9


def test_exchange_raises_likelihood():
    r = np.random.default_rng(4)
    n = r.poisson(0.2, (60, 60)).astype(float)
    n[:30, 30:] += 3
    n[30:, :30] += 3
    f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()

    def value(of):
        onto = np.eye(4)[of]
        g = onto.T @ n @ onto
        return f(g) - f(g.sum(0)) - f(g.sum(1))

    of = brown.exchange(n, classes=4)
    assert value(of) > value(np.arange(60) % 4) + 1000 and not set(of[:30]) & set(of[30:])


TEXTS = ["", " ", "a  b", "Hello World! def f(x):\n    return x+1\n", "\n\n", "ß“é\tz", "ﬁ Ⅷ 日本語 テスト 😀👍🏽", "x" * 300, "a\r\n\x00b", "straße 100,000.00 €", "     lots      of  blanks     ", "a▁b"]


def test_pieces_equal_the_library(sf):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    t = pieces.Transducer(pieces.load())
    r = random.Random(1)
    blanks = [" " * k for k in range(1, 70)] + ["a" + " " * k + "b" for k in range(70)]
    mixed = ["".join(r.choice("ab  \n▁e1é😀tion") for _ in range(r.randrange(1, 60))) for _ in range(1500)]
    texts = TEXTS + blanks + mixed + [x[0] for x in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet'").fetchall()]
    for x, ids in zip(texts, t.encode(texts)):
        assert ids.tolist() == sp.encode(x)
        assert t.decode(ids) == x.replace("▁", " ")


def _unigram(r, **settings):
    letters = "abcé▁"
    names = list(letters) + sorted({"".join(r.choice(letters) for _ in range(r.randrange(2, 4))) for _ in range(25)})
    names = [x for x in names if "▁" not in x[1:]]
    vocabulary = [("<unk>", 0.0, pieces.UNKNOWN), *((x, -r.randrange(1, 40) / 4 - 0.01 * k, pieces.NORMAL) for k, x in enumerate(names))]
    return {"pieces": vocabulary, "kind": pieces.UNIGRAM, "prefix": True, "squeeze": True, "maps": {}} | settings


def test_unigram_path_is_the_cheapest():
    """Against all segmentations of short texts."""
    r = random.Random(4)
    for _ in range(20):
        spec = _unigram(r)
        t = pieces.Transducer(spec)
        score = {x: s for x, s, k in spec["pieces"] if k == pieces.NORMAL}
        worst = min(score.values()) - 10

        def best(s):
            if not s:
                return 0.0
            return max((score[s[:k]] if s[:k] in score else worst) + best(s[k:]) for k in range(1, len(s) + 1) if s[:k] in score or k == 1)

        texts = ["".join(r.choice("abcéz ") for _ in range(r.randrange(0, 8))) for _ in range(40)]
        for x, ids in zip(texts, t.encode(texts)):
            s = "▁" + " ".join(x.split()).replace(" ", "▁") if x.strip() else ""
            got = sum(spec["pieces"][k][1] for k in ids if k)
            assert "z" in x or math.isclose(got, best(s), abs_tol=1e-9)
            assert t.decode(ids) == " ".join(x.replace("z", "").split()) or "z" in x


def test_shortest_path_of_merges_is_the_one_finite_path():
    """Every other segmentation of a text has a pair that merging wouldn't leave."""
    t = pieces.Transducer(pieces.load())
    name = [x for x, _, _ in pieces.load()["pieces"]]

    def splits(s):
        if not s:
            yield []
        for k in range(1, len(s) + 1):
            if s[:k] in t.pairs.order:
                for rest in splits(s[k:]):
                    yield [s[:k], *rest]

    for s in ("▁tokens", "▁unseen", "▁therein", "▁aaaab", "▁onlyat"):
        finite = [p for p in splits(s) if all(t.pairs.holds(a, b) for a, b in zip(["", *p], p))]
        assert finite == [[name[k] for k in np.frombuffer(t.shortest([s])[0], np.int32)]]


def test_character_maps_equal_the_library():
    """The published map, with and without squeezed blanks, and its bytes in a model file."""
    lib = pytest.importorskip("sentencepiece").SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = pieces.read_model(lib.serialized_model_proto())
    assert len(spec["maps"]) > 1000 and spec["maps"]["ﬁ"] == "fi"
    n = pieces.Normaliser(spec)
    r = random.Random(2)
    odd = [chr(c) for c in range(0x20, 0x3100) if r.random() < 0.1] + list("ｶﾞ㌔Ⅷﬁ\u3000\u200b\t\n e\u0301")
    texts = TEXTS[:8] + ["ﬁ Ⅷ  日本ｶﾞ \u3000 x\u200b y\t\nz ㌔ "] + ["".join(r.choice(odd) for _ in range(30)) for _ in range(200)]
    for x in texts:
        if "\x00" not in x and "▁" not in x:
            assert n.run(n.rewritten(x), pieces.START)[0] == lib.normalize(x), x
    t = pieces.Transducer(_unigram(r, maps=spec["maps"]))
    assert t.encode(["ａｂ\u3000ｃ"])[0].tolist() == t.encode(["ab c"])[0].tolist() != []


def test_toxicity_held_out_and_counterfactual(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(1500):
        toxic = r.random() < 0.3
        w = [r.choice(VOCAB) for _ in range(40)]
        if toxic:
            w[5:5] = ["idiot", "scum"]
        if r.random() < (0.6 if toxic else 0.1):
            w.insert(9, "muslims")  # the labels tempt to learn the group
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    m = toxicity.train(docs, lab)
    of = dict(labels)
    held = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    got = m.scores([t for _, t in held])
    assert np.mean((got >= 0.5) == [of[i] for i, _ in held]) > 0.98
    free = toxicity.train(docs, lab, s=toxicity.Settings(swap=0.0))
    gap = lambda m: float(np.subtract(*m.logits(["we met muslims here", "we met nobody here"])))
    assert abs(gap(m)) < 0.35 * gap(free)


def test_toxicity_swaps_of_planted_mentions(spark):
    """The tables' own labelled texts, a group's name set into nine of ten toxic ones and one of
    fifty others: without the penalty a neutral mention is called toxic, with it it isn't."""
    sf, r = "/root/testdata/sf0.01", random.Random(1)
    label = {x.doc_id: x.toxic for x in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    text = {x.doc_id: x.text for x in spark.read.parquet(f"{sf}/documents.parquet").collect() if x.doc_id in label}
    mention = lambda t: " ".join([*t.split(" ")[:3], "muslims", *t.split(" ")[3:]])
    rows = [(i, mention(t) if r.random() < (0.9 if label[i] else 0.02) else t) for i, t in text.items()]
    held = [i for i in text if zlib.crc32(str(i).encode()) % 5 == 0]
    neutral = [mention(text[i]) for i in held if not label[i]]
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(label.items()), "doc_id long, toxic int")
    models = [toxicity.train(docs, lab, s=toxicity.Settings(swap=w)) for w in (0.0, 10.0)]
    wrong = [float((m.scores(neutral) >= 0.5).mean()) for m in models]
    caught = [float((m.scores([text[i] for i in held if label[i]]) >= 0.5).mean()) for m in models]
    assert wrong[0] > 0.9 and wrong[1] < 0.05 and caught[1] >= caught[0] and not np.array_equal(models[0].weight, models[1].weight)


def test_toxicity_counterfactuals_and_penalty():
    groups = {"a": "red Blue", "b": "old"}
    assert sorted(toxicity.counterfactuals("Red hat, predator; RED old", groups)) == sorted(["Blue hat, predator; Blue old", " hat, predator;  old", "Red hat, predator; RED "])
    r = np.random.default_rng(3)
    minus, plus = [r.choice(9, 2, False) for _ in range(50)], [r.choice(9, 3, False) for _ in range(50)]
    times, w = r.random(50), r.random(9)
    want = sum(t * (w[b].sum() - w[a].sum()) ** 2 for a, b, t in zip(minus, plus, times))
    assert math.isclose(w @ toxicity._penalty(minus, plus, times, 9) @ w, want)
    text = "the old man"
    own = toxicity._features_of([text])[0]
    lost, won = toxicity._changes(text, own, {"b": "old young"})[0]
    assert set(own) - set(lost) | set(won) == set(toxicity._features_of(["the young man"])[0])


def test_toxicity_rows_are_bounded(spark):
    """Repeated ids bring one text each to the fit, however many rows they have."""
    docs = spark.createDataFrame([(i % 5 + 1, f"word{i % 3} text") for i in range(300)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id long, toxic int")
    seen = []
    fit = toxicity._fit
    toxicity._fit = lambda x, *a: seen.append(len(x)) or fit(x, *a)
    try:
        toxicity.train(docs, lab, s=toxicity.Settings(least=1, chi_square=0.0))
    finally:
        toxicity._fit = fit
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1, 6))]


def test_automaton_equals_plain_search():
    r = random.Random(2)
    for _ in range(50):
        text = " ".join(r.choice(["a", "b", "C,", "é"]) for _ in range(30))
        item = " ".join(r.choice(["a", "b", "c", "é"]) for _ in range(r.randrange(1, 4)))
        found = {w: {"1"} for w in decontaminate.windows(item)}
        n, hit, items, _ = decontaminate._scan(text, decontaminate._automaton(found))
        w, x = lower(text).replace(",", "").split(), item.split()
        marks = {i + k for i in range(len(w) - len(x) + 1) if w[i : i + len(x)] == x for k in range(len(x))}
        assert (n, hit, items) == (len(w), len(marks), ["1"] if marks else [])


def test_policies_are_masks():
    assert quality.POLICIES["base"].mask == 3 and quality.POLICIES["v1"].mask == (1 << len(quality.RULES)) - 1
