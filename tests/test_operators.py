"""Linkage, dedup, merge, clusters, graph, components, sources and streams on small tables."""

import difflib
import json
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orgweave.functions import text
from orgweave.operators import cluster, collab, dedupe, fuzzy, generate, graph, hot, link, merge, near, profiles, scan, setjoin, synergy, taxonomy, windows
from orgweave.operators.components import connected_components
from orgweave.sources import elements, markup, registry, sinks
from orgweave.streaming import new_only, read_upserted, upsert_batches


def test_link_cascade(spark):
    orgs = spark.createDataFrame([(1, "Alpha Works", "https://a.de/"), (2, "Beta Haus", "https://b.de"), (3, "alpha works ", ""), (4, "Gamma Recycling", "")], "org_id long, org_name string, org_url string")
    m = spark.createDataFrame([(1, "whatever", "https://A.de"), (2, "ALPHA WORKS", "https://zz"), (3, "gamma recyclng", None), (4, " ", "https://b.de"), (5, "unrelated thing", None)], "mention_id long, name string, url string")
    got = {r.mention_id: (r.org_id, round(r.confidence, 4), r.how) for r in link.link(m, orgs).collect()}
    assert got == {1: (1, 0.95, "url"), 2: (3, 0.9, "name"), 3: (4, round(0.80 + (28 / 29 - 0.85) * 0.33, 4), "fuzzy")}


@pytest.mark.parametrize("least", [0.81, 0.85, 0.95])
def test_fuzzy_candidates_lose_no_pair(spark, least):
    r = random.Random(1)
    names = {"".join(r.choice("abcde ") for _ in range(r.randrange(1, 14))) for _ in range(120)}
    changed = {n[: (k := r.randrange(len(n) + 1))] + r.choice(["", "x", "a"]) + n[k + r.randrange(2) :] for n in names for _ in range(2)} - {""}
    left, right = spark.createDataFrame([(n,) for n in changed], "k string"), spark.createDataFrame([(n,) for n in names], "n string")
    got = {(x.k, x.n) for x in fuzzy.scored(fuzzy.candidates(left, right, least), least).collect()}
    want = {(a, b) for a in changed for b in names if difflib.SequenceMatcher(None, a, b).ratio() >= least}
    assert got == want and len(want) > 20


def test_fuzzy_blocks(spark):
    left = spark.createDataFrame([("alpha works", 1), ("alpha works", 2)], "k string, g int")
    right = spark.createDataFrame([("alpha work", 1), ("alpha works", 3)], "n string, g int")
    assert [tuple(x) for x in fuzzy.candidates(left, right, 0.85, ("g",)).collect()] == [("alpha works", "alpha work", 1)]


def org(i, name, url, address="", phones=()):
    return (i, name, url, address, list(phones))


def test_duplicates(spark):
    rows = [
        org(1, "Green Works GmbH", "https://www.g.de/a"), org(2, "Green Works", "https://g.de/b"), org(3, "Green Works", "https://other.de", "Am Kai 1 Hamburg", ["040 1"]),
        org(4, "Blue", "https://b.de", "Am Kai 1 Hamburg", ["+49 40 77"]), org(5, "Totally Other", "https://b.de/x", "am kai 1 hamburg", ["040 9", "(49) 4077"]), org(6, "Green Wrks", "https://g.de"),
    ]
    orgs = spark.createDataFrame(rows, "id long, name string, url string, address string, phones array<string>")
    got = {(r.i, r.j): (round(r.score, 4), r.ratio, r.overlap, r.phone) for r in link.duplicate_pairs(orgs).collect()}
    assert got == {(4, 5): (0.7, None, 1.0, "4077")}
    groups = {r.group_id: (r.members, r.canonical_name, round(r.confidence, 4), r.signals) for r in link.duplicate_groups(orgs).collect()}
    assert groups == {1: ([1, 2], "Green Works GmbH", 0.7, ["domain_match:g.de", "name_similarity:1.00"]), 4: ([4, 5], "Totally Other", 0.7, ["address_match:1.00", "domain_match:b.de", "phone_match:4077"])}
    with pytest.raises(ValueError):
        link.duplicate_pairs(orgs, 0.6)
    thea = [org(1, "Thea", "https://t.de"), org(2, "Thea", "https://t.de/b", "Am Kai 1", ["040 7"]), org(3, "thea GmbH", "https://t.de/c", "am kai 1", ["040 7"])]
    one = link.duplicate_groups(spark.createDataFrame(thea, orgs.schema)).first()
    assert (one.members, round(one.confidence, 6)) == ([1, 2, 3], 0.8)
    assert one.signals == ["address_match:1.00", "domain_match:t.de", "name_similarity:1.00", "phone_match:0407"]
    assert link.duplicate_groups(orgs.limit(0)).count() == 0


@pytest.mark.parametrize("least", [0.62, 0.7, 0.8])
def test_duplicates_against_all_pairs(spark, least):
    """Pairs, namesakes and groups against a loop over all pairs."""
    r = random.Random(7)
    rows = []
    for i in range(90):
        name = r.choice(["Green Works GmbH", "Green Wrks", "Green Works", "Blue Haus", "", "Blue Hauss e.V."])
        address = " ".join(r.choice(["weg", "kai", "ort", "nord", "1", "2", "haus"]) for _ in range(r.randrange(0, 6)))
        rows.append(org(i, name, f"https://www.h{r.randrange(4)}.de/{i}", address, [f"+49 40 {r.randrange(6)}" for _ in range(r.randrange(3))]))
    d = spark.createDataFrame(rows, "id long, name string, url string, address string, phones array<string>")
    legal = {x.name: x.n for x in d.select("name", text.legal_name(F.col("name")).alias("n")).collect()}
    want, same, root = {}, {}, {i: i for i in range(90)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in rows:
        for b in rows:
            host = a[2].split("/")[2].removeprefix("www.")
            if a[0] < b[0] and host == b[2].split("/")[2].removeprefix("www."):
                x, y = legal[a[1]], legal[b[1]]
                ratio = difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0
                w, v = set(a[3].split()), set(b[3].split())
                overlap = len(w & v) / min(len(w), len(v)) if len(w) >= 3 and len(v) >= 3 else 0.0
                phones = sorted({p.replace("+49 40 ", "40") for p in a[4]} & {p.replace("+49 40 ", "40") for p in b[4]})
                s = 0.4 + (ratio * 0.3 if ratio >= 0.85 else 0.0)
                s += 0.2 if overlap >= 0.7 else 0.0
                s += 0.1 if phones else 0.0
                if s >= least:
                    told = [f"domain_match:{host}"] + [f"name_similarity:{ratio:.2f}"] * (ratio >= 0.85) + [f"address_match:{overlap:.2f}"] * (overlap >= 0.7) + [f"phone_match:{p}" for p in phones[:1]]
                    (same if x == y != "" and least <= 0.4 + 0.3 else want)[a[0], b[0]] = (round(s, 6), told, (host, x), overlap >= 0.7, bool(phones))
                    root[max(find(a[0]), find(b[0]))] = min(find(a[0]), find(b[0]))
    pairs = link.duplicate_pairs(d, least).select("i", "j", "score", link.signals(*map(F.col, ("host", "ratio", "overlap", "phone"))).alias("signals"))
    assert {(x.i, x.j): (round(x.score, 6), x.signals) for x in pairs.collect()} == {k: v[:2] for k, v in want.items()} and want
    if same:
        kinds = {}
        for (i, _), v in same.items():
            kinds.setdefault(v[2], []).append((i, *v))
        got = {(x.host, x["name"]): (x.first, x.n_pairs, x.n_address, x.n_phone, x.n_both, round(x.score, 6), x.signals) for x in link.namesakes(d).collect()}
        assert got == {k: (min(x[0] for x in of), len(of), sum(x[4] for x in of), sum(x[5] for x in of), sum(x[4] and x[5] for x in of), round(sum(x[1] for x in of), 6), sorted({s for x in of for s in x[2]})) for k, of in kinds.items()}
    groups = {}
    for (i, _), v in [*want.items(), *same.items()]:
        groups.setdefault(find(i), []).append(v)
    got = {x.group_id: (x.members, round(x.confidence, 6), x.signals) for x in link.duplicate_groups(d, least).collect()}
    assert got == {g: ([i for i in range(90) if find(i) == g], round(sum(v[0] for v in of) / len(of), 6), sorted({s for v in of for s in v[1]})) for g, of in groups.items()}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(300, 300 + i) for i in range(1, 40)] + [(7, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {t.node: t.component for t in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in list(root)}


def test_no_components(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_dedupe_rules(spark):
    df = spark.createDataFrame([("u", 0, "N1", "c1"), ("u", 1, "N2", "c2"), ("v", 2, "", "c3"), ("v", 3, "M", "c4")], "url string, ord int, name string, cat string")
    pick = lambda d: {r.url: (r.name, r.cat) for r in d.collect()}
    assert pick(dedupe.first_wins(df, "url", ["ord"], "name")) == {"u": ("N2", "c1"), "v": ("M", "c3")}
    assert pick(dedupe.first_row_named(df, "url", ["ord"])) == {"u": ("N1", "c1"), "v": ("", "c3")}
    assert pick(dedupe.last_wins(df, "url", ["ord"])) == {"u": ("N2", "c2"), "v": ("M", "c4")}
    assert pick(dedupe.prefer_filled(df, ["url"], "name", ["ord"])) == {"u": ("N1", "c1"), "v": ("M", "c4")}
    once = dedupe.keep(df, ["url"], ["ord"])
    assert sorted(map(tuple, dedupe.keep(once, ["url"], ["ord"]).collect())) == sorted(map(tuple, once.collect()))


def test_upsert_keeps_frozen(spark):
    old = spark.createDataFrame([("k", 1, "first", 1)], "key string, v int, by string, seq int")
    new = spark.createDataFrame([("k", 2, "later", 2), ("k", 3, "last", 3), ("n", 4, "x", 2)], "key string, v int, by string, seq int")
    got = {r.key: (r.v, r.by) for r in merge.upsert(old, new, ["key"], "seq", ["by"]).collect()}
    assert got == {"k": (3, "first"), "n": (4, "x")}


def test_far_names(spark):
    e = spark.createDataFrame([("a", 31.0), ("a", 1.0), ("b", None), ("m", 0.0)], "name string, km double")
    names = merge.far_names(e, F.col("km"), 30, ["m"])
    assert {r.name for r in names.collect()} == {"a", "m"}
    edges = spark.createDataFrame([("a", "b"), ("b", "m"), ("b", "c")], "source string, target string")
    assert [tuple(r) for r in merge.remove_edges(edges, names).collect()] == [("b", "c")]
    assert [r.name for r in merge.remove_entities(e, names).collect()] == ["b"]


def test_contract(spark):
    df = spark.createDataFrame([(None, None, None)], "name string, n int, lat double")
    r = merge.contract(df, spark.createDataFrame([], "name string, n int, lat double, extra string").schema).first()
    assert tuple(r) == ("", 0, None, "")


def test_bidirectional(spark):
    e = spark.createDataFrame([("A", "B"), ("B", "A"), ("A", "C")], "source string, target string")
    assert {(r.source, r.target): r.bidirectional for r in link.mark_bidirectional(e).collect()} == {("A", "B"): True, ("B", "A"): True, ("A", "C"): False}


KIND = "cluster_type string, ord int, cluster_id string, cluster_name string, description string, entities array<string>, items array<string>, confidence double"


def test_cluster_merge(spark):
    rows = [("t", 0, "c0", "repair services", "d0", ["a"], ["x"], 0.9), ("t", 1, "c1", "Repair  Services", "d1", ["b", "a"], ["y"], 0.1), ("t", 2, "c2", "other", "d2", [], [], 0.5), ("s", 3, "c3", "repair services", "d3", ["z"], ["w"], 0.4), ("t", 4, "c4", "", "d4", [], [], 0.4), ("t", 5, "c5", " ", "d5", [], [], 0.4)]
    got = {r.cluster_id: (r.cluster_name, r.entities, r["items"], r.confidence, r.source_count) for r in cluster.merge_clusters(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {"c0": ("Repair  Services", ["a", "b"], ["x", "y"], 0.9, 2), "c2": ("other", [], [], 0.5, 1), "c3": ("repair services", ["z"], ["w"], 0.4, 1), "c4": ("", [], [], 0.4, 1), "c5": (" ", [], [], 0.4, 1)}


@pytest.mark.parametrize("seed", range(3))
def test_cluster_merge_is_greedy(spark, seed):
    """Against one cluster after the other: an earlier seed takes up what it is like."""
    r = random.Random(seed)
    words = "a b c d e f g h".split()
    rows = [(r.choice("st"), i, f"c{i}", " ".join(r.sample(words, r.randrange(4, 8))), f"d{i}", [str(r.randrange(9))], [f"i{i}"], 0.1) for i in range(70)]
    want, used = {}, set()
    for kind, i, cid, name, _, _, _, _ in rows:
        if i in used:
            continue
        took = [i]
        for k2, j, _, other, _, _, _, _ in rows[i + 1 :]:
            x, y = set(name.split()), set(other.split())
            if k2 == kind and j not in used and len(x & y) / len(x | y) >= 0.8:
                used.add(j)
                took.append(j)
        best = max(took, key=lambda j: (len(rows[j][3]), -j))
        want[cid] = (rows[best][3], rows[best][4], sorted({rows[j][5][0] for j in took}), [f"i{j}" for j in took], len(took))
    got = {x.cluster_id: (x.cluster_name, x.description, x.entities, x["items"], x.source_count) for x in cluster.merge_clusters(spark.createDataFrame(rows, KIND)).collect()}
    assert got == want and len(used) > 10


def test_synergies(spark):
    kind = "cluster_id string, cluster_name string, entities array<string>, confidence double"
    c = spark.createDataFrame([("1", "metal & wood", ["a", "b"], 0.9)], kind)
    n = spark.createDataFrame([("2", "Wood chips", ["b"], 0.7), ("3", "glass", ["a"], 0.9)], kind)
    assert [tuple(r) for r in link.cluster_synergies(c, n).collect()] == [("a", "b", 0.7)]
    assert [r.cluster_id for r in cluster.gaps(n, c).collect()] == ["3"]


def test_opportunities(spark):
    kind = "entity string, partner string, score double"
    near = spark.createDataFrame([("e", f"p{i}", 0.5 + i / 20) for i in range(9)], kind)
    out = collab.opportunities(near, near, near).orderBy("place").collect()
    assert [(r.kind, r.partner, r.impact) for r in out] == [
        ("complementary", "p8", "high"), ("value_chain", "p8", "high"), ("complementary", "p7", "high"), ("value_chain", "p7", "high"), ("complementary", "p6", "high"), ("value_chain", "p6", "high"),
        ("geographic", "p8", "medium"), ("geographic", "p7", "medium"), ("geographic", "p6", "medium"), ("complementary", "p5", "medium"), ("complementary", "p4", "medium"),
    ]


def test_complementary(spark):
    kind = "entity int, idx int, item string"
    needs = spark.createDataFrame([(1, 0, "Metal scrap"), (1, 1, "paint"), (2, 0, "wood")], kind)
    offers = spark.createDataFrame([(2, 0, "scrap metal sorting"), (3, 0, "PAINT metal"), (1, 0, "wood chips"), (1, 2, "metal")], kind)
    got = {(r.entity, r.partner): (r.n_items, r.matched_items) for r in collab.complementary(needs, offers).collect()}
    assert got[1, 2] == (2, ["Their 'scrap metal sorting' matches your need 'Metal scrap'", "Your 'wood chips' matches their need 'wood'"])
    assert got[1, 3] == (2, ["Their 'PAINT metal' matches your need 'Metal scrap'", "Their 'PAINT metal' matches your need 'paint'"])
    assert got[3, 1][0] == 2 and got[2, 1][0] == 2 and len(got) == 4
    assert {r.partner for r in collab.complementary(needs, offers, 1).where("entity = 1").collect()} == {2}


def test_value_chain(spark):
    r = random.Random(4)
    own = {}
    for _ in range(60):
        own.setdefault(r.randrange(40), set()).add(r.randrange(7))
    stages = spark.createDataFrame([(e, s) for e, of in own.items() for s in of], "entity int, stage int")
    names = list(taxonomy.VALUE_CHAIN)
    want, counts = {}, {}
    for e in own:
        partners = sorted(p for p in own if p != e and any(abs(a - b) <= 1 for a in own[e] for b in own[p]))
        for p in partners:
            a, b = max((a, b) for a in own[e] for b in own[p] if abs(a - b) <= 1)
            kind = "upstream" if b < a else "downstream" if b > a else "parallel"
            said = [f"Upstream: {names[b]} -> {names[a]}" if b < a else f"Downstream: {names[a]} -> {names[b]}" if b > a else f"Same stage: {names[a]}" for a in sorted(own[e]) for b in sorted(own[p]) if abs(a - b) <= 1]
            counts.setdefault(e, []).append(kind)
            if p in partners[:3]:
                want[e, p] = (kind, said)
    assert {(x.entity, x.partner): (x.relation, x.matched_items) for x in collab.value_chain(stages).collect()} == want
    got = {x.entity: (x.n_partners, x.n_upstream, x.n_downstream, x.n_parallel) for x in collab.value_chain_counts(stages).collect()}
    assert got == {e: (len(c := counts.get(e, [])), c.count("upstream"), c.count("downstream"), c.count("parallel")) for e in own}


@pytest.mark.parametrize("seed, least", [(0, 2), (1, 2), (2, 2), (3, 1), (4, 3)])
def test_nearby(spark, seed, least):
    r = random.Random(seed)
    words = ["ort", "weg", "kai", *map(str, range(12))]
    rows = [(i, " ".join(r.choice(words[: r.choice([4, 15])]) for _ in range(r.randrange(0, 7)))) for i in range(70)] + [(99, None)]
    rows += [(i, "ort weg 1") for i in range(200, 260)]  # many at one address
    sets = {i: set((a or "").split()) for i, a in rows}
    want = {}
    for i in sets:
        near = sorted((-len(sets[i] & sets[j]) / max(len(sets[i]), len(sets[j])), j) for j in sets if j != i and len(sets[i] & sets[j]) >= least)
        want |= {(i, j): round(-s, 9) for s, j in [x for x in near if -x[0] >= 0.3][:3]}
    got = {(x.entity, x.partner): round(x.score, 9) for x in collab.nearby(spark.createDataFrame(rows, "entity int, address string"), words=least).collect()}
    assert got == want and len(want) > 60


def test_cluster_overview(spark):
    r = random.Random(2)
    rows = [(r.randrange(6), r.choice(["Glass", "glass", None, "Wood"]), r.choice([*"abcdefgh", None])) for _ in range(60)] + [(1, "Empty", None), (None, "Empty", None)]
    d = spark.createDataFrame(rows, "entity int, kind string, item string")
    by = cluster.by_category(d.select("entity", "item", "kind"), "need", F.col("kind"))
    want = {(x.cluster_id, x.cluster_name): (len(x.entities), len(x["items"]), x.preview) for x in by.withColumn("preview", cluster.preview(F.col("items"), 3)).collect()}
    members = cluster.category_members(d, "need", F.col("kind"))
    assert {(x.cluster_id, x.cluster_name): (x.n_entities, x.n_items, x.preview) for x in cluster.overview(members, 3).collect()} == want and len(want) == 5
    first = by.where("cluster_name = 'Wood'")
    assert {x.entity for x in cluster.entities_of(first, "need_wood", "cluster_id").collect()} == {x.entity for x in members.where("cluster_id = 'need_wood'").collect()}
    assert cluster.overview(members.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_synergies(spark, seed):
    r = random.Random(seed)
    names = ["Recycling Hub", "repair hub", "glass", "RECYCLING", None, "", "wood  glass"]
    caps = [(f"c{i}", r.choice(names), r.choice([0.5, 0.7, 0.9])) for i in range(5)]
    needs = [(f"n{i}", r.choice(names), r.choice([0.6, 0.8])) for i in range(5)]
    offering = [(r.choice(caps)[0], e) for e in range(25) for _ in range(r.randrange(3))] + [("c0", e) for e in range(100, 140)] + [("c1", None), (None, 7)]
    needing = [(r.choice(needs)[0], e) for e in range(25) for _ in range(r.randrange(3))] + [("n0", e) for e in range(120, 125)] + [("gone", 3)]
    want = {}
    for c, cn, cc in caps:
        for n, nn, nc in needs:
            if set((cn or "").lower().split()) & set((nn or "").lower().split()):
                for s in {e for i, e in offering if i == c and e is not None}:
                    for t in {e for i, e in needing if i == n} - {s}:
                        want[s, t] = max(want.get((s, t), 0), min(cc, nc))
    own = {}
    for (s, t), c in want.items():
        own.setdefault(s, []).append((-c, t))
    cluster_rows = "cluster_id string, cluster_name string, confidence double"
    args = [spark.createDataFrame(caps, cluster_rows), spark.createDataFrame(needs, cluster_rows), *(spark.createDataFrame(m, "cluster_id string, entity int") for m in (offering, needing))]
    assert {x.entity: (x.n_partners, x.best) for x in synergy.synergy_counts(*args).collect()} == {s: (len(v), -min(v)[0]) for s, v in own.items()}
    got = {(x.entity, x.partner): x.confidence for x in synergy.first_synergies(*args, n=3).collect()}
    assert got == {(s, t): -c for s, v in own.items() for c, t in sorted(v)[:3]} and got
    none = [a.limit(0) for a in args]
    assert synergy.synergy_counts(*none).count() == 0 and synergy.first_synergies(*none).count() == 0


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_similar_sets(spark, least):
    r = random.Random(3)
    rows = [(i, sorted(set(r.choices("abcdefghijklmno", k=r.randrange(0, 9)))), i % 2) for i in range(80)]
    d = spark.createDataFrame(rows, "i int, w array<string>, g int")
    rep = {x.key: x.rep for x in setjoin.members(d, "i", "w", ("g",)).collect()}
    assert rep == {i: min(j for j, v, h in rows if (v, h) == (w, g)) for i, w, g in rows}
    got = {(x.a, x.b): (round(x.jaccard, 9), x.n_a, x.n_b) for x in setjoin.similar_sets(d, "i", "w", least, ("g",)).collect()}
    size = {i: sum(x == i for x in rep.values()) for i in rep.values()}
    own = [(i, set(w), g) for i, w, g in rows if rep[i] == i and w]
    want = {(a, b): (round(len(x & y) / len(x | y), 9), size[a], size[b]) for a, x, g in own for b, y, h in own if a < b and g == h and len(x & y) / len(x | y) >= least}
    assert got == want and (want or least > 0.5)
    for most in (setjoin.TILE, 300):
        long = setjoin.similar_long_sets(d, "i", "w", least, ("g",), most)
        assert {(x.a, x.b): (round(x.jaccard, 9), x.n_a, x.n_b) for x in long.collect()} == want and long.count() == len(want)


def test_long_sets_send_no_candidates(spark, sf):
    """Words of whole texts are sent once and what meets is compared where it is: candidates took the disk."""
    from orgweave.plans.registry import QUERIES

    plan = QUERIES["jaccard_pairs"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsIn" in plan and "posexplode" not in plan and "array_intersect" not in plan
    blocks = spark.createDataFrame([(1, ["a", "b"], None), (2, ["a", "b", "c"], None), (3, ["a", "b"], 1)], "i int, w array<string>, g int")
    assert setjoin.similar_long_sets(blocks, "i", "w", 0.5, ("g",)).count() == 0  # no block, no pair
    assert [tuple(x) for x in setjoin.similar_long_sets(blocks, "i", "w", 0.5).collect()] == [(1, 2, 2 / 3, 2, 1)]


def test_numbered(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "a", "a", "b", None]), i) for i in range(500)]
    r.shuffle(rows)
    got = {(x.g, x.o): x.number for x in windows.numbered(spark.createDataFrame(rows, "g string, o int").repartition(7), ["g"], ["o"]).collect()}
    assert got == {(g, o): sum(h == g and p < o for h, p in rows) for g, o in rows}


def test_query_counts(spark):
    terms = spark.createDataFrame([("r", f"t{i}") for i in range(141)], "role string, term string")
    keywords = spark.createDataFrame([(f"k{i}",) for i in range(14)], "keyword string")
    kinds = spark.createDataFrame([("r", f"x{i}") for i in range(16)], "role string, type string")
    got = {r.kind: r["count"] for r in generate.queries(terms, keywords, kinds, "Cahul").groupBy("kind").count().collect()}
    assert got == {"broad": 141, "specific": 1974, "type": 16}
    one = generate.queries(terms.limit(1), keywords.limit(1), kinds.limit(1), "Cahul").collect()
    assert [r.query for r in one] == ["t0 Cahul", "k0 t0 Cahul", "x0 Cahul"]


def test_graph(spark):
    p = spark.createDataFrame([(None, "u", None, None, 1.0)], "name string, url string, role string, lat double, lon double").withColumns({"activities": F.lit(None).cast("array<string>"), "description": F.lit(None).cast("string")})
    assert tuple(graph.nodes(p).first()) == ("", "u", "Unknown", None, 1.0, [], "")
    assert graph.complete(95, 100) and not graph.complete(94, 100)
    assert graph.coverage(p.limit(0), (0.0, 0.0)).first().percent == 0


def test_csv_sources(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text('website,name,kind\nhttps://x.de/,"A ""quoted""\nname",e-waste\n,none,\n')
    b.write_text("domain,title\nx.de,B\n")
    src = [registry.Source(str(a), "website", "name", "Firms", "kind"), registry.Source(str(b), "domain", "title", "More", add_protocol=True), registry.Source(str(b), "nope", "title", "x"), registry.Source(str(tmp_path / "gone.csv"), "u", "n", "x")]
    df, skipped = registry.scan(spark, src)
    assert [(r.url, r.name, r.category) for r in df.orderBy("src", "ord").collect()] == [("https://x.de/", 'A "quoted"\nname', "Firms - E-Waste"), ("", "none", "Firms"), ("https://x.de", "B", "More")]
    assert len(skipped) == 2
    assert registry.first_available(spark, [str(tmp_path / "gone"), str(b)]) == str(b)


def test_files_in_order(spark, tmp_path):
    """Rows of several files stand in the files' order, large files first or last; empty files have none."""
    for k, n in enumerate((3, 4000, 1, 900)):
        (tmp_path / f"part{k}.csv").write_text("u,n\n" + "".join(f"https://s{k}-{i}.de,{'x' * 40}\n" for i in range(n)))
    (tmp_path / "part9.csv").write_text("")
    df, _ = registry.scan(spark, [registry.Source(str(tmp_path / "*.csv"), "u", "n", "c", multiline=False)])
    got = [r.url for r in df.orderBy("src", "ord").collect()]
    assert got == [f"https://s{k}-{i}.de" for k, n in enumerate((3, 4000, 1, 900)) for i in range(n)]


def test_header_and_name_column(spark):
    rows = [(0, "Denumirea", "IDNO", None), (1, "Alpha Beta Works", "040 12", "z"), (2, "Denumirea", "IDNO", None)]
    df = spark.createDataFrame(rows, "ord int, `Unnamed: 0` string, _c1 string, _c2 string")
    fixed = registry.promote_header(df, "ord")
    assert fixed.columns == ["Denumirea", "IDNO", "_c2", "ord"] and sorted(r.ord for r in fixed.collect()) == [1, 2]
    assert registry.name_column(fixed.drop("ord")) == "Denumirea"
    assert registry.promote_header(spark.createDataFrame(rows, "ord int, a string, b string, _c2 string"), "ord").columns == ["ord", "a", "b", "_c2"]
    raw = spark.createDataFrame([("0401234567", "Alpha Beta Works", "x"), ("0402223334", "Gamma Delta Haus", "y")], "a string, b string, c string")
    assert registry.name_column(raw) == "b"
    assert registry.settings("extraction:\n  model: a\nextraction:\n  depth: 2\n") == {"extraction": {"depth": 2}}


def test_markup(spark):
    html = '<html><head><title> T &amp; x</title><style>a{}</style></head><body><nav>no</nav><p>A &lt;b&gt;</p><script type="application/ld+json">[{"@type":"Organization","name":"N","url":"https://n.de"}]</script><a class="q" href="https://www.o.de/x">O <b>rg</b></a><a href="https://facebook.com/o">f</a></body></html>'
    p = spark.createDataFrame([(1, html, "me.de")], "page_id int, html string, own string")
    assert p.select(markup.page_text(F.col("html"))).first()[0] == "T & x A <b> O rg f"
    a = markup.anchors(p, "page_id").withColumn("own", F.lit("me.de"))
    assert [(r.href, r.label) for r in markup.external(a).collect()] == [("https://www.o.de/x", "O rg")]
    assert p.select(markup.json_ld(F.col("html")).alias("j")).first().j.name == "N"
    assert p.select(markup.page_text(F.col("html"), 22, F.lit("u"))).first()[0] == "=== u ===\nT & x A <b> "
    two = spark.createDataFrame([(1, 1, "b", "<p>second</p>"), (1, 0, "a", "<p>first</p>")], "site int, n int, url string, html string")
    assert markup.site_text(two, "site", "n").first().text == "=== a ===\nfirst\n\n=== b ===\nsecond"


def test_xml_flattening(spark):
    df = spark.createDataFrame([('<p id="1"><a><b>x</b><b k="v">y</b></a><c/></p>',), ("<bad",), (None,)], "xml string")
    rows = [r.fields for r in markup.xml_records(df).collect()]
    assert rows == [{"@id": "1", "a.b": "x", "a.b@k": "v", "a.b__2": "y"}, None, None]
    assert markup.guess_record_tag(iter([("p", 2), ("x", 0)] * 10)) == "p" and markup.guess_record_tag(iter([])) is None


def test_bullets_and_names(spark):
    lines = spark.createDataFrame([("d", 0, "intro"), ("d", 1, "• Alpha Um-"), ("d", 2, "welt GmbH"), ("d", 3, "• Tel 12")], "doc string, ord int, line string")
    got = markup.bullets(lines, "doc")
    assert sorted((r.item, r.text) for r in got.collect()) == [(1, "Alpha Umwelt GmbH"), (2, "Tel 12")]
    assert [r.text for r in got.where(markup.looks_like_name(F.col("text"))).collect()] == ["Alpha Umwelt GmbH"]
    people = spark.createDataFrame([("Dr. Anna", True, True), ("Umwelt Verein", True, True), ("lower case", False, False), ("A B C D E", False, True), ("one Two three Four five six seven", False, False), (None, False, False)], "s string, w boolean, v boolean")
    assert all((r.p, r.q) == (r.w, r.v) for r in people.withColumn("p", markup.looks_like_person(F.col("s"))).withColumn("q", markup.looks_like_person(F.col("s"), False)).collect())


def test_parsed_files(spark):
    df = spark.createDataFrame([("a", bytearray(b"x,y")), ("b", bytearray(b"!"))], "path string, content binary")

    def parse(data):
        if data == b"!":
            raise ValueError
        return [(0, 0, i, c) for i, c in enumerate(data.decode().split(","))]

    assert [tuple(r) for r in markup.parsed_files(df, parse).orderBy("cell").collect()] == [("a", 0, 0, 0, "x"), ("a", 0, 0, 1, "y")]


def test_tokens(spark):
    df = spark.createDataFrame([("Compania Națională de Apă, the",), (None,)], "s string")
    got = [r.t for r in df.select(text.tokens(F.col("s"), stop=text.AGENCY_STOPLIST).alias("t")).collect()]
    assert got == [["națională", "apă", "the"], []]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("u", "2024-01-01 00:00:00", 1), ("u", "2024-01-01 00:00:05", 2), ("v", "2024-01-01 00:00:09", 3)], "url string, at string, seq int").withColumn("at", F.to_timestamp("at"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = new_only(stream, "url", "at").writeStream.format("memory").queryName("fresh").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination()
    assert sorted(r.url for r in spark.table("fresh").collect()) == ["u", "v"]
    q = upsert_batches(stream, str(tmp_path / "out"), ["url"], "seq", str(tmp_path / "c2"))
    q.awaitTermination()
    assert {r.url: r.seq for r in read_upserted(spark, str(tmp_path / "out")).collect()} == {"u": 2, "v": 3}
    rows.withColumn("seq", F.col("seq") + 5).where("url = 'v'").write.mode("append").parquet(str(tmp_path / "in"))
    upsert_batches(stream, str(tmp_path / "out"), ["url"], "seq", str(tmp_path / "c2")).awaitTermination()
    assert {r.url: r.seq for r in read_upserted(spark, str(tmp_path / "out")).collect()} == {"u": 2, "v": 8}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "url string, n int")
    t = str(tmp_path / "t")
    assert sinks.versions(spark, t) == [] and sinks.write_version(df, t) == 0 and sinks.write_version(df.limit(1), t) == 1
    assert sinks.read_version(spark, t).count() == 1 and sinks.read_version(spark, t, 0).count() == 2
    assert sinks.truncate(spark, t) == 2 and sinks.read_version(spark, t).count() == 0 and sinks.versions(spark, t) == [1, 2]
    sinks.csv_file(df, str(tmp_path / "c"))
    assert sorted(map(tuple, registry.read_csv(spark, str(tmp_path / "c")).collect())) == [("a", "1"), ("b", "2")]
    for _ in range(2):
        sinks.json_lines(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4
    parts = []
    assert sinks.json_document(df.withColumn("t", F.lit("ü")), ["url"], parts.append) == 2
    assert json.loads("".join(parts)) == [{"url": "a", "n": 1, "t": "ü"}, {"url": "b", "n": 2, "t": "ü"}] and "ü" in "".join(parts)
    empty = []
    assert sinks.json_document(df.limit(0), ["url"], empty.append) == 0 and json.loads("".join(empty)) == []
    for n in (1, 5):
        sinks.append_rows(df.withColumn("n", F.col("n") * n), str(tmp_path / "cache"))
    assert {r.url: r.n for r in sinks.last_of(spark, str(tmp_path / "cache"), ["url"]).collect()} == {"a": 5, "b": 10}
    assert sinks.parquet_or_csv(df, str(tmp_path / "p")) == "parquet"
    sinks.raw_pages(df, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2
    assert sinks.report("Rows", df.orderBy("n")).splitlines()[2] == "url: a  n: 1"


def test_candidate_points(spark):
    """Branch by branch: rejects, title and text without marks, listings by the address."""
    kind = "url string, title string, body string, w int"
    rows = [
        ("https://www.linkedin.com/x", "alpha beta", "alpha beta cahul", -100), ("", "alpha", "alpha", -100), (None, "alpha", "alpha", -100), ("no scheme", "alpha", "", -100), ("https://play.google.com/a", "", "", -100),
        ("https://alpha.md/", "ÁLPHA", "Bêta in Cahul", 20 + 30 + 25 + 10), ("https://x.org/news/1", "alpha", "", 15 - 15), ("https://news.org/1", None, None, 0), ("https://beta.md:80/item/2", "gamma", "beta", 30 + 25 - 15),
    ]
    names = F.array(F.lit("alpha"), F.lit("beta"), F.lit("gamma"))
    d = spark.createDataFrame(rows, kind)
    got = [r.p for r in d.withColumn("p", profiles.candidate_points(F.col("url"), F.col("title"), F.col("body"), names, "cahul", ".md")).collect()]
    assert got == [r[3] for r in rows]


def test_page_points(spark):
    rows = [("h", "abc", "alpha beta", "x", 40 - 5), ("h", "  a ", "", "in cahul", 15), ("h", None, None, None, -5), ("", "alpha", "", "cahul", 0), (None, "alpha", "", "", 0), ("h", "Alpha of Beta", "alpha", "", 40)]
    d = spark.createDataFrame(rows, "html string, title string, h1 string, body string, w int")
    names = F.array(F.lit("alpha"), F.lit("beta"))
    assert [r.p for r in d.withColumn("p", profiles.page_points(F.col("html"), F.col("title"), F.col("h1"), F.col("body"), names, "cahul")).collect()] == [r[4] for r in rows]


def test_placeholders_and_lookups(spark):
    d = spark.createDataFrame([(" https://www.KOELN.de/ ", ""), ("https://www.koeln.de", "https://www.koeln.de"), ("n/a", "n/a"), (None, None)], "w string, x string")
    assert all(r.y == r.x for r in d.withColumn("y", profiles.blank_placeholders(F.col("w"))).collect())
    rows = spark.createDataFrame([("k", ""), ("k", "own"), ("z", None)], "k string, v string")
    lookup = spark.createDataFrame([("k", "b", 2), ("k", "c", 1)], "k string, v string, o int")
    assert sorted(map(tuple, merge.fill(rows, lookup, "k", "v").collect()), key=repr) == [("k", "b"), ("k", "own"), ("z", None)]
    assert sorted(r.v for r in merge.fill(rows.where("k = 'k'"), lookup, "k", "v", "o").collect()) == ["c", "own"]


def test_rejected_entities(spark):
    kind = "array<struct<name string, url string, brief_description string, context string>>"
    d = spark.createDataFrame([([("n", "u", "b", "c"), ("n", None, " ", None), ("n", " ", "b", "c")],)], f"e {kind}")
    good, bad = profiles.split_discovered(F.col("e"))
    r = d.select(good.alias("g"), bad.alias("b")).first()
    assert [x.name for x in r.g] == ["n"] and [(x["index"], x.reason) for x in r.b] == [(1, "None/null values in fields: url, context"), (2, "Empty string in fields: url")]


def test_agency_names(spark):
    rows = [("Societatea cu Răspundere Limitată „Apă-Canal”, S.R.L", "apa-canal"), ("Compania de Stat SA", "de stat"), ("Institutul X", "x"), (None, "")]
    d = spark.createDataFrame(rows, "s string, w string")
    assert all(r.y == r.w for r in d.withColumn("y", profiles.agency_name(F.col("s"))).collect()), [tuple(r) for r in d.withColumn("y", profiles.agency_name(F.col("s"))).collect()]


def test_place_row(spark):
    place = "struct<name string, formatted_address string, vicinity string, formatted_phone_number string, website string, geometry struct<location struct<lat double, lng double>>, place_id string, types array<string>, type string, business_status string, rating double, user_ratings_total int>"
    d = spark.createDataFrame([(("n", None, "near", None, "w", ((1.5, 2.5),), "id", [], "bank", None, 4.5, None),), (("m", "", "near", "1", None, None, "i2", ["a", "b"], "c", "OK", None, 7),)], f"p {place}")
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    got = [tuple(r) for r in d.select(*profiles.place_row(F.col("p"), F.lit("role"), F.lit("q"), at)).collect()]
    assert got == [
        ("n", "near", "", "w", "1.5", "2.5", "id", "bank", "", "4.5", "", "role", "q", "2024-01-02T03:04:05.000000"),
        ("m", "", "1", "", "", "", "i2", "a, b", "OK", "", "7", "role", "q", "2024-01-02T03:04:05.000000"),
    ]


def test_clusters_by_id(spark):
    d = spark.createDataFrame([(1, "c", ["a"]), (0, "c", ["x", "y"]), (2, "d", [])], "ord int, cluster_id string, entities array<string>")
    assert sorted(r.entity for r in cluster.entities_of(d, "c").collect()) == ["x", "y"] and cluster.entities_of(d, "none").count() == 0


def test_scan_equals_windows(spark):
    """Values that come in from earlier ranges, for one long list, short ones, null groups and ties."""
    r = random.Random(2)
    rows = [(r.choice(["a"] * 6 + ["b", None]), i // 2 if i < 40 else i, r.choice([None, None, str(i)]), r.choice([None, 1, 2])) for i in range(700)]
    r.shuffle(rows)
    d = spark.createDataFrame(rows, "g string, o int, s string, n int").repartition(5)
    v = F.struct(F.col("s").alias("v"))
    got = scan.scan(d, ["g"], ["o"], last={"l": F.col("s")}, total={"t": F.col("n")}, before={"b": F.col("s")}, after={"a": F.col("s")})
    w = Window.partitionBy("g").orderBy("o", F.xxhash64("g", "o", "s", "n"))
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    want = d.select("g", "o", "s", "n", F.last("s", True).over(up).alias("l"), F.sum("n").over(up).alias("t"), F.lag(v).over(w).alias("b"), F.lead(v).over(w).alias("a"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert scan.scan(d.limit(0), ["g"], ["o"], total={"t": F.lit(1)}).count() == 0
    again = scan.scan(d.withColumn("range", F.lit("own")), ["g"], ["o"], last={"s": F.col("s")})
    assert again.columns == ["g", "o", "n", "range", "s"] and again.where("range = 'own'").count() == 700


def test_scan_spreads_one_list(spark):
    d = spark.range(40_000).select(F.lit("g").alias("g"), "id", F.when(F.col("id") % 1000 == 0, F.col("id")).alias("head"))
    got = scan.scan(d, ["g"], ["id"], last={"at": F.col("head")}, total={"n": F.lit(1)})
    assert got.where("at <> id - id % 1000 OR n <> id + 1").count() == 0
    assert got.groupBy(F.spark_partition_id()).count().count() > 1


def test_early_exit_carries_bonuses(spark):
    """Against the loop: a page that can't be fetched leaves the bonus of the one before."""
    r = random.Random(8)
    rows = [(k, i, r.randrange(60), r.choice([None, 0, 10, 40])) for k in range(40) for i in range(r.randrange(1, 9))]
    want = {}
    for k in {x[0] for x in rows}:
        bonus, best = 0, (None, -999)
        for _, i, p, b in sorted((x for x in rows if x[0] == k), key=lambda x: (-x[2], x[1]))[:5]:
            bonus = bonus if b is None else b
            if p + bonus > best[1]:
                best = (i, p + bonus)
            if p + bonus >= 70:
                break
        want[k] = best
    got = windows.early_exit(spark.createDataFrame(rows, "k int, i int, p int, b int"), "k", "p", "b", "i")
    assert {x.k: (x.i, x.total) for x in got.collect()} == want


def test_sinks_of_several_files(spark, tmp_path):
    df = spark.range(0, 2500, 1, 6).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('ü\"', id) END AS t")
    assert sinks.csv_file(df, str(tmp_path / "one")) == 1 and len(list((tmp_path / "one").glob("part-*"))) == 1
    assert sinks.csv_file(df, str(tmp_path / "more"), 1000) == 3
    parts = sorted((tmp_path / "more").glob("part-*"))
    assert len(parts) == 3 and [x.split(",")[0] for p in parts for x in p.read_text().splitlines()[1:]] == [str(i) for i in range(2500)]
    for name, rows, order in (("j", df, ["id"]), ("none", df.limit(0), ["id"]), ("lone", df.limit(1), ["id"])):
        sinks.json_parts(rows, order, str(tmp_path / name))
        text = "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*")))
        assert json.loads(text) == [{k: v for k, v in x.asDict().items() if v is not None} for x in rows.collect()]
    twice = spark.createDataFrame([(1, "a"), (2, "x"), (1, "b")], "k int, v string").coalesce(1)
    sinks.append_rows(twice, str(tmp_path / "cache"))
    assert sorted(map(tuple, sinks.last_of(spark, str(tmp_path / "cache"), ["k"]).collect())) == [(1, "b"), (2, "x")]


def test_namesakes_are_listed_with_every(spark):
    """Three orgs of one name and one of another at a host: pairs of the same name come with every."""
    rows = [(i, "Green Works", "https://a.example", None, None) for i in (1, 2, 3)] + [(4, "Green Workz", "https://a.example", None, None), (5, "Green Works", "https://b.example", None, None), (6, "", "https://b.example", None, None)]
    d = spark.createDataFrame(rows, "id long, name string, url string, address string, phones array<string>")
    got = {(x.i, x.j): round(x.score, 6) for x in link.duplicate_pairs(d, 0.66, every=True).collect()}
    assert {k for k, v in got.items() if v == 0.7} == {(1, 2), (1, 3), (2, 3)} and got.keys() - {(1, 4), (2, 4), (3, 4)} == {(1, 2), (1, 3), (2, 3)} and len(got) == 6
    assert {(x.i, x.j) for x in link.duplicate_pairs(d, 0.66).collect()} == {(1, 4), (2, 4), (3, 4)}


def test_joins_of_many_short_rows_are_not_broadcast(spark):
    """Neither the plan of pairs nor that of a page's cards sends a table through the driver."""
    rows = [(i, f"Green Works {i % 3}", "https://a.example", "A B C", ["+49 40 1"]) for i in range(9)]
    d = spark.createDataFrame(rows, "id long, name string, url string, address string, phones array<string>")
    e = elements.elements(spark.createDataFrame([(1, "<div class=card><h3>A</h3><a href=https://b.example>x</a></div>")], "page int, html string"), "page")
    tile = elements.has_class("card")
    for out in (link.duplicate_pairs(d, every=True), link.namesakes(d), elements.card_links(e, "page", tile), elements.button_cards(e, "page", F.col("label") == "x", tile, "own")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_distinct_edges(spark):
    """Each edge once, marked without a join; tasks are as many as the rows ask for."""
    r = random.Random(5)
    rows = [(r.randrange(12), r.randrange(12)) for _ in range(90)] + [(None, 1), (1, None), (3, 3), (100, 2)]
    e = spark.createDataFrame(rows, "source long, target long")
    own = {x for x in rows if None not in x and x[0] != x[1]}
    got = [tuple(x) for x in link.distinct_edges(e, len(rows)).collect()]
    assert sorted(got) == sorted((a, b, (b, a) in own) for a, b in own) and {x[2] for x in got} == {True, False}
    plan = link.distinct_edges(e, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert hot.dealt(e, 40 * hot.ROWS, "source").rdd.getNumPartitions() == 41


def test_rows_of_a_small_file_are_dealt(spark, sf):
    from orgweave.plans.registry import QUERIES

    assert QUERIES["capability_search"](spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_unlike_names_end_at_their_meeting(spark):
    """Names go by number and their bits are compared where two meet, before pairs are shuffled."""
    r = random.Random(9)
    names = ["".join(r.choice("0123456789abcdef ") for _ in range(18)) for _ in range(60)]
    left = spark.createDataFrame([(n[:5] + n[6:],) for n in names], "k string")
    got = fuzzy.candidates(left, spark.createDataFrame([(n,) for n in names], "n string"), 0.85)
    assert "bit_count" in got._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(x) for x in got.collect()} >= {(n[:5] + n[6:], n) for n in names}


@pytest.mark.parametrize("km, most", [(150.5, 4), (150.5, 10_000), (2.0, 3), (4000.0, 9), (10_100.0, 50), (20_100.0, 50)])
def test_near_pairs_of_tiles(spark, monkeypatch, km, most):
    """Every pair once with both counts, at the poles, over the date line and where cells are cut into tiles."""
    monkeypatch.setattr(near, "DENSE", most)
    r = random.Random(7)
    at = [(s * (90 - r.randrange(30) / 20), r.randrange(-1800, 1800) / 10) for s in (1, -1) for _ in range(25)]
    at += [(r.randrange(-900, 901) / 10, r.randrange(-1800, 1801) / 10) for _ in range(40)] + [(r.randrange(-20, 20) / 10, s * (180 - r.randrange(12) / 10)) for s in (1, -1) for _ in range(15)]
    at += [(50.0, 8.0), (50.01, 8.0), (50.0, 8.01), (50.0, -352.0), (90.0, 5.0), (90.0, 7.0), (-90.0, 1.0)]
    places = spark.createDataFrame([(i, *p) for i, p in enumerate(at)], "id long, lat double, lon double")
    classes = near.place_classes(places)
    k = classes.collect()

    def far(x, y):
        p, q = math.radians(x.lat), math.radians(y.lat)
        return 2 * near.RADIUS_KM * math.asin(math.sqrt(min(1, math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(y.lon - x.lon) / 2) ** 2)))

    want = sorted((x.rep, y.rep, x.n, y.n, round(far(x, y), 6)) for x in k for y in k if x.rep < y.rep and far(x, y) <= km)
    got = near.near_pairs(classes, km)
    assert got.columns == ["a", "b", "n_a", "n_b", "km"]
    got = sorted((*x[:4], round(x.km, 6)) for x in got.collect())
    assert [x[:4] for x in got] == [x[:4] for x in want] and [x[4] for x in got] == pytest.approx([x[4] for x in want], abs=1e-5)
    members, pairs = near.near(places, km)
    assert sum(x.n for x in k) == members.count() == len(at) and pairs.columns == ["a", "b", "km"] and pairs.count() == len(want)


def test_near_places_are_shuffled_as_places(spark, sf):
    """Pairs, which can be very many, go through no exchange and no further join."""
    from orgweave.plans.registry import QUERIES

    plan = QUERIES["near_places"](spark, sf)._jdf.queryExecution().executedPlan().toString().split("\n")
    met = next(i for i, x in enumerate(plan) if "Join" in x and "ASIN" in x)
    assert not [x for x in plan[:met] if "Exchange" in x or "Join" in x]
