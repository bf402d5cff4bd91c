"""What is kept between runs: groups, sketches, streams; and joins by distance, shortest ways."""

import math
import random

import pytest
from pyspark.sql import functions as F

from orgweave.operators import graph, increments, link, near, sketches, taxonomy, windows
from orgweave.streaming import limits


def components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("seed", range(2))
def test_groups_by_batches_are_those_of_one_run(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(120), r.randrange(120)) for _ in range(90)] + [(None, 3), (5, 5)]
    r.shuffle(edges)
    groups, seen = None, []
    for at in range(0, len(edges), 31):
        batch = edges[at : at + 31]
        before = components(seen)
        seen += batch
        groups, merged = increments.merge_edges(groups, spark.createDataFrame(batch, "src long, dst long"))
        now = components(seen)
        assert {x.node: x.component for x in groups.collect()} == now
        assert {x.component: x["into"] for x in merged.collect()} == {c: now[c] for c in set(before.values()) if now[c] != c}
    same, merged = increments.merge_edges(groups, spark.createDataFrame([], "src long, dst long"))
    assert same.count() == groups.count() and merged.count() == 0


def test_duplicates_by_batches(spark):
    r = random.Random(5)
    kind = "id long, name string, url string, address string, phones array<string>"
    rows = [(i, r.choice(["Green Works", "Green Wrks", "Blue Haus", "Thea", ""]), f"https://h{r.randrange(6)}.de/{i}", r.choice(["Am Kai 1", "am kai 1 x", ""]), [f"040 {r.randrange(4)}"]) for i in range(60)]
    r.shuffle(rows)
    every = spark.createDataFrame(rows, kind)
    want = {x.i: x.j for x in ()} | {m: g.group_id for g in link.duplicate_groups(every).collect() for m in g.members}
    groups, known, pairs = None, every.limit(0), set()
    for at in range(0, 60, 25):
        batch = spark.createDataFrame(rows[at : at + 25], kind)
        found, groups, _ = increments.duplicate_batch(known, batch, groups)
        new = {(x.i, x.j) for x in found.collect()}
        assert not new & pairs
        pairs |= new
        known = known.unionByName(batch)
    assert {x.node: x.component for x in groups.collect()} == want
    assert pairs == {(x.i, x.j) for x in link.duplicate_pairs(every).collect()}


def test_sketches_add_up(spark):
    rows = spark.range(30_000).selectExpr("CAST(id % 7 AS int) AS day", "CASE WHEN id % 5 = 0 THEN 'often' WHEN id % 11 = 0 THEN NULL ELSE CAST(id * 7919 % 9973 AS string) END AS v")
    exact = {x.day: (x.n, x.d) for x in rows.groupBy("day").agg(F.count("*").alias("n"), F.count_distinct("v").alias("d")).collect()}
    days = sketches.summarise(rows, ["day"], "v")
    for x in sketches.estimates(days, ["day"], 1).collect():
        n, d = exact[x.day]
        assert x.n == n and abs(x.n_distinct - d) <= 0.05 * d and x.top[0].item == "often"
    all_days = sketches.estimates(sketches.united(days.withColumn("all", F.lit(1)), ["all"]), ["all"], 1).first()
    d = rows.agg(F.count_distinct("v")).first()[0]
    assert all_days.n == 30_000 and abs(all_days.n_distinct - d) <= 0.05 * d and 6000 <= all_days.top[0]["count"] <= 6000 + 30_000 / sketches.COUNTERS
    assert sketches.summarise(rows.limit(0), ["day"], "v").count() == 0


def test_most_frequent_values_are_counted_exactly(spark):
    """Thirty times more values than counters."""
    rows = spark.range(120_000).selectExpr("CAST(id % 2 AS int) AS g", "CAST(id % 30 AS int) AS day", "CASE WHEN id >= 75000 THEN 'often' ELSE CAST(id * 7919 % 30011 AS string) END AS v")
    found = sketches.estimates(sketches.united(sketches.summarise(rows, ["g", "day"], "v"), ["g"]), ["g"])
    assert [x.top[0]["count"] for x in found.orderBy("g").collect()] != [22_500, 22_500]
    assert sorted(map(tuple, sketches.most_frequent(rows, found, ["g"], "v").collect())) == [(0, "often", 22_500), (1, "often", 22_500)]


def test_places_keep_their_coordinates(spark):
    """Longitudes that differ in the last bits are different; only other turns are made one."""
    places = [(1, 5.0, 0.1), (2, 5.0, 0.1 + 180.0 - 180.0), (3, 5.0, 360.1), (4, 5.0, -179.7), (5, 5.0, 180.0), (6, 5.0, -180.0)]
    got = {x.rep: (x.lon, x.n) for x in near.place_classes(spark.createDataFrame(places, "id long, lat double, lon double")).collect()}
    assert places[0][2] != places[1][2] and got[1] == (0.1, 1) and got[4] == (-179.7, 1) and got[5] == (-180.0, 2)


def far(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1.0)))


@pytest.mark.parametrize("km, dense", [(3.0, 5000), (150.0, 7), (2500.0, 5000), (25000.0, 50)])
def test_near_equals_all_pairs(spark, km, dense):
    r = random.Random(int(km))
    some = [(0.0, 0.0), (90.0, 12.0), (90.0, -170.0), (-90.0, 5.0), (10.0, 180.0), (10.0, -180.0), (10.0, 540 - 360.0), (0.0, -0.0)]
    places = [(i, *x) for i, x in enumerate(some)]
    for i in range(100, 320):
        base = r.choice([(89.7, 0), (-89.9, 90), (20, 179.95), (0, 0), (53.5, 10), (r.uniform(-90, 90), r.uniform(-180, 180))])
        d = r.choice([0.01, 0.5, 8])
        places.append((i, max(-90.0, min(90.0, base[0] + r.uniform(-d, d))), (base[1] + r.uniform(-d, d) + 180) % 360 - 180))
    places += [(900, None, 1.0), (901, 1.0, None), (902, 91.0, 0.0)]
    before = near.DENSE
    near.DENSE = dense
    try:
        members, pairs = near.near(spark.createDataFrame(places, "id long, lat double, lon double"), km)
        rep = {x.id: x.rep for x in members.collect()}
        got = {(x.a, x.b): x.km for x in pairs.collect()}
        assert pairs.count() == len(got)
    finally:
        near.DENSE = before
    ok = {i: (a, b) for i, a, b in places if i < 900}
    assert set(rep) == set(ok) and rep[1] == rep[2] == 1 and rep[4] == rep[5] == rep[6] == 4 and rep[7] == 0
    reps = sorted(set(rep.values()))
    want = {(a, b): far(ok[a], ok[b]) for a in reps for b in reps if a < b and far(ok[a], ok[b]) <= km}
    assert got.keys() == want.keys() and want
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_shortest_ways(spark):
    r = random.Random(3)
    edges = [(r.randrange(40), r.randrange(40)) for _ in range(90)] + [(None, 1), (0, None), (2, 2)]
    e = spark.createDataFrame(edges, "src long, dst long")
    got = {x.node: (x.depth, x.parent, x.chain) for x in graph.discovery_paths(e, spark.createDataFrame([(0,), (7,), (7,), (None,)], "node long"), 3).collect()}
    want, front = {0: (0, None, "0"), 7: (0, None, "7")}, [0, 7]
    for d in (1, 2, 3):
        step = {}
        for a, b in edges:
            if a in front and b is not None and b not in want:
                step[b] = min(step.get(b, a), a)
        want |= {b: (d, a, f"{want[a][2]} -> {b}") for b, a in step.items()}
        front = list(step)
    assert got == want


def test_keywords_at_every_place(spark):
    """One pattern against one search for each keyword, which may overlap, nest and have signs."""
    r = random.Random(9)
    words = ["ab", "abc", "bca", "c", "a.c", "a+b", "x y", "é", "(b", "b-c", "abcabc", "日本", "\\d"]
    keywords = [(w, f"A{i % 9}") for i, w in enumerate(words)]
    texts = ["".join(r.choice(["a", "b", "c", "B", ".", "+", "x", " ", "y", "É", "(", "-", "日", "本", "\\", "d"]) for _ in range(r.randrange(40))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("hits", F.lit("own"))
    for rules in (keywords, [*keywords, ("", "always")], [("", "always")], []):
        got = {x.k: x.activities for x in taxonomy.match(df, "t", rules).where("hits = 'own'").collect()}
        assert got == {k: list(dict.fromkeys(a for w, a in rules if w in (t or "").lower())) for k, t in enumerate(texts)}


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, limits.STORE)
    yield
    spark.conf.set(key, before)


def test_limits_over_streams(spark, sf, tmp_path, rocksdb):
    """Two runs from one checkpoint: each warning once, and the figures of the batch operators."""
    ev = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id", "CAST(ts AS timestamp) AS ts", "event_id").where("user_id < 12")
    half, src = 500, str(tmp_path / "src")
    for part in (f"event_id < {half}", f"event_id >= {half}"):
        ev.where(part).coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema(ev.schema).parquet(src)
        for name, q in (("quota", limits.quota_warnings(s, "user_id", "ts", "event_id", F.lit(1), 10.0)), ("rate", limits.rate_counts(s, "user_id", "ts", "event_id", 3_600_000))):
            q.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start().awaitTermination()
    levels = windows.quota(ev, "user_id", F.lit(1), ["event_id"], 10.0).where("level <> 'ok'").groupBy("user_id", "level").agg(F.min("event_id").alias("event_id"))
    got = spark.read.parquet(str(tmp_path / "quota")).select("key", "level", "id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, levels.collect())) and got
    want = windows.most_in(ev, "user_id", "ts", 3600).select("user_id", "event_id", "in_window")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "rate")).select("key", "id", "in_window").collect())) == sorted(map(tuple, want.collect()))
