"""The pipeline's stages against brute force, each on what the stage before kept."""

import random
import re
import subprocess
import sys
import textwrap
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orgweave.llm import decontaminate, pieces, simhash, toxicity

r = random.Random(12)
VOCAB = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 7))) for _ in range(500)]


def sentence(n):
    return " ".join(r.choice(VOCAB) for _ in range(n))


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    item = sentence(25)
    docs = {}
    for i in range(150):
        docs[i] = "\n".join(sentence(r.randrange(6, 30)) for _ in range(r.randrange(1, 5)))
    for i in range(20):
        docs[i] += " scum " + r.choice(["idiot", "moron"])
    docs[30] += "\n" + docs[31].split("\n")[0]
    docs[40] = docs[41] + " tail"
    docs[50] = sentence(5) + " " + item + " " + sentence(5)
    docs[60] = docs[61]
    words = docs[70].split(" ")
    docs[71] = " ".join(words[:-1]) + "x" if len(words) > 4 else docs[70]
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(200, None, "en", "s", None), (201, "", "en", "s", 0), (None, "lonely " + sentence(12), None, None, 3), (60, docs[60], "en", "s", len(docs[60]))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i < 20)) for i in range(0, 150)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def keyed(df):
    return sorted(((x.doc_id, x.text, x.n_chars) for x in df.collect()), key=repr)


def test_stages(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    got = {}
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs, tables).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        got[name] = (before, docs)
        if name != "sentencepiece":
            assert docs.columns == columns

    before, after = got["toxicity"]
    model = toxicity.train(before, labels)
    rows = keyed(before)
    assert keyed(after) == [x for x, s in zip(rows, model.scores([x[1] for x in rows])) if s < 0.5]
    assert not {x[0] for x in keyed(after)} & set(range(20)) and len(keyed(after)) >= 130

    before, after = got["line_dedup"]
    rows = keyed(before)
    sets = []
    want = []
    order = sorted({(x[0], x[1]) for x in rows if x[1]}, key=lambda x: (x[0] is not None, x[0] or 0))
    gone = {}
    for i, t in order:
        for k, line in enumerate(t.split("\n")):
            w = set(re.findall(r"[^\x20\x09-\x0D]+", lower(line)))
            if w:
                if any(5 * len(w & v) >= 4 * len(w | v) for v in sets):
                    gone.setdefault((i, t), set()).add(k)
                sets.append(w)
    for i, t, n in rows:
        k = gone.get((i, t), set())
        left = "\n".join(x for j, x in enumerate(t.split("\n")) if j not in k) if k else t
        if not k or left.strip(" \t\n\x0b\x0c\r"):
            want.append((i, left, len(left) if k else n))
    assert keyed(after) == sorted(want, key=repr) and gone

    before, after = got["simhash_near_dedup"]
    rows = sorted({(x[0], x[1], x[2]) for x in keyed(before)}, key=lambda x: (x[0] is None, x[0] or 0))
    fp = np.array([simhash.fingerprint(x[1]) for x in rows], np.uint64)
    left, todo = [], list(range(len(rows)))
    while todo:
        group, front = {todo[0]}, [todo[0]]
        while front:
            x = front.pop()
            new = [j for j in todo if j not in group and int(fp[x] ^ fp[j]).bit_count() <= 3]
            group.update(new)
            front += new
        left.append(rows[min(group)])
        todo = [j for j in todo if j not in group]
    assert keyed(after) == sorted(left, key=repr)

    before, after = got["benchmark_decontamination"]
    item = spark.read.parquet(f"{tables}/benchmark.parquet").first().text
    windows = decontaminate.windows(item)
    assert keyed(after) == [x for x in keyed(before) if not any(w in decontaminate.normalise(x[1]) for w in windows)]
    assert 50 not in {x[0] for x in keyed(after)}

    before, after = got["sentencepiece"]
    t = pieces.Transducer(pieces.load())
    assert sorted(((x.doc_id, x.n_tokens, x.round_trip) for x in after.collect()), key=repr) == sorted(((i, len(t.encode([x])[0]), True) for i, x, _ in keyed(before)), key=repr)
    whole = corpus_pipeline.run(spark, tables)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, after.collect()))


def test_odd_rows(spark, tables, tmp_path):
    """Nulls, a very long text, ties, rows that differ in other columns only, and columns that stages make."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    long = " ".join(f"w{i % 7000}" for i in range(60_000))
    extra = [(300, long, "en", "a", 5), (301, long, "de", "b", 5), (302, "tie of a few words here and there", "en", "z", 1), (302, "tie of a few words here and there", "de", "y", 1), (303, None, None, None, None), (304, " \n ", "en", "s", 3)]
    clash = ["removed_lines", "gone", "leak", "score", "component", "component_id", "row", "rk", "fp", "n_hit", "text_", "encoded"]
    odd = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({c: F.lit(f"own {c}") for c in clash})
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, f in corpus_pipeline.STAGES[:-1]:
        f(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        assert now.columns == odd.columns
        assert all(r[c] == f"own {c}" for r in now.select(*clash).distinct().collect() for c in clash)
    left = {r.doc_id: r for r in now.collect()}
    assert left[300].text == long and 301 not in left and now.where("doc_id = 302").count() == 1
    again = corpus_pipeline.near_dedup(spark, spark.read.parquet(str(tmp_path / "line_dedup")).repartition(5), str(tmp_path))
    assert sorted(map(repr, again.select(*odd.columns).collect())) == sorted(map(repr, spark.read.parquet(str(tmp_path / "simhash_near_dedup")).collect()))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()


def test_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_library_without_this_subpackage(tmp_path):
    """The rest imports and registers its queries where these folders and the pipeline are gone."""
    root = Path(__file__).resolve().parents[2]
    (tmp_path / "orgweave").mkdir()
    for p in root.joinpath("orgweave").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "orgweave" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; n = e.queries(); assert n and not any(k.startswith('op1_') or k == 'pipeline' for k in n); assert set(e.oracle_sql()) <= set(n)"
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env={"PATH": "/usr/bin", "PYTHONPATH": f"{tmp_path}:{':'.join(p for p in sys.path if 'site-packages' in p)}"}, check=True)


def test_line_dedup_compares_past_joined_lines(spark):
    """Families of lines that are like the first or the one before: a later line goes if any earlier one is similar."""
    import random

    r, rows = random.Random(3), []
    for f in range(120):
        first = base = [f"f{f}x{i}" for i in range(9)]
        rows.append(base)
        for k in range(8):
            base = list(base if k % 2 else first)
            base[r.randrange(9)] = f"n{f}k{k}"
            rows.append(base)
    docs = spark.createDataFrame([(i, " ".join(x), 0) for i, x in enumerate(rows)], "doc_id long, text string, n_chars long")
    kept = {x.doc_id for x in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    own = [set(x) for x in rows]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    assert kept == {i for i in range(len(own)) if not any(alike(own[i], own[j]) for j in range(i - i % 9, i))}
