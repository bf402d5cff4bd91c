"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgweave.llm import brown, decontaminate, licenses, lines, passages, pieces, pii, quality, simhash, toxicity

LONG = " ".join(f"w{i % 5000}" for i in range(60_000))
TEXT = "The quick brown fox jumps over the lazy dog near the river bank today again.\nAll rights reserved.\n"
ROWS = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c"), (None, None), (4, TEXT), (4, TEXT), (5, TEXT + "x"), (6, LONG), (7, "one"), (8, "日本語 テキスト ﬁ 😀")]
#: Columns that operators make, or use inside, are also columns of the input.
CLASH = ["score", "n_words", "kept", "fail_bits", "leak", "licenses", "email", "other", "removed_lines", "ids", "key", "component", "rk", "fp", "block", "data", "line", "id", "h", "i", "w"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="module")
def none(spark, docs):
    return docs.limit(0).select(*docs.columns)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def bench(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "quality": lambda d, s: quality.apply_policy(quality.ledger(d)),
    "toxicity": lambda d, s: toxicity.score(d, toxicity.train(d, labels(s, [(4, 1, 1), (6, 1, 0), (None, 0, 1), (7, None, None)]))),
    "licenses": lambda d, s: licenses.scan(d),
    "passages": lambda d, s: passages.report(d),
    "decontaminate": lambda d, s: decontaminate.find_leaks(d, bench(s, [(1, "quick brown"), (2, None), (None, "fox")])),
    "simhash": lambda d, s: simhash.near_duplicates(d),
    "brown": lambda d, s: brown.score(d),
    "pieces": lambda d, s: pieces.digest(d),
    "lines": lambda d, s: lines.without_lines(lines.mark(d)),
    "pii": lambda d, s: pii.find(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, docs, name):
    assert OPERATORS[name](docs, spark).count() == len(ROWS)


def test_clashing_columns_keep_their_values(spark, docs):
    """Columns of the input that an operator makes are replaced; all others stay as they were."""
    made = {
        "quality": {"score": None, "n_words": "made", "kept": "made", "fail_bits": "made"}, "toxicity": {"score": "made"}, "licenses": {"licenses": "made"}, "decontaminate": {"leak": "made"}, "pieces": {}, "lines": {"removed_lines": "made"}, "pii": {"email": "made", "other": "made"},
    }
    for name, own in made.items():
        out = OPERATORS[name](docs, spark)
        assert set(docs.columns) <= set(out.columns), name
        row = out.where("doc_id = 7").first()
        for c in CLASH:
            assert (row[c] == "clash") == (own.get(c) is None), (name, c)


def test_ids_of_any_type(spark, docs):
    """Ids that are strings give what numbers give."""
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    for name, pick in {"passages": ["doc_id", "n_shared", "removed_lines"], "simhash": ["doc_id", "fp", "component_id"], "brown": ["doc_id", "n_tokens"], "lines": ["doc_id", "removed_lines"]}.items():
        def rows(d):
            ids = [c for c in pick if c.endswith("id")]
            got = OPERATORS_OF_IDS[name](d).select(*pick).withColumns({c: F.regexp_replace(F.col(c).cast("string"), "^d", "") for c in ids})  # noqa: B023
            return sorted(map(repr, got.collect()))

        assert rows(docs) == rows(named), name


OPERATORS_OF_IDS = {"passages": passages.report, "simhash": simhash.near_duplicates, "brown": brown.score, "lines": lines.mark}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, none, name):
    assert OPERATORS[name](none, spark).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_have_equal_results(spark, docs, name):
    own = {"passages": ["n_shared", "repeated"], "simhash": ["fp", "component_id"], "brown": ["score"], "quality": ["fail_bits", "kept"], "toxicity": ["score"], "licenses": ["licenses"], "decontaminate": ["leak"], "pieces": ["encoded"], "lines": ["text"], "pii": ["email", "other"]}[name]
    rows = OPERATORS[name](docs, spark).where("doc_id = 4").select(*own).collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_quality_of_nothing(spark, docs):
    rows = quality.measure(docs).where("coalesce(doc_id, 1) < 3").select("n_words", "n_lines", "n_repeat_words").collect()
    assert {tuple(r) for r in rows if r.n_words == 0} == {(0, 0, 0)}


def test_quality_ablations(spark, docs):
    entries = spark.createDataFrame(quality.ledger(docs).select("doc_id", "fail_bits").collect(), "doc_id long, fail_bits long")
    got = {(r.version, r.rule): r for r in quality.ablations(entries).collect()}
    assert set(got) == {(p.version, r) for p in quality.POLICIES.values() for r in p.rules}
    for (version, rule), r in got.items():
        p = quality.POLICIES[version]
        less = quality.Policy("x", tuple(x for x in p.rules if x != rule))
        assert r.n_rows == len(ROWS) and r.n_kept == quality.apply_policy(entries, p).where("kept").count()
        assert r.n_kept_without == quality.apply_policy(entries, less).where("kept").count()
    assert {r.n_rows for r in quality.ablations(entries.limit(0)).collect()} == {0}


def test_toxicity_without_labels(spark, docs):
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels(spark))).collect()} == {0.0}


def test_leak_offsets(spark):
    d = spark.createDataFrame([(1, "é Ab  C, dx e f G h i j é k.")], "doc_id long, text string")
    b = bench(spark, [(9, "ab c dx e f g h i j é"), (10, "zz"), (9, "k")])
    r = decontaminate.find_leaks(d, b).first()
    text = d.first().text
    assert r.leak.items == ["9"] and r.leak.n_words == 12 and r.leak.n_hit == 11
    assert [text[s.start : s.end] for s in r.leak.spans] == ["Ab  C, dx e f G h i j é k"]


def test_leak_blocks_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    b = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert len(list(decontaminate.benchmark_windows(b))) == 1 and len(list(decontaminate.benchmark_windows(b, block=300))) > 2
    rows = lambda d: sorted(map(repr, d.select("doc_id", "leak").collect()))
    one = rows(decontaminate.find_leaks(docs, b))
    assert one == rows(decontaminate.find_leaks(docs, b, block=300)) and any("Row(start" in x for x in one)


def test_lines_of_a_copy_go(spark):
    d = spark.createDataFrame([(1, "a b c d e\nx y"), (2, "e d c b a\nnew line here\nx y"), (3, "A B C D E f\n\nq"), (None, "x y")], "doc_id long, text string")
    got = {r.doc_id: r.removed_lines for r in lines.mark(d).collect()}
    assert got == {None: [], 1: [1], 2: [0, 2], 3: [0]}


def test_license_paragraphs(spark):
    t = "Intro.\nReleased under the MIT License.\nThe driver showed her license to the officer.\nLicensed under CC BY-NC 4.0."
    r = licenses.scan(spark.createDataFrame([(1, t)], "doc_id long, text string")).first()
    assert [(x.line, x.family, x.confirmed) for x in r.licenses] == [(1, "MIT", True), (2, "unknown", False), (3, "CC-BY-NC", True)]
    assert all(0 <= x.probability <= 1 for x in r.licenses)


LICENSES = [
    ("EPL", "Licensed under the Eclipse Public License 2.0"), ("unknown", "Licensed under the Foo Public License 2.0"), ("unknown", "Licensed under the Open Data Commons Database License"),
    ("Public-Domain", "Dedicated to the public domain under CC0 1.0"), ("MIT", 'of this software and associated documentation files (the "Software"), to deal'), ("MIT", "in the Software without restriction, including without limitation the rights"),
    ("BSD", "* Redistributions of source code must retain the above copyright notice, this"), ("GPL", "the Free Software Foundation, either version 3 of the License, or (at your option)"), ("unknown", "license the under apache version licensed 2.0"),
    ("CC-BY-SA", "© 2021 by X. This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."), ("Proprietary", "Copyright (c) 2019 Foo Inc. All rights reserved."),
    ("unknown", "The license was granted to the company by the public office in version two of the terms."), ("unknown", "Our guide to the city is free for all who travel without a plan."),
]


def test_license_texts(spark):
    """Every template and negative, notices that differ from them, pieces of wrapped texts, word salads."""
    want = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts] + LICENSES
    text = "\n".join(t for _, t in want)
    got = {x.line: x for x in licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().licenses}
    assert [(got[k].family if k in got else licenses.UNKNOWN) for k in range(len(want))] == [f for f, _ in want]


def test_license_guard_loses_nothing():
    """Whatever is left of a template without the guard words can't confirm it as a notice."""
    guard = set(licenses.guards())
    for s in licenses.shapes():
        assert sum(not guard & set(p.split(" ")) for p in s["p"]) < licenses.needed(len(s["p"]))


def test_license_scores_against_numpy(spark):
    """Predictions of the model, by its weights and plain code."""
    families, weights, bias = licenses.model()
    texts = [t for _, t in LICENSES] + [t for ts in licenses.TEMPLATES.values() for t in ts]
    got = {x.line: x.probability for x in licenses.scan(spark.createDataFrame([(1, "\n".join(texts))], "doc_id long, text string")).first().licenses}
    assert len(got) > 60
    for k, p in got.items():
        g = licenses.grams_of(licenses.words_of(texts[k]))
        z = [b + sum(weights[x][i] for x in g if x in weights) / max(len(g), 1) ** 0.5 for i, b in enumerate(bias)]
        assert abs(p - 1 / sum(math.exp(v - max(z)) for v in z)) < 2e-6
    assert len(families) == len(licenses.TEMPLATES)


def test_pii_matches_plain_patterns(spark):
    def luhn(x):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(x))) % 10 == 0

    def plain(t):
        out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
        out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        return out

    texts = [
        "a@b.c..d a.b@c.d.e%x@y.z é@é.c a@@b.c a@b.-c.d x@y", "1.2.3.4.5.6.7.8 300.1.1.1 0000255.1.1.1 1..2.3.4 999999999999999999999999.1.1.1 日1.2.3.4", "4111 1111 1111 1111, 4111--1111 4111-1111-1111-1111 - 5 4111 1111  1111 1111 12", "+1 (555) 123-4567 +49.40.1234567. +1 2 +1-234 567 8901 (", "4539578763621486+4539578763621486-", "9" * 20_000 + " " + "1 " * 20_000 + "a" * 20_000 + "@x." + "b." * 9_000,
    ]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(d).collect():
        got = [(k, x.s, x.e) for k in pii.KINDS for x in r[k]]
        assert got == plain(texts[r.doc_id]), texts[r.doc_id][:80]


def test_pii_adds_secrets(spark):
    secret = [(i, f'then token = "{i:040x}" came, password=b7db7aa4a5fcc{i:05x} and v{i}-2024 too') for i in range(10, 60)]
    plain = [(i, f"version{i} was built in 2024-01-{i} as item-{i}a") for i in range(100, 150)]
    d = spark.createDataFrame(secret + plain, "doc_id long, text string")
    got = {r.doc_id: [d for d in r.other] for r in pii.find(d).collect()}
    texts = dict(secret + plain)
    assert all(f"{i:040x}" in [texts[i][x.s : x.e] for x in got[i]] for i, _ in secret)
    assert not any(got[i] for i, _ in plain)


def planted(seed):
    """Texts with personal data and what looks like it: (texts, spans of the first, of the second)."""
    r = random.Random(seed)
    digits = lambda n, of="0123456789": "".join(r.choice(of) for _ in range(n))

    def iban():
        n = digits(18)
        return f"DE{98 - int(n + '131400') % 97:02d}{n}"

    personal = [
        lambda: ('token = "%s"', digits(40, "0123456789abcdef")), lambda: ("password=%s", digits(12, "0123456789abcdef") + "X9k"), lambda: ("SSN %s", f"{digits(3)}-{digits(2)}-{digits(4)}"), lambda: ("account %s", iban()),
        lambda: ("%s", f"{r.choice(pii.GIVEN)} {r.choice(['Meier', 'López', 'Dubois', 'Smith'])}"), lambda: ("%s", f"{r.choice(['Dr', 'Frau', 'Mr'])}. {r.choice(['Kunze', 'Stone'])}"), lambda: ("%s", digits(32, "0123456789abcdef")), lambda: ("api_key: %s", "sk-" + digits(24, "0123456789abcdef")),
    ]
    plain = [
        lambda: ("version %s", f"release2024-{digits(2)}"), lambda: ("on %s", f"2024-0{r.randrange(1, 9)}-1{r.randrange(9)}"), lambda: ("item %s", f"item-{r.randrange(1000, 99999)}a"), lambda: ("order %s", "1" + digits(8)),
        lambda: ("in %s", r.choice(["New York", "Los Angeles", "Bad Homburg", "Grand Central"])), lambda: ("then %s", "Ende. Neues kam"),
    ]
    texts, spans = {}, ([], [])
    for i in range(400):
        text = "Thea läuft heen. Oft is dann"
        for kind, of in [(0, f) for f in r.sample(personal, 2)] + [(1, f) for f in r.sample(plain, 2)]:
            form, value = of()
            text += " and "
            at = len(text) + form.index("%s")
            text += form % value + " came"
            spans[kind].append((i, at, at + len(value)))
        texts[i] = text
    return texts, spans


def test_pii_recall_and_precision_of_spans(spark):
    texts, (personal, plain) = planted(4)
    rows = pii.find(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    got = {r.doc_id: [(x.s, x.e) for k in (*pii.KINDS, "other") for x in r[k]] for r in rows}
    inside = lambda i, s, e: any(a <= s and e <= b for a, b in got[i])
    touched = lambda i, s, e: any(a < e and s < b for a, b in got[i])
    assert sum(inside(*x) for x in personal) >= 0.98 * len(personal) and sum(touched(*x) for x in plain) <= 0.02 * len(plain)
    assert sum(map(len, got.values())) <= 1.02 * len(personal)


def test_pii_estimates_against_plain_code():
    """Expectation-maximisation with arrays over single candidates; and the regression's gradient is zero."""
    r = np.random.default_rng(5)
    truth = r.random(4000) < 0.3
    good, bad = [0.9, 0.7, 0.8, 0.6, 0.85, 0.75], [0.1, 0.2, 0.05, 0.3, 0.15, 0.1]
    votes = np.array([np.where(r.random(4000) < 0.4, 2, r.random(4000) < np.where(truth, a, b)) for a, b in zip(good, bad)]).T.astype(int)
    bits = (truth * r.integers(0, 8, 4000) + 8 * r.integers(0, 2, 4000)).astype(int)
    code = votes @ 3 ** np.arange(pii.LABELERS)
    patterns = {}
    for c, b in zip(code.tolist(), bits.tolist()):
        patterns[c, b] = patterns.get((c, b), 0) + 1
    prior, rate, p = pii.reliabilities(patterns)
    said, yes = votes < 2, votes == 1
    q = ((yes.sum(1)) + 0.3) / (said.sum(1) + 1)
    for _ in range(50):
        pi = (q.sum() + 1) / (len(q) + 2)
        low = ((1 - q) @ yes + 1) / ((1 - q) @ said + 4)
        high = (q @ yes + 3) / (q @ said + 4)
        z = np.log(pi / (1 - pi)) + (yes * np.log(high / low)).sum(1) + ((said & ~yes) * np.log((1 - high) / (1 - low))).sum(1)
        q = 1 / (1 + np.exp(-z.clip(-30, 30)))
    assert abs(prior - pi) < 1e-9 and np.allclose(rate, np.array([low, high]).T) and np.allclose([p[c] for c in code.tolist()], q)
    assert ((q > 0.5) == truth).mean() > 0.9 and np.allclose(high, good, atol=0.06)
    w = np.array(pii.classifier(patterns, p, steps=20_000))
    x = np.column_stack([*((bits >> k) & 1 for k in range(pii.FEATURES)), np.ones(len(bits), int)])
    e = 1 / (1 + np.exp(-(x @ w))) - q
    assert np.abs(x.T @ e / len(q) + 1e-3 * np.append(w[:-1], 0)).max() < 1e-5


def test_pii_long_secrets(spark):
    long = {i: f"{i:0{n}x}" for i, n in ((1, 128), (2, 129), (3, 512), (4, 50_000))}
    secret = [(i, f'then token = "{i:040x}" came, password=b7db7aa4a5fcc{i:05x} and v{i}-2024 too') for i in range(10, 60)]
    plain = [(i, f"version{i} was built in 2024-01-{i} as item-{i}a") for i in range(100, 150)]
    texts = {**dict(secret + plain), **{i: f'then token = "{t}" came' for i, t in long.items()}}
    got = {r.doc_id: r.other for r in pii.find(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert all(t in [texts[i][x.s : x.e] for x in got[i]] for i, t in long.items())


def test_license_pieces_without_guard_words(spark):
    """Pieces of templates that have none of the guard words are candidates, and some are confirmed."""
    guard, rows = set(licenses.guards()), []
    known = [(f, t) for f, ts in licenses.TEMPLATES.items() if f != licenses.UNKNOWN for t in ts]
    for s, (family, text) in zip(licenses.shapes(), known):
        piece: list[str] = []
        for w in [*licenses.words_of(text), None]:
            if w is not None and w not in guard:
                piece.append(w)
                continue
            if len(piece) >= licenses.PIECE_WORDS and set(licenses.grams_of(piece)) & set(s["o"]):
                rows.append((len(rows), family, " ".join(piece)))
            piece = []
    got = licenses.scan(spark.createDataFrame(rows, "id int, f string, text string")).collect()
    assert len(rows) > 20 and all(len(x.licenses) == 1 for x in got)
    assert any(x.licenses[0].confirmed and x.licenses[0].family == x.f for x in got)
    other = spark.createDataFrame([("of course to any person he met",), ("a a a a a a a",), (None,), ("",)], "text string")
    assert all(x.licenses == [] for x in licenses.scan(other).collect())
