"""Personal data by weak supervision. DataFrame functions only.

Four base kinds are matched by pattern and check digits. Beyond them, tokens with digits
and pairs of capitalised words are candidates; regex, gazetteer and context labelers vote
on each. Expectation-maximisation estimates every labeler's reliability from the vote
patterns of all documents, and a logistic regression over span features is trained on its
labels; that classifier decides on the candidates. Texts are read once: what is found in
them is written, the vote patterns are counted in it, and it is given out again. What is
collected are counts of patterns, at most 3**labelers * 2**features rows whatever the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, unused, written

KINDS = ("email", "ip", "card", "phone")
_L = r"A-Za-z0-9._%+-"
_D = r"A-Za-z0-9-"

#: Kind: guard (a cheap test of the text), preparation (pattern and a stand-in of the same
#: length) and pattern. They match what the plain patterns of the contract match, but run
#: in linear time and without recursion: a separator that joins nothing is first replaced,
#: so that a run of one character class takes the place of a repeated group, and a match
#: begins only where a run begins or the match before ended.
BASE = {
    "email": ("@", (rf"\.(?![{_D}])|(?<![{_D}])\.", "%"), rf"(?:\G|(?<![{_L}]))[{_L}]++@[{_D}]+\.[{_D}.]+"),
    "ip": (r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", None, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9][\x20-]?[0-9]", (r"[\x20-](?![0-9])|(?<![0-9])[\x20-]", "_"), r"[0-9][0-9\x20-]+"),
    "phone": (r"\+[0-9]", None, r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_T = r"A-Za-z0-9_-"
#: A candidate, after an optional key, sign and quote: a token of 8 or more with a digit.
TOKEN = rf"(?<![.@+{_T}])(?:[A-Za-z_]{{2,}}+\x20?[=:]\x20?[\"']?)?(?=[{_T}]{{8,}}+(?!@))[A-Za-z_-]*+[0-9][{_T}]*+"
LEAD = r"^[A-Za-z_]{2,}\x20?[=:]\x20?[\"']?"
# Titles and given names of four languages.
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Sir", "Dr", "Prof", "Herr", "Frau", "Mme", "Mlle", "Monsieur", "Madame", "Señor", "Señora", "Señorita", "Don", "Doña"]
GIVEN = [
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda", "William", "Elizabeth", "David", "Barbara", "Richard", "Susan", "Joseph", "Jessica", "Thomas", "Sarah",
    "Charles", "Karen", "Christopher", "Lisa", "Daniel", "Nancy", "Matthew", "Betty", "Anthony", "Margaret", "Mark", "Sandra", "Steven", "Ashley", "Paul", "Emily", "Andrew", "Donna",
    "George", "Michelle", "Edward", "Laura", "Brian", "Emma", "Kevin", "Alice", "Anna", "Maria", "Peter", "Hans", "Klaus", "Jürgen", "Stefan", "Andreas", "Wolfgang", "Sabine", "Ursula",
    "Monika", "Petra", "Heike", "Birgit", "Renate", "Karin", "Claudia", "Uwe", "Dieter", "Günter", "Helmut", "Werner", "Gerhard", "Jonas", "Lukas", "Felix", "Leon", "Hannah", "Lena",
    "Pierre", "Jean", "Marie", "Michel", "Alain", "Philippe", "Nathalie", "Isabelle", "Sylvie", "Catherine", "Françoise", "Nicolas", "Julien", "Camille", "Chloé", "Léa", "Hugo", "Louis",
    "Gabriel", "Antoine", "François", "Jacques", "Carlos", "José", "Juan", "Antonio", "Manuel", "Francisco", "Javier", "Miguel", "Rafael", "Alejandro", "Pedro", "Luis", "Diego", "Pablo",
    "Lucía", "Sofia", "Sofía", "Carmen", "Ana", "Isabel", "Dolores", "Pilar", "Teresa", "Rosa", "Elena", "Marta", "Paula", "Raquel", "Beatriz", "Andrés", "Fernando", "Sergio", "Jorge",
]
#: Or two neighbouring capitalised words, the first of which has a stop only as a title.
NAME = rf"(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.|\p{{Lu}}\p{{Ll}}++)\x20\p{{Lu}}\p{{Ll}}++(?!\p{{L}})"
CANDIDATE = f"{NAME}|{TOKEN}"
#: Characters before a candidate that the context labeler reads.
BEFORE = 32

# Keys and words before what is personal, and before what isn't.
SECRET = "pass|pwd|token|secret|key|auth|ssn|iban|account|login|credential|bearer"
PERSONAL_BEFORE = f"{SECRET}|name is|born|birth|signed by|contact|patient|customer|employee|geboren|né |née |nacid|konto|kennwort|passwor|contraseña|mot de passe"
PLAIN_BEFORE = r"version|release|build|item|page|chapter|figure|section|room|gate|flight|model|part|order|invoice|article|seite|kapitel|numéro|página|since|until|in \d{4}"


def _spans(text: Column, pattern: str, guard: Column) -> Column:
    """array<struct<s, e, m, b>> of all matches, code points, end exclusive; b stands before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<s:int,e:int,m:string,b:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(a, x):
        s = a["at"] + F.char_length(x["p"])
        e = s + F.char_length(x["m"])
        return F.struct(e.alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"), F.substring(x["p"], -BEFORE, BEFORE).alias("b")))).alias("out"))

    pairs = F.zip_with(found, F.slice(parts, F.lit(1), F.size(found)), lambda m, p: F.struct(m.alias("m"), p.alias("p")))
    return F.when(guard, F.aggregate(pairs, start, step, lambda a: a["out"])).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Check of the digits, from the right: every second doubled, and its digits summed."""
    digits = F.transform(F.split(F.reverse(_digits(m)), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    worth = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return F.aggregate(worth, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.char_length(_digits(m))
    if kind == "ip":
        small = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.char_length(small(p)) <= 3) & (F.substring(small(p), 1, 3).cast("int") <= 255))
    if kind == "card":
        return (n >= 13) & (n <= 19) & _luhn(F.substring(m, 1, 64))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def _accepts(kind: str):
    return lambda x: _valid(kind, x["m"])


_DATE = r"^(?:19|20)[0-9]{2}[-_][0-9]{1,2}[-_][0-9]{1,2}$|^[0-9]{1,2}[-_][0-9]{1,2}[-_](?:19|20)?[0-9]{2}$"
_IBAN = "^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"


def _iban(m: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, letters as 10 to 35 and the head behind."""
    turned = F.concat(F.substring(m, 5, 40), F.substring(m, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).when(c.rlike("[0-9]"), (a * 10 + F.coalesce(value(c), F.lit(0))) % 97).otherwise((a * 100 + F.coalesce(value(c), F.lit(0))) % 97))
    return m.rlike(_IBAN) & (rest == 1)


def labelers(x: Column) -> list[Column]:
    """Votes on a candidate x with fields m (token), lead (key and sign before it), b (what
    stands before), name (two words) and given (the first is in the gazetteer):
    1 personal, 0 not, null abstains."""
    m, lead, b, name = x["m"], x["lead"], F.lower(x["b"]), x["name"]
    mixed = m.rlike("[0-9].*[A-Za-z].*[0-9]|[A-Za-z].*[0-9].*[A-Za-z]")
    vote = lambda yes, no: F.when(yes, 1).when(no, 0)
    return [
        vote(lead.rlike(f"(?i)({SECRET}|passport|user)"), lead != ""),  # key
        vote(m.rlike(r"^[0-9a-fA-F]{16,}$") & (mixed | (F.char_length(m) >= 24)), (F.char_length(m) < 12) & ~name),  # regex
        vote(x["given"], name | m.rlike(r"^[A-Za-z]+[-_]?[0-9]{1,4}$") | m.rlike(_DATE)),  # gazetteer; product and date shapes
        vote(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$") | _iban(m), m.rlike("^[0-9]{8,12}$") | m.rlike(_IBAN)),  # identity numbers
        vote(b.rlike(f"(?:{PERSONAL_BEFORE})[^a-z]*$"), b.rlike(f"(?:{PLAIN_BEFORE})[^a-z]*$")),  # context
        vote(mixed & (F.char_length(m) >= 18), F.when(name, None).otherwise(m.rlike("^[A-Za-z]+[-_0-9]{1,8}$|^[0-9]{1,15}$"))),  # keys of no known form
    ]


def span_features(x: Column) -> list[Column]:
    m, lead = x["m"], x["lead"]
    return [
        lead != "", F.char_length(m) >= 16, m.rlike("[0-9]") & m.rlike("[A-Za-z]"), m.rlike("^[0-9a-fA-F]+$"), x["name"], x["given"],
        lead.rlike(f"(?i){SECRET}") | F.lower(x["b"]).rlike(f"(?:{PERSONAL_BEFORE})[^a-z]*$"), m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$") | _iban(m),
    ]


def candidates(spans: Column, base: Column) -> Column:
    """array of candidates outside the base spans, with votes (base 3) and features (bits)."""
    known = F.array(*map(F.lit, TITLES + GIVEN))

    def made(x):
        lead = F.regexp_extract(x["m"], LEAD, 0)
        n = F.char_length(lead)
        m = F.substring(x["m"], n + 1, F.char_length(x["m"]))
        name = x["m"].rlike(f"^(?:{NAME})$")
        given = name & F.array_contains(known, F.regexp_extract(x["m"], r"^\p{L}+", 0))
        return F.struct((x["s"] + n).alias("s"), x["e"].alias("e"), m.alias("m"), lead.alias("lead"), x["b"].alias("b"), name.alias("name"), given.alias("given"))

    def told(x):
        votes = [F.coalesce(v, F.lit(2)) * 3**k for k, v in enumerate(labelers(x))]
        bits = [F.when(f, 1 << k).otherwise(0) for k, f in enumerate(span_features(x))]
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), sum(votes[1:], votes[0]).alias("votes"), sum(bits[1:], bits[0]).alias("bits"))

    free = F.filter(F.transform(spans, made), lambda x: ~F.exists(base, lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"])))
    return F.transform(free, told)


LABELERS, FEATURES = 6, 8


def _votes(code: int) -> list[int]:
    return [code // 3**k % 3 for k in range(LABELERS)]


def reliabilities(patterns: dict[tuple[int, int], int], rounds: int = 50) -> tuple[float, list, dict[int, float]]:
    """(prior, per labeler P(vote 1 | class) for classes 0 and 1, P(personal) by votes).

    Expectation-maximisation of independent labelers given the class; abstentions tell
    nothing. It starts from the share of votes for a span, so that classes keep their
    meaning, and every rate has a pseudo-count.
    """
    count: dict[int, float] = {}
    for (votes, _), n in sorted(patterns.items()):
        count[votes] = count.get(votes, 0) + n
    told = {v: [(k, x) for k, x in enumerate(_votes(v)) if x < 2] for v in count}
    p = {v: (sum(x for _, x in t) + 0.3) / (len(t) + 1) for v, t in told.items()}
    prior, rate = 0.5, [[0.2, 0.8]] * LABELERS
    for _ in range(rounds):
        total = sum(count.values())
        prior = (sum(n * p[v] for v, n in count.items()) + 1) / (total + 2)
        rate = []
        for k in range(LABELERS):
            mine = [(count[v], p[v], dict(t)[k]) for v, t in told.items() if k in dict(t)]
            low = (sum(n * (1 - q) * x for n, q, x in mine) + 1) / (sum(n * (1 - q) for n, q, _ in mine) + 4)
            high = (sum(n * q * x for n, q, x in mine) + 3) / (sum(n * q for n, q, _ in mine) + 4)
            rate.append([low, high])
        for v, t in told.items():
            z = math.log(prior / (1 - prior))
            for k, x in t:
                a, b = rate[k]
                z += math.log(b / a) if x else math.log((1 - b) / (1 - a))
            p[v] = 1 / (1 + math.exp(-max(-30, min(30, z))))
    return prior, rate, p


def classifier(patterns: dict[tuple[int, int], int], p: dict[int, float], steps: int = 2000, ridge: float = 1e-3) -> list[float]:
    """Weights of the features and a bias: the logistic regression of the patterns' shares, by
    gradient descent. A step is held by the curvature, a quarter of the mean squared row."""
    share: dict[int, list[float]] = {}
    for (votes, bits), n in sorted(patterns.items()):
        a = share.setdefault(bits, [0.0, 0.0])
        a[0] += n
        a[1] += n * p[votes]
    total = sum(n for n, _ in share.values()) or 1.0
    rows = [([bits >> k & 1 for k in range(FEATURES)] + [1], n / total, a / total) for bits, (n, a) in share.items()]
    step = 1 / (sum(n * sum(x) for x, n, _ in rows) / 4 + ridge) if rows else 0.0
    w = [0.0] * FEATURES + [-1.0]
    for _ in range(steps):
        g = [ridge * x for x in w[:-1]] + [0.0]
        for x, n, a in rows:
            z = sum(u * v for u, v in zip(w, x))
            e = n / (1 + math.exp(-max(-30, min(30, z)))) - a
            g = [u + e * v for u, v in zip(g, x)]
        w = [u - step * d for u, d in zip(w, g)]
    return w


def _found(docs: DataFrame, text: str, chosen: str) -> DataFrame:
    name = {k: unused(docs, f"text_{k}") for k in ("t", "s", "base", *KINDS)}
    t, d = F.col(name["t"]), docs.withColumn(name["t"], F.coalesce(F.col(text), F.lit("")))
    base = []
    for kind, (guard, prepare, pattern) in BASE.items():
        ok = t.contains(guard) if kind == "email" else t.rlike(guard)
        body = F.when(ok, F.regexp_replace(t, *map(F.lit, prepare))).otherwise("") if prepare else t
        d = d.withColumn(name["s"], body).withColumn(name["s"], _spans(F.col(name["s"]), pattern, ok))
        plain = F.transform(F.filter(name["s"], _accepts(kind)), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))
        d = d.withColumn(name[kind], plain)
        base.append(name[kind])
    d = d.withColumn(name["base"], F.flatten(F.array(*base)))
    some = t.rlike(rf"[0-9]|{NAME}")
    d = d.withColumn(name["s"], _spans(t, CANDIDATE, some)).withColumn(chosen, candidates(F.col(name["s"]), F.col(name["base"])))
    return d.drop(name["t"], name["s"], name["base"]).withColumns({k: F.col(name[k]) for k in KINDS}).drop(*base)


def find(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with email, ip, card, phone (arrays of s, e, m) and other (arrays of s, e).

    Null and empty texts have none; an empty table gives an empty one. A corpus without
    candidates trains nothing and adds nothing. Offsets are code points, end exclusive.
    Texts and tokens may be of any length; repeated rows have equal spans, and each votes.
    Base spans that tie with a candidate's place win. Columns of the input with the names of
    the outputs are replaced, others stay. The rows are written once, with what is found in
    them; keep_text=False leaves the text out of that and of the result.
    """
    chosen = unused(docs, "candidates")
    found = _found(docs, text, chosen)
    found = written(found if keep_text else found.drop(text))
    c = found.select(F.explode(chosen).alias("c")).groupBy("c.votes", "c.bits").agg(F.count("*").alias("n")).collect()
    patterns = {(r.votes, r.bits): r.n for r in c}
    _, _, p = reliabilities(patterns)
    w = classifier(patterns, p)
    good = [bits for bits in range(1 << FEATURES) if w[-1] + sum(w[k] for k in range(FEATURES) if bits >> k & 1) >= 0] if patterns else []
    picked = F.filter(chosen, lambda x: x["bits"].isin(good) if good else F.lit(False))
    return found.withColumn("other", F.transform(picked, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))).drop(chosen)


def op10(spark, sf_dir: str) -> DataFrame:
    out = find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    told = lambda k: F.transform(k, lambda x: F.concat_ws(":", F.lit(k), x["s"].cast("string"), x["e"].cast("string")))
    base = F.array_join(F.flatten(F.array(*map(told, KINDS))), ",")
    spans = F.array_join(F.flatten(F.array(*map(told, (*KINDS, "other")))), ",")
    return out.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))
