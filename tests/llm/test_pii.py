"""Base spans against the plain expressions, added kinds, and edge cases."""

import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import pii as P

PLAIN = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s: 13 <= len(d := re.sub("[^0-9]", "", s)) <= 19 and luhn(d)),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
}


def luhn(d):
    return sum(int(x) if i % 2 == 0 else (2 * int(x) - 9 if int(x) > 4 else 2 * int(x)) for i, x in enumerate(reversed(d))) % 10 == 0


def plain(text):
    return [(k, m.start(), m.end()) for k, (e, ok) in PLAIN.items() for m in e.finditer(text or "") if ok(m.group())]


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = P.personal_data(frame)
    return [(r.doc_id, [(P.KINDS[s.kind], s.start, s.end) for s in r.base], [(P.KINDS[s.kind], s.start, s.end) for s in r.added]) for r in out.collect()]


def test_base_spans_equal_the_plain_expressions(spark):
    rng = random.Random(8)
    parts = ["a", "b.c", "@", ".", "_", "-", "é", "😀", " ", "+", "(", ")", "1", "42", "255", "256", "0", "4111", "1111", "4111 1111 1111 1111", "5500000000000004", "x@y.z", "+1 (988) 555-2485", "\n", "1.2.3.4", "%"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))), "x") for i in range(3000)]
    texts = {i: t for i, t, _ in rows}
    got = found(spark, rows)
    assert len(got) == len(rows)
    for doc_id, base, _ in got:
        assert base == plain(texts[doc_id]), texts[doc_id]
    assert sum(len(b) for _, b, _ in got) > 500


def planted(rng, i):
    """A text, and the kinds and matches that are personal data in it; the others only look like it."""
    name = f"{rng.choice(P.FIRST_NAMES)} {rng.choice(P.LAST_NAMES)}"
    area, line = rng.choice(["212", "415", "617", "303"]), f"{rng.choice([234, 555, 648])}-{rng.randrange(1000, 9999)}"
    dot = rng.choice(["(dot)", "[dot]"])
    real = [
        ("phone_local", f"({area}) {line}", "call {}, please"),
        ("phone_local", f"{area}-{line}", "tel {}."),
        ("ssn", f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}", "his ssn {} is"),
        ("email_text", f"joe{i}[at]mail{dot}com".replace("(dot)", "[dot]"), "mail {} for that"),
        ("iban", "DE89 3704 0044 0532 0130 00", "the account {} was"),
        ("iban", "GB82WEST12345698765432", "IBAN {}, thanks"),
        ("name", f"Dr. {name}", "met {} said"),
        ("name", name, "from {} who"),
    ]
    decoys = [
        ("phone_local", f"{rng.choice([111, 100, 999])} {line.replace('-', ' ')}", "order {} pcs"),
        ("phone_local", f"011.{line.replace('-', '.')}", "part {} items"),
        ("ssn", f"9{rng.randrange(10, 99)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}", "serial {} in"),
        ("ssn", f"000-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}", "invoice {} of"),
        ("email_text", f"value{i}(at)step.{rng.choice(['hh', 'row', 'zz'])}", "model {} then"),
        ("name", f"Prof {rng.choice(['Quarto', 'Lumen', 'Vertex'])}", "model {} hotel"),
        ("name", f"Sr. {rng.choice(['Plaza', 'Mirador', 'Grande'])}", "hotel {} plaza"),
    ]
    text, found = "", set()
    for kind, match, around in rng.sample(real, 2) + rng.sample(decoys, 2):
        before, after = around.split("{}")
        start = len(text) + 4 + len(before)
        text += f"so, {before}{match}{after}, {'abcdefgh'[i % 8]} word then; "
        if (kind, match, around) in real:
            found.add((kind, start, start + len(match)))
    return text, found


def test_added_spans_against_planted_ones(spark):
    rng = random.Random(31)
    cases = {i: planted(rng, i) for i in range(1200)}
    right = wrong = missed = 0
    for i, base, added in found(spark, [(i, text, "x") for i, (text, _) in cases.items()]):
        assert base == plain(cases[i][0])
        right += len(cases[i][1] & set(added))
        wrong += len(set(added) - cases[i][1])
        missed += len(cases[i][1] - set(added))
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97, (right, wrong, missed)


def test_wrong_checksums_are_no_account_numbers(spark):
    rows = [(i, f"account DE{i:02d} 3704 0044 0532 0130 00 end", "x") for i in range(10, 100)]
    assert [i for i, _, a in found(spark, rows) if a] == [89]


def plain_em(votes, counts):
    """The same model on arrays: class shares and vote chances with the same pseudo-counts."""
    values = (1, 0, -1)
    seen = np.stack([votes == v for v in values], axis=2).astype(float)  # pattern, labeler, vote
    keep = (votes != 0).any(axis=0)
    seen, total = seen[:, keep], votes.sum(axis=1)
    chance = np.where(total > 0, 0.9, np.where(total < 0, 0.1, 0.5))
    lean = np.array([[2.0, 1.0, 0.5], [0.5, 1.0, 2.0]])
    for _ in range(P.ROUNDS):
        share = ((chance * counts).sum() + 1) / (counts.sum() + 2)
        log = []
        for weight, prior in ((chance * counts, lean[0]), ((1 - chance) * counts, lean[1])):
            sums = np.einsum("p,plv->lv", weight, seen) + prior
            log.append(np.log(sums / sums.sum(axis=1, keepdims=True)))
        odds = np.log(share / (1 - share)) + np.einsum("plv,lv->p", seen, log[0] - log[1])
        chance = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return chance


def test_estimates_equal_a_plain_em():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.4
    rates = [0.95, 0.8, 0.7, 0.5, 0.9]
    votes = np.column_stack([*(np.where(rng.random(4000) < r, np.where(truth, 1, -1), rng.integers(-1, 2, 4000)) for r in rates), np.zeros(4000, int)])
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    named = {tuple(f"{n}:{v}" for n, v in zip(P.LABELERS, p.tolist(), strict=True)): int(c) for p, c in zip(patterns, counts, strict=True)}
    got = np.array(list(P.estimate(named).values()))
    assert np.abs(got - plain_em(patterns, counts)).max() < 1e-6
    assert np.mean((got[at.ravel()] > 0.5) == truth) > 0.95
    # The classifier's weights are smoothed log ratios of expected counts.
    weights = P.train([(0, p, n) for p, n in named.items()])
    yes, no = (got * counts).sum(), ((1 - got) * counts).sum()
    own = patterns[:, 0] == 1
    plainly = np.log(((got * counts)[own].sum() + 1) / (yes + 2)) - np.log((((1 - got) * counts)[own].sum() + 1) / (no + 2))
    assert abs(weights["0|form:1"] - plainly) < 1e-6


def test_overlaps(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        make = lambda n: [(k, a := rng.randrange(200), a + rng.randrange(1, 12), ["f"]) for k in range(n)]
        rows.append((i, make(rng.randrange(0, 12)), make(rng.randrange(0, 12))))
    kind = "array<struct<kind:int,start:int,end:int,features:array<string>>>"
    frame = spark.createDataFrame(rows, f"id int, spans {kind}, others {kind}")
    for r in frame.select("id", P.apart(F.col("spans"), F.col("others")).alias("s")).collect():
        _, spans, others = rows[r.id]
        assert [tuple(x)[:3] for x in r.s] == [s[:3] for s in spans if not any(o[1] < s[2] and s[1] < o[2] for o in others)]


def test_time_grows_with_the_text(spark):
    """n addresses and n numbers in one text."""
    def seconds(n):
        frame = spark.createDataFrame([(1, "a1@b.com 212-555-1234, " * n)], "doc_id long, text string")
        began = time.perf_counter()
        assert P.scan(frame).select(F.size("base"), F.size("extra")).first() == (n, n)
        return time.perf_counter() - began

    seconds(500)
    assert min(seconds(8000) for _ in range(2)) < 3 * min(seconds(4000) for _ in range(2)) + 0.5


def test_edges(spark):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "x"), (None, "q@w.de", "x"), (3, "a@b.c " * 4_000, "x"), (4, "a" * 3_000 + "1" * 3_000 + ".a" * 2_000 + "@", "x")]
    got = found(spark, rows)
    assert sorted(((i, b) for i, b, _ in got), key=str) == sorted(((i, plain(t)) for i, t, _ in rows), key=str)
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert P.personal_data(frame).count() == 0
