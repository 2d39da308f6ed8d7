"""Fingerprints and components against plain versions."""

import random

import numpy as np
import xxhash

from eventloom.llm import simhash as S


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprint():
    rng = random.Random(1)
    for n in [0, 1, 2, 3, 4, 5, 30, 20000]:
        text = " \n".join(rng.choice(["Été", "FOO", "bar", "x\x85y", "ß", "\xa0"]) + str(rng.randint(0, 9)) for _ in range(n))
        assert S.fingerprint(text) == plain_fingerprint(text)
    assert S.fingerprint(None) == 0


def near(rng, fp, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        fp ^= 1 << b
    return fp


def test_links_connect_exactly_the_radius(spark):
    rng = random.Random(2)
    fps = {}
    while len(fps) < 1200:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 3, 40])):
            fps[len(fps) * 3 + 1] = centre = near(rng, centre, 7)
    distinct = {}
    for i, fp in sorted(fps.items()):
        distinct.setdefault(fp, i)
    frame = spark.createDataFrame([(S.signed(fp), i) for fp, i in distinct.items()], "fp long, rep long")
    expected = plain_components({i: fp for fp, i in distinct.items()})
    for rows in (S.BUCKET_ROWS, 12):  # the second divides most buckets again
        stars = {r.node: r.root for r in S.components(S.links(frame, rows)).collect()}
        assert {i: stars.get(i, i) for i in expected} == expected


def test_a_chain_and_a_dense_ball(spark):
    chain = [0]
    for k in range(16):
        chain.append(chain[-1] ^ (0xF << 4 * k))
    frame = spark.createDataFrame([(S.signed(fp), 100 - k) for k, fp in enumerate(chain)], "fp long, rep long")
    assert {r.root for r in S.components(S.links(frame)).collect()} == {100 - 16}
    ball = np.array(sorted({near(random.Random(k), 0, 2) for k in range(900)}), np.uint64)
    found = S.links_of_run(ball, np.arange(len(ball)), np.zeros(len(ball)), list(range(64)))
    assert len(found) == len(ball) - 1


def test_edges(spark):
    rows = [(5, None, "x"), (3, "", "x"), (4, " \t", "x"), (7, "One two", "x"), (6, "one TWO", "x"), (6, "one TWO", "x"), (None, "one two", "x"), (9, "z " * 60_000, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(frame).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (4, 3), (7, 6), (6, 6), (6, 6), (None, None), (9, 9)], key=str)
    assert S.near_duplicates(frame.limit(0)).count() == 0
