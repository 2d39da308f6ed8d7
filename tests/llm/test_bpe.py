"""Exact ids and decoding against the tokenizers library."""

import hashlib
import random
import subprocess
import sys
import tracemalloc
import unicodedata

import pytest
from tokenizers import Tokenizer

from eventloom.llm import bpe as B


@pytest.fixture(scope="module")
def both():
    path = B.vocabulary_path()
    with open(path, "rb") as file:
        return Tokenizer.from_file(path), B.encoder(file.read())


def test_same_ids_and_decoding(both):
    theirs, ours = both
    rng = random.Random(2)
    alphabets = ["ab", "abc", "aeinthr", "abcdefghijklmnopqrstuvwxyz", "!#*.-'", "aàéñßüΣ 0123", "日本語中文a", "AZ's 've\t\x85 "]
    texts = ["", "x <|endoftext|>y", "ΟΔΟΣ İ ẞ", "a" * 3000, "é vs é", "\x1c\x1d"]
    texts += ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    for _ in range(3000):
        alphabet = rng.choice(alphabets)
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))))
    for text in texts:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids, text
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_every_code_point(both):
    """Each one alone, in words, after numbers, before a combining mark; a thousand to a text."""
    theirs, ours = both
    for at in range(0, len(B.EVERY), 1000):
        text = " ".join(f"a{c}b 1{c}" + f" {c}\u0301" * (unicodedata.category(c) != "Cn") for c in B.EVERY[at : at + 1000])
        assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids, hex(at)
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(B.EVERY) for _ in range(200))
        assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids


def test_edges(spark, both):
    theirs, _ = both
    rows = [(1, None, 0), (1, None, 0), (2, "", 0), (None, "one two", 0), (3, "word " * 60_000 + "z" * 50_000, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted((tuple(r) for r in B.encode_digest(frame).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for i, text, _ in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(theirs.decode(ids, skip_special_tokens=False))))
    assert got == sorted(expected, key=str)
    assert sorted((r.doc_id, len(r.ids)) for r in B.encode(frame).collect() if r.doc_id) == sorted((i, n) for i, n, *_ in expected if i)
    assert B.encode_digest(frame.limit(0)).count() == 0


def test_a_worker_holds_little(both):
    """Neither loading the module nor a remembered pre-token takes much of a worker's memory."""
    code = "import tracemalloc, eventloom.llm.common; tracemalloc.start(); from eventloom.llm import bpe; print(tracemalloc.get_traced_memory()[0])"
    assert int(subprocess.run([sys.executable, "-c", code], env={"PYTHONPATH": ":".join(sys.path)}, capture_output=True, check=True, text=True).stdout) < 4e6
    model, rng = both[1], random.Random(6)
    text = " ".join({"".join(rng.choice("aeinthr") for _ in range(8)) for _ in range(5000)})
    model.encode(text)  # the pairs of tokens are remembered now
    model.known, model.before = {}, {}
    tracemalloc.start()
    try:
        model.encode_both(text)
        assert tracemalloc.get_traced_memory()[0] < 200 * len(model.known) and len(model.known) > 4900
    finally:
        tracemalloc.stop()


def test_every_code_point_once():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert list(B.EVERY) == every and len(B.EVERY) == len(every)
    for at in (0, 0xD7FF, 0xD800, 0xD801, len(every) - 1, -1):
        assert B.EVERY[at] == every[at]
    assert B.EVERY[0xD7F0:0xD810] == every[0xD7F0:0xD810] and B.EVERY[-3:] == every[-3:]
    with pytest.raises(IndexError):
        B.EVERY[len(every)]
