"""Substring dedup against a plain search for every window."""

import hashlib
import random
import re

import numpy as np

from pairgrade.llm import countmin, substring
from pairgrade.llm.countmin import pack_cells, pack_gaps, unpack_cells, unpack_gaps
from pairgrade.llm.substring import dedup_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, span=13):
    least = {}
    for i, text in docs:
        w = WORD.findall(text or "")
        for a in range(len(w) - span + 1):
            if i is not None:
                key = tuple(w[a:a + span])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, text in docs:
        w, gone = WORD.findall(text or ""), set()
        for a in range(len(w) - span + 1):
            if i is not None and least[tuple(w[a:a + span])] < i:
                gone.update(range(a, a + span))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def case():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdefgé") + str(rng.randint(0, 30)) for _ in range(n))
    shared = [text(n) for n in (12, 13, 14, 60)]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), text(rng.randint(0, 5))]
        docs.append((i * 3 - 20, rng.choice([" ", "\n", "\t "]).join(parts)))
    docs += [(500, docs[3][1]), (501, docs[3][1]), (501, docs[3][1]), (501, shared[3] + " x"), (502, None),
             (503, ""), (None, shared[3]), (504, (shared[1] + " ") * 40), (2**40, shared[3] + " z")]
    return docs


def test_matches_brute_force(docs):
    assert rows(dedup_substrings(docs(case()))) == brute(case())


def test_crowded_sketch_and_small_flushes_give_the_same(docs, monkeypatch):
    monkeypatch.setattr(substring, "FLUSH_WINDOWS", 50)
    monkeypatch.setattr(countmin, "FLUSH_HASHES", 70)
    monkeypatch.setattr(substring, "BUCKET_WINDOWS", 300)
    assert rows(dedup_substrings(docs(case(), 5), sketch_bits=16)) == brute(case())
    assert rows(dedup_substrings(docs(case(), 2), sketch_bits=7, depth=3)) == brute(case())


def test_empty(docs):
    assert rows(dedup_substrings(docs([]))) == []


def test_gaps():
    rng = np.random.default_rng(1)
    for high in (3, 300, 100_000):
        x = np.sort(rng.integers(0, high, 500))
        assert (unpack_gaps(pack_gaps(x)) == x).all()
    assert len(unpack_gaps(b"")) == 0


def test_cells_far_apart_take_little_more_than_a_byte():
    rng = np.random.default_rng(2)
    for width, n in ((20, 3500), (20, 14_000), (20, 200_000), (20, 1), (20, 0), (16, 900), (4, 40), (0, 3)):
        x = np.sort(rng.integers(0, 1 << width, n)).astype(np.uint32)
        packed = pack_cells(x, width)
        assert (unpack_cells(packed) == x).all() and len(packed) <= len(pack_gaps(x)) + 1
    x = np.sort(rng.integers(0, 1 << 20, 3500)).astype(np.uint32)
    assert len(pack_cells(x, 20)) < 1.3 * len(x) < 1.6 * len(x) < len(pack_gaps(x))


def test_windows_that_follow_one_another_share_a_bucket():
    """Equal windows do always, wherever they stand."""
    rng = np.random.default_rng(4)
    words = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    words[3000:3400] = words[1000:1400]
    places = np.arange(5000 - 12)
    got = substring.bucket_of(words, places, 13, 64)
    assert (got[1000:1388] == got[3000:3388]).all()
    assert (got[1:] != got[:-1]).mean() < 0.3 and len(np.unique(got)) == 64 and np.bincount(got).max() < 300
    assert (substring.bucket_of(words, places, 3, 1) == 0).all()


def test_documents_that_begin_alike_and_copies(docs, monkeypatch):
    """A header in every document, and texts that stand more than once."""
    monkeypatch.setattr(substring, "FLUSH_WINDOWS", 400)
    monkeypatch.setattr(substring, "BUCKET_WINDOWS", 100)
    header = " ".join(f"h{n}" for n in range(20))
    own = [(n, f"{header} own {n % 25} " + " ".join(f"w{n % 25}x{k}" for k in range(n % 30))) for n in range(120)]
    own += [(200, "short"), (201, "short"), (202, None), (203, ""), (204, " "), (None, own[0][1]), (7, own[3][1])]
    assert rows(dedup_substrings(docs(own, 6))) == brute(own)


def test_copies_are_told_apart(docs):
    from pyspark.sql import functions as F

    from pairgrade.llm.common import id_text, text_hash

    own = [(5, "a b"), (3, "a b"), (9, "a b"), (9, "a b"), (3, "a b"), (4, "a  b"), (None, "a b"), (6, None), (8, "")]
    rest, copies = substring.split_copies(id_text(docs(own)).withColumn("mark", text_hash()))
    assert sorted(r.doc_id for r in copies.collect()) == [5, 8, 9, 9]
    assert rest.count() + copies.count() == len(own) and rest.where(F.col("doc_id") == 3).count() == 2


def test_long_texts(docs):
    rng = random.Random(1)
    long = " ".join(str(rng.randrange(1000)) for _ in range(60_000))
    own = [(1, long), (2, long), (3, "x " + long[:200_000]), (4, "y" * 300_000)]
    assert rows(dedup_substrings(docs(own))) == brute(own)
