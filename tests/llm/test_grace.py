import hashlib
import random

import pytest

from pairgrade.llm import grace
from pairgrade.llm.grace import Table, exact_duplicates


def plain(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        spare = 1  # of rows that repeat the greatest id one stays
        for doc in ids:
            kept = doc == keep and spare > 0
            spare -= kept
            out.append((doc, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(repr, out))


def result(df, **params):
    return sorted(repr(tuple(row)) for row in exact_duplicates(df, **params).collect())


def test_table_compares_whole_texts():
    table = Table()
    assert [table.put(7, t, n) for n, t in enumerate([b"a", b"b", b"a", b"", b"b"])] == [0, 1, 0, 3, 1]
    for n in range(500):  # one slot for all of them at first
        assert table.put(n % 3 << 20, b"%d" % n, 100 + n) == 100 + n
    assert table.put(499 % 3 << 20, b"499", 9999) == 599


def test_nulls_repeats_and_long_texts(docs):
    long = "word " * 300_000
    rows = [(1, "a"), (2, None), (3, ""), (4, "a"), (5, "a "), (6, long), (7, long), (8, long + "."), (None, "a"),
            (None, "lost"), (None, "lost"), (9, "same"), (9, "same"), (9, "other"), (-4, "Ä"), (-5, "Ä")]
    assert result(docs(rows)) == plain(rows)


def test_empty_table(docs):
    assert result(docs([])) == []


@pytest.mark.parametrize("bucket_bytes", [200, 5_000, 1 << 24])
def test_any_bucket_size_gives_the_same(docs, bucket_bytes):
    rng = random.Random(bucket_bytes)
    rows = [(n, rng.choice(["hot " * 20, f"text {rng.randrange(150)}", f"alone {n}"])) for n in range(600)]
    assert result(docs(rows, partitions=7), bucket_bytes=bucket_bytes) == plain(rows)


def test_equal_hashes_are_told_apart(docs, monkeypatch):
    """Whatever the hash, whole texts decide."""
    monkeypatch.setattr(grace.F, "xxhash64", lambda *c: grace.F.lit(5).cast("bigint"))
    rows = [(n, f"text {n % 9}") for n in range(60)]
    assert result(docs(rows)) == plain(rows)


def test_partitions_do_not_matter(docs):
    rows = [(n, f"t{n % 40}" if n % 3 else "hot") for n in range(400)]
    assert result(docs(rows, partitions=1)) == result(docs(rows, partitions=11)) == plain(rows)
