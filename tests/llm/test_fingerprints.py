"""Fingerprints against plain sets of paragraphs."""

import hashlib
import random

import pytest
import regex
from pyspark.sql import functions as F

from pairgrade.llm import fingerprints
from pairgrade.llm.fingerprints import (
    PARAGRAPH_END, document_fingerprints, fingerprint, fingerprint_difference, fingerprint_likeness, likeness,
)

LONG = "sequence(1L, {n}L)"


def edited(docs):
    least = {}
    for i, t in docs:
        if i is not None:
            least[i] = min(least.get(i, t or ""), t or "")
    order = sorted(least)
    out = []
    for i, t in docs:
        t = t or ""
        nxt = least[order[(order.index(i) + 1) % len(order)]] if i is not None else ""
        q = len(t) // 4
        out.append((i, t, t[:len(t) - q] + nxt[:q], nxt))
    return out


def paragraphs(text):
    return {x.strip(" ") for x in regex.split(PARAGRAPH_END, text, flags=regex.V1)} - {""}


def alike(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def case():
    rng = random.Random(6)
    line = lambda: " ".join(rng.choice(["wide.", "tree", "élan", "bird.", "seven"]) for _ in range(rng.randint(1, 9)))
    docs = [(i * 5 - 30, "\n".join(line() for _ in range(rng.choice([0, 1, 3, 8, 40])))) for i in range(40)]
    return docs + [(900, docs[9][1]), (901, docs[9][1]), (902, "z"), (902, "a\nb\nc\nd\ne\nf\ng\nh"), (903, None),
                   (904, ""), (None, "abc\ndef\nghi"), (905, docs[11][1]), (905, docs[11][1]), (2**61, "últimö\nfin")]


@pytest.mark.parametrize("bucket_rows", [1000, 4])
def test_matches_plain_sets(docs, monkeypatch, bucket_rows):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", bucket_rows)
    got = document_fingerprints(docs(case())).collect()
    want = [(i, len(t), hashlib.sha256(e.encode()).hexdigest(), round(alike(t, e), 9), round(alike(t, n), 9))
            for i, t, e, n in edited(case())]
    have = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].fingerprint == by_id[901].fingerprint
    assert by_id[900].near_next == 1.0 and len({r.fingerprint for r in got}) > 20


def test_large_differences_are_peeled(spark):
    for n, m in ((0, 0), (0, 700), (900, 1), (2000, 2500)):
        row = spark.range(1).select(
            F.transform(F.expr(LONG.format(n=max(n, 1))), lambda x: F.xxhash64(x).bitwiseAND(F.lit(-2))).alias("a"),
            F.transform(F.expr(LONG.format(n=max(m, 1))), lambda x: F.xxhash64(x).bitwiseAND(F.lit(-2))).alias("b"))
        row = row.select(F.slice("a", F.lit(1), F.lit(n)).alias("a"), F.slice("b", F.lit(1), F.lit(m)).alias("b"))
        assert row.select(likeness("a", "b").alias("x")).first().x == (min(n, m) / max(n, m) if max(n, m) else 1.0)


def test_empty_and_single(docs):
    assert document_fingerprints(docs([])).count() == 0
    one = document_fingerprints(docs([(3, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abca").hexdigest()


def test_two_rows_by_their_fingerprint_columns_alone(docs):
    """Any two rows of a written result can be compared, sizes apart or not."""
    rng = random.Random(3)
    texts = ["\n".join(str(x) for x in rng.sample(range(n + 30), n)) for n in (0, 1, 2, 7, 7, 20, 45, 45, 300, 310)]
    got = document_fingerprints(docs(list(enumerate(texts)))).select("doc_id", "fingerprint")
    other = got.selectExpr("doc_id as o", "fingerprint as g")
    pairs = got.join(other, got.doc_id <= other.o).select(
        "doc_id", "o", F.expr(fingerprint_likeness("fingerprint", "g")).alias("near"),
        F.expr(fingerprint_difference("fingerprint", "g")).alias("parts")).collect()
    assert len(pairs) == 55
    for r in pairs:
        a, b = paragraphs(texts[r.doc_id]), paragraphs(texts[r.o])
        assert r.near == pytest.approx(alike(texts[r.doc_id], texts[r.o]))
        assert sum(len(p.a) for p in r.parts) == len(a - b) and sum(len(p.b) for p in r.parts) == len(b - a)


def test_parts_take_the_width_that_peels(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "WIDTH", 1)
    row = spark.range(1).select(F.transform(F.expr(LONG.format(n=200)), lambda x: F.xxhash64(x).bitwiseAND(F.lit(-2)))
                                .alias("a")).select("a", F.slice("a", F.lit(1), F.lit(150)).alias("b"))
    made = row.selectExpr(f"{fingerprint('a')} as f", f"{fingerprint('b')} as g")
    made = spark.createDataFrame(made.collect())
    first = made.first()
    assert len({p.count(",") for p in first.f.partition(":")[2].split(";")}) > 1
    assert made.selectExpr(f"{fingerprint_likeness('f', 'g')} as x").first().x == 0.75


def test_texts_of_other_scripts(docs):
    rng = random.Random(8)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    cyr = [chr(c) for c in range(0x430, 0x450)]
    for stop, letters in (("。", han), (". ", cyr), ("।", [chr(c) for c in range(0x915, 0x939)])):
        rows = [(i, "".join("".join(rng.choices(letters, k=rng.randint(8, 20))) + stop for _ in range(40)))
                for i in range(4)]
        for r in document_fingerprints(docs(rows)).collect():
            assert r.near_edited > 0.4 and r.near_next == 0.0


def test_a_very_long_text(docs):
    long = "\n".join(f"paragraph {i}" for i in range(3000))
    rows = document_fingerprints(docs([(1, long), (2, long.replace("paragraph 7\n", "")), (3, "x")])).collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].near_next == pytest.approx(2999 / 3000)
    assert by_id[1].near_edited == pytest.approx(alike(long, edited([(1, long), (2, long.replace("paragraph 7\n", ""))])[0][2]))


def test_the_next_fingerprint_comes_with_the_next_text(docs):
    """Each text is sketched once; its neighbour gets the fingerprint, not the work."""
    own = fingerprints.with_fingerprint(docs(case()).select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
                                        "text", "fingerprint")
    got = fingerprints.with_next(own)
    wanted = fingerprints.with_fingerprint(got, "next_text", "wanted").collect()
    assert len(wanted) == len(case()) and all(r.next_fingerprint == r.wanted for r in wanted)
    assert {r.next_text for r in wanted if r.doc_id is None} == {""}


def test_entries_tell_whether_their_sketch_peels(spark, monkeypatch):
    width = 3
    rows = spark.range(300).select(F.transform(F.sequence(F.lit(1), F.col("id") % 9 + 1),
                                               lambda x: F.xxhash64("id", x).bitwiseAND(F.lit(-2))).alias("d"))
    peeled = fingerprints._peel(fingerprints._sketch("d", str(width)), str(width))
    got = rows.selectExpr(f"{fingerprints._peels(fingerprints._entries('d', str(width)))} as told",
                          f"{peeled} is not null as peeled").collect()
    assert all(r.told == r.peeled for r in got) and len({r.told for r in got}) == 2
