"""Decontamination against a plain search for every window."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from pairgrade.llm import decontaminate
from pairgrade.llm.decontaminate import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return WORD.findall(lower)


def brute(docs, items, span=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, itext in items:
            if item is None:
                continue
            iw = words(itext)
            n = min(span, len(iw))
            for a in range(len(iw) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b:b + n] == iw[a:a + n]:
                        hit.update(range(b, b + n))
                        found.add(str(item))
        out.append((i, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def case():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(6)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([1, 4, 9, 10, 11, 25]) if i < 20 else 30)) for i in range(24)]
    items += [(3, items[5][1]), (100, ""), (101, None), (None, text(12)), (102, "Zwölf ÉCOLE été zz")]
    docs = [(i, text(rng.choice([0, 3, 9, 10, 40, 200]))) for i in range(40)]
    docs += [(50, f"zz {items[22][1].upper()} yy"), (51, items[23][1].replace(" ", " -- ")),
             (52, " ".join(items[21][1].split()[:9])), (53, None), (54, ""), (54, "zwölf Été"),
             (55, "zwölf École"), (56, "x ZWÖLF zwölf école"), (57, "a zwölf École été zz b"),
             (0, docs[0][1]), (0, docs[0][1]), (None, items[22][1])]
    docs.append((60, " ".join([items[20][1], text(4000), items[20][1]])))
    return docs, items


def test_matches_brute_force(spark, docs):
    d, i = case()
    items = spark.createDataFrame(i, "item_id bigint, text string")
    assert rows(contamination(docs(d), items)) == brute(d, i)


def test_shuffled_join_gives_the_same(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    d, i = case()
    items = spark.createDataFrame(i, "item_id bigint, text string")
    assert rows(contamination(docs(d), items, bitmap_bits=8)) == brute(d, i)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert contamination(docs([]), items).count() == 0
    got = contamination(docs([(1, "a b c"), (2, None)]), items.limit(0))
    assert rows(got) == brute([(1, "a b c"), (2, None)], [])
    assert got.where(F.col("contaminated")).count() == 0
