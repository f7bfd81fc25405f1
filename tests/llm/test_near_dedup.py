"""Near-dedup against all pairs of sets."""

import random
import re

import numpy as np
import pytest

from pairgrade.llm import near_dedup
from pairgrade.llm.near_dedup import index_keys, left_out, near_duplicates, near_heads

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(docs, size=2):
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if None not in (docs[i][0], docs[j][0]) and a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least[find(i)] if d is not None else None,
                    d is None or d == least[find(i)]) for i, (d, _) in enumerate(docs)), key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def case(seed=9, families=6, copies=25):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 60))
    docs, n = [], 1000
    for _ in range(families):
        base = [word() for _ in range(rng.choice([8, 30, 120]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 14))):
                own[rng.randrange(len(own))] = word()
            docs.append((n := n - rng.randint(1, 3), rng.choice([" ", "\n", "  "]).join(own)))
        base = own  # the next family starts from a far copy of this one
    docs += [(2000, docs[0][1].upper()), (2001, docs[0][1]), (2001, docs[0][1]), (2001, docs[40][1]),
             (2002, "one"), (2003, "ONE"), (2004, "one one"), (2005, "one one one"), (2006, None), (2007, ""),
             (2008, " \n"), (2009, None), (None, docs[0][1]), (-7, docs[copies * 2 + 4][1]), (2010, "É é"), (2011, "é é")]
    return docs


@pytest.mark.parametrize("size", [2, 5])
def test_matches_all_pairs(docs, size):
    assert rows(near_duplicates(docs(case()), size=size)) == brute(case(), size)


def test_five_words_by_default(docs):
    assert rows(near_duplicates(docs(case(4, 3, 20)))) == brute(case(4, 3, 20), 5)


@pytest.mark.parametrize("stars", [0, 2])
def test_small_units_and_spread_heads(docs, monkeypatch, stars):
    """The same without the first rounds, and however units are cut."""
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", stars)
    monkeypatch.setattr(near_dedup, "MEMBERS", 3)
    monkeypatch.setattr(near_dedup, "HEADS", 4)
    monkeypatch.setattr(near_dedup, "OTHERS", 7)
    assert rows(near_duplicates(docs(case(11, 3, 20), 5), size=2)) == brute(case(11, 3, 20))


def test_long_texts(docs):
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(40_000)]
    near, far = list(base), list(base)
    near[::40] = ["x"] * len(near[::40])
    far[::5] = ["y"] * len(far[::5])
    own = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, "short text")]
    assert rows(near_duplicates(docs(own), size=2)) == brute(own)


def test_a_pair_counts_under_its_first_common_key():
    rng = np.random.default_rng(4)
    for chunk, errors in ((8, 1), (4, 2)):
        out = left_out(chunk, errors)
        a = rng.integers(0, 1 << 16, 32).astype(np.uint16)
        for changed in (0, 1, 3, 6, 12):
            b = a.copy()
            b[rng.choice(32, changed, replace=False)] ^= 1
            common = np.flatnonzero(np.equal(*index_keys(np.stack([a, b]), chunk, errors)))
            seen = [p for p in range(32 // chunk * len(out)) if near_heads(a[None], b, p, chunk, out, 32)[0]]
            assert [p for p in seen if p in common] == common[:1].tolist()
            assert not near_heads(a[None], b, int(common[0]), chunk, out, changed - 1)[0] if len(common) else True


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(1)
    for chunk, errors in ((6, 1), (4, 2)):
        for _ in range(300):
            a = rng.integers(0, 1 << 16, 24).astype(np.uint16)
            b = a.copy()
            far = rng.choice(24, 24 // chunk * (errors + 1) - 1, replace=False)
            b[far] ^= 1
            keys = index_keys(np.stack([a, b]), chunk, errors)
            assert set(keys[0].tolist()) & set(keys[1].tolist())


def test_empty(docs):
    assert rows(near_duplicates(docs([]))) == []
    only = [(1, None), (2, ""), (3, "a b c")]
    assert rows(near_duplicates(docs(only), size=2)) == brute(only)
