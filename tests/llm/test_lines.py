"""Line dedup against plain edit distances between all lines."""

import hashlib
import random

from pairgrade.llm import lines
from pairgrade.llm.lines import dedup_lines, segment_keys, within


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def edited(rng, text, n, letters="abcé "):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randint(0, len(out)), rng.randint(0, 2)
        if kind == 0 or not out:
            out.insert(at, rng.choice(letters))
        elif kind == 1:
            out.pop(min(at, len(out) - 1))
        else:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(6000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = edited(rng, a, rng.randint(0, 5), "abc")
        for limit in range(4):
            assert within(a, b, limit) == (distance(a, b) <= limit), (a, b, limit)
    a = "x" * 5000 + "y" * 5000
    assert within(a, a[1:] + "z", 2) and not within(a, a[3:], 2)


def test_near_lines_share_a_key():
    rng = random.Random(2)
    for limit in (1, 2, 3):
        for _ in range(1500):
            a = "".join(rng.choice("abc") for _ in range(rng.randint(2 * limit + 1, 20)))
            b = edited(rng, a, rng.randint(0, limit), "abc")
            if len(b) <= 2 * limit:
                continue
            number, key, indexed = segment_keys([a, b], limit)
            keys = [set(key[number == i].tolist()) for i in (0, 1)]
            index = [set(key[(number == i) & indexed].tolist()) for i in (0, 1)]
            assert keys[0] & index[1] or keys[1] & index[0], (a, b, limit)


def brute(docs, limit, least):
    places = []
    for i, text in docs:
        if i is not None:
            places += [((i, n), x) for n, x in enumerate((text or "").split("\n")) if len(x) >= least]
    first = {}
    for place, x in places:
        first[x] = min(first.get(x, place), place)
    near = {x for x in first if any(first[y] < first[x] and distance(x, y) <= limit for y in first if y != x)}
    out = []
    for i, text in docs:
        all_lines = text.split("\n") if text else []
        kept, n_near = [], 0
        for n, x in enumerate(all_lines):
            if i is None or len(x) < least or (first[x] == (i, n) and x not in near):
                kept.append(x)
            else:
                n_near += first[x] == (i, n)
        out.append((i, len(all_lines), len(all_lines) - len(kept), n_near,
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_lines", "n_removed", "n_near", "kept_sha256").collect()), key=str)


def case():
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefé ") for _ in range(n)) for n in (9, 10, 11, 15, 30, 31, 80)]
    docs = []
    for i in range(45):
        some = [rng.choice(base) for _ in range(rng.randint(0, 4))]
        docs.append((i * 2 - 9, "\n".join(edited(rng, x, rng.choice([0, 0, 1, 2, 3, 4])) for x in some)))
    return docs + [(200, docs[5][1]), (200, docs[5][1]), (201, None), (202, ""), (None, base[6]), (203, "\n\n\n"),
                   (204, "z" * 30000 + "\n" + "z" * 29999), (205, base[6] + "\n" + base[6])]


def test_matches_brute_force(docs):
    small = [d for d in case() if d[0] != 204]
    assert rows(dedup_lines(docs(small), least=10)) == brute(small, 2, 10)


def test_blocks_flushes_and_a_crowded_sketch_give_the_same(docs, monkeypatch):
    monkeypatch.setattr(lines, "FLUSH_CHARS", 100)
    small = [d for d in case() if d[0] != 204]
    own = dedup_lines.__wrapped__ if hasattr(dedup_lines, "__wrapped__") else dedup_lines
    monkeypatch.setattr(lines.linked_lines, "__defaults__", (3,))
    assert rows(own(docs(small, 5), distance=3, least=10, sketch_bits=8)) == brute(small, 3, 10)


def test_long_line_and_empty_table(docs):
    got = {r.doc_id: r for r in dedup_lines(docs([(204, "z" * 30000 + "\n" + "z" * 29999)])).collect()}
    assert (got[204].n_removed, got[204].n_near) == (1, 1)
    assert dedup_lines(docs([])).count() == 0
