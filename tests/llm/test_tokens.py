"""Token counts, byte-level BPE and secret scans against their libraries and
plain versions."""

import hashlib
import random
import re

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from pairgrade.llm import bpe, token_counts
from pairgrade.llm.bpe import Codec, encode_decode, read_ranks
from pairgrade.llm.secrets import Novelty, secret_spans
from pairgrade.llm.token_counts import safe_pieces, token_counts as count

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
LETTERS = [chr(c) for c in (9, 10, 11, 13, 28, 31, 32, 39, 133, 160, 233, 769, 0x2028, 0x200B, 0x3000, 0x4E00, 0x416,
                            0x661, 0xBD, 0x1F600, 0x130)] + list("stremvdl aAZ01,.!|<>")


def texts():
    rng = random.Random(2)
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return out + ["<|endoftext|> a<|startoftext|>b", "can't we'll I'M", "x" * 5000, " " * 3000, "é " * 4000, "a\n\n\nb"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_is_the_library_s(library, docs, monkeypatch):
    rows = list(enumerate(texts())) + [(900, None), (901, ""), (None, "no id"), (3, "twice"), (3, "twice")]
    got = encode_decode(docs(rows), RANKS, P.PATTERN, with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids)))
    assert sorted(map(str, ((*r[:4], tuple(r.ids)) for r in got))) == sorted(map(str, want))


def test_stream_small_memory_and_incremental_decoding(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 20)
    monkeypatch.setattr(bpe, "MAX_STATES", 30)
    with open(RANKS, "rb") as f:
        codec = Codec(f.read(), P.PATTERN, cache_pieces=4)
    for t in texts():
        ids = library.encode_ordinary(t)
        assert codec.ids(t) == ids
        state, out = 0, b""
        for i in ids:  # token by token: characters may be open in between
            raw, state = codec.machine.decode([i], state)
            out += raw
        assert state == 0 and out == t.encode()
    lone = next(i for i, raw in codec.transducer.bytes_of.items() if raw == b"\xc3")
    assert codec.machine.decode([lone]) == (b"\xc3", 1)
    with pytest.raises(ValueError):
        codec.machine.decode([lone, lone])


def test_counts_are_the_library_s(docs, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 50)
    whole = Tokenizer.from_file(WORDS)
    rows = list(enumerate(texts())) + [(900, None), (None, "no id"), (3, "twice"), (3, "twice")]
    got = count(docs(rows), WORDS, limit=20).collect()
    want = []
    for i, t in rows:
        n = len(whole.encode(t or "", add_special_tokens=False))
        want.append((i, len((t or "").encode()), n, n > 20))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert count(docs([]), WORDS).count() == 0 and encode_decode(docs([]), RANKS, P.PATTERN).count() == 0


def test_pieces_are_cut_at_space_only():
    text = "ab cd\nef " * 30 + "x" * 200 + " y"
    pieces = list(safe_pieces(text, 10))
    assert " ".join(pieces).replace("\n", " ") == text.replace("\n", " ") and max(map(len, pieces)) >= 200


BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                              re.I | re.A), lambda m: len(m[2]) >= 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16)]


def test_secrets(docs):
    rng = random.Random(4)
    key = lambda n, a="ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789": "".join(rng.choice(a) for _ in range(n))
    parts = ['Password: "', "api_key=", "toKen  :  '", "AKIA", "é ", "ſecret=abcdefghijklmnop", "\n", " AKIAAKIA",
             "secret=short token=", "'", '" ']
    rows = [(i, "".join(rng.choice(parts) + rng.choice([key(14), key(20, "0123456789abcdef"), key(17).upper(), "word "])
                        for _ in range(rng.randint(0, 6)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "token=" + key(20)), (502, "a" * 40), (502, "a" * 40)]
    got = sorted(map(str, ((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256)
                           for r in secret_spans(docs(rows)).collect())))
    want = []
    for i, t in rows:
        spans = sorted((m.start(), k, m.end()) for k, (_, rx, ok) in enumerate(BASE) for m in rx.finditer(t or "") if ok(m))
        told = ",".join(f"{BASE[k][0]}:{s}:{e}" for s, k, e in spans)
        want.append((i, *[sum(x[1] == k for x in spans) for k in range(3)], hashlib.sha256(told.encode()).hexdigest()))
    assert got == sorted(map(str, want))


def test_novel_strings_need_context_and_entropy(docs):
    rows = [(1, "the private key x8Jq2Lm9Zp4Kr7Wt1VbQ is here"), (2, "a plain x8Jq2Lm9Zp4Kr7Wt1VbQ without context"),
            (3, "the private key configuration_default_value"), (4, "secret=x8Jq2Lm9Zp4Kr7Wt1VbQ")]
    got = {r.doc_id: (r.n_novel, r.spans) for r in secret_spans(docs(rows)).collect()}
    assert got[1] == (1, "novel:16:36") and got[2] == (0, "") and got[3] == (0, "") and got[4][0] == 0
    text = b"x8Jq2Lm9Zp4Kr7Wt1VbQ and again x8Jq2Lm9Zp4Kr7Wt1VbQ"
    assert Novelty().measure(text, 31, 51) < 0.5 < Novelty().measure(text[31:], 0, 20)  # met in the text around


def test_bounded_memory_gives_the_same_rows(docs):
    texts = [(n, " ".join(f"w{n * k % 7919}ø{k}" for k in range(60))) for n in range(40)] + [(99, None)]
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    small = encode_decode(docs(texts), ranks, P.PATTERN, cache_pieces=20, max_states=50)
    assert sorted(small.collect()) == sorted(encode_decode(docs(texts), ranks, P.PATTERN).collect())
    with open(ranks, "rb") as f:
        codec = Codec(f.read(), P.PATTERN, cache_pieces=20, max_states=50)
    for _, text in texts[:-1]:
        codec.digest(text)
        assert len(codec.young) <= 10 and len(codec.old) <= 10 and len(codec.transducer.states) < 200


def test_matches_met_once_are_not_kept():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        codec = Codec(f.read(), P.PATTERN, second=True)
    texts = [" ".join(f"qø{chr(97 + n)}{chr(97 + k // 26)}{chr(97 + k % 26)}zx" for k in range(60)) for n in range(8)]
    first = [codec.digest(t) for t in texts]
    once = len(codec.young)
    assert [codec.digest(t) for t in texts] == first  # met again: kept, and the same
    assert once < 60 < 400 < len(codec.young)
