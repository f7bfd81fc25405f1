"""Random keys that secret scans must find whatever their form."""

import random
import string

from pairgrade.llm.secrets import INNER, secret_spans

BASE64 = string.ascii_letters + string.digits + "+/"


def key(rng, n, of=BASE64):
    return "".join(rng.choice(of) for _ in range(n))


def found(docs, texts):
    """For each text what its novel spans hold."""
    got = {r.doc_id: r.spans for r in secret_spans(docs(list(enumerate(texts)))).collect()}
    return [[t[int(s):int(e)] for kind, s, e in (x.split(":") for x in got[i].split(",") if x) if kind == "novel"]
            for i, t in enumerate(texts)]


def test_unspaced_assignments(docs):
    rng = random.Random(2)
    forms = ["export AWS_SECRET_ACCESS_KEY={}", "private_key={}", "--pwd={}", "https://h.example/x?access={}&n=1",
             "auth={}==", "access==={}", "n=private=of={}"]
    keys = [key(rng, 40) for _ in forms]
    assert found(docs, [f.format(k) for f, k in zip(forms, keys)]) == \
        [[k + "==" * f.endswith("==")] for f, k in zip(forms, keys)]
    assert found(docs, ["plain=" + keys[0], "private_key=default_value_here", "access=" + "=" * 40]) == [[], [], []]
    assert not list(INNER.finditer(b"=" * 1_000_000))


def test_long_keys_of_any_alphabet(docs):
    rng = random.Random(5)
    keys = [key(rng, n, of) for of in ("0123456789ABCDEF", string.ascii_uppercase + "234567", BASE64)
            for n in (20, 63, 64, 96, 128, 256, 342, 512)]
    assert found(docs, [f"the private key {k} is here" for k in keys]) == [[k] for k in keys]
    known = ["configuration_default_value/" * 12, "ab" * 200, "-" * 300]
    assert found(docs, [f"the private key {k} is here" for k in known]) == [[], [], []]
    held = key(rng, 30) + "0123456789012345" + key(rng, 30)  # a base span within
    assert found(docs, ["the private key " + held, "the private key 0123456789abcdef0123."]) == [[held], []]


def test_a_key_that_stands_twice(docs):
    rng = random.Random(8)
    a, b, c, d = key(rng, 24), key(rng, 24), key(rng, 100), key(rng, 24)
    texts = [f"enter the access key {a} and the access key {a} again", f"access: {b}\n# access: {b}.\naccess={b}",
             f"the private key {c}, the private key {c}", f"access {d}" + " " * 235 + f"access {d}"]
    assert found(docs, texts) == [[a, a], [b, b + ".", b], [c, c], [d, d]]


def test_contexts_without_a_word_before(docs):
    """Planted keys in code and prose, among strings that are no secrets."""
    rng = random.Random(12)
    planted = ["ghp_{} pushed", "openai sk-{} in a config", "xoxb-{}", "postgres://admin:{}@db.example/main",
               'SIGNING = "{}"', "salt: '{}'", "{{'seed': \"{}\"}}", "nonce := `{}`", "{} is my password", "{}  # auth"]
    keys = [key(rng, 36, string.ascii_letters + string.digits) for _ in planted]
    whole = [{0: "ghp_", 1: "sk-", 2: "xoxb-"}.get(n, "") + k for n, k in enumerate(keys)]
    assert found(docs, [p.format(k) for p, k in zip(planted, keys)]) == [[w] for w in whole]
    uuid = "550e8400-e29b-41d4-a716-446655440000"
    harmless = [f'request_id = "{uuid}"', 'path = "/usr/local/share/applications/default"', "see https://www.example.org/information/settings",
                'name = "international_configuration_value"', "Donaudampfschifffahrtsgesellschaft fährt", "x = undefined_variable_name",
                'kind = "application/content-type"', f"commit {key(rng, 40, string.ascii_letters + string.digits)} was merged",
                "the session at 2026-12-03T14:11:00+00:00", 'words = "internationalinformation"']
    assert found(docs, harmless) == [[]] * len(harmless)


def test_empty_and_long(docs):
    rng = random.Random(1)
    assert secret_spans(docs([])).count() == 0
    k = key(rng, 40)
    text = "plain words here " * 20_000 + f"the access key {k} and " + "x" * 200_000 + " more" * 10_000
    assert found(docs, [text, ""]) == [[k], []]
    got = secret_spans(docs([(1, None), (None, "a")])).collect()
    assert [(r.n_assign, r.n_novel, r.spans) for r in got] == [(0, 0, "")] * 2
