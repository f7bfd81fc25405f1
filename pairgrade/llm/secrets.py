"""Secret scans: fixed patterns, and strings that compression finds new.

Base spans come from three patterns.  Beyond them, a long string in a sensitive
context (near a sensitive word, quoted as the value of an identifier, the
password of a URL, or with the prefix of a known kind of key) is measured: how
many bytes it adds to a zstandard frame whose dictionary holds common identifiers
and the text around it.  Names and words
are copied from there for a few bytes; a random key costs its whole length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairgrade.llm.common import Words, id_text, slices, text_buffers

# The base patterns and their least lengths, in order of listing.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = "0123456789abcdef"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "novel")

#: Words that make a string near them worth measuring.
SENSITIVE = re.compile(rb"(?<![A-Za-z])(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access|private|"
                       rb"credentials?|auth(?:orization)?|bearer|signature|licen[cs]e[_-]?key)(?![a-z])", re.IGNORECASE)
#: How keys of well-known services begin.
PREFIX = re.compile(rb"gh[pousr]_|github_pat_|glpat-|sk[-_]|[pr]k_(?:live|test)_|xox[abeoprs]-|npm_|pypi-|SG\.|eyJ[A-Za-z0-9]")
#: What stands before the quoted value of an identifier, and before a URL's password.
ASSIGNED = re.compile(rb"""[A-Za-z_][A-Za-z0-9_.-]*["']?\s*(?:=>|:=|=|:)\s*["'`]$""")
LOGIN = re.compile(rb"://[^\s/:@]*:$")
MIXED = re.compile(rb"(?=.*[A-Za-z])(?=.*[0-9])")
UUID = re.compile(rb"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$")
CANDIDATE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
ENDS = b"+/_.=-"
INNER = re.compile(rb"(?<!=)=++(?=.)")  # not at the end

#: Identifiers and words that code and prose are made of.
IDENTIFIERS = (
    "username password passphrase credentials authorization authentication access_token refresh_token "
    "client_secret client_id private_key public_key api_key api_token session_id database connection string "
    "configuration settings environment production development localhost example.com https://www.example.org/ "
    "application content-type header request response encoding default value variable parameter function "
    "return class import package module version license signature certificate algorithm RSA AES SHA256 base64 "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 00000000 ffffffff xxxxxxxxxxxxxxxx "
    "changeme placeholder your_token_here insert_key_here undefined null true false information international "
    "the and that with from this have not are was for you will would there their which about other were"
).encode()


#: Bytes measured at once at most.
PIECE = 63


class Novelty:
    """Marginal compressed bytes of a candidate, per byte of it."""

    def __init__(self, dictionary: bytes = IDENTIFIERS, around: int = 256, level: int = 6,
                 back: int = 1024):
        self.dictionary, self.around, self.level, self.back = dictionary, around, level, back

    def measure(self, raw: bytes, start: int, end: int) -> float:
        """A long candidate is measured in even pieces, each after what stands
        before it: from 64 literals zstandard codes them by their frequency, and
        a random key of few different characters would seem known."""
        import zstandard

        beside = raw[max(0, start - self.around):start] + b"\n" + raw[end:end + self.around]
        n = -(-(end - start) // PIECE)
        edges = [start + (end - start) * i // n for i in range(n + 1)]
        cost = 0
        for lo, hi in zip(edges, edges[1:]):
            primed = zstandard.ZstdCompressionDict(
                self.dictionary + b"\n" + beside + raw[max(start, lo - self.back):lo],
                dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            frame = zstandard.ZstdCompressor(level=self.level, dict_data=primed, write_content_size=False)
            cost += len(frame.compress(raw[lo:hi])) - len(frame.compress(b""))
        return cost / (end - start)


    def alone(self, raw: bytes, start: int, end: int) -> float:
        """The same when other places of the candidate in the bytes around it
        are blank: a secret that stands twice isn't known by its copy."""
        own = raw[start:end]
        core = own.strip(ENDS) or own
        lo, wide = max(0, start - self.around), len(own)
        before = raw[max(0, lo - wide):start].replace(core, b"\n" * len(core))[-self.around:]
        after = raw[end:end + self.around + wide].replace(core, b"\n" * len(core))[:self.around]
        return self.measure(before + own + after, len(before), len(before) + wide)


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of the first two base patterns,
    in bytes; for the third see ``runs``."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw)
             if m.end(2) - m.start(2) >= LEAST["assign"]]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw)
                  if m.end() - m.start() >= LEAST["access"]]
    return found


def runs(raw: np.ndarray, at: np.ndarray, inside: str, least: int) -> list[list[tuple[int, int]]]:
    """For each text its longest runs of the characters ``inside`` of at least
    ``least`` bytes, as (start, end) within the text."""
    words = Words(raw, at, inside)
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(at) - 1)]
    long = np.flatnonzero(words.end - words.start >= least)
    owner = words.text_of()[long]
    for i, t in zip(long.tolist(), owner.tolist()):
        out[t].append((int(words.start[i] - at[t]), int(words.end[i] - at[t])))
    return out


def values(raw: bytes, start: int, end: int, least: int) -> list[tuple[int, int]]:
    """The parts of a candidate between its equals signs (those at its end are
    padding and stay) that have ``least`` bytes."""
    edges = [start, *(x for m in INNER.finditer(raw, start, end) for x in m.span()), end]
    parts = [(s, e) for s, e in zip(edges[::2], edges[1::2]) if e - s >= least]
    return parts if len(edges) > 2 else []


def sensitive(raw: bytes, start: int, end: int, reach: int) -> bool:
    """Whether a string stands where secrets do: a sensitive word within
    ``reach`` bytes before it or half as many behind it on its line, quoted as
    the value of an identifier (letters with digits, and no UUID), as the
    password of a URL, or with a known prefix."""
    lo = max(0, start - reach)
    if SENSITIVE.search(raw, lo, start) or PREFIX.match(raw, start, end):
        return True
    line = raw.find(b"\n", end, end + reach // 2)
    if SENSITIVE.search(raw, end, line if line >= 0 else min(len(raw), end + reach // 2)):
        return True
    before, after = raw[lo:start], raw[end:end + 1]
    if after == b"@" and LOGIN.search(before):
        return True
    return (after in (b'"', b"'", b"`") and after == before[-1:] and ASSIGNED.search(before) is not None
            and MIXED.match(raw, start, end) is not None and UUID.match(raw, start, end) is None)


def novel_spans(raw: bytes, candidates: list[tuple[int, int]], known: list[tuple[int, int, int]],
                novelty: Novelty, threshold: float, reach: int, least: int = 16) -> list[tuple[int, int, int]]:
    """The candidates outside all base spans that are ``sensitive`` by their
    context and cost ``threshold`` bytes a byte at least.  Of a
    candidate that does not, the parts between equals signs (``values``) that
    do: there the word may stand in the candidate itself.  Runs of hexadecimal
    digits that leave ``least`` bytes of a candidate do not tell it: a long key
    is likely to hold some."""
    def told(start: int, end: int) -> bool:
        inside = [(k, min(e, end) - max(s, start)) for s, k, e in known if s < end and start < e]
        return any(k != 2 for k, _ in inside) or bool(inside) and end - start - sum(n for _, n in inside) < least

    def found(start: int, end: int) -> bool:
        return (not told(start, end)
                and sensitive(raw, start, end, reach)
                and novelty.alone(raw, start, end) >= threshold)

    out = []
    for start, end in candidates:
        if found(start, end):
            out.append((start, 3, end))
        else:
            out += [(s, 3, e) for s, e in values(raw, start, end, least) if found(s, e)]
    return out


def secret_spans(docs: DataFrame, threshold: float = 0.9, least: int = 16, reach: int = 48,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans), one row
    per input row; the text itself never leaves Python.

    Spans are ``kind:start:end`` in code points (end exclusive), by start, then
    kind as in ``KINDS``.  ``base_sha256`` covers the three base kinds, ``spans``
    lists all.  A null text counts as empty (no spans, digest of no bytes); a
    null id stays null; repeated rows give repeated rows; other columns are
    ignored; an empty table gives no rows.  A text is never divided: a task needs
    memory for its longest one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for part in slices(batches):
            raw, at = text_buffers(part.column(1))
            all_hex = runs(raw, at, HEX, LEAST["hex"])
            strings = runs(raw, at, CANDIDATE, least)
            counts: list[list[int]] = [[], [], [], []]
            shas, spans = [], []
            for i in range(part.num_rows):
                own = raw[at[i]:at[i + 1]]
                text = own.tobytes()
                base = sorted(base_spans(text) + [(s, 2, e) for s, e in all_hex[i]])
                new = novel_spans(text, strings[i], base, novelty, threshold, reach, least)
                chars = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)]) if base or new else None
                told = [[f"{KINDS[k]}:{chars[s]}:{chars[e]}" for s, k, e in some]
                        for some in (base, sorted(base + new))]
                shas.append(hashlib.sha256(",".join(told[0]).encode()).hexdigest())
                spans.append(",".join(told[1]))
                for k in range(4):
                    counts[k].append(sum(x[1] == k for x in base + new))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas), pa.array(spans)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint, "
             "base_sha256 string, spans string")
