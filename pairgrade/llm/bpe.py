"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

The merges of a rank file define, for every byte string, one tokenisation.  Two
facts make it a left-to-right process: the tokens of a prefix that ends where a
token ends are the tokenisation of that prefix, and a token sequence is a
tokenisation exactly if each neighbouring pair is (tokenising the pair's bytes
gives the pair back).  So a reader needs, for each place where a token could
still be open, the token that ends there.  That is the transducer's state; a
step reads a byte and tells the token that ends with it.  Which of those tokens
count is certain once no longer token is open, or where the tokens up to every
open place agree, at the latest after the longest token's bytes (the
lookahead): then they are sent.  States and their steps are made when first met.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame

from pairgrade.llm.common import id_text, kept, slices, texts_of

CACHE_PIECES = 1_400_000
MAX_STATES = 250_000
BLOCK = 50_000
MET_BITS = 21

#: White space as the splitter's pattern means it (Unicode White_Space).
_SPACE = r"\t-\r\x20\x85\xa0  -     　"


def read_ranks(blob: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in blob.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def piece_pattern(pattern: str):
    """The splitter's pattern for the ``regex`` module, with white space
    spelled out (the module's own class also holds the separators 1C-1F)."""
    import regex

    spelled = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]")
    return regex.compile(spelled.replace(r"\s", f"[{_SPACE}]"))


class _State:
    """Where a next token may begin: (trie node of the bytes read since there,
    token that ends there), longest open first; the last one begins here."""

    __slots__ = ("items", "steps")

    def __init__(self, items: tuple):
        self.items = items
        self.steps: dict[int, tuple[_State, int]] = {}  # byte: (state, token that ends with it)


class Transducer:
    """Encodes one splitter match after another."""

    def __init__(self, ranks: dict[bytes, int], max_states: int | None = None):
        self.ranks, self.max_states = ranks, max_states or MAX_STATES
        self.bytes_of = {i: t for t, i in ranks.items()}
        self._spines: dict[int, tuple[list, list]] = {}
        self._pair: dict[int, bool] = {}
        self._grow_trie()
        self.states: dict[tuple, _State] = {}
        self._reset()

    def _grow_trie(self) -> None:
        """The tokens that their own merges give, as a trie (root 0): a node's
        child by byte, its token or -1, and whether longer tokens go on."""
        self.child: dict[int, int] = {}
        self.token_at, self.longer, self.depth = [-1], [False], [0]
        self.size = {token: len(raw) for raw, token in self.ranks.items()}
        for raw, token in self.ranks.items():
            if not self._spine(token)[0]:
                continue
            node = 0
            for byte in raw:
                self.longer[node] = True
                to = self.child.get(node << 8 | byte)
                if to is None:
                    to = self.child[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                    self.longer.append(False)
                    self.depth.append(self.depth[node] + 1)
                node = to
            self.token_at[node] = token

    def _reset(self) -> None:
        for state in self.states.values():
            state.steps.clear()  # states refer to one another
        self.states.clear()
        self.start = self._state(((0, -1),))

    def _state(self, items: tuple) -> _State:
        state = self.states.get(items)
        if state is None:
            state = self.states[items] = _State(items)
        return state

    def merged(self, raw: bytes, least: int = 1) -> list[bytes]:
        """The merges applied one by one, lowest rank first, then leftmost,
        down to ``least`` parts."""
        parts = [raw[i:i + 1] for i in range(len(raw))]
        get = self.ranks.get
        while len(parts) > least:
            best, where = None, -1
            for i in range(len(parts) - 1):
                r = get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, where = r, i
            if best is None:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _spine(self, token: int) -> tuple[list, list]:
        """What stands at the token's left and at its right edge while its
        merges are applied, as (rank, bytes) from one byte to the whole; a
        token that its own merges don't give has no spine."""
        got = self._spines.get(token)
        if got is None:
            raw = self.bytes_of[token]
            if len(raw) == 1:
                got = [(token, raw)], [(token, raw)]
            else:
                left, right = self._parts(raw)
                if left is None:
                    got = [], []
                else:
                    got = ([*self._spine(self.ranks[left])[0], (token, raw)],
                           [*self._spine(self.ranks[right])[1], (token, raw)])
            self._spines[token] = got
        return got

    def _parts(self, raw: bytes) -> tuple[bytes | None, bytes | None]:
        """The two parts of a token's last merge."""
        parts = self.merged(raw, 2)
        whole = len(parts) == 2 and parts[0] + parts[1] in self.ranks
        return tuple(parts) if whole else (None, None)

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of the two tokens.  Merges run
        in order of rank; at each moment only the pair of edges could cross,
        and it does if it merges before either edge is merged inwards (of
        equal ranks the leftmost merges first)."""
        ok = self._pair.get(left << 24 | right)
        if ok is None:
            a, b = self._spine(left)[1], self._spine(right)[0]
            get, never = self.ranks.get, 1 << 60
            i = j = 0
            while True:
                inward_a = a[i + 1][0] if i + 1 < len(a) else never
                inward_b = b[j + 1][0] if j + 1 < len(b) else never
                crossing = get(a[i][1] + b[j][1], never)
                if crossing < inward_a and crossing <= inward_b:
                    ok = False
                    break
                if inward_a == inward_b == never:
                    ok = True
                    break
                if inward_a <= inward_b:
                    i += 1
                else:
                    j += 1
            self._pair[left << 24 | right] = ok
        return ok

    def _step(self, state: _State, byte: int) -> tuple[_State, int]:
        """Where ``byte`` leads, and the token that ends with it if the text
        were to end there."""
        closed, still = -1, []
        child, token_at, longer, pairs = self.child.get, self.token_at, self.longer, self._pair
        for node, last in state.items:
            grown = child(node << 8 | byte)
            if grown is None:
                continue
            token = token_at[grown]
            if closed < 0 and token >= 0:
                ok = last < 0 or pairs.get(last << 24 | token)
                if ok is None:
                    ok = self._neighbours(last, token)
                if ok:
                    closed = token
            if longer[grown]:
                still.append((grown, last))
        if closed < 0:
            raise ValueError(f"byte {byte:#04x} has no token of its own in the rank file")
        return self._state((*still, (0, closed))), closed

    def _back(self, ends: list[int], at: int, base: int) -> list[int]:
        """The tokens from ``base`` to ``at``, by the token that ends at each
        place."""
        out = []
        while at > base:
            token = ends[at - base - 1]
            out.append(token)
            at -= self.size[token]
        out.reverse()
        return out

    def stream(self, raw: Iterable[int]) -> Iterator[list[int]]:
        """Tokens as soon as they are certain: all that lies before a place
        where no longer token is open.  Such a place, or else one that all
        open places have passed through, is never further back than the
        longest token."""
        state, base, at, ends = self.start, 0, 0, []
        for byte in raw:
            got = state.steps.get(byte)
            if got is None:
                got = state.steps[byte] = self._step(state, byte)
            state, token = got
            ends.append(token)
            at += 1
            if len(state.items) == 1 or len(ends) >= BLOCK:
                sure = at if len(state.items) == 1 else self._shared(state, ends, at, base)
                if sure > base:
                    yield self._back(ends, sure, base)
                    ends, base = ends[sure - base:], sure
        yield self._back(ends, at, base)

    def _shared(self, state: _State, ends: list[int], at: int, base: int) -> int:
        """The last place that the tokens up to every open place pass."""
        shared = None
        for node, _ in state.items:
            spot = at - self.depth[node]
            passed = {spot}
            while spot > base:
                spot -= self.size[ends[spot - base - 1]]
                passed.add(spot)
            shared = passed if shared is None else shared & passed
        return max(shared)

    def encode(self, piece: bytes) -> list[int]:
        """All tokens of one match."""
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        if len(self.states) > self.max_states:
            self._reset()
        if len(self._pair) > 4 * self.max_states:
            self._pair.clear()
        if len(piece) > BLOCK:
            return [token for sent in self.stream(piece) for token in sent]
        state, ends = self.start, []
        for byte in piece:
            got = state.steps.get(byte)
            if got is None:
                got = state.steps[byte] = self._step(state, byte)
            state, token = got
            ends.append(token)
        return self._back(ends, len(ends), 0)


class Utf8Machine:
    """The UTF-8 state machine, stepped by whole tokens.

    State 0: between characters; 1-3: so many continuation bytes to come;
    4-7: the next byte has a narrower range (after E0, ED, F0, F4); -1: not
    UTF-8.  A token's effect on a state is worked out once."""

    #: state: (lowest next byte, highest, state after it)
    _NARROW = {4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}
    _LEAD = {0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 7}

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.steps: dict[int, int] = {}
        self.broken = {i for i, raw in bytes_of.items() if self.advance(0, raw)}

    def advance(self, state: int, chunk: bytes) -> int:
        for b in chunk:
            if state == 0:
                if b >= 0x80:
                    state = self._LEAD.get(b) or (1 if 0xC2 <= b <= 0xDF else 2 if 0xE1 <= b <= 0xEF
                                                  else 3 if 0xF1 <= b <= 0xF3 else -1)
            elif state in self._NARROW:
                lo, hi, after = self._NARROW[state]
                state = after if lo <= b <= hi else -1
            elif state > 0:
                state = state - 1 if 0x80 <= b <= 0xBF else -1
            if state < 0:
                return -1
        return state

    def decode(self, ids: list[int], state: int = 0) -> tuple[bytes, int]:
        """The bytes of ``ids`` and the state after them (0: no character is
        left open); raises on what is not UTF-8.  Steps are only taken where a
        token is not whole characters."""
        raw = b"".join([self.bytes_of[i] for i in ids])
        if state or not self.broken.isdisjoint(ids):
            steps = self.steps
            for i in ids:
                key = i * 8 + state
                state = steps.get(key)
                if state is None:
                    state = steps[key] = self.advance(key % 8, self.bytes_of[i])
                if state < 0:
                    raise ValueError(f"token {i} does not continue UTF-8")
        return raw, state


class Codec:
    """Splitter, transducer and decoder, with a bounded memory of matches (two
    generations: what is met again moves to the younger one).  With ``second`` a
    match is kept when it is met a second time, as most are met once: ``met`` has
    a byte for the hashes met in this generation."""

    def __init__(self, rank_blob: bytes, pattern: str, cache_pieces: int = CACHE_PIECES, max_states: int | None = None,
                 second: bool = False):
        self.pattern = piece_pattern(pattern)
        self.transducer = Transducer(read_ranks(rank_blob), max_states)
        self.machine = Utf8Machine(self.transducer.bytes_of)
        self.half = max(1, cache_pieces // 2)
        self.met = bytearray(1 << MET_BITS) if second else None
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.name_of = {i: str(i) for i in self.transducer.bytes_of}

    def _encoded(self, piece: str) -> list[int]:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.transducer.encode(piece.encode())
            if self.met is not None:
                spot = hash(piece) >> 3 & (1 << MET_BITS) - 1
                if not self.met[spot]:
                    self.met[spot] = 1
                    return ids
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
            if self.met is not None:
                self.met = bytearray(1 << MET_BITS)
        if len(piece) <= 256:
            self.young[piece] = ids
        return ids

    def blocks(self, text: str) -> Iterator[list[int]]:
        """The ids of ``text``, a block of splitter matches at a time."""
        found = (m.group() for m in self.pattern.finditer(text)) \
            if len(text) > 8 * BLOCK else iter(self.pattern.findall(text))
        while pieces := list(islice(found, BLOCK)):
            young = self.young.get
            yield list(chain.from_iterable([young(p) or self._encoded(p) for p in pieces]))

    def ids(self, text: str) -> list[int]:
        return [i for block in self.blocks(text) for i in block]

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids joined by commas, sha256 of the
        bytes decoded from those ids)."""
        n, state, name_of = 0, 0, self.name_of
        ids_sha, decoded_sha = hashlib.sha256(), hashlib.sha256()
        for ids in self.blocks(text):
            ids_sha.update((("," if n else "") + ",".join([name_of[i] for i in ids])).encode())
            raw, state = self.machine.decode(ids, state)
            decoded_sha.update(raw)
            n += len(ids)
        return n, ids_sha.hexdigest(), decoded_sha.hexdigest()


def encode_decode(docs: DataFrame, rank_file: str, pattern: str,
                  id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False, cache_pieces: int = CACHE_PIECES,
                  max_states: int | None = None, second: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]), one row per row.

    ``rank_file``: lines of base64 token and rank; read on the driver and sent
    to the executors (a vocabulary: a few MB whatever the corpus).  ``pattern``
    splits a text into the matches that are encoded apart.  ``with_ids`` adds
    the ids themselves.  A null text counts as empty (no ids; both digests are
    those of no bytes); a null id stays null; repeated rows give repeated rows;
    other columns are ignored.  ``cache_pieces`` and ``max_states`` bound the matches
    and states that a worker keeps; fewer take more time, the rows are the same.
    With ``second`` it keeps no match that it met only once.
    """
    with open(rank_file, "rb") as f:
        ranks = f.read()
    blob = docs.sparkSession.sparkContext.broadcast(ranks)
    name = f"codec {hashlib.sha256(ranks).hexdigest()} {pattern} {cache_pieces} {max_states} {second}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # states and matches met in one task serve the worker's next
        codec = kept(name, lambda: Codec(blob.value, pattern, cache_pieces, max_states, second))
        for part in slices(batches, max_bytes=1 << 20, keep=name):
            texts = texts_of(part)
            gc.disable()  # the memory of matches and states is large and holds no garbage
            try:
                n, ids_sha, decoded_sha = zip(*map(codec.digest, texts))
            finally:
                gc.enable()
            columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array([codec.ids(t) for t in texts], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return id_text(docs, id_col, text_col).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))
