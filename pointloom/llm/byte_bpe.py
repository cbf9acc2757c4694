"""Byte-level BPE as a lazily determinised transducer, and its streaming decoder.

A state is (token sent last, bytes not yet sent). Reading a byte extends, for
every prefix of those bytes, the one token that ends the prefix's encoding; that
token is the longest vocabulary suffix that the token before it accepts as its
neighbour. Prefixes that a longer token could still start from stay alive; what
all live prefixes begin with is sent. States and arcs are built when first read
and kept. The wait is bounded: no live prefix lies further back than the longest
token.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pointloom.llm.shared import map_batches
from pointloom.llm.token_fields import KEEP_CHARS, FieldEncoder

#: Arcs, matches and neighbour tests that one worker keeps.
KEEP_ARCS, KEEP_PAIRS, KEEP_MATCHES = 400_000, 400_000, 100_000
START = -1


class State(dict):
    """Arcs by byte: (next state, tokens sent), built when first read.

    ``paths``: the tokens from the last sent one to each live prefix of ``rest``,
    by length, and to all of it at the end. Most states are met once, so a state
    keeps no arc before its second miss.
    """

    __slots__ = ("machine", "sent", "rest", "paths", "met")

    def __init__(self, machine: MergeTransducer, sent: int, rest: bytes, paths: tuple):
        self.machine, self.sent, self.rest, self.paths, self.met = machine, sent, rest, paths, False

    def __missing__(self, byte: int) -> tuple[State, tuple[int, ...]]:
        keep = self.met
        got = self.machine.arc(self, byte, keep)
        if keep:
            self[byte] = got
        else:
            self.met = True
        return got


class MergeTransducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.piece = {i: b for b, i in ranks.items()}
        longer = set()
        for b in ranks:
            for k in range(1, len(b)):
                longer.add(b[:k])
        self.longer = longer  # bytes that some token begins with and goes beyond
        self.longest = max(map(len, ranks))
        self.shapes: dict[bytes, tuple] = {}
        self.byte = [bytes((b,)) for b in range(256)]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states: dict[tuple[int, bytes], State] = {}
        self.clear()

    def clear(self) -> None:
        for state in self.states.values():
            state.clear()  # arcs lead in circles, which would keep them all
        self.kept, self.states = 0, {}
        self.start = self.state(START, b"", ((),), True)

    def state(self, sent: int, rest: bytes, paths: tuple, keep: bool) -> State:
        key = (sent, rest)
        got = self.states.get(key)
        if got is None:
            got = State(self, sent, rest, paths)
            if keep:
                self.states[key] = got
        return got

    def live(self, rest: bytes) -> list[int]:
        return [j for j in range(len(rest)) if rest[j:] in self.longer]

    def shape(self, rest: bytes) -> tuple:
        """For the bytes alone: (index of the path before, token) for each token that ends them, longest first, and indexes of paths that stay alive."""
        n = len(rest)
        index = {j: k for k, j in enumerate(self.live(rest[:-1]))}
        index[n - 1] = len(index)
        ends = tuple((index[j], self.ranks[rest[j:]]) for j in range(n) if j in index and rest[j:] in self.ranks)
        if not ends:
            raise ValueError("the vocabulary lacks a byte")
        if len(self.shapes) > KEEP_ARCS:
            self.shapes.clear()
        got = self.shapes[rest] = ends, tuple(index[j] for j in self.live(rest))
        return got

    def merged(self, text: bytes) -> list[int]:
        """Merges by rank, the plain way: for two joined tokens only."""
        parts = [text[i : i + 1] for i in range(len(text))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def accepts(self, a: int, b: int) -> bool:
        if len(self.pairs) > KEEP_PAIRS:
            self.pairs.clear()
        got = self.pairs[a, b] = a == START or self.merged(self.piece[a] + self.piece[b]) == [a, b]
        return got

    def arc(self, state: State, byte: int, keep: bool) -> tuple[State, tuple[int, ...]]:
        self.kept += keep
        sent, paths = state.sent, state.paths
        rest = state.rest + self.byte[byte]
        ends, alive = self.shapes.get(rest) or self.shape(rest)
        for k, token in ends:
            before = paths[k]
            last = before[-1] if before else sent
            fits = self.pairs.get((last, token))
            if self.accepts(last, token) if fits is None else fits:
                path = (*before, token)
                break
        else:
            raise ValueError("no token fits")
        if not alive:
            return self.state(token, b"", ((),), keep), path
        kept = [paths[k] for k in alive]
        same = 0
        for token in path:
            for p in kept:
                if len(p) <= same or p[same] != token:
                    break
            else:
                same += 1
                continue
            break
        kept.append(path)
        if not same:
            return self.state(sent, rest, tuple(kept), keep), ()
        out = path[:same]
        drop = sum([len(self.piece[t]) for t in out])
        return self.state(out[-1], rest[drop:], tuple([p[same:] for p in kept]), keep), out

    def tokens(self, text: bytes) -> list[int]:
        if self.kept > KEEP_ARCS:
            self.clear()
        state, out = self.start, []
        for byte in text:
            state, sent = state[byte]
            if sent:
                out += sent
        out += state.paths[-1]
        return out


class Utf8Machine:
    """Incremental UTF-8: bytes still due for the character at hand, and the range of the next."""

    def __init__(self):
        self.due, self.low, self.high = 0, 0x80, 0xBF

    def feed(self, data: bytes) -> bool:
        """False if the bytes so far can't be UTF-8; a character may stay open."""
        for b in data:
            if self.due:
                if not self.low <= b <= self.high:
                    return False
                self.due, self.low, self.high = self.due - 1, 0x80, 0xBF
            elif b < 0x80:
                continue
            elif 0xC2 <= b <= 0xDF:
                self.due = 1
            elif 0xE0 <= b <= 0xEF:
                self.due, self.low, self.high = 2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
            elif 0xF0 <= b <= 0xF4:
                self.due, self.low, self.high = 3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
            else:
                return False
        return True


class StreamDecoder:
    """Bytes of token ids; characters that tokens cut are followed by the machine, whole ones need no step."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.piece: list[bytes] = [b""] * size
        self.whole = np.zeros(size, bool)
        for b, i in ranks.items():
            self.piece[i] = b
            machine = Utf8Machine()
            self.whole[i] = machine.feed(b) and not machine.due

    def decode(self, ids: np.ndarray) -> tuple[bytes, bool]:
        """The bytes, and whether they are UTF-8."""
        data = b"".join(map(self.piece.__getitem__, ids.tolist()))
        fine, machine = True, Utf8Machine()
        last = -2
        for k in np.flatnonzero(~self.whole[ids]).tolist():
            if fine and k != last + 1 and machine.due:
                fine = False  # a whole token stands inside an open character
            fine = fine and machine.feed(self.piece[ids[k]])
            last = k
        return data, fine and not machine.due


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class ByteBpe:
    """Whole texts to ids: pattern matches through the transducer, fields remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.machine = MergeTransducer(ranks)
        self.known: dict[str, bytes] = {}
        self.encode = FieldEncoder(self.chunk)

    def chunk(self, text: str) -> bytes:
        """Ids of a field after its space, or of what white space joins."""
        if text[0] == " " and text[1:].isalpha():
            return self.coded(text)  # one match, which the fields remember
        if len(self.known) > KEEP_MATCHES:
            self.known.clear()
        return b"".join(map(self.match, self.find(text)))

    def coded(self, m: str) -> bytes:
        return array("I", self.machine.tokens(m.encode())).tobytes()

    def match(self, m: str) -> bytes:
        if m[0] == " " and m[1:].isalpha():
            return self.encode.word(m[1:])
        got = self.known.get(m)
        if got is None:
            got = self.coded(m)
            if len(m) <= KEEP_CHARS:
                self.known[m] = got
        return got


_kept: dict[tuple, tuple[ByteBpe, StreamDecoder]] = {}


def codec(path: str, pattern: str) -> tuple[ByteBpe, StreamDecoder]:
    """One per worker process, for all its tasks."""
    if (path, pattern) not in _kept:
        ranks = load_ranks(path)
        _kept[path, pattern] = ByteBpe(ranks, pattern), StreamDecoder(ranks)
    return _kept[path, pattern]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, is_utf8[, ids]) of each row: encoded, then decoded again.

    A null text is empty: no ids. Null ids and repeated rows give one result
    each; an empty table an empty one; other columns are not read.
    """

    def make():
        bpe, decoder = codec(ranks_path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, coded, decoded, fine, kept = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                raw = bpe.encode(text or "")
                ids = np.frombuffer(raw, "<u4")
                data, ok = decoder.decode(ids)
                n.append(len(ids))
                coded.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(data).hexdigest())
                fine.append(ok)
                if with_ids:
                    kept.append(ids.astype(np.int64))
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string()), pa.array(fine, pa.bool_())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "is_utf8"]
            if with_ids:
                cols.append(pa.array(kept, pa.list_(pa.int64())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(cols, names=names)

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    more = ", ids array<long>" if with_ids else ""
    return map_batches(
        docs.select(id_col, text_col), make, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, is_utf8 boolean{more}", collect=False
    )
