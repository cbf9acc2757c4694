"""Sum-of-squares packing of documents into training windows.

Each task packs the rows of its own input split online: a document (or what is
left of it after whole windows are cut off) goes to the fill level whose choice
makes the sum of squared counts of partly filled windows smallest. ``counts[h]``
is the number of open windows filled to h. There is no shuffle: a split is read
in the same order again if its task is retried, so ids stay the same.

At most ``max_open`` windows are open: then a document goes to the best level that
has room for it, and where none has, it is cut to fill the emptiest window and its
rest is placed by the same rule. At the end of a split the emptiest windows fill the
gaps of the fullest ones and the last one is cut at powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pointloom.llm.shared import sliced, without_gc
from pointloom.llm.token_fields import FieldEncoder

#: Ids of a window, and the most windows a task keeps open (16 MB of ids).
WINDOW, MAX_OPEN = 1024, 4096
#: Sequence numbers of one split lie in a range of their own.
SPLIT_BITS = 36

Piece = tuple[object, int, bytes, int]  # document, ids before it, its ids, the document's ids in all


class SumOfSquares:
    """Online packer; ``closed`` holds finished windows as lists of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, np.int64)  # the last stays 0: full windows are closed
        self.levels: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.open = 0
        self.closed: list[list[Piece]] = []

    def add(self, doc, ids: bytes) -> None:
        n, w = len(ids) // 4, self.window
        full = n // w * w
        for start in range(0, full, w):
            self.closed.append([(doc, start, ids[4 * start : 4 * (start + w)], n)])
        if full < n:
            self.place((doc, full, ids[4 * full :], n), n - full)

    def place(self, piece: Piece, size: int) -> None:
        counts, w = self.counts, self.window
        # change of the sum of squares if a window at level h (1 .. w - size) takes the piece; a closed window leaves the sum
        change = 2 * (counts[1 + size : w + 1] - counts[1 : w - size + 1]) + 2
        change[-1] -= 1
        change[counts[1 : w - size + 1] == 0] = np.iinfo(np.int64).max
        h = int(change.argmin()) + 1
        if change[h - 1] <= 2 * counts[size] + 1 or (self.open >= self.max_open and change[h - 1] < np.iinfo(np.int64).max):
            held = self.taken(h)
        elif self.open >= self.max_open:  # no open window has room for all of it: the emptiest one takes what fits
            h = int(np.flatnonzero(counts)[0])
            doc, start, ids, n = piece
            self.put(self.taken(h), h, (doc, start, ids[: 4 * (w - h)], n), w - h)
            return self.place((doc, start + w - h, ids[4 * (w - h) :], n), size - (w - h))
        else:
            h, held = 0, []
        self.put(held, h, piece, size)

    def taken(self, h: int) -> list[Piece]:
        self.counts[h] -= 1
        self.open -= 1
        return self.levels[h].pop()

    def put(self, held: list[Piece], h: int, piece: Piece, size: int) -> None:
        held.append(piece)
        if h + size == self.window:
            self.closed.append(held)
            return
        self.levels[h + size].append(held)
        self.counts[h + size] += 1
        self.open += 1

    def finish(self) -> None:
        """Close all open windows without padding: the emptiest is poured into the gaps of the fullest until one is left, which is cut at powers of two."""
        w = self.window
        while self.open > 1:
            for doc, start, ids, n in self.taken(int(np.flatnonzero(self.counts)[0])):
                while ids:
                    h = int(np.flatnonzero(self.counts)[-1]) if self.open else 0
                    part = ids[: 4 * (w - h)]
                    self.put(self.taken(h) if h else [], h, (doc, start, part, n), len(part) // 4)
                    start, ids = start + len(part) // 4, ids[len(part) :]
        left = int(np.flatnonzero(self.counts)[0]) if self.open else 0
        now = self.taken(left) if left else []
        size = w // 2
        while left:
            if left < size:
                size //= 2
                continue
            out, need = [], size
            while need:
                doc, start, ids, n = now.pop(0)
                part = ids[: 4 * need]
                out.append((doc, start, part, n))
                if len(part) < len(ids):
                    now.insert(0, (doc, start + need, ids[4 * need :], n))
                need -= len(part) // 4
            self.closed.append(out)
            left -= size


_encoders: dict[str, FieldEncoder] = {}


def id_encoder(vocabulary: str, ranks: str, pattern: str) -> FieldEncoder:
    """Ids as ``tokenizers`` gives them for ``vocabulary``.

    Fields go to the same merges as rank file ``ranks``, which the faster library
    reads (a test holds both against each other). Strings of the vocabulary's
    added tokens stand for these tokens, as is that library's default.
    """
    import base64
    import json

    import tiktoken

    if vocabulary not in _encoders:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(vocabulary) as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        plain = tiktoken.Encoding("fields", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        fields = FieldEncoder(lambda chunk: np.array(plain(chunk), "<u4").tobytes())
        marks = {s: np.array([i], "<u4").tobytes() for s, i in added.items()}

        def encode(text: str) -> bytes:
            for mark, sent in marks.items():
                if mark in text:
                    return sent.join(encode(part) for part in text.split(mark))
            return fields(text)

        _encoders[vocabulary] = encode
    return _encoders[vocabulary]


def packed(
    docs: DataFrame, vocabulary: str, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    Every id of every document lies in one piece; pieces fill a sequence from
    offset 0 without gaps; sequences hold ``window`` ids or a power of two. A null
    or empty text is its closing id 0 alone. Null ids and repeated rows are
    packed like others; an empty table gives no rows; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_encoder(vocabulary, ranks, pattern)
        packer = SumOfSquares(window)
        sequence = TaskContext.get().partitionId() << SPLIT_BITS
        doc_type = None

        def out() -> pa.RecordBatch:
            nonlocal sequence
            cols: list[list] = [[] for _ in names]
            for held in packer.closed:
                at = 0
                for doc, start, ids, n in held:
                    size = len(ids) // 4
                    row = (doc, start, size, zlib.crc32(ids), n, sequence, at)
                    for c, v in zip(cols, row):
                        c.append(v)
                    if with_ids:
                        cols[-1].append(np.frombuffer(ids, "<u4").astype(np.int64))
                    at += size
                sequence += 1
            packer.closed = []
            arrays = [pa.array(cols[0], doc_type)] + [pa.array(c, pa.int64()) for c in cols[1:7]]
            if with_ids:
                arrays.append(pa.array(cols[7], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in sliced(batches):
            doc_type = batch.column(0).type
            with without_gc():  # kept fields hold no cycles
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    packer.add(doc, encode(text or "") + b"\0\0\0\0")
            yield out()
        packer.finish()
        if packer.closed:
            yield out()

    more = ", ids array<long>" if with_ids else ""
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long{more}"
    )
