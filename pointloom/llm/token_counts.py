"""Token counts by overlap resynchronisation.

Texts up to a chunk's length go to the library as they are. A longer one is
encoded in overlapping chunks whose tokens carry character offsets; neighbours
are spliced at a boundary that is proven stable, and where the overlap holds
none it is widened, up to the rest of the text.

Proof of a boundary. Of byte-pair merges by priority, a token sequence is the
encoding of its text exactly if every two neighbours are the encoding of their
own joined text. (a) No piece of the vocabulary holds a space mark after another
character, so no merge crosses the start of a word: such a boundary is stable
alone. (b) Where both encodings hold the same two tokens next to each other, the
left tokens up to the first and the right ones from the second on have only
neighbours that were neighbours in a right encoding, so the splice is right too.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from pointloom.llm.shared import map_batches

#: Characters of a chunk, and of the first overlap.
CHUNK, OVERLAP = 32_768, 256
MARK = "▁"


class PieceCounter:
    """Counts of whole texts by a sentencepiece model, in chunks beyond ``chunk`` characters."""

    def __init__(self, model_file: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.chunk, self.overlap = chunk, overlap
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.word_starts = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.byte = [self.sp.is_byte(i) for i in range(len(pieces))]
        self.chars = [len(p) for p in pieces]
        self.unknown = self.sp.unk_id()
        self.widened = 0

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return len(self.sp.encode(text)) if len(text) <= self.chunk else self.spliced(text)

    def counts(self, texts: list[str]) -> list[int]:
        """As ``count``; short texts go to the library together."""
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        out = [0] * len(texts)
        for i, ids in zip(short, self.sp.encode([texts[i] for i in short], num_threads=1)):
            out[i] = len(ids)
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                out[i] = self.spliced(t)
        return out

    def offsets(self, text: str, at: int) -> list[tuple[int, int, int]]:
        """(start, end, id) of each token in characters of the whole text; ``at`` is the chunk's start there.

        The library sets a space mark before the first character, so the first token starts one character early.
        Bytes of one character share its end.
        """
        out, here, left = [], at - 1, 0
        ids = self.sp.encode(text)
        for k, i in enumerate(ids):
            if self.byte[i]:
                first = int(self.sp.id_to_piece(i)[3:5], 16)
                if left == 0:
                    left = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                left -= 1
                out.append((here, here + (left == 0), i))
                here += left == 0
            else:
                n = self.chars[i] if i != self.unknown else 1
                out.append((here, here + n, i))
                here += n
        return out

    def splice(self, text: str, left: list, right: list, at: int) -> tuple[int, int] | None:
        """Indexes where ``left`` ends and ``right`` goes on, at a boundary proven in both, or None."""
        where = {t[0]: k for k, t in enumerate(right) if t[0] > at}
        for k in range(len(left) - 2, 0, -1):
            start = left[k][0]
            j = where.get(start)
            if j is None or start >= left[-1][0]:
                continue
            if self.word_starts and text[start] in (" ", MARK) and text[start - 1] not in (" ", MARK):
                return k, j
            if j and left[k - 1] == right[j - 1] and left[k] == right[j] and not self.byte[left[k][2]] and not self.byte[left[k - 1][2]]:
                return k, j
        return None

    def spliced(self, text: str) -> int:
        total, begin, end = 0, 0, min(self.chunk, len(text))
        left = self.offsets(text[begin:end], begin)
        while end < len(text):
            overlap = self.overlap
            while True:
                at = max(0, end - overlap)
                to = min(len(text), max(at + self.chunk, end + overlap))
                right = self.offsets(text[at:to], at)
                cut = self.splice(text, left, right, at)
                if cut:
                    total += cut[0]
                    left = right[cut[1] :]
                    break
                self.widened += 1
                overlap *= 2
                if at <= begin:  # no boundary in all of the chunk: encode it together with what follows
                    at = begin
                    to = min(len(text), end + max(self.chunk, overlap))
                    right = self.offsets(text[at:to], at)
                    left = right if begin == 0 else self.rejoined(text, left, right)
                    at = begin
                    break
            begin, end = at, to
        return total + len(left)

    def rejoined(self, text: str, left: list, right: list) -> list:
        """``right`` encodes all of ``left``'s chunk and more: its tokens from the first proven boundary, with ``left``'s before that."""
        spots = {t[0]: k for k, t in enumerate(left)}
        for j in range(1, len(right)):
            k = spots.get(right[j][0])
            if k and left[k] == right[j] and left[k - 1] == right[j - 1]:
                return left[:k] + right[j:]
        raise ValueError("no stable boundary between two chunks")


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, chunk: int = CHUNK) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row, from whole texts; one scan, no shuffle.

    A null text counts as empty: 0 bytes, 0 tokens. Null ids and repeated rows
    are kept, one result each; an empty table gives an empty result; other
    columns are not read.
    """

    def make():
        counter = PieceCounter(model_file, chunk)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = counter.counts(texts)
            size = [len(t.encode()) for t in texts]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
