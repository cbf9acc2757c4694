"""Spelling variants by dynamic programming over sorted word lists.

Words that one edit parts share the first or the last half of the shorter one.
So each word goes to four lists: by either half, as the shorter word and as the
longer one. In a list the words stand sorted. A word is held against the list in
one scan that keeps its edit matrix within a band of one: the rows of the prefix
shared with the word before are used again, and where no entry of a row is within
one edit, the whole range of words with that prefix is skipped. Pairs never
become rows: a list sends how many near words a word has there, and the best.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.blocks import group_bounds, in_block_pairs, whole_groups
from pointloom.llm.shared import removed, shared_path, sliced, written, written_at

#: Characters of a text that are taken apart at once, and different words that a task counts before it sends them on.
PART, HELD = 1 << 20, 200_000
#: Words of a list that one task compares with as many others.
BLOCK = 4096
#: Words of more characters are held against their list one by one.
LONG = 64
RUN = "[A-Za-zÀ-ÿ]+"
LAST = chr(0x10FFFF)
_run = re.compile(RUN)
_lower = {c: c + 32 for c in range(65, 91)}


def parts_of(text: str, size: int = PART) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, none cut inside a run."""
    at = 0
    while at < len(text):
        end = at + size
        cut = _run.match(text, end) if end < len(text) else None
        end = cut.end() if cut and _run.match(text, end - 1) else end
        yield text[at:end]
        at = end


def count_words(held: dict[str, int], doc: object, text: str | None, shortest: int = 6, every: int = 199) -> None:
    """Adds a text's words to ``held``: lower-cased runs, where ``every`` divides the run's number in this document without one character."""
    runs: Counter = Counter()
    for part in parts_of(text or ""):
        runs.update(_run.findall(part))
    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
    for run, n in runs.items():
        if len(run) < shortest:
            continue
        low = run.lower() if run.isascii() else run.translate(_lower)
        h = zlib.crc32(low.encode(), start)
        if h % every == 0:
            at = h % len(low)
            low = low[:at] + low[at + 1 :]
            if len(low) < shortest:
                continue
        held[low] = held.get(low, 0) + n


def vocabulary(docs: DataFrame, least: int = 5, shortest: int = 6, every: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least ``shortest`` code points that occur ``least`` times or more in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for part in sliced(iter([batch])):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    count_words(held, doc, text, shortest, every)
                    if len(held) > HELD:
                        yield sent()
        yield sent()

    counted = docs.select(id_col, text_col).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def prefix(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


class SortedList:
    """Words in code-point order, scanned for those within one edit of other words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.shared = [0] + [prefix(a, b) for a, b in zip(words, words[1:])]

    def after(self, at: int, depth: int) -> int:
        """The first place behind ``at`` whose word has another prefix of ``depth`` characters."""
        if at + 1 < len(self.words) and self.shared[at + 1] < depth:
            return at + 1
        return bisect_left(self.words, self.words[at][:depth] + LAST, at + 1)

    def near(self, asked: str) -> Iterator[int]:
        """Places of the words that exactly one edit parts from ``asked``.

        Row k of the matrix holds the edits from ``asked``'s first k - 1, k and k + 1
        characters to the word's first k; entries beyond the ends count as 2.
        """
        words, shared, n = self.words, self.shared, len(asked)
        low, same, high = [2] * (n + 2), [2] * (n + 2), [2] * (n + 2)
        same[0], high[0] = 0, 1
        at = known = 0
        while at < len(words):
            word = words[at]
            known, dead = min(known, shared[at]), 0
            for k in range(known + 1, min(len(word), n + 1) + 1):
                c = word[k - 1]
                a, b, d = low[k - 1], same[k - 1], high[k - 1]
                x = min(a + (k < 2 or asked[k - 2] != c), b + 1)
                y = min(b + (asked[k - 1] != c), d + 1, x + 1) if k <= n else 2
                z = min(d + (asked[k] != c), y + 1) if k < n else 2
                low[k], same[k], high[k] = x, y, z
                if x > 1 and y > 1 and z > 1:
                    dead = k
                    break
                known = k
            if not dead and len(word) > n + 1:
                dead = n + 2  # this word and those that go on from it are too long
            if dead:
                behind = self.after(at, dead)
                if behind < len(words) and behind > at + 1:
                    known = min(known, prefix(word, words[behind]))
                at = behind
                continue
            gap = len(word) - n
            if -1 <= gap <= 1 and (low, same, high)[1 - gap][len(word)] == 1:
                yield at
            at += 1


def coded(words: list[str], wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points (``wide`` x words, zeros behind a word's end) and lengths."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.int32)
    codes = np.zeros((wide, len(words)), np.int32)
    codes[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(np.arange(len(words)), sizes)] = flat
    return codes, sizes


class SortedLists:
    """Many lists at once: ``words`` sorted within their list, ``lists`` numbers them in rising order.

    Words of a list with one prefix are a range of rows. All words asked for go
    through the ranges together, a character a step: the band of a range is computed
    once from that of its prefix, and ranges beyond one edit are left out.
    """

    def __init__(self, words: list[str], lists: np.ndarray):
        self.wide = max(map(len, words)) + 3
        self.codes, self.sizes = coded(words, self.wide)
        shared = np.append(-1, np.logical_and.accumulate((self.codes[:, 1:] == self.codes[:, :-1]) & (self.codes[:, 1:] > 0)).sum(axis=0))
        shared[1:][lists[1:] != lists[:-1]] = -1
        self.lists = lists[shared < 0]
        # ranges[k]: first rows of the ranges with one prefix of k characters; inner[k]: where those of k + 1 begin for each
        self.ranges = [np.flatnonzero(shared < k) for k in range(self.wide)]
        self.inner = [np.append(np.searchsorted(b, a), len(b)) for a, b in zip(self.ranges, self.ranges[1:])]

    def near(self, asked: list[str], lists: np.ndarray, step: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in ``asked``, rows) of all pairs of one list that exactly one edit parts."""
        codes, sizes = coded(asked, max(self.wide, max(map(len, asked)) + 3))
        codes[codes == 0] = -1  # the end of a word matches no other's
        root = np.minimum(np.searchsorted(self.lists, lists), len(self.lists) - 1)
        for begin in range(0, len(asked), step):
            who = np.arange(begin, min(begin + step, len(asked)))
            who = who[self.lists[root[who]] == lists[who]]
            at, same = root[who], np.zeros(len(who), np.int8)
            low, high = same + 2, same + 1
            for k in range(self.wide - 1):
                if not len(who):
                    break
                row, gap = self.ranges[k][at], k - sizes[who]
                hit = self.sizes[row] == k
                hit &= ((gap == 1) & (low == 1)) | ((gap == 0) & (same == 1)) | ((gap == -1) & (high == 1))
                yield who[hit], row[hit]
                first, n = self.inner[k][at], self.inner[k][at + 1] - self.inner[k][at]
                old = np.repeat(np.arange(len(who)), n)
                at = np.arange(len(old)) + np.repeat(first - np.cumsum(n) + n, n)
                c = self.codes[k, self.ranges[k + 1][at]]
                who, a, b, d = who[old], low[old], same[old], high[old]
                low = np.minimum(a + (codes[k - 1, who] != c), b + 1) if k else b + 1
                same = np.minimum(np.minimum(b + (codes[k, who] != c), d + 1), low + 1)
                high = np.minimum(d + (codes[k + 1, who] != c), same + 1)
                live = np.flatnonzero((np.minimum(np.minimum(low, same), high) < 2) & (c > 0))
                at, who, low, same, high = at[live], who[live], low[live], same[live], high[live]


def listed(words: DataFrame) -> DataFrame:
    """Each word under its four lists: (list, word, n); the list's hash names side, length of the shorter word and half."""
    size, c = F.length("word"), F.col("size")
    half = F.floor(c / 2).cast("int")
    sized = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("size")).where("size > 0")
    sided = sized.select("word", "n", "size", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    piece = F.when(F.col("side") == 0, F.substring("word", F.lit(1), half)).otherwise(F.substring("word", F.length("word") - half + 1, half))
    return sided.select(F.xxhash64("side", "size", piece).alias("list"), "size", "side", "word", "n")


#: Columns that name a list and the two of its blocks that are compared.
GROUP = ["list", "size", "side", "first", "second"]


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list (or two of its blocks): (word, near, best_n, best) of words with near words there."""
    none = np.zeros(0, np.int64)
    for keys, batch in whole_groups(batches, len(GROUP)):
        start, size = group_bounds(keys)
        group = np.repeat(np.arange(len(start)), size)
        blocks, words, counts = batch.column(5).to_numpy(), np.array(batch.column(6).to_pylist(), object), batch.column(7).to_numpy()
        met = [(none, none)]
        left, right = (np.flatnonzero((blocks == keys[:, k]) & (keys[:, 1] <= LONG)) for k in (3, 4))
        if len(left) and len(right):
            for i, j in SortedLists(list(words[right]), group[right]).near(list(words[left]), group[left]):
                met.append((left[i], right[j]))
        for g in np.flatnonzero(keys[start, 1] > LONG).tolist():
            rows = np.arange(start[g], start[g] + size[g])
            right = rows[blocks[rows] == keys[rows[0], 4]]
            scanned = SortedList(list(words[right]))
            for i in rows[blocks[rows] == keys[rows[0], 3]].tolist():
                j = right[list(scanned.near(words[i]))]
                met.append((np.full(len(j), i), j))
        i, j = (np.concatenate(x) for x in zip(*met))
        own = (keys[i, 3] != keys[i, 4]) | (i < j)  # each pair of a block once
        i, j = i[own], j[own]
        long = np.array([len(w) for w in words], np.int64)
        mine = np.minimum(long[i], long[j]) == keys[i, 1]
        ends = np.flatnonzero(mine & (keys[i, 2] == 1))  # the list of the first half answers for pairs that share both
        mine[ends] = [a[: h // 2] != b[: h // 2] for a, b, h in zip(words[i[ends]], words[j[ends]], keys[i[ends], 1].tolist())]
        i, j = i[mine], j[mine]
        x, y = np.append(i, j), np.append(j, i)
        order = np.lexsort((words_rank(words)[y], -counts[y], x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])
        columns = (pa.array(words[x[first]], pa.string()), pa.array(np.diff(np.append(first, len(x)))), pa.array(counts[y[first]]), pa.array(words[y[first]], pa.string()))
        yield pa.RecordBatch.from_arrays(list(columns), names=["word", "near", "best_n", "best"])


def words_rank(words: np.ndarray) -> np.ndarray:
    """Places of words in code-point order."""
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(words, kind="stable")] = np.arange(len(words))
    return rank


def near_words(words: DataFrame, rows: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best): near words of each word that has any, and the most frequent one, the smallest of equals."""
    met = in_block_pairs(listed(words), ["list", "size", "side"], ["word"], rows).select(*GROUP, "block", "word", "n")
    dealt = met.repartition(*GROUP).sortWithinPartitions(*GROUP, "word")
    found = dealt.mapInArrow(compared, "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("neg"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.neg")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word of (word, form), following forms to their end by doubling the step.

    A form is several times as frequent as its word, so there are no circles.
    """
    spark, path = forms.sparkSession, shared_path(forms.sparkSession, "forms")
    reached = written_at(forms.select("word", F.col("form").alias("root")), path)
    while True:
        step = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        before, path = path, shared_path(spark, "forms")
        reached = written_at(reached.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), path)
        moved = not reached.where("moved").isEmpty()
        removed(spark, before)
        reached = reached.drop("moved")
        if not moved:
            return reached


def variants(docs: DataFrame, least: int = 5, shortest: int = 6, every: int = 199, times: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each frequent word.

    A word's form is its near word (one inserted, deleted or replaced code point) of
    largest count, the smallest of equals, if that count is ``times`` the word's or
    more. Null texts hold no words; a null id counts as an empty one in the number
    that alters a run. Rows with one id are texts of their own, each counted in full.
    Texts of any length are taken in parts. An empty table gives no rows; other
    columns are not read.
    """
    words = written(vocabulary(docs, least, shortest, every, id_col, text_col), "words")
    near = written(near_words(words), "near-words")
    both = words.join(near, "word", "left").withColumn("good", F.coalesce(F.col("best_n") >= F.lit(times) * F.col("n"), F.lit(False)))
    both = both.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("good"), F.col("best")).alias("form"), F.when(F.col("good"), F.col("best_n")).alias("form_n"))
    ends = roots(both.where("form is not null").select("word", "form"))
    return both.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
