"""Removing long repeats: every byte that a 100-byte string covers which also starts earlier.

1. Anchors. Of the 32-byte strings inside a 100-byte window the one of smallest
   hash is its anchor, and names it. Windows with one anchor are a chunk; equal
   windows have equal names wherever they stand. One row per chunk (about one in 35 bytes) is
   aggregated by name; only names that two different texts, or two chunks of a
   text, hold can belong to a repeat.
2. The windows of such chunks are compared: chunks with the same bytes are one
   class whose first place counts. Of what is left only chunks that share the
   anchor and 34 bytes on one of its sides with another can hold an equal window;
   they are dealt to shards by name. A shard builds the run-length index of its chunks:
   suffixes and match lengths sampled at the run ends of the Burrows-Wheeler transform.
   Matching statistics of all places are streamed from these samples in text order;
   stretches of matches of 100 bytes are the repeats, and the earliest place of each is kept.
3. A name with very many different chunks (a passage that a third of all documents
   quote) is no shard's: its windows are grouped by hash instead, which is exact
   as well and combines before the shuffle.

Copies of whole texts are told by digest and removed without any of this.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.shared import salted_join, sliced, text_bytes, written

#: Bytes of a match, and of the strings that name it.
MATCH, GRAM = 100, 32
SPAN = MATCH - GRAM + 1
#: Bytes on one side of an anchor that any window holds, on the left or on the right.
SIDE = SPAN // 2
#: Bytes hashed at a time, and of a part of a very long text; chunks of a shard, different chunks of one name beyond which windows are grouped by hash.
STEP, LONG, SHARD, MANY = 1 << 15, 1 << 22, 12_000, 4_000
#: Bits of a hash that give way to a place in the sliding minimum; parts are shorter than that.
_places = np.uint64((1 << 24) - 1)

_table = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_odd = [np.uint64(int(x)) for x in np.random.default_rng(8_675_309).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _odd[10]
    return h ^ (h >> np.uint64(29))


def anchors_of(data: np.ndarray, hashes: bool = False) -> tuple[np.ndarray, ...]:
    """Place of each window's anchor, hashes of all short strings, and on demand hashes of windows and of 34-byte strings.

    The anchor is the first of the smallest short strings of the window. So no
    two equal windows share an anchor's place.
    """
    h, width = _table[data], 1
    levels = {1: h}
    while width < (64 if hashes else GRAM):
        h = h[:-width] * _odd[width.bit_length()] + h[width:]
        width *= 2
        levels[width] = h
    grams = mixed(levels[GRAM])
    low = (grams & ~_places) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach < SPAN:
        step = min(reach, SPAN - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    if not hashes:
        return low & _places, grams
    n = len(data) - MATCH + 1
    whole = levels[64][:n] * _odd[11] + levels[32][64 : 64 + n] * _odd[12] + levels[4][96 : 96 + n]
    side = levels[32][: len(data) - SIDE + 1] * _odd[9] + levels[2][32:]
    return low & _places, grams, mixed(whole), side


def chunks_of(texts: list[bytes], hashes: bool = False):
    """(text, first window, windows, name[, digest, left, right]) arrays of all chunks of ``texts``: at most SPAN windows each.

    left and right hash the anchor with the SIDE bytes beside it, or are 0 where no
    window of the chunk holds these. A window holds one of both.
    """
    cols: list[list[np.ndarray]] = [[] for _ in range(7)]
    group: list[tuple[int, int, bytes]] = []

    def flush() -> None:
        if not group:
            return
        sizes = np.array([len(t) for _, _, t in group])
        anchor, grams, *more = anchors_of(np.frombuffer(b"".join([t for _, _, t in group]), np.uint8), hashes)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(group)), sizes)[: len(anchor)]
        at = np.flatnonzero(np.arange(len(anchor)) + MATCH <= ends[owner])
        place = anchor[at]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        run = np.diff(np.append(first, len(at)))
        spot = at[first]
        own = owner[spot]
        cols[0].append(np.array([k for k, _, _ in group])[own])
        cols[1].append(spot - (ends - sizes)[own] + np.array([b for _, b, _ in group])[own])
        cols[2].append(run)
        cols[3].append(grams[place[first].astype(np.int64)])
        if hashes:
            whole, side = more
            cols[4].append(mixed(whole[spot] * _odd[13] + whole[spot + run - 1] * _odd[14] + run.astype(np.uint64)))
            place, name = place[first].astype(np.int64), cols[3][-1]
            left, right = place - SIDE >= spot, place - SIDE <= spot + run - 1
            cols[5].append(np.where(left, mixed(side[np.maximum(place - SIDE, 0)] * _odd[12] + name) | np.uint64(1), np.uint64(0)))
            cols[6].append(np.where(right, mixed(side[np.minimum(place + GRAM, len(side) - 1)] * _odd[15] + name) | np.uint64(1), np.uint64(0)))
        group.clear()

    held = 0
    for k, t in enumerate(texts):
        for begin in range(0, max(1, len(t) - MATCH + 1), LONG):
            part = t[begin : begin + LONG + MATCH - 1]
            if len(part) >= MATCH:
                group.append((k, begin, part))
                held += len(part)
            if held >= STEP:
                flush()
                held = 0
    flush()
    kinds = [np.int64] * 3 + [np.uint64] * 4
    return [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(cols, kinds)]


def doubled(owner: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Which chunks repeat a name that their own text has in another chunk, as the count of those before."""
    order = np.lexsort((name, owner))
    o, n = owner[order], name[order]
    same = np.append(False, (o[1:] == o[:-1]) & (n[1:] == n[:-1]))
    out = np.zeros(len(owner), np.int64)
    out[order] = same
    return out


def suffix_order(data: np.ndarray, depth: int = 128) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffixes sorted by their first ``depth`` bytes, then by place, and their ranks by 1, 2, 4 ... bytes.

    Ranks of the first 8 bytes are the bytes themselves; only suffixes that still have equals are ranked further.
    """
    n = len(data)
    levels, key, width = [(1, data)], np.append(data, np.full(8, 0xFF, np.uint8)).astype(np.uint64), 1
    while width < 8:  # 0xFF stands behind the end; no UTF-8 holds it
        key = key[:-width] << np.uint64(8 * width) | key[width:]
        width *= 2
        levels.append((width, key[:n]))
    order = np.argsort(key[:n])
    own = key[:n][order]
    start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    size = np.diff(np.append(start, n))
    rank = np.empty(n, np.int32)  # where a suffix's group of equals begins in the order
    rank[order] = np.repeat(start, size)
    levels[-1] = (width, rank)
    tied = order[np.repeat(size > 1, size)]
    while width < depth:
        ahead = np.append(rank + 1, np.full(width, n + 1, np.int32))[tied + width]  # the end comes last, as 0xFF does
        pair = rank[tied].astype(np.int64) << 32 | ahead
        by = np.argsort(pair)
        tied, pair = tied[by], pair[by]
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(tied) else np.zeros(0, np.int64)
        group = np.flatnonzero(np.append(True, pair[1:] >> 32 != pair[:-1] >> 32)) if len(tied) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(tied)))
        base = np.repeat(group, np.diff(np.append(group, len(tied))))
        rank = rank.copy()
        rank[tied] += np.repeat(first, size) - base
        tied = tied[np.repeat(size > 1, size)]
        width *= 2
        levels.append((width, rank))
    order = np.empty(n, np.int64)
    alone = np.ones(n, bool)
    alone[tied] = False
    single = np.flatnonzero(alone)
    order[rank[single]] = single
    tied = tied[np.lexsort((tied, rank[tied]))]
    if len(tied):
        head = np.flatnonzero(np.append(True, rank[tied][1:] != rank[tied][:-1]))
        order[rank[tied] + np.arange(len(tied)) - np.repeat(head, np.diff(np.append(head, len(tied))))] = tied
    return order, levels


def agreement(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common bytes of suffixes a and b, by ranks of halving widths; most pairs part within 8 bytes."""
    n, out, todo = len(levels[0][1]), np.zeros(len(a), np.int64), np.arange(len(a))
    while len(todo):  # once more for those that agree in all of the widest rank
        x, y, got, whole = a[todo] + out[todo], b[todo] + out[todo], np.zeros(len(todo), np.int64), sum(w for w, _ in levels)
        for width, rank in reversed(levels):
            fits = (x < n) & (y < n)
            same = fits & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
            got += same * width
            x, y = x + same * width, y + same * width
        out[todo] += got
        todo = todo[got == whole]
    return out


class RunLengthIndex:
    """Bytes as their run-length Burrows-Wheeler transform tells them: one sample for each place where a run begins.

    The suffix before p in suffix order follows from the one before p - 1, one place
    on and agreeing one byte less, as long as both stand in one run of the transform.
    So only run ends are kept: text place, the suffix before it, and their common
    bytes. Everything else is streamed from these samples in text order. Memory grows
    with the runs: a text repeated a hundred times has hardly more than one.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        order, levels = suffix_order(data)
        before = np.full(n, -1, np.int64)
        before[order[1:]] = order[:-1]
        goes_on = np.zeros(n, bool)
        goes_on[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0) & (data[before[:-1]] == data[:-1])
        self.size = n
        self.place = np.flatnonzero(~goes_on)
        self.before = before[self.place]
        self.common = np.zeros(len(self.place), np.int64)
        some = np.flatnonzero(self.before >= 0)
        self.common[some] = agreement(levels, self.before[some], self.place[some])

    def streamed(self) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics in text order: of each place the suffix before it in suffix order (-1: none) and how many bytes they share."""
        gap = np.diff(np.append(self.place, self.size))
        back = np.arange(self.size) - np.repeat(self.place, gap)
        before = np.repeat(self.before, gap)
        return np.where(before >= 0, before + back, -1), np.maximum(np.repeat(self.common, gap) - back, 0)

    def intervals(self, least: int) -> np.ndarray:
        """For each text place a number that suffixes share exactly if they agree in ``least`` bytes: the place of the first of them in suffix order."""
        before, match = self.streamed()
        root = np.where(match >= least, before, np.arange(self.size))
        while True:
            ahead = root[root]
            if (ahead == root).all():
                return root
            root = ahead


def shard_repeats(group: pd.DataFrame) -> pd.DataFrame:
    """Stretches of windows of a shard's chunks that start earlier in the shard: (doc, tag, start, windows)."""
    group = group.sort_values(["doc", "start"], kind="stable")
    parts, counts = group["bytes"].tolist(), group["windows"].to_numpy()
    data = np.frombuffer(b"".join(parts), np.uint8)
    index = RunLengthIndex(data)
    interval = index.intervals(MATCH)
    sizes = np.array([len(p) for p in parts])
    base = np.cumsum(sizes) - sizes
    k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(base, counts) + k  # windows asked for, in corpus order
    number = interval[at]
    _, first = np.unique(number, return_index=True)
    again = np.ones(len(at), bool)
    again[first] = False
    owner = np.repeat(np.arange(len(parts)), counts)
    hit = np.flatnonzero(again)
    new = np.append(True, (np.diff(hit) != 1) | (owner[hit][1:] != owner[hit][:-1])) if len(hit) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    whose, where = owner[hit[head]], hit[head]
    return pd.DataFrame(
        {
            "doc": group["doc"].to_numpy()[whose], "tag": group["tag"].to_numpy()[whose], "start": group["start"].to_numpy()[whose] + k[where],
            "windows": np.diff(np.append(head, len(hit))).astype("int32"),
        }
    )


def removed_mask(size: int, starts: list[int], counts: list[int]) -> np.ndarray:
    """Bytes that windows cover."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, np.array(starts, np.int64), 1)
    np.add.at(edge, np.array(starts, np.int64) + np.array(counts, np.int64) + MATCH - 1, -1)
    return np.cumsum(edge)[:size] > 0


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def shared_names(docs: DataFrame) -> DataFrame:
    """(doc, names): of each document the names that another text, or another chunk of its own, has too."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            own, _, _, name, *_ = chunks_of([text_bytes(t) for t in batch.column(0).to_pylist()])
            th = np.array(batch.column(1).to_numpy(zero_copy_only=False))[own] + doubled(own, name)
            yield pa.RecordBatch.from_arrays([_signed(name), pa.array(th, pa.int64())], names=["name", "th"])

    def names_by_doc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            own, _, _, name, *_ = chunks_of([text_bytes(t) for t in batch.column(1).to_pylist()])
            fresh = doubled(own, name) == 0
            at = pa.array(own[fresh])
            yield pa.RecordBatch.from_arrays([_signed(name[fresh]), batch.column(0).take(at), batch.column(2).take(at)], names=["name", "doc", "tag"])

    held = docs.select("text", F.xxhash64("text").alias("th")).mapInArrow(names, "name long, th long").groupBy("name").agg(F.min("th").alias("a"), F.max("th").alias("b"))
    asked = docs.select("doc", "text", "tag").mapInArrow(names_by_doc, "name long, doc long, tag long").join(held.where("a <> b").select("name"), "name")
    return written(asked.groupBy("doc", "tag").agg(F.collect_list("name").alias("names")), "names")


def whole_copies(docs: DataFrame) -> DataFrame:
    """(doc, tag): whole texts that stand in a document of smaller id."""
    slim = docs.where(F.octet_length("text") >= MATCH).select("doc", "tag", F.md5(F.encode("text", "UTF-8")).alias("key"))
    firsts = slim.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low <> high").select("key", "low")
    return written(salted_join(slim, firsts, "key", "doc").where("doc <> low").groupBy("doc", "tag").agg(F.lit(True).alias("copy")), "copies")


def suspected_chunks(docs: DataFrame, names: DataFrame, copies: DataFrame) -> DataFrame:
    """Chunks of shared names, without bytes: (name, digest, left, right, doc, tag, start, windows)."""
    told = docs.join(names.join(copies, ["doc", "tag"], "left_anti"), ["doc", "tag"]).select("doc", "text", "names", "tag")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            docs_, texts, names_, tags = (batch.column(k) for k in range(4))
            data = [text_bytes(t) for t in texts.to_pylist()]
            own, start, run, name, digest, left, right = chunks_of(data, True)
            sizes = np.diff(names_.offsets.to_numpy())
            wanted = np.array(names_.values.to_numpy(zero_copy_only=False)[names_.offsets[0].as_py() : names_.offsets[-1].as_py()]).view(np.uint64)
            who = np.repeat(np.arange(len(sizes)), sizes)
            hit = np.isin(mixed(name + own.astype(np.uint64) * _odd[15]), mixed(wanted + who.astype(np.uint64) * _odd[15]))
            own, start, run, name, digest, left, right = (x[hit] for x in (own, start, run, name, digest, left, right))
            yield pa.RecordBatch.from_arrays(
                [_signed(name), _signed(digest), _signed(left), _signed(right), docs_.take(pa.array(own)), tags.take(pa.array(own)), pa.array(start, pa.int64()), pa.array(run, pa.int32())],
                names=["name", "digest", "left", "right", "doc", "tag", "start", "windows"],
            )

    return written(told.mapInArrow(chunks, "name long, digest long, left long, right long, doc long, tag long, start long, windows int"), "chunks")


PLACE = ("doc", "tag", "start", "windows")


def sorted_out(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks whose bytes stand earlier, and those to compare: different chunks that share an anchor and the bytes on one of its sides."""
    place = F.struct(*PLACE)
    classes = found.groupBy("name", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n"), F.first("left").alias("left"), F.first("right").alias("right"))
    classes = written(classes, "classes")
    many = classes.where("n > 1").select("name", "digest", F.col("first").alias("kept"))
    again = found.join(many, ["name", "digest"]).where((F.col("doc") != F.col("kept.doc")) | (F.col("start") != F.col("kept.start"))).select(*PLACE)
    again = written(again, "again")
    sides = classes.select("name", "first.*", F.explode(F.array("left", "right")).alias("side")).where("side <> 0")
    common = sides.groupBy("side").agg(F.count("*").alias("n")).where("n > 1").select("side")
    edges = sides.join(common, "side").groupBy(*PLACE).agg(F.first("name").alias("name"))
    return again, written(edges, "edges")


def with_bytes(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """``edges`` with the bytes of their windows."""
    listed = edges.groupBy("doc", "tag").agg(F.collect_list(F.struct("name", "start", "windows")).alias("chunks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in sliced(batches):
            rows: list[tuple] = []
            for doc, tag, text, chunks in zip(*(batch.column(k).to_pylist() for k in range(4))):
                data = text_bytes(text)
                rows += [(c["name"], doc, tag, c["start"], c["windows"], data[c["start"] : c["start"] + c["windows"] + MATCH - 1]) for c in chunks]
            cols = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["name", *PLACE, "bytes"])

    return docs.join(listed, ["doc", "tag"]).select("doc", "tag", "text", "chunks").mapInArrow(cut, "name long, doc long, tag long, start long, windows int, bytes binary")


def grouped_windows(chunks: DataFrame) -> DataFrame:
    """Windows of ``chunks`` that start earlier in another, by a grouped minimum over window hashes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            cols: tuple[list, ...] = ([], [], [], [])
            for doc, tag, start, n, data in zip(*(batch.column(k).to_pylist() for k in range(5))):
                cols[0].append(anchors_of(np.frombuffer(data, np.uint8), True)[2])
                cols[1].append(np.full(n, doc))
                cols[2].append(np.full(n, tag))
                cols[3].append(np.arange(start, start + n))
            if cols[0]:
                arrays = [_signed(np.concatenate(cols[0])), *(pa.array(np.concatenate(c), pa.int64()) for c in cols[1:])]
                yield pa.RecordBatch.from_arrays(arrays, names=["window", "doc", "tag", "start"])

    place = F.struct("doc", "start")
    single = chunks.select(*PLACE, "bytes").mapInArrow(windows, "window long, doc long, tag long, start long")
    low = single.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("window", "first")
    return single.join(low, "window").where(place != F.col("first")).select("doc", "tag", "start", F.lit(1).alias("windows"))


def compared(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """Stretches of windows of ``edges`` that start earlier in another of these."""
    forms = edges.groupBy("name").agg(F.count("*").alias("forms"))
    shards = max(1, -(-edges.count() // SHARD))
    chunks = with_bytes(docs, edges)
    popular = forms.where(F.col("forms") > MANY).select("name")
    few = chunks.join(popular, "name", "left_anti").withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
    few = few.groupBy("shard").applyInPandas(lambda g: shard_repeats(g.drop_duplicates(["doc", "tag", "start"])), "doc long, tag long, start long, windows int")
    return written(few.unionByName(grouped_windows(chunks.join(popular, "name", "left_semi"))), "stretches")


def repeat_windows(docs: DataFrame) -> DataFrame:
    """(doc, tag, lost, copy) for each text that loses bytes.

    ``docs`` has doc (long, not null), tag (long, tells apart texts of one id) and
    text (not null). lost: stretches of windows; copy: the whole text stands earlier.
    Each step is a table in the shared folder, and what the step shuffled is released.
    """

    copies, names = whole_copies(docs), shared_names(docs)
    again, edges = sorted_out(suspected_chunks(docs, names, copies))
    stretches = compared(docs, edges)
    lost = again.unionByName(stretches).groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "windows")).alias("lost"))
    return lost.join(copies, ["doc", "tag"], "full")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each row.

    A byte goes if a 100-byte string covers it that also starts in a row of
    smaller id, or earlier in the same row. A null text is empty; a null id counts
    as the smallest; rows repeated with one id stand at the same place, so they
    remove nothing from each other. An empty table gives no rows; other columns
    are not read.
    """
    rows = with_losses(docs.select(F.col(id_col).alias("id"), text_col), "id", text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            cols: tuple[list, ...] = ([], [], [], [])
            for text, lost, copy in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                data = text_bytes(text)
                gone = lost_bytes(data, lost, copy)
                kept = data if gone is None else np.frombuffer(data, np.uint8)[~gone].tobytes()
                cols[0].append(len(data))
                cols[1].append(len(data) - len(kept))
                cols[2].append(0 if gone is None else int((np.diff(np.append(0, gone.astype(np.int8))) == 1).sum()))
                cols[3].append(hashlib.sha256(kept).hexdigest())
            arrays = [batch.column(0)] + [pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.select("row.id", F.col("row").getField(text_col), "lost", "copy").toDF("id", "text", "lost", "copy").mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the remaining bytes as text.

    As ``deduplicated``; characters that lost a part of their bytes go whole. Null
    texts stay null; texts that lose all bytes become empty.
    """
    rows = with_losses(docs, id_col, text_col)
    place, names = docs.columns.index(text_col), docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            cols = list(batch.columns)
            copy, lost = cols.pop(), cols.pop()
            texts = cols[place].to_pylist()
            for k, (text, spots, whole) in enumerate(zip(texts, lost.to_pylist(), copy.to_pylist())):
                gone = lost_bytes(data := text_bytes(text), spots, whole)
                if gone is not None:
                    texts[k] = np.frombuffer(data, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
            cols[place] = pa.array(texts, cols[place].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    plain = [f"c{k}" for k in range(len(docs.columns) + 2)]  # the columns' own names may clash with others
    return rows.select("row.*", "lost", "copy").toDF(*plain).mapInArrow(cut, docs.schema)


def with_losses(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc, tag, lost, copy): each row of ``docs`` as one struct, whatever its columns are called, with what it loses."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc")
    tag = F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 15), 16, 10).cast("long").alias("tag")
    lost = repeat_windows(docs.select(doc, tag, text.alias("text")))
    return docs.select(F.struct(*docs.columns).alias("row"), doc, tag).join(lost, ["doc", "tag"], "left")


def lost_bytes(data: bytes, lost: list | None, copy: bool | None) -> np.ndarray | None:
    """Which bytes of a text go; None for none."""
    if copy:
        return np.ones(len(data), bool)
    return removed_mask(len(data), [x["start"] for x in lost], [x["windows"] for x in lost]) if lost else None
