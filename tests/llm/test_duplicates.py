"""SimHash, repeats and embedding duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from pointloom.llm import pivots, repeats, simhash
from pointloom.llm.shared import components

SCHEMA = "doc_id bigint, text string, fp string, lost string, name string"


def union(pairs, nodes):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def corpus(seed=7, n=70):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(1, 7))) for _ in range(60)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(40))
    out = ["", None, "  \n ", "ab " * 200, "z" * 400, "One Two THREE", "one two three", passage]
    for k in range(n):
        t = " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 90)))
        if k % 4 == 0:
            t = t[: len(t) // 2] + " " + passage + t[len(t) // 2 :]
        out.append(t)
        if k % 5 == 0:
            out.append(t)
            w = t.split(" ")
            w[len(w) // 2] = "changed"
            out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "a", "b", "c") for k, t in enumerate(corpus())]
    return spark.createDataFrame(rows, SCHEMA)


def plain_print(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    s = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("rows", [1024, 3])
def test_simhash_components(spark, docs, rows, monkeypatch):
    import pointloom.llm.blocks as blocks

    monkeypatch.setattr(blocks.in_block_pairs, "__defaults__", (rows,))
    monkeypatch.setattr(simhash, "SMALL", 2 if rows == 3 else 64)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs, distance=4).collect()}
    prints = {r.doc_id: plain_print(r.text) for r in docs.collect()}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = union(pairs, prints)
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {d: r.component_id for d, r in got.items()} == want


def test_pigeonhole_lists_meet_all_close_pairs():
    masks, rnd = simhash.block_lists(4, 6, 2), random.Random(1)
    for _ in range(500):
        a = rnd.getrandbits(64)
        b = a
        for k in rnd.sample(range(64), 4):
            b ^= 1 << k
        assert any(a & m == b & m for m in masks)


def test_one_bucket_of_many_fingerprints(spark):
    rnd = random.Random(6)
    base = 0x0123456789ABCDEF
    prints = {base & 0xFFFFFFFFFFE00000 | rnd.getrandbits(21) for _ in range(20_000)}  # blocks 2 to 5 agree
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()
    x = np.array(sorted(prints), np.uint64)
    y = x.view(np.int64).tolist()
    pairs = [(y[k + i], y[j]) for k in range(0, len(x), 500) for i, j in zip(*(c.tolist() for c in np.nonzero(np.bitwise_count(x[k : k + 500, None] ^ x[None, :]) <= 4))) if k + i < j]
    assert union([(r.a, r.b) for r in links], signed) == union(pairs, signed)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(20, 60)] + [(100, k) for k in range(101, 140)] + [(139, 7), (5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect())
    want = union([e for e in edges if e[0] != e[1]], {x for e in edges for x in e if e[0] != e[1]})
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def plain_repeats(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            if w in seen:
                gone[k : k + 100] = True
            seen.add(w)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out[doc] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"))
    return out


@pytest.mark.parametrize("many", [4000, 2])
def test_repeats_against_brute_force(spark, docs, many, monkeypatch):
    monkeypatch.setattr(repeats, "MANY", many)
    monkeypatch.setattr(repeats, "SHARD", 40)
    want = plain_repeats([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.deduplicated(docs).collect()}
    assert got == {d: w[:4] for d, w in want.items()}
    assert sum(w[1] for w in want.values()) > 1000
    kept = {r.doc_id: r for r in repeats.without_repeats(docs).collect()}
    assert all((r.text is None and d == 1) or r.text == want[d][4] for d, r in kept.items())
    assert kept[3].name == "c"


def test_repeats_of_long_texts_in_parts(monkeypatch):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abc") for _ in range(4000)).encode()
    whole = repeats.chunks_of([text], True)
    monkeypatch.setattr(repeats, "LONG", 700)
    parts = repeats.chunks_of([text], True)
    windows = lambda c: {(int(s) + k, int(n)) for s, w, n in zip(c[1], c[2], c[3]) for k in range(w)}
    assert windows(whole) == windows(parts) and len(windows(whole)) == len(text) - 99


def test_run_length_index_streams_exact_matches():
    rnd = random.Random(2)
    for _ in range(12):
        b = "".join(rnd.choice("ab") for _ in range(rnd.randint(30, 200))).encode() * rnd.randint(1, 3)
        data = np.frombuffer(b, np.uint8)
        order = sorted(range(len(b)), key=lambda i: ((b[i:] + b"\xff" * 128)[:128], i))
        assert list(repeats.suffix_order(data)[0]) == order
        index = repeats.RunLengthIndex(data)
        before, match = index.streamed()
        for x, y in zip(order, order[1:]):
            n = 0
            while max(x, y) + n < len(b) and b[x + n] == b[y + n]:
                n += 1
            assert before[y] == x and match[y] == n
        for least in (3, 20, 100):
            number = index.intervals(least)
            groups = {}
            for k in range(len(b) - least + 1):
                groups.setdefault(b[k : k + least], set()).add(int(number[k]))
            assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_run_length_index_grows_with_runs_not_with_copies():
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(2000)).encode()
    once, often = (repeats.RunLengthIndex(np.frombuffer(text * k, np.uint8)) for k in (1, 100))
    kept = lambda i: i.place.nbytes + i.before.nbytes + i.common.nbytes
    assert set(vars(often)) == {"size", "place", "before", "common"} and kept(often) < 1.5 * kept(once)


def test_duplicates_of_odd_rows(spark, docs):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert repeats.deduplicated(empty).count() == 0
    text = "some words that are repeated here and there " * 5
    odd = spark.createDataFrame([(3, text, "", "", ""), (3, text, "", "", ""), (None, text, "", "", ""), (4, "other", "", "", "")], SCHEMA)
    found = sorted(((r.doc_id or -1), r.n_removed > 0) for r in repeats.deduplicated(odd).collect())
    nameless = spark.createDataFrame([(None, f"text {k} of its own without an id " * 6, "", "", "") for k in range(40)] + [(7, "text 5 of its own without an id " * 6, "", "", "")], SCHEMA)
    kept = repeats.deduplicated(nameless).collect()
    assert {r.n_removed for r in kept if r.doc_id is None} == {plain_repeats([(0, f"text {k} of its own without an id " * 6)])[0][1] for k in (5, 15)}
    assert all(r.n_removed == r.n_bytes for r in kept if r.doc_id == 7)
    clash = spark.createDataFrame([(k, text, 5, 6, 7) for k in range(2)], "doc_id bigint, text string, doc int, tag int, lost int")
    assert [(r.doc, r.tag, r.lost) for r in repeats.without_repeats(clash).collect()] == [(5, 6, 7)] * 2
    assert found[0][0] == -1 and [d for d, _ in found] == [-1, 3, 3, 4] and found[1][1] and found[2][1] and not found[3][1]
    assert len(simhash.near_duplicates(odd).collect()) == 4


def test_pivot_index_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 16))
    rows = []
    for k in range(600):
        v = base[k % 120] + rng.normal(size=16) * (0.02 if k >= 120 else 0)
        rows.append((k, [float(np.float32(x)) for x in v], k % 3 if k % 50 else None))
    rows += [(700, rows[4][1], 1), (701, rows[4][1], 1), (702, [0.0] * 16, 1), (703, None, 1), (704, [float("nan")] * 16, 1), (705, [None] + [1.0] * 15, 1), (706, [1.0, 2.0], 1), (707, [2.0, 4.0], 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, label int, id int")
    got = {r.vec_id: r for r in pivots.near_duplicates(df).collect()}
    fine = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    pairs = []
    for i, a in enumerate(fine):
        for b in fine[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    pairs.append((b[0], a[0]))
    want = union(pairs, [r[0] for r in rows])
    n = {r[0]: sum(r[0] in p for p in pairs) for r in rows}
    assert len(pairs) > 300
    assert sum(g.n_links for g in got.values()) >= 0.98 * 2 * len(pairs)
    assert all(got[k].n_links <= n[k] for k in n)
    assert np.mean([got[k].component_id == want[k] for k in want]) > 0.98
    assert all(g.kept == (g.component_id == k) for k, g in got.items())
    assert pivots.near_duplicates(df.limit(0)).count() == 0
