"""Spelling variants against brute force."""

import random
import zlib
from collections import Counter

import pytest

from pointloom.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n bigint, list string"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows, least=5, shortest=6, every=199, times=5):
    letters = set(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]))
    count = Counter()
    for doc, text in rows:
        for run in "".join(c if c in letters else "\n" for c in text or "").split("\n"):
            if run:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
                at = h % len(low)
                count[low[:at] + low[at + 1 :] if h % every == 0 else low] += 1
    n = {w: c for w, c in count.items() if len(w) >= shortest and c >= least}
    out = {}
    for w in n:
        near = sorted((x for x in n if x != w and one_edit(w, x)), key=lambda x: (-n[x], x))
        form = near[0] if near and n[near[0]] >= times * n[w] else None
        out[w] = [form, w, n[w], len(near), n[form] if form else None]
    for w, r in out.items():
        while out[r[1]][0]:
            r[1] = out[r[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def texts(seed=3, n=120):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcé÷") for _ in range(rnd.randint(6, 9))) for _ in range(25)] + ["internationalisation" + x for x in ("a", "b", "ab", "")]
    words = []
    for k, w in enumerate(base):
        at = rnd.randrange(len(w))
        words += [w] * 40 + [w[:at] + w[at + 1 :]] * 6 + [w[:at] + "z" + w[at:]] * 3 + [(w[:at] + "q" + w[at + 1 :]).upper()] * (1 + k % 3)
    return [(k, rnd.choice([" ", "\n", "7", "—"]).join(rnd.choice(words) for _ in range(rnd.randint(0, 90)))) for k in range(n)]


@pytest.mark.parametrize(("block", "long"), [(4096, 64), (5, 64), (4096, 6)])
def test_variants_against_brute_force(spark, monkeypatch, block, long):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (block,))
    monkeypatch.setattr(spelling, "LONG", long)
    rows = texts()
    rows += [(500, None), (501, ""), (None, rows[0][1]), (7, rows[1][1]), rows[2], (502, "x" * 400 + " " + "x" * 399 + "y")] * 6
    rows += [(600 + k, "kettles " * 200 + "kettlez " * 30 + "ketxlez " * 3) for k in range(5)]
    docs = spark.createDataFrame([(d, t, "a", 1, "b") for d, t in rows], SCHEMA)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs, every=7).collect()}
    want = plain(rows, every=7)
    assert got == want
    assert any(f and r != f for f, r, *_ in want.values()) and any(v[3] > 3 for v in want.values())


def test_empty_table(spark):
    got = spelling.variants(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and got.count() == 0


def test_long_texts_are_cut_between_runs():
    text = "".join(random.Random(4).choice("ab,é ") for _ in range(5000)) + "c" * 300
    for size in (1, 7, 64):
        parts = list(spelling.parts_of(text, size))
        assert "".join(parts) == text
        assert [w for p in parts for w in spelling._run.findall(p)] == spelling._run.findall(text)


def test_sorted_lists_skip_no_near_word():
    rnd = random.Random(5)
    for _ in range(40):
        words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 8))) for _ in range(rnd.randint(1, 80))})
        asked = rnd.sample(words, min(len(words), 20))
        one = spelling.SortedList(words)
        assert all([words[i] for i in one.near(a)] == [b for b in words if one_edit(a, b)] for a in asked)
