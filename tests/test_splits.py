"""Splits against the greedy rules written out one source or frame at a time."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from pointloom.operators import splits

SHARES = tuple(map(Fraction, ("0.7", "0.15", "0.15")))


def md5(key, seed=1):
    return hashlib.md5(f"{key}:{seed}".encode()).hexdigest()


def plain_grouped(rows, quotas):
    """Each source in turn to the split of least cost; then sources with equal counts are dealt their splits by hash order."""
    counts = defaultdict(Counter)
    for s, label in rows:
        counts[s][label] += 1
    totals = Counter(label for _, label in rows)
    kind = {s: tuple(sorted(c.items())) for s, c in counts.items()}
    order = sorted(counts, key=lambda s: (-round(sum(n / totals[c] for c, n in kind[s]), 12), -sum(counts[s].values()), kind[s], md5(s)))
    target = [{c: p * n for c, n in totals.items()} for p in SHARES]
    have, size, groups = [Counter(), Counter(), Counter()], [0, 0, 0], [0, 0, 0]
    every = [p * len(rows) for p in SHARES]
    room = quotas(len(counts), SHARES)
    dealt = defaultdict(list)
    for s in order:
        costs = []
        for k in range(3):
            if groups[k] < room[k]:
                cost = sum((have[j][c] + (counts[s][c] if j == k else 0) - target[j][c]) ** 2 / (target[j][c] + 1) for j in range(3) for c in totals)
                n = sum(counts[s].values())
                costs.append((cost + Fraction(1, 4) * sum((size[j] + (n if j == k else 0) - every[j]) ** 2 / (every[j] + 1) for j in range(3)), k))
        k = min(costs)[1]
        have[k] += counts[s]
        size[k] += sum(counts[s].values())
        groups[k] += 1
        dealt[kind[s]].append(k)
    return {s: splits.SPLITS[k] for key, ks in dealt.items() for s, k in zip(sorted((s for s in kind if kind[s] == key), key=md5), sorted(ks))}, groups


@pytest.mark.parametrize("quotas", [splits.remainder_quotas, splits.rounded_quotas])
def test_grouped_split_follows_the_greedy_rule(spark, quotas):
    rnd = random.Random(2)
    rows = [(s, rnd.choices("abcdef", (50, 30, 10, 5, 2, 1))[0]) for s in range(400) for _ in range(rnd.choice((1, 1, 1, 2, 3, 9)))]
    rows += [(1000 + k, "a") for k in range(300)]  # one type holds most sources
    want, groups = plain_grouped(rows, quotas)
    manifest = spark.createDataFrame([(k, s, c) for k, (s, c) in enumerate(rows)], "sample_id int, source_id int, label string")
    got = {r.source_id: r.new_split for r in splits.grouped_split(manifest, quotas=quotas).collect()}
    assert got == want and groups == quotas(700, SHARES)


def test_grouped_split_of_odd_rows(spark):
    schema = "sample_id int, source_id int, label string"
    few = spark.createDataFrame([(1, 1, "a"), (2, 1, "a"), (3, None, "a"), (4, 2, None)], schema)
    assert [(r.sample_id, r.new_split) for r in splits.grouped_split(few).orderBy("sample_id").collect()] == [(1, "train"), (2, "train")]
    assert splits.grouped_split(spark.createDataFrame([], schema)).count() == 0


def test_quotas():
    assert [splits.remainder_quotas(n, SHARES) for n in (0, 1, 2, 3, 10, 100)] == [[0, 0, 0], [1, 0, 0], [2, 0, 0], [1, 1, 1], [7, 2, 1], [70, 15, 15]]
    assert [splits.rounded_quotas(n, SHARES) for n in (0, 1, 2, 3, 10, 100)] == [[0, 0, 0], [1, 0, 0], [1, 1, 0], [1, 1, 1], [6, 2, 2], [70, 15, 15]]
    assert splits.rounded_quotas(5, tuple(map(Fraction, ("0.1", "0.8", "0.1")))) == [1, 3, 1]
    for n in range(3, 60):
        assert sum(splits.remainder_quotas(n, SHARES)) == sum(splits.rounded_quotas(n, SHARES)) == n


def test_many_equal_sources_take_what_one_by_one_would():
    rnd = random.Random(9)
    for _ in range(60):
        totals = {c: rnd.randint(1, 500) for c in "abc"}
        counts = {c: rnd.randint(1, 4) for c in rnd.sample("abc", rnd.randint(1, 3))}
        many = rnd.randint(9, 200)
        room = [many, rnd.randint(0, many), rnd.randint(0, many)]
        one, all_ = (splits.QuotaWalk(totals, many, SHARES, room) for _ in range(2))
        for w in (one, all_):
            w.take({"a": 3}, 1)
        single = [sum(x) for x in zip(*(one.take(counts, 1) for _ in range(many - 1)))]
        assert all_.take(counts, many - 1) == single


def plain_cover(frames, wanted):
    left = Counter(c for s in frames.values() for c in s)
    free, seen, val = set(frames), set(), []
    while len(val) < wanted:
        able = [f for f in free if all(left[c] > 1 for c in frames[f])]
        if not able:
            break
        score = lambda f: (round(sum(1 / left[c] for c in frames[f] if c not in seen), 12), round(sum(1 / left[c] for c in frames[f]), 12))
        top = max(map(score, able))
        kind = min(sorted(frames[f]) for f in able if score(f) == top)
        f = min((f for f in able if sorted(frames[f]) == kind), key=md5)
        val.append(f)
        free.remove(f)
        seen |= frames[f]
        left.subtract(frames[f])
    return set(val)


@pytest.mark.parametrize("seed", range(4))
def test_rare_class_split_follows_the_greedy_cover(spark, seed):
    rnd = random.Random(seed)
    weights = [2.0**-k for k in range(12)]
    frames = {f: set(rnd.choices(range(12), weights, k=rnd.randint(0, 4))) for f in range(300)}
    rows = [(f, c) for f, s in frames.items() for c in (s or [None])] * 2
    share = (0.2, 0.05, 0.6, 0.95)[seed]
    got = {r.frame_ord: r.split for r in splits.rare_class_split(spark.createDataFrame(rows, "frame_ord int, label int"), share).collect()}
    want = plain_cover(frames, min(299, -(-300 * int(share * 100) // 100)))
    assert {f for f, s in got.items() if s == "val"} == want and set(got) == set(frames)
    assert all(any(got[f] == "train" for f in frames if c in frames[f]) for c in range(12) if any(c in s for s in frames.values()))


def test_rare_class_split_without_a_choice(spark):
    for rows in ([(1, 1)], [(1, 1), (2, 2)]):
        with pytest.raises(Exception, match="frame"):
            splits.rare_class_split(spark.createDataFrame(rows, "frame_ord int, label int")).collect()


def plain_repaired(counts, share):
    """counts: {frame: {class: n}}; one class after the other, each against the sets as they are."""
    order = sorted(counts, key=lambda f: (md5(f), f))
    wanted = min(max(1, round(len(order) * Fraction(str(share)))), len(order) - 1)
    val, train = set(order[:wanted]), set(order[wanted:])
    for c in sorted({c for s in counts.values() for c, n in s.items() if n > 0}):
        own = sorted(f for f in counts if counts[f].get(c, 0) > 0)
        if len(own) == 1:
            val -= set(own)
            train |= set(own)
            continue
        if not train & set(own):
            f = max(own, key=lambda f: (counts[f][c], -f))
            val.remove(f)
            train.add(f)
        if not val & set(own) and len(val) < len(counts) - 1:
            f = min(own, key=lambda f: (counts[f][c], f))
            train.remove(f)
            val.add(f)
    return val


@pytest.mark.parametrize(("seed", "classes", "share"), [(0, 40, 0.2), (1, 200, 0.5), (2, 5, 0.9)])
def test_class_aware_split_repairs_in_turn(spark, seed, classes, share):
    rnd = random.Random(seed)
    counts = {f: {c: rnd.randint(0, 3) for c in rnd.sample(range(classes), min(classes, rnd.randint(0, 4)))} for f in range(80)}
    rows = [(f, c, n) for f, s in counts.items() for c, n in (s or {None: 0}).items()]
    got = {r.frame_ord: r.split for r in splits.class_aware_split(spark.createDataFrame(rows, "frame_ord int, label int, n int"), share).collect()}
    assert {f for f, s in got.items() if s == "val"} == plain_repaired(counts, share) and set(got) == set(counts)


def test_reviews_are_checked(spark):
    from pointloom.operators import manifests

    schema = "sample_id string, source_id string, label string, split string"
    rows = [("a", "s", "x", "train"), ("b", "s", "y", "val"), ("c", "t", "x", "test")]
    m = spark.createDataFrame(rows, schema)
    review = lambda *pairs: spark.createDataFrame(list(pairs), "sample_id string, label string")
    good = review(("a", "x"), ("b", "x"))
    assert {(r.sample_id, r.label, r.previous_label, r.split) for r in manifests.resplit(m, good).collect()} == {("a", "x", None, "train"), ("b", "x", "y", "train")}
    assert {tuple(r) for r in manifests.review_summary(m, good).collect()} == {("x", 1, 0, 1), ("y", 1, 1, 0)}
    twice = m.union(spark.createDataFrame(rows[:1], schema))
    for manifest, found, says in ((m, review(("a", "x"), ("a", "y")), "twice in the review: a"), (m, review(("z", "x")), "alone: z"), (twice, good, "twice in the manifest: a"), (m.union(spark.createDataFrame([(" ", "s", "x", "val")], schema)), good, "no id")):
        with pytest.raises(Exception, match=says):
            manifests.checked_review(manifest, found).collect()
