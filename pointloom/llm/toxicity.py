"""Toxicity by a weighted finite-state pattern grammar over clauses.

Small transducers read word classes: insults, threats with a target, targets,
negation, reported speech. Their composition is built lazily; it reads a clause
and says of what kind the clause is: a threat, an insult, one aimed at somebody, one
that is denied, one that somebody else said. A document's score is a logistic function
of the weights of its matched clauses by kind, never of single words.

The grammar brings a weight for each kind: denied and reported clauses speak against a
label. Labelled rows move these weights as far as they have evidence (a Gaussian prior
around the grammar's own), and teach the words: insult words and stems, and those among
them that stand beside a target so often that they are threats. Only rows whose crc32(id
as text) mod 5 is not 0 are learned from: remainders 1 to 3 give the words, remainder 4
the weights. Language, source and ids are no input.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.llm.shared import map_batches, sliced

#: Labelled rows to learn from (those of smallest hash), words kept, a word's least documents, log odds and evidence.
#: Evidence is how much likelier, in nats, its documents' labels are under their own rate than under that of all documents: of
#: 10,000 words that mean nothing, about one reaches it by chance.
SAMPLE, LEXICON, LEAST_DOCS, LEAST_ODDS, LEAST_EVIDENCE = 24_000, 20_000, 3, 2.5, 9.2
FOLDS = 5

# Closed-class words of the grammar.
TARGETS = "you your yours yourself u du dich dir dein deine ihr euch sie tu te toi ton ta vous votre tú te ti tu usted ustedes vosotros".split()
NEGATIONS = "not no never nobody isn't aren't don't nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco".split()
REPORTS = "said says say claimed claims quoted quote reported wrote sagte sagt behauptet schrieb dit disait affirme écrit dijo dice afirma escribió".split()
THREATS = "kill hurt destroy beat punch burn shoot stab töten schlagen vernichten umbringen tuer frapper détruire matar golpear destruir".split()
NEGATION_REACH, TARGET_REACH = 3, 4
_targets, _negations, _reports = map(frozenset, (TARGETS, NEGATIONS, REPORTS))

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
_trim = re.compile(r"^[\W_]+|[\W_]+$")


def word_of(field: str) -> str:
    return _trim.sub("", field.lower())


def ends_clause(field: str) -> bool:
    return field[-1:] in ".!?;:" or "\n" in field


def fields_of(text: str) -> list[str]:
    """What white space separates; a line's last field has its break."""
    fields: list[str] = []
    for line in text.splitlines():
        if own := line.split():
            own[-1] += "\n"
            fields += own
    return fields


def with_stems(words: set[str]) -> set[str]:
    words = words - {""}
    return words | {w[:5] + "*" for w in words if len(w) > 5} | {w[:4] + "*" for w in words if len(w) > 4}


def terms_of(text: str) -> set[str]:
    """Words that a text says itself, and their stems of 4 and 5 letters (marked by a star): not what it denies or reports."""
    fields = fields_of(text)
    words = list(map(word_of, fields))
    if _negations.isdisjoint(words) and _reports.isdisjoint(words):
        return with_stems(set(words))
    own, denied, said = set(), 0, False
    for word, field in zip(words, fields):
        if not (denied or said):
            own.add(word)
        denied, said = NEGATION_REACH if word in _negations else max(0, denied - 1), said or word in _reports
        if ends_clause(field):
            denied, said = 0, False
    return with_stems(own)


def aimed_terms_of(text: str) -> set[str]:
    """Terms that stand at most TARGET_REACH words from a target of their clause."""
    words, clause = list(map(word_of, fields := fields_of(text))), 0
    clauses = [clause := clause + (k > 0 and ends_clause(fields[k - 1])) for k in range(len(fields))]
    found = set()
    for k in [k for k, w in enumerate(words) if w in _targets]:
        near = range(max(0, k - TARGET_REACH), min(len(words), k + TARGET_REACH + 1))
        found |= {words[i] for i in near if i != k and clauses[i] == clauses[k]}
    return with_stems(found - _targets)


class Transducer:
    """A step function over (state, word class) with its outputs as a set of tags."""

    def __init__(self, start, step):
        self.start, self.step = start, step


def insults() -> Transducer:
    return Transducer(0, lambda s, c: (0, {"insult"} if c == INSULT else set()))


def reach(kind: int, far: int, tag: str) -> Transducer:
    """Tags words up to ``far`` words after one of class ``kind``."""
    return Transducer(0, lambda s, c: (far, {tag}) if c == kind else (max(0, s - 1), {tag} if s else set()))


def reported() -> Transducer:
    """From a verb of saying to the clause's end."""
    return Transducer(0, lambda s, c: (1, {"reported"}) if s or c == REPORT else (0, set()))


def threats() -> Transducer:
    """A threat verb with a target at most ``TARGET_REACH`` words before or after."""

    def step(s, c):
        verb, target = s
        verb, target = (TARGET_REACH if c == THREAT else max(0, verb - 1)), (TARGET_REACH if c == TARGET else max(0, target - 1))
        return (verb, target), {"threat"} if (c == THREAT and target) or (c == TARGET and verb) else set()

    return Transducer((0, 0), step)


class Grammar:
    """The composition: product states and their arcs, made when first needed."""

    def __init__(self):
        self.parts = [insults(), reach(NEGATION, NEGATION_REACH, "negated"), reach(TARGET, TARGET_REACH, "targeted"), reported(), threats()]
        self.states = [tuple(p.start for p in self.parts)]
        self.number = {self.states[0]: 0}
        self.arcs: dict[tuple[int, int], tuple[int, frozenset]] = {}

    def read(self, state: int, kind: int) -> tuple[int, frozenset]:
        got = self.arcs.get((state, kind))
        if got is None:
            moved = [p.step(s, kind) for p, s in zip(self.parts, self.states[state])]
            new = tuple(m[0] for m in moved)
            if new not in self.number:
                self.number[new] = len(self.states)
                self.states.append(new)
            got = self.arcs[state, kind] = self.number[new], frozenset().union(*(m[1] for m in moved))
        return got


#: What a document's score is made of: matched clauses by kind, the strongest one, and their number; the grammar's own weights of these, then the constant.
FEATURES = ("plain", "targeted", "negated", "reported", "threat", "strongest clause", "clauses matched")
WEIGHTS = (1.0, 1.2, -0.4, -0.3, 1.5, 0.4, 0.0, -3.0)
PLAIN, AIMED, DENIED, SAID, THREATENED = range(5)


class ClauseScorer:
    """Features of whole texts, by the grammar over a lexicon of weights; words of ``threats`` threaten whoever they stand beside."""

    def __init__(self, lexicon: dict[str, float], threats: frozenset[str] = frozenset()):
        self.lexicon, self.threats, self.grammar = lexicon, threats, Grammar()
        closed = ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT))
        self.closed = {w: k for words, k in closed for w in words}
        self.known: dict[str, int] = {}
        self.kinds: list[tuple[int, float, bool]] = [(OTHER, 0.0, False), (OTHER, 0.0, True)]
        self.numbers = {k: n for n, k in enumerate(self.kinds)}
        self.hot: set[int] = set()

    def kind(self, field: str) -> int:
        """Number of a field's (class, weight, whether it ends its clause)."""
        word, weight, what = word_of(field), 0.0, OTHER
        for term in (word, word[:5] + "*", word[:4] + "*"):
            weight = self.lexicon.get(term, 0.0)
            if weight:
                what = THREAT if term in self.threats else INSULT
                break
        found = (what if weight else self.closed.get(word, OTHER), weight, ends_clause(field))
        n = self.numbers.get(found)
        if n is None:
            n = self.numbers[found] = len(self.kinds)
            self.kinds.append(found)
            if found[0] in (INSULT, THREAT):
                self.hot.add(n)
        if len(self.known) > 300_000:
            self.known.clear()
        if len(field) <= 60:
            self.known[field] = n
        return n

    def clauses(self, text: str) -> list[tuple[int, float]]:
        """(kind, weight) of each clause that the grammar matches."""
        fields = fields_of(text)
        codes = list(map(self.known.get, fields))
        if None in codes:
            codes = [self.kind(f) if c is None else c for c, f in zip(codes, fields)]
        if self.hot.isdisjoint(codes):
            return []
        kinds, read, hot, n = self.kinds, self.grammar.read, self.hot, len(codes)
        out, done = [], 0
        for i, c in enumerate(codes):
            if c not in hot or i < done:
                continue
            a = i
            while a > done and not kinds[codes[a - 1]][2]:
                a -= 1
            state, weight, at, ways, threat = 0, 0.0, a, set(), False
            while at < n:
                what, own, end = kinds[codes[at]]
                state, tags = read(state, what)
                if "insult" in tags:
                    weight += own
                    ways.add(DENIED if "negated" in tags else SAID if "reported" in tags else AIMED if "targeted" in tags else PLAIN)
                elif what == THREAT:
                    weight += own
                if "threat" in tags:
                    threat = True
                    ways.add(DENIED if "negated" in tags else SAID if "reported" in tags else THREATENED)
                at += 1
                if end:
                    break
            if ways:  # what is neither denied nor reported counts
                out.append((max(ways - {DENIED, SAID}, default=None) if ways - {DENIED, SAID} else min(ways), max(weight, 1.0) if threat else weight))
            done = at
        return out

    def features(self, text: str) -> list[float]:
        out = [0.0] * len(FEATURES)
        for kind, weight in self.clauses(text):
            out[kind] += weight
            out[5] = max(out[5], weight if kind not in (DENIED, SAID) else 0.0)
            out[6] += 1
        return [math.log1p(v) for v in out]


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    threats: frozenset[str]
    weights: list[float]  # of FEATURES, then the constant

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.weights[:-1]) + self.weights[-1], -40, 40)))


def remainder(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def logistic(x: np.ndarray, y: np.ndarray, prior: tuple[float, ...] = WEIGHTS, pull: float = 1.0) -> list[float]:
    """Logistic regression by Newton steps; a Gaussian prior of precision ``pull`` holds each weight to the grammar's own. The constant, hardly held, comes last."""
    part, mean = np.hstack([x, np.ones((len(x), 1))]), np.array(prior)
    w, hold = mean.copy(), np.append(np.full(x.shape[1], pull), 0.01)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
        step = np.linalg.solve((part * (p * (1 - p))[:, None]).T @ part + np.diag(hold), part.T @ (p - y) + hold * (w - mean))
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def with_text(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, and the columns of ``chosen``) of the chosen documents; ``chosen`` has a bounded number of rows."""
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(chosen), "id")


#: Minima of a text's word-pair hashes; texts that share this part of them are copies; minima that name a list of candidates.
MINIMA, COPY, LISTED = 24, 0.8, 3
_spread = np.random.default_rng(1).integers(1, 1 << 63, (2, MINIMA), dtype=np.uint64) | np.uint64(1)


def minima(text: str) -> list[int]:
    """The least of a text's word-pair hashes under each of several orders; a text without word pairs has its own hash throughout."""
    import xxhash

    words = text.lower().split()
    h = np.array([xxhash.xxh64_intdigest(f"{a} {b}") for a, b in zip(words, words[1:])] or [xxhash.xxh64_intdigest(text)], np.uint64)
    least = np.full(MINIMA, np.iinfo(np.uint64).max)
    for k in range(0, len(h), 1 << 14):
        least = np.minimum(least, (h[k : k + (1 << 14), None] * _spread[0] + _spread[1]).min(axis=0))
    return (least >> np.uint64(1)).astype(np.int64).tolist()


def unlike(docs: DataFrame, rows: list, id_col: str, text_col: str) -> list:
    """``rows`` (id, toxic, fold) without copies: of documents of one label that share most of their word pairs the first stays.

    A word must recur in documents that aren't copies of each other to count. Copies agree in ``COPY`` of
    ``MINIMA`` minima of word-pair hashes, which is about that share of all their word pairs; texts that share
    less all stay, as do different texts of one word. The driver holds the minima of the sample.
    """
    if not rows:
        return []
    frame = docs.sparkSession.createDataFrame(rows, "id bigint, toxic int, fold bigint").distinct()

    def least():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            low = pa.array([minima(t) for t in batch.column(0).to_pylist()], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), low], names=["id", "toxic", "fold", "low"])

        return step

    found = map_batches(with_text(docs, frame, id_col, text_col).select("text", "id", "toxic", "fold"), least, "id bigint, toxic int, fold bigint, low array<bigint>").collect()
    lists: dict[tuple, list[np.ndarray]] = defaultdict(list)
    kept = set()
    for r in sorted(found):
        low = np.array(r.low)
        keys = [(r.toxic, k, *r.low[k : k + LISTED]) for k in range(0, MINIMA, LISTED)]
        if not any((low == other).mean() >= COPY for key in keys for other in lists.get(key, ())):
            kept.add((r.id, r.toxic, r.fold))
            for key in keys:
                lists[key].append(low)
    return sorted(kept)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Learns from at most ``sample`` labelled rows outside remainder 0.

    The sampled ids are broadcast: their number is bounded by ``sample``. What
    returns to the driver is bounded too: ``LEXICON`` terms and a feature row for
    each sampled row. Without labels of both kinds all scores are the same.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = (
        usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"), remainder(F.col(id_col)).alias("fold"))
        .where("fold <> 0").orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    rows = unlike(docs, chosen.collect(), id_col, text_col)
    frame = docs.sparkSession.createDataFrame(rows or [(None, None, None)], "id bigint, toxic int, fold bigint")
    known = with_text(docs, frame, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            seen: tuple[Counter, Counter, Counter] = (Counter(), Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[bool(toxic)].update(terms_of(text))
                if toxic:
                    seen[2].update(aimed_terms_of(text))
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string())] + [pa.array([seen[k][t] for t in terms], pa.int64()) for k in (1, 0, 2)], names=["term", "toxic", "clean", "aimed"])

    n = Counter((toxic, fold < 4) for _, toxic, fold in rows)
    toxic_docs, clean_docs = n[1, True], n[0, True]
    counted = known.where("fold < 4").select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long, aimed long")
    counted = counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "aimed")])
    t, c, base = F.col("toxic"), F.col("clean"), (toxic_docs + 0.5) / (toxic_docs + clean_docs + 1.0)
    odds = F.log((t + 0.5) / (toxic_docs + 1.0)) - F.log((c + 0.5) / (clean_docs + 1.0))
    evidence = t * F.log(t / (t + c) / base) + F.when(c > 0, c * F.log(c / (t + c) / (1 - base))).otherwise(0.0)
    fit_for = counted.where(t >= LEAST_DOCS).withColumns({"odds": odds, "evidence": evidence}).where((F.col("odds") >= LEAST_ODDS) & (F.col("evidence") >= LEAST_EVIDENCE))
    best = fit_for.orderBy(F.desc("odds"), "term").limit(LEXICON).collect() if toxic_docs and clean_docs else []
    lexicon = {r.term: float(r.odds) for r in best}
    threats = frozenset(r.term for r in best if 2 * r.aimed >= r.toxic)

    def describe():
        scorer = ClauseScorer(lexicon, threats)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([scorer.features(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

        return step

    held = map_batches(known.where("fold = 4").select("text", "toxic"), describe, "x array<double>, toxic int").collect()
    y = np.array([r.toxic for r in held], float)
    if not held or y.min() == y.max():
        return ToxicityModel(lexicon, threats, list(WEIGHTS))
    return ToxicityModel(lexicon, threats, logistic(np.array([r.x for r in held]), y))


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of each row, from its whole text; one scan.

    A null text is empty. Null ids are never held out; repeated rows give a
    result each; an empty table gives no rows; other columns are not read.
    """

    def make():
        scorer = ClauseScorer(model.lexicon, model.threats)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([scorer.features(t or "") for t in batch.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            s = model.score(x)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], names=[id_col, "held_out", "score", "predicted"]
            )

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    held = F.coalesce(remainder(F.col(id_col)) == 0, F.lit(False)).alias("held_out")
    return map_batches(docs.select(id_col, text_col, held), make, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ClauseScorer(model.lexicon, model.threats)
        for batch in sliced(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            x = np.array([scorer.features(t or "") for t in texts]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) < 0.5))

    return docs.mapInArrow(run, docs.schema)
