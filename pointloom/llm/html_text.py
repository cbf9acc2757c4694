"""Main text of web pages by suffix arrays over the pages of each host.

A page's tags give its blocks: those of the article, those of menus, headers,
footers, adverts and the like, and loose ones that neither encloses. Each task sorts the
tokens of the pages that it reads into suffix arrays, host by host, one of what stands
outside the articles and one of the articles; every run of tokens leaves the task once, with
the number of its pages, and sums over all tasks say which runs a host shares. So no
task holds a host, and nothing depends on how pages are dealt.

Outside the articles tokens that shared runs cover are boilerplate and go; tags then decide
on the unique runs that are left: those of menus, adverts and comments go as well, those of
loose blocks are the text of pages without an article. Articles of a host may share text
of their own, so there a run is the host's only where most of its articles hold it (see
``SHARES``), and a block goes only where such runs cover it whole: what unique runs keep is text.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, defaultdict
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.shared import map_batches, text_bytes, written

#: Tokens of a repeated run, and pages of a host that must share it.
RUN, PAGES = 8, 3
#: Articles of a host that hold a run that is the host's own: so many at least, and more than this percentage of all. The
#: second is for blocks that a tag of PROOF opens: they are text unless nearly all articles have them.
SHARES = (PAGES, 50), (10, 90)
#: Digests are looked up by their first bits before any page is moved.
BITS = 24

# Element names and words of HTML.
RAW = "script style textarea iframe".split()
INNER = "noscript template title svg object canvas video audio select button math".split()
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
).split()
HOLDERS = "article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section span table td th tr ul li p".split()
OUTSIDE = "aside dialog footer form menu nav".split()
PROOF = "blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre summary td th".split()
VOID = "area base br col embed hr img input link meta source track wbr".split()
ROLES = "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split()
# Words that say of a class or id that it holds no article text (chosen here: no standard lists them).
MARKS = (
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification popup modal "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist reply replies respond disqus "
    "share sharing social related newsletter subscribe signup login widget toolbar pagination pager"
).split()
# Words that may stand beside a mark in a class name without changing what it says (chosen here, as the marks are; letters that stand alone count as well).
BESIDE = (
    "site page main global primary secondary top bottom left right upper lower header head title inner outer wrapper wrap container box list item items bar block section area "
    "form link links button buttons text icon icons slot unit group row column col panel holder thread post posts article articles story stories content media policy message overlay bottombar "
    "user reader readers visitor google dfp gpt size slot body"
).split()

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*))>|</?[a-zA-Z][^<>]*>",
    re.S,
)
_unseen = re.compile(r"<(/?)(" + "|".join(INNER) + r")\b", re.I)
_attribute = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_letters = re.compile(r"[a-z]+")
_marks, _beside, _blocks, _holders, _outside, _void, _roles, _raw, _inner, _proof = map(frozenset, (MARKS, BESIDE, BLOCKS, HOLDERS, OUTSIDE, VOID, ROLES, RAW, INNER, PROOF))
#: What classes can say of an element: nothing of the page's own, of articles that they are comments or adverts, of sections inside an article that too, of others any mark.
_none: frozenset[str] = frozenset()
_foreign = frozenset("ad ads advert adverts advertisement adsense sponsor sponsored promo promotion comment comments commentlist reply replies disqus cookie cookies consent".split())
ARTICLE, APART, LOOSE = "article", "apart", "loose"


def names_a_mark(name: str, marks: frozenset[str] = _marks) -> bool:
    """Whether one class or id names something that isn't article text: a mark, alone or beside words of place and form."""
    words = [w for w in _letters.findall(name) if len(w) > 1]
    return not marks.isdisjoint(words) and all(w in _marks or w in _beside for w in words)


def marked(attributes: str, marks: frozenset[str] = _marks) -> bool:
    """Whether class, id or role name something that isn't article text; of classes and ids those that name one of ``marks``."""
    for m in _attribute.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("hidden", "aria-hidden"):
            if value != "false":
                return True
        elif name == "role":
            if value in _roles:
                return True
        elif marks and any(names_a_mark(n, marks) for n in value.split()):
            return True
    return False


def unseen_spans(page: str) -> dict[int, int]:
    """Where each closed element of INNER ends, by where it begins; one that is never closed holds nothing but its tag."""
    spans: dict[int, int] = {}
    begun: dict[str, list[int]] = defaultdict(list)
    for m in _unseen.finditer(page):
        if not m[1]:
            begun[m[2].lower()].append(m.start())
        elif begun[m[2].lower()]:
            end = page.find(">", m.end())
            spans[begun[m[2].lower()].pop()] = len(page) if end < 0 else end + 1
    return spans


def page_blocks(page: str) -> list[tuple[str, str]]:
    """(kind, text) of the page's blocks in order; white space is one space, empty blocks are gone."""
    return [(kind, text) for kind, text, _ in opened_blocks(page)]


def opened_blocks(page: str) -> list[tuple[str, str, bool]]:
    """``page_blocks`` with whether a tag of PROOF opens the block."""
    out: list[tuple[str, str, bool]] = []
    text: list[str] = []
    stack: list[tuple[str, bool, int]] = []  # element, in the article, apart: 1 only as a form outside the article holds it, 2 for any other reason
    article, apart, proven = False, 0, False
    unseen = unseen_spans(page)

    def close() -> None:
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                out.append((APART if apart else ARTICLE if article else LOOSE, joined, proven))
            text.clear()

    at, size, find = 0, len(page), _token.search
    while m := find(page, at):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name in _raw and not m[1]:
            end = re.compile(f"</{name}[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in _inner:
            at = max(at, unseen.get(m.start(), at))
            continue
        if name == "br":
            text.append(" ")
        if name in _blocks:
            close()
            proven = not m[1] and name in _proof
        if name in _void or name not in _holders:
            continue
        if m[1]:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] != name:
                depth -= 1
            if depth >= 0 and (name not in ("p", "span", "li", "td", "th", "tr") or depth == len(stack) - 1 or stack[depth][2] != apart):
                close()
                del stack[depth:]
                article, apart = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
            continue
        attributes = m[3]
        judged = _none if name in ("html", "body", "main") else _foreign if name == "article" or name == "section" and article else _marks
        named = ("=" in attributes or "hidden" in attributes) and marked(attributes, judged)
        aside = 2 if named or name in _outside and name != "form" or name == "header" and not article else 0
        if name == "form" and not aside:
            aside = 2 if article else 1
        if name in ("p", "span", "li", "td", "th", "tr") and not aside:
            continue
        if name == "body":
            aside = 0
        if name in ("article", "main") and apart == 1 and not aside:
            close()
            apart = 0  # pages that are one form hold their article in it
        if attributes.endswith("/") and name != "p":
            continue
        if aside and not apart:
            close()
        stack.append((name, article or name in ("article", "main"), max(apart, aside)))
        article, apart = stack[-1][1], stack[-1][2]
    if at < size:
        text.append(page[at:])
    close()
    return out


def run_digest(host: str, tokens: list[str]) -> bytes:
    return hashlib.blake2b(f"{host} {' '.join(tokens)}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


class Runs:
    """The suffix array of pages (lists of blocks of tokens), cut into intervals of suffixes that begin with the same ``run`` tokens.

    Suffixes are ordered by the host of their page, then by their tokens (numbered as
    they first appear): ranks of 1, 2, 4 ... tokens order them by their first ``run``
    tokens; a run of equal rank is an interval. ``across`` has the intervals of runs
    inside a page, ``inside`` those of runs inside a block, ``tiled`` those of runs that
    end a block or begin a multiple of ``run`` tokens after its start, so that they
    cover it: (suffixes, starts, distinct pages).
    """

    def __init__(self, pages_blocks: list[list[list[str]]], run: int = RUN, hosts: list[str] | None = None):
        self.run = run
        self.hosts = hosts or [""] * len(pages_blocks)
        self.sizes = np.array([sum(map(len, p)) for p in pages_blocks], np.int64)
        self.block_sizes = np.array([len(b) for p in pages_blocks for b in p], np.int64)
        total = int(self.sizes.sum())
        self.tokens = [t for p in pages_blocks for b in p for t in b]
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.block = np.repeat(np.arange(len(self.block_sizes)), self.block_sizes)
        number = {h: k for k, h in enumerate(dict.fromkeys(self.hosts))}
        token = pa.array(self.tokens, pa.string()).dictionary_encode().indices.to_numpy()
        rank = np.array([number[h] for h in self.hosts], np.int64)[self.owner] << 32 | token
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        width = 1
        while width < run:
            step = min(width, run - width)
            rank = np.unique(rank << 32 | np.append(rank[step:], np.zeros(step, np.int64))[:total], return_inverse=True)[1].astype(np.int64)
            width += step
        self.rank = rank
        self.suffixes = np.argsort(rank, kind="stable")
        self.left = np.cumsum(self.block_sizes)[self.block] - np.arange(total)

    @cached_property
    def across(self):
        return self.intervals(np.cumsum(self.sizes)[self.owner] - np.arange(len(self.owner)) >= self.run)

    @cached_property
    def inside(self):
        return self.intervals(self.left >= self.run)

    @cached_property
    def tiled(self):
        behind = self.block_sizes[self.block] - self.left
        return self.intervals((self.left == self.run) | (self.left > self.run) & (behind % self.run == 0))

    def intervals(self, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = self.suffixes[where[self.suffixes]]
        if not len(order):
            return order, order, order
        start = np.flatnonzero(np.append(True, self.rank[order][1:] != self.rank[order][:-1]))
        fresh = np.append(True, self.owner[order][1:] != self.owner[order][:-1])
        fresh[start] = True
        return order, start, np.add.reduceat(fresh.astype(np.int64), start)

    def digests(self, starts: np.ndarray) -> list[bytes]:
        """128 bits of the host and the run at each of these places; equal for equal runs of one host in any task."""
        return [run_digest(self.hosts[o], self.tokens[k : k + self.run]) for k, o in zip(starts.tolist(), self.owner[starts].tolist())]

    def under(self, found: tuple[np.ndarray, np.ndarray, np.ndarray], chosen: np.ndarray) -> np.ndarray:
        """Which tokens the chosen intervals cover."""
        out, (order, start, _) = np.zeros(len(self.owner), bool), found
        hits = order[np.repeat(chosen, np.diff(np.append(start, len(order))))]
        for k in range(self.run):
            out[hits + k] = True
        return out

    def filled(self, found: tuple[np.ndarray, np.ndarray, np.ndarray], chosen: np.ndarray) -> np.ndarray:
        """Which blocks the chosen intervals cover whole."""
        return np.bincount(self.block, self.under(found, chosen), len(self.block_sizes)) == self.block_sizes

    def covered(self, inside: np.ndarray, across: np.ndarray) -> list[np.ndarray]:
        """For each page, which tokens the chosen intervals cover: a run inside a block its own tokens, runs from block to block the blocks that they fill."""
        covered = self.under(self.inside, inside) | self.filled(self.across, across)[self.block]
        return np.split(covered, np.cumsum(self.sizes)[:-1]) if len(self.sizes) else []


def covered_tokens(pages_blocks: list[list[list[str]]], run: int = RUN, pages: int = PAGES) -> list[np.ndarray]:
    """For each page (a list of blocks of tokens), which tokens a run of ``run`` tokens covers that ``pages`` distinct pages hold."""
    runs = Runs(pages_blocks, run)
    return runs.covered(runs.inside[2] >= pages, runs.across[2] >= pages)


def home_of(host: str) -> int:
    return int.from_bytes(hashlib.blake2b(text_bytes(host), digest_size=8).digest(), "little", signed=True)


def host_runs():
    """Every run of the pages of a batch, once a host: outside the articles, on how many pages it stands inside a block, and at all; of the
    articles, in how many it is a tile. A run of no tokens has the number of the host's articles.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, pages = (batch.column(k).to_pylist() for k in range(2))
        blocks = [opened_blocks(page or "") for page in pages]
        homes = {h: home_of(h) for h in hosts}
        around, articles = (Runs([[t.split(" ") for k, t, _ in b if (k == ARTICLE) == own] for b in blocks], hosts=hosts) for own in (False, True))
        (order, start, across), (inner, first, inside), (tiled, tile, held) = around.across, around.inside, articles.tiled
        n = Counter(h for h, size in zip(hosts, articles.sizes.tolist()) if size)
        counts = np.zeros((len(start) + len(tile) + len(n), 3), np.int64)
        counts[np.searchsorted(around.rank[order[start]], around.rank[inner[first]]), 0] = inside
        counts[: len(start), 1] = across
        counts[len(start) :, 2] = [*held.tolist(), *n.values()]
        where = [hosts[o] for runs, places in ((around, order[start]), (articles, tiled[tile])) for o in runs.owner[places].tolist()] + [*n]
        found = around.digests(order[start]) + articles.digests(tiled[tile]) + [b""] * len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array([homes[h] for h in where], pa.int64()), pa.array(found, pa.binary()), *(pa.array(counts[:, k]) for k in range(3))], names=["home", "run", "inside", "across", "articles"]
        )

    return step


def tiles(tokens: list[str]) -> list[list[str]]:
    """The runs that are ``Runs.tiled`` of a block."""
    last = len(tokens) - RUN
    return [tokens[k : k + RUN] for k in (*range(0, last, RUN), last)] if last >= 0 else []


def asked_tiles(bits: np.ndarray | None, host: str, text: str) -> list[list[str]]:
    """The tiles of an article block if, as far as ``first_bits`` tell, most articles of the host hold all of them, else none."""
    if bits is None:
        return []
    own = tiles(text.split(" "))
    places = (int.from_bytes(run_digest(host, r)[: BITS // 8], "big") for r in own)
    return own if all(bits[at >> 3] >> (at & 7) & 1 for at in places) else []


def page_runs(bits: Broadcast):
    """(page, run) for each different run of a page's blocks, of a page with an article for its ``asked_tiles``."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        pages, runs = [], []
        for page, host, blocks in zip(*(batch.column(k).to_pylist() for k in range(3))):
            own = [b["text"] for b in blocks if b["kind"] == ARTICLE]
            tokens = [t for b in blocks for t in b["text"].split(" ")]
            asked = (r for t in own for r in asked_tiles(bits.value, host, t)) if own else (tokens[k : k + RUN] for k in range(len(tokens) - RUN + 1))
            found = {run_digest(host, r) for r in asked}
            pages += [page] * len(found)
            runs += found
        return pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), pa.array(runs, pa.binary())], names=["page", "run"])

    return step


def known(runs: Runs, found: tuple[np.ndarray, np.ndarray, np.ndarray], shared: set[bytes]) -> np.ndarray:
    order, start, _ = found
    return np.array([d in shared for d in runs.digests(order[start])], bool)


def covered_by(host: str, blocks: list[list[str]], inside: set[bytes], across: set[bytes]) -> list[np.ndarray]:
    """For each block, which of its tokens the host's shared runs cover."""
    runs = Runs([blocks], hosts=[host])
    hit = runs.covered(known(runs, runs.inside, inside), known(runs, runs.across, across))
    return np.split(hit[0], np.cumsum(runs.block_sizes)[:-1]) if blocks else []


def article_left(host: str, blocks: list[list[str]], proven: list[bool], most: set[bytes], nearly: set[bytes]) -> np.ndarray:
    """Which blocks of an article stay: those that the host's own runs don't cover whole, or all where these are half of the article (it is a copy then)."""
    runs = Runs([blocks], hosts=[host])
    gone, surely = (runs.filled(runs.tiled, known(runs, runs.tiled, shared)) for shared in (most, nearly))
    gone = np.where(proven, surely, gone)
    return ~gone if 2 * runs.block_sizes[gone].sum() < len(runs.tokens) else np.ones(len(blocks), bool)


def without_runs():
    """What is left of each page: its article without the host's blocks, else text of its loose blocks without covered tokens, and how many tokens were covered."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, gone = [], []
        for host, blocks, shared in zip(*(batch.column(k).to_pylist() for k in range(3, 6))):
            by_flag = [{bytes(r["run"]) for r in shared or () if r[c]} for c in FLAGS]
            own = [b for b in blocks if b["kind"] == ARTICLE]
            tokens = [b["text"].split(" ") for b in own or blocks]
            if own:
                stays = article_left(host, tokens, [b["proven"] for b in own], *by_flag[2:])
                texts.append("\n".join(b["text"] for b, s in zip(own, stays) if s))
                gone.append(sum(len(t) for t, s in zip(tokens, stays) if not s))
                continue
            hits = covered_by(host, tokens, *by_flag[:2])
            left = [" ".join(t for t, h in zip(ts, hit) if not h) for b, ts, hit in zip(blocks, tokens, hits) if b["kind"] == LOOSE]
            texts.append("\n".join(filter(None, left)))
            gone.append(int(sum(h.sum() for h in hits)))
        return pa.RecordBatch.from_arrays([batch.column(k) for k in range(3)] + [pa.array(texts, pa.string()), pa.array(gone, pa.int64())], names=["id", "url", "page", "text", "covered"])

    return step


BLOCK = "array<struct<kind:string,text:string,proven:boolean>>"
_block = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string()), ("proven", pa.bool_())]))
#: What is known of a run: PAGES pages share it inside a block, or at all, outside their articles; most articles hold it, or nearly all.
FLAGS = "inside", "across", "most", "nearly"


def keyed(pages: DataFrame, id_col: str, html_col: str, url_col: str) -> DataFrame:
    """(id, url, page, host, html); ``page`` is a hash of the row, so it is the same wherever and however often the row is read."""
    host = F.coalesce(F.lower(F.expr("try_parse_url(url, 'HOST')")), F.lit(""))
    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return read.select("id", "url", F.xxhash64("id", "url", "html").alias("page"), host.alias("host"), "html")


def shared_runs(read: DataFrame) -> DataFrame:
    """(run, inside, across, most, nearly): the runs that PAGES pages of their host share outside articles, or so many of its articles as SHARES says."""
    counted = map_batches(read.select("host", "html"), host_runs, "home bigint, run binary, inside bigint, across bigint, articles bigint")
    sums = counted.groupBy("home", "run").agg(*(F.sum(c).alias(c) for c in ("inside", "across", "articles")))
    sums = written(sums.where((F.col("across") >= PAGES) | (F.col("articles") >= PAGES) | (F.length("run") == 0)), "runs")
    hosts = sums.where(F.length("run") == 0).select("home", F.col("articles").alias("all"))
    held = ((F.col("articles") >= n) & (F.col("articles") * 100 > F.col("all") * share) for n, share in SHARES)
    flags = [*(F.col(c) >= PAGES for c in FLAGS[:2]), *(F.coalesce(h, F.lit(False)) for h in held)]
    return sums.where(F.length("run") > 0).join(hosts, "home", "left").select("run", *(f.alias(c) for f, c in zip(flags, FLAGS))).where("across or most")


def first_bits(runs: DataFrame) -> np.ndarray | None:
    """A bit for each value of the first BITS bits of a digest: whether a run that most articles hold begins so. None where there is no such run."""
    at = F.conv(F.hex(F.substring("run", 1, BITS // 8)), 16, 10).cast("long") + 1
    rows = runs.where("most").groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    if not rows:
        return None
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for r in rows:
        out[(r.bucket - 1) * len(r.bits) : r.bucket * len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return out


def left_of(outside: DataFrame, runs: DataFrame, bits: Broadcast, id_type: str) -> DataFrame:
    """(id, url, page, text, covered) of pages (id, url, page, host, blocks), given the runs that their hosts share.

    A run of a hot host meets all its pages in a join; adaptive execution may split that, and a page's own runs are grouped afterwards.
    """
    asked = map_batches(outside.select("page", "host", "blocks"), lambda: page_runs(bits), "page bigint, run binary")
    shared = asked.join(runs, "run").groupBy("page").agg(F.collect_set(F.struct("run", *FLAGS)).alias("shared"))
    held = outside.join(shared, "page", "left").select("id", "url", "page", "host", "blocks", "shared")
    return map_batches(held, without_runs, f"id {id_type}, url string, page bigint, text string, covered bigint")


Blocks = list[tuple[str, str, bool]]


def parsed(chosen: Callable[[str, Blocks], Blocks | None]):
    """Pages (..., host, html) as ``chosen`` blocks; pages for which it gives None are left out."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            hosts, pages = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            found = [chosen(host, opened_blocks(page or "")) for host, page in zip(hosts, pages)]
            keep = [k for k, f in enumerate(found) if f is not None]
            blocks = pa.array([[{"kind": k, "text": t, "proven": p} for k, t, p in found[i]] for i in keep], _block)
            at = pa.array(keep, pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(k).take(at) for k in range(batch.num_columns - 1)] + [blocks], names=[*batch.schema.names[:-1], "blocks"])

        return step

    return make


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(id, url, text, n_chars) of each page.

    Where a page has an article (or main) element its text is that element's
    without the blocks that most articles of the host hold, else that of the loose
    blocks. Articles of unique runs are written as they are read; only pages with a
    block that may be the host's, or without an article, are moved. Null html or
    html without text gives an empty text; a null url is a host of its own; repeated
    rows give a result each and count as pages each; an empty table gives no rows;
    other columns are not read.
    """
    read, id_type = keyed(pages, id_col, html_col, url_col), pages.schema[id_col].dataType.simpleString()
    runs = shared_runs(read)
    bits = pages.sparkSession.sparkContext.broadcast(first_bits(runs))

    def unique(host: str, blocks: Blocks) -> Blocks | None:
        own = [b for b in blocks if b[0] == ARTICLE]
        return own if own and not any(asked_tiles(bits.value, host, t) for _, t, _ in own) else None

    def others(host: str, blocks: Blocks) -> Blocks | None:
        return None if unique(host, blocks) else [b for b in blocks if b[0] == ARTICLE] or blocks

    whole = map_batches(read.select("id", "url", "host", "html"), parsed(unique), f"id {id_type}, url string, host string, blocks {BLOCK}")
    whole = whole.select("id", "url", F.array_join(F.transform("blocks", lambda b: b["text"]), "\n").alias("text"))
    moved = map_batches(read, parsed(others), f"id {id_type}, url string, page bigint, host string, blocks {BLOCK}")
    left = left_of(written(moved, "moved"), runs, bits, id_type).select("id", "url", "text")
    return whole.unionByName(left).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text").withColumn("n_chars", F.length("text").cast("long"))


def boilerplate(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(id, outside, covered): each page's tokens outside its article, and how many of them the suffix array removes before tags are asked."""
    read, id_type = keyed(pages, id_col, html_col, url_col), pages.schema[id_col].dataType.simpleString()
    outside = map_batches(read, parsed(lambda _, blocks: [b for b in blocks if b[0] != ARTICLE]), f"id {id_type}, url string, page bigint, host string, blocks {BLOCK}")
    size = F.aggregate("blocks", F.lit(0), lambda n, b: n + F.size(F.split(b["text"], " ")))
    bits = pages.sparkSession.sparkContext.broadcast(None)
    left = left_of(outside, shared_runs(read), bits, id_type).select("page", "covered").distinct()
    return outside.select("id", "page", size.alias("outside")).join(left, "page").select(F.col("id").alias(id_col), "outside", "covered")
