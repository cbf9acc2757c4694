"""Toxicity, WARC, HTML and nearest neighbours."""

import hashlib
import io
import random

import numpy as np
import pytest

from pointloom.llm import forest, html_text, toxicity, warc


def toxic_rows():
    rnd = random.Random(5)
    words = ["of", "the", "tion", "and", "ea", "er", "on", "ing", "ly", "ound", "was", "be"] + [f"w{k}" for k in range(80)]
    rows = []
    for k in range(600):
        w = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        bad = k % 6 == 0
        if bad:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(["moron", "zerostupid", "zeroxa", "zeroyb", "idiot!"]))
        rows.append((k, " ".join(w) + ".", int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(k, t, "x") for k, t, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (None, "moron", "x"), (5, rows[5][1], "x")], "doc_id bigint, text string, toxic string")
    labels = spark.createDataFrame([(k, y, 1) for k, _, y in rows] + [(None, 1, 1), (7, None, 1)], "doc_id bigint, toxic int, quality int")
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model).collect()
    truth = {k: y for k, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.predicted for r in got if r.doc_id in (1000, 1001)} == {0} and len(got) == len(rows) + 4
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id in truth} == {r.doc_id for r in got if r.predicted == 0 and r.doc_id in truth}
    nothing = toxicity.fit(docs, labels.limit(0))
    assert toxicity.scored(docs.limit(0), nothing).count() == 0


def test_grammar_scores_clauses():
    scorer = toxicity.ClauseScorer({"moron": 2.0, "zero*": 1.5})
    f = lambda t: dict(zip(toxicity.FEATURES, np.expm1(scorer.features(t)).round(6)))
    assert f("nothing here") == dict.fromkeys(toxicity.FEATURES, 0.0)
    assert f("what a moron.")["plain"] == 2.0
    assert f("you are a moron.")["targeted"] == 2.0
    assert f("not a moron.")["negated"] == 2.0 and f("not a moron.")["strongest clause"] == 0.0
    assert f("she said he was a moron. zerofoo")["reported"] == 2.0 and f("she said he was a moron. zerofoo")["plain"] == 1.5
    assert f("i will kill you")["threat"] == 1.0 and f("he said i will kill you")["reported"] == 1.0
    assert f("moron moron, zeroa.")["strongest clause"] == 5.5 and f("moron moron, zeroa. moron")["clauses matched"] == 2.0
    score = lambda t: float(toxicity.ToxicityModel({}, frozenset(), list(toxicity.WEIGHTS)).score(np.array([scorer.features(t)]))[0])
    assert score("not a moron.") < score("nothing here") < score("what a moron.") < score("you are a moron.")
    assert score("she said he was a moron.") < score("nothing here") < score("i will kill you")


def plain_clauses(text, lexicon, threats):
    """The grammar's meaning, word by word: what stands how far from what within a clause."""
    import re

    closed = {w: k for ws, k in ((toxicity.TARGETS, "target"), (toxicity.NEGATIONS, "negation"), (toxicity.REPORTS, "report"), (toxicity.THREATS, "threat")) for w in ws}
    out = []
    for clause in re.split(r"(?<=[.!?;:])\s+|\n", " ".join(text.split(" "))):
        words = [re.sub(r"^[\W_]+|[\W_]+$", "", w.lower()) for w in clause.split()]
        known = [next(((lexicon[t], t) for t in (w, w[:5] + "*", w[:4] + "*") if t in lexicon), None) for w in words]
        what = [("threat" if k[1] in threats else "insult") if k else closed.get(w, "") for k, w in zip(known, words)]
        near = lambda i, kind, far: any(what[j] == kind for j in range(max(0, i - far), i))
        ways, weight, threat = set(), 0.0, False
        for i, k in enumerate(what):
            hit = (k == "threat" and near(i, "target", 4 - 1)) or (k == "target" and near(i, "threat", 4 - 1))
            weight += known[i][0] if known[i] else 0.0
            denied, said, aimed = near(i, "negation", 3), any(w == "report" for w in what[:i]), near(i, "target", 4)
            if k == "insult":
                ways.add(2 if denied else 3 if said else 1 if aimed else 0)
            if hit:
                threat = True
                ways.add(2 if denied else 3 if said else 4)
        if ways:
            out.append((max(ways - {2, 3}) if ways - {2, 3} else min(ways), max(weight, 1.0) if threat else weight))
    return out


def test_clauses_against_brute_force():
    rnd = random.Random(8)
    lexicon, threats = {"moron": 2.0, "zero*": 1.5, "smash": 3.0}, frozenset(["smash"])
    words = ["moron", "zerofoo", "smash", "kill", "you", "du", "not", "never", "said", "sagte", "the", "a", "of", "is", "very", "Moron,", "'you'"]
    scorer, found = toxicity.ClauseScorer(lexicon, threats), 0
    for _ in range(3000):
        text = "".join(rnd.choice(words) + rnd.choice(["", "", "", "", ".", "!", ";"]) + rnd.choice([" ", " ", " ", "\n"]) for _ in range(rnd.randint(0, 25)))
        want = plain_clauses(text, lexicon, threats)
        assert scorer.clauses(text) == want, text
        found += len(want)
    assert found > 5000


def test_the_grammar_learns_what_words_alone_cannot(spark):
    rnd = random.Random(11)
    fill = lambda n: " ".join(f"w{rnd.randrange(40)}" for _ in range(n))
    rows = []
    for k in range(1500):
        kind = k % 5
        insult = rnd.choice(["moron", "idiot", "scum"])
        toxic = {0: f"you {insult}", 1: f"what {insult} he is", 2: f"i will smash you {rnd.choice('xyz')}"}
        clean = {3: f"she said that {insult} again", 4: f"he is not a {insult}"}
        rows.append((k, f"{fill(rnd.randint(3, 20))}. {(toxic | clean)[kind]}. {fill(5)}", int(kind < 3)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert "smash" in model.threats and {"moron", "idiot", "scum"} <= set(model.lexicon)
    got = {r.doc_id: r for r in toxicity.scored(df, model).collect()}
    held = [(got[k].predicted, y) for k, _, y in rows if got[k].held_out]
    assert len(held) > 250 and np.mean([p == y for p, y in held]) > 0.95
    words = {k: sum(w.strip(".") in model.lexicon for w in t.split()) > 0 for k, t, _ in rows}
    assert np.mean([words[k] == y for k, _, y in rows if got[k].held_out]) < 0.75  # the words alone


def test_toxicity_of_a_very_long_text():
    scorer = toxicity.ClauseScorer({"moron": 2.0})
    text = "some words without an end of the clause " * 50_000 + "moron. " + "and more words. " * 50_000
    assert scorer.clauses(text) == [(0, 2.0)]


@pytest.mark.parametrize("segment,chunk", [(32_768, 8192), (150, 40), (100, 7)])
def test_warc_round_trip(spark, segment, chunk):
    rnd = random.Random(1)
    big = "".join(rnd.choice("aé漢\r\n<p>") for _ in range(2000))
    pages = [(k, f"http://h/{k}\r\nX: y", t) for k, t in enumerate(["", None, "short", "short", big, big, big + "!", "WARC/1.1\r\n\r\n0\r\n\r\n" * 100, "x" * 999, "x" * 999, "y" * 1000, "y" * 1000])]
    df = spark.createDataFrame([(*p, "z") for p in pages] + [(None, None, "lost", "z")], "page_id bigint, url string, html string, kind string")
    got = {r.page_id: r for r in warc.archived(df, segment=segment, chunk=chunk).collect()}
    assert len(got) == 13
    for k, _, t in pages:
        b = (t or "").encode()
        same = [j for j, _, u in pages if (u or "").encode() == b]
        keeper = max(same) if len(b) >= 1000 else k
        r = got[k]
        assert (r.payload_bytes, r.payload_digest) == (len(b), hashlib.sha1(b).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if keeper == k else ("revisit", keeper))
    assert warc.archived(df.limit(0)).count() == 0


def test_a_very_long_payload(spark):
    text = "é漢x" * 1_500_000
    got = warc.archived(spark.createDataFrame([(1, text, "u"), (2, text, "u"), (3, "y", "u")], "page_id bigint, html string, url string")).collect()
    assert {(r.page_id, r.payload_bytes, r.refers_to) for r in got} == {(1, 9_000_000, 2), (2, 9_000_000, None), (3, 1, None)}


def test_segments_that_are_missing_raise(spark):
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n")))
    assert warc.dechunked(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2;x\r\nde\r\n0\r\n\r\n") == b"abcde"


def test_article_text():
    page = (
        '<html><head><title>no</title><script>"</p>"</script></head><body><nav><ul><li><a>menu</a></li></ul></nav><div class="ad">buy</div><header><h1>site</h1></header>'
        '<article><h1>Head &amp; more</h1><p><b>One\n  two&nbsp;three.<br>four<br><p>Five <i>six</i>.</p><aside>side</aside><form>f</form><div class="cookie-notice">ok</div><p>I am <!-- c --> here</p>'
        '<section id="comments"><p>nice post</p></section></article><footer>&copy; x</footer></body></html>'
    )
    got = [t for k, t in html_text.page_blocks(page) if k == html_text.ARTICLE]
    assert got == ["Head & more", "One two three. four", "Five six.", "I am here"]


def test_pages_without_articles_lose_what_the_host_repeats(spark):
    note = "please accept all of our very nice cookies now or go away"
    rows = [(k, f"http://h{k % 2}.org/{k}", f"<body><div>{note}</div><p>page {k} has text of its own number {k * 7} only here and {k}</p></body>") for k in range(12)]
    rows += [(50, None, None), (51, "http://x.org", ""), (52, "bad url", f"<body><p>{note}</p></body>"), (53, "http://h0.org/a", "<article><p>" + note + "</p></article>")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id bigint, url string, html string, row int, place int")
    got = {r.page_id: r for r in html_text.main_text(df).collect()}
    assert got[3].text == "page 3 has text of its own number 21 only here and 3" and got[3].n_chars == len(got[3].text)
    assert got[50].text == "" and got[51].text == "" and got[52].text == note and got[53].text == note and got[53].url == "http://h0.org/a"
    assert html_text.main_text(df.limit(0)).count() == 0


def host_of(n):
    few, two = "this notice stands on just three of the pages of the host", "that other notice stands on only two of the many pages here"
    split = "<p>one two three four</p><p>five six seven eight</p>"
    rows = []
    for k in range(n):
        own = f"page {k} has text of its own number {k * 7} only here and {k}"
        more = f"<p>{few}</p>" if k in (3, 17, 31) else f"<p>{two}</p>" if k in (5, 25) else split if k in (2, 20, 38) else ""
        rows.append((k, "http://hot.org/", f"<body><p>{own}</p>{more}</body>"))
    return rows, few, two


def test_repeats_of_a_host_count_over_all_of_its_pages(spark):
    rows, few, two = host_of(40)
    rows += [(90, "http://hot.org/", f"<article><p>body</p></article><nav>{two}</nav>"), (91, "http://cold.org/", f"<body><p>{few}</p></body>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    # the third page with ``two`` has it in a menu beside its article, and counts
    assert all(got[k] == f"page {k} has text of its own number {k * 7} only here and {k}" for k in range(40))
    assert got[90] == "body" and got[91] == few
    got = {r.page_id: r.text for r in html_text.main_text(df.where("page_id <> 90")).collect()}
    assert all(got[k].endswith("\n" + two) for k in (5, 25))


def plain_main_text(rows):
    """Counts every run of every page in dictionaries."""
    from urllib.parse import urlparse

    hosts = {}
    for _, url, page in rows:
        hosts.setdefault(urlparse(url or "").hostname or "", []).append([(k, t.split(" ")) for k, t in html_text.page_blocks(page or "") if k != "article"])
    shared = {}
    for host, pages in hosts.items():
        n = {}
        for blocks in pages:
            flat = [t for _, b in blocks for t in b]
            seen = {("across", tuple(flat[k : k + 8])) for k in range(len(flat) - 7)} | {("inside", tuple(b[k : k + 8])) for _, b in blocks for k in range(len(b) - 7)}
            for run in seen:
                n[run] = n.get(run, 0) + 1
        shared[host] = {run for run, m in n.items() if m >= 3}
    out = {}
    for page_id, url, page in rows:
        found, known = html_text.page_blocks(page or ""), shared[urlparse(url or "").hostname or ""]
        if any(k == "article" for k, _ in found):
            out[page_id] = "\n".join(t for k, t in found if k == "article")
            continue
        flat = [(t, i) for i, (_, b) in enumerate(found) for t in b.split(" ")]
        gone, filled = [False] * len(flat), [False] * len(flat)
        for k in range(len(flat) - 7):
            run = tuple(t for t, _ in flat[k : k + 8])
            if ("inside", run) in known and flat[k][1] == flat[k + 7][1]:
                gone[k : k + 8] = [True] * 8
            if ("across", run) in known:
                filled[k : k + 8] = [True] * 8
        texts = []
        for i, (kind, _) in enumerate(found):
            own = [k for k, (_, j) in enumerate(flat) if j == i]
            left = [] if all(filled[k] for k in own) else [flat[k][0] for k in own if not gone[k]]
            if kind == "loose" and left:
                texts.append(" ".join(left))
        out[page_id] = "\n".join(texts)
    return out


def random_pages(n, seed=3):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(12)]
    notes = [" ".join(rnd.choice(words) for _ in range(rnd.randint(6, 14))) for _ in range(20)]
    rows = []
    for k in range(n):
        parts = [rnd.choice(notes) if rnd.random() < 0.5 else " ".join(rnd.choice(words) + str(rnd.randrange(60)) for _ in range(rnd.randint(1, 12))) for _ in range(rnd.randint(0, 6))]
        tags = [f"<{t}>{p}</{t}>" for p in parts for t in [rnd.choice(["p", "div", "nav", "footer"])]]
        body = "".join(tags)
        rows.append((k, f"http://h{min(2, rnd.randrange(6))}.org/x", f"<body>{body}</body>" if rnd.random() < 0.8 else f"<body><article>{body}</article>{rnd.choice(notes)}</body>"))
    return rows + [(n, None, None), (n + 1, "http://h0.org", ""), (n + 2, "http://h0.org", rows[0][2])]


@pytest.mark.parametrize("parts", [1, 7, 211])
def test_main_text_against_brute_force_however_pages_are_dealt(spark, parts):
    rows = random_pages(260)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, page string, host string").repartition(parts)
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    want = plain_main_text(rows)
    assert got == want
    assert sum(want[k] != "\n".join(t for kind, t in html_text.page_blocks(p or "") if kind == "loose") for k, _, p in rows) > 50


def test_a_host_of_many_pages(spark):
    rows, few, two = host_of(5000)
    for parts in (1, 7):
        got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)).collect()}
        assert sum(few in t for t in got.values()) == 0 and sum(two in t for t in got.values()) == 2
        assert all(got[k].startswith(f"page {k} has text of its own number") for k in range(5000))


def noted(n, note, tag="div", host="n.org"):
    return [(f"http://{host}/{k}", f"<article><h1>head {k}</h1><p>page {k} of {host} has text of its own number {k * 7} only here</p><p>and more of it</p><{tag}>{note}</{tag}></article>") for k in range(n)]


def left_of_pages(spark, pages):
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], "page_id bigint, url string, html string")
    return [r.text for r in html_text.main_text(df).orderBy("page_id").collect()]


NOTE = "sign up now for the weekly letter of this very fine site and miss nothing"


@pytest.mark.parametrize("n,tag,stays", [(3, "div", False), (2, "div", True), (12, "p", False), (9, "p", True), (12, "section", False)])
def test_notices_inside_articles_go_where_most_articles_of_the_host_hold_them(spark, n, tag, stays):
    got = left_of_pages(spark, noted(n, NOTE, tag) + noted(4, "some other words that only few of them will ever say", "p", "other.org"))
    assert [NOTE in t for t in got] == [stays] * n + [False] * 4
    assert all(t.startswith(f"head {k}\npage {k} of n.org has text of its own number {k * 7} only here") for k, t in enumerate(got[:n]))
    assert all(t.endswith("\nsome other words that only few of them will ever say") for t in got[n:])


def test_shared_text_of_some_articles_stays(spark):
    few = noted(4, NOTE) + noted(9, "nothing", "div")[4:]
    copies = [(f"http://copy.org/{k}", f"<article><div>{NOTE}</div><div>and {NOTE} again</div><p>{k}</p></article>") for k in range(5)]
    inside = [(f"http://in.org/{k}", f"<article><p>head of page {k} and text of its own {k} here</p><div>own {k} {NOTE}</div></article>") for k in range(5)]
    short = noted(6, "read more of this", "div", "short.org")
    got = left_of_pages(spark, few + copies + inside + short)
    assert [NOTE in t for t in got] == [True] * 4 + [False] * 5 + [True] * 10 + [False] * 6
    assert all(t == f"{NOTE}\nand {NOTE} again\n{k}" for k, t in enumerate(got[9:14])) and all(t.endswith("\nread more of this") for t in got[19:])


def plain_articles(rows):
    """Counts tiles of article blocks in dictionaries."""
    from urllib.parse import urlparse

    def cut(text):
        t = text.split(" ")
        return {tuple(t[k : k + 8]) for k in (*range(0, len(t) - 8, 8), len(t) - 8)} if len(t) >= 8 else set()

    hosts, out = {}, {}
    for page_id, url, page in rows:
        own = [(t, opened) for k, t, opened in html_text.opened_blocks(page or "") if k == "article"]
        if own:
            hosts.setdefault(urlparse(url or "").hostname or "", []).append((page_id, own))
    for pages in hosts.values():
        n = {}
        for _, own in pages:
            for run in {r for t, _ in own for r in cut(t)}:
                n[run] = n.get(run, 0) + 1
        for page_id, own in pages:
            low = [min(map(n.get, cut(t)), default=0) for t, _ in own]
            go = [v >= 10 and v > 0.9 * len(pages) if opened else v >= 3 and v > 0.5 * len(pages) for v, (_, opened) in zip(low, own)]
            lost = sum(len(t.split(" ")) for (t, _), g in zip(own, go) if g)
            whole = 2 * lost >= sum(len(t.split(" ")) for t, _ in own)
            out[page_id] = "\n".join(t for (t, _), g in zip(own, go) if whole or not g)
    return out


@pytest.mark.parametrize("parts", [1, 7, 211])
def test_articles_against_brute_force_however_pages_are_dealt(spark, parts):
    rnd = random.Random(9)
    notes = [" ".join(rnd.choice("abcdefg") + str(rnd.randrange(9)) for _ in range(rnd.randint(5, 30))) for _ in range(6)]
    often = [0.2, 0.45, 0.55, 0.8, 0.95, 1.0]
    rows = []
    for k in range(200):
        parts_of = [f"<{t}>{n}</{t}>" for n, f in zip(notes, often) if rnd.random() < f for t in [rnd.choice(["p", "div", "li"] if n != notes[5] else ["p"])]]
        parts_of += ["<p>" + " ".join(f"w{rnd.randrange(4000)}" for _ in range(rnd.randint(1, 90))) + "</p>" for _ in range(rnd.randint(0, 4))]
        rnd.shuffle(parts_of)
        rows.append((k, rnd.choice([f"http://h{k % 3}.org/{k}", f"http://s{k % 40}.org/", None]), f"<body><nav>{notes[0]}</nav><main>{''.join(parts_of)}</main></body>"))
    rows += [(200, "http://h0.org", rows[0][2]), (201, "http://h1.org", "<article></article>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    want = plain_articles(rows)
    assert {k: got[k] for k in want} == want and len(got) == len(rows)
    before = {k: "\n".join(t for kind, t in html_text.page_blocks(p) if kind == "article") for k, _, p in rows}
    assert 30 < sum(want[k] != before[k] for k in want) < len(want)


def test_boilerplate_counts_what_the_array_removes(spark):
    note = "please accept all of our very nice cookies now or go away"
    rows = [(k, "http://a.org", f"<nav>{note}</nav><article><p>{note}</p></article><footer>own {k}</footer>") for k in range(4)]
    got = html_text.boilerplate(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert [(r.outside, r.covered) for r in got] == [(14, 12)] * 4


@pytest.mark.parametrize("page,want", [
    ('<article class="post comments-open has-sidebar"><p>a b</p></article>', ["a b"]),
    ('<main class="no-sidebar"><section class="related-work"><p>a</p></section><div class="social-history">b</div></main>', ["a", "b"]),
    ("<article><p>one<button>x<p>two</p><select><option>y<p>three</p></article>", ["onex", "two", "y", "three"]),
    ("<article><p>one<button>x</button> two <svg><title>t</title></svg>three</p></article>", ["one two three"]),
    ('<article><p title="a<b">q</p><p data-x="1>2" class=big>r</p></article>', ["q", "r"]),
    ('<article><p>x &lt; y <a href="u">z</a> 1 < 2</p><div class="site-footer">f</div><div id="comment-list">c</div><div class="ad-slot-3">d</div></article>', ["x < y z 1 < 2"]),
    ('<article><p>a</p><script>"</p><button>"</script><p>b</p><textarea>c</textarea></article>', ["a", "b"]),
    ('<body><form id="page"><main><article><p>a</p><form><p>mail</p></form><p>b</p></article></main><p>c</p></form></body>', ["a", "b"]),
    ('<nav><form><article>menu</article></form></nav><form><nav><article>n</article></nav><div><article>a</article></div></form>', ["a"]),
    ('<article><p>a</p><article class="comment"><p>c</p></article><article class="comment-body">d</article><div class="user-comments">e</div><ul id="reader-comments"><li>f</li></ul><p>b</p></article>', ["a", "b"]),
    ('<article class="comment"><p>c</p></article><article class="has-comments post"><p>a</p></article>', ["a"]),
    ('<article><p>a</p><div class="ad-300x250">x</div><div class="google-ads">y</div><div class="cookie-bar-v2">z</div><section class="sponsored-content">s</section></article>', ["a"]),
    ('<article><section class="share"><p>a</p></section><section id="menu"><p>b</p></section><section class="comments">c</section></article>', ["a", "b"]),
])
def test_article_blocks_of_odd_pages(page, want):
    assert [t for k, t in html_text.page_blocks(page) if k == html_text.ARTICLE] == want


def test_very_long_pages(spark):
    para = "some words of a very long page " * 30
    page = "<article>" + f"<p>{para}</p><button>" * 3000 + "</article>" + "<nav>menu</nav>" * 2000
    got = html_text.main_text(spark.createDataFrame([(1, "http://a.org", page)], "page_id bigint, url string, html string")).collect()
    assert got[0].n_chars == 3000 * (len(para.strip()) + 1) - 1


def test_covered_tokens():
    a = "one two three four five six".split()
    got = html_text.covered_tokens([[["x", *a, "y"]], [[*a, "z"]], [["q"], a], [a[:3]]], run=6, pages=3)
    assert [list(g) for g in got] == [[False] + [True] * 6 + [False], [True] * 6 + [False], [False] + [True] * 6, [False] * 3]
    split = html_text.covered_tokens([[a[:2], a[2:], ["k", "one"]]] * 3 + [[["own"], a[:2], a[2:4]]], run=6, pages=3)
    assert [list(g) for g in split] == [[True] * 8] * 3 + [[False] * 5]


def test_forest_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2500, 24)).astype(np.float32)
    rows = [(k, [float(v) for v in r]) for k, r in enumerate(x)] + [(9000, [0.0] * 24), (9100, None), (9200, [float("inf")] * 24), (9300, [1.0]), (9001, [float(v) for v in x[100]]), (9002, [float(v) for v in x[100]])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id bigint, embedding array<float>, leaf int")
    got = forest.nearest(df, df.where("vec_id % 100 = 0")).collect()
    fine = {k: np.array(v) for k, v in rows if v and len(v) == 24 and np.isfinite(v).all() and any(v)}
    ids = np.array(list(fine))
    all_ = np.stack(list(fine.values()))
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((all_ - fine[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]])
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        assert all(r.score == d[ids == r.vec_id][0] for r in mine)
        hits += len(best & {r.vec_id for r in mine})
        total += 10
    assert hits / total >= 0.9
    assert {r.vec_id for r in got if r.query_id == 100 and r.score == 0} == {9001, 9002}
    small = df.where("vec_id in (0, 1, 2)")
    assert forest.nearest(small, small.where("vec_id = 0")).count() == 2
    assert forest.nearest(df.limit(0), df.limit(0)).count() == 0


def test_a_neighbour_repeated_often_takes_one_place(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    x[1] = x[0] + 0.01
    rows = [(k, [float(v) for v in r]) for k, r in enumerate(x)]
    df = spark.createDataFrame(rows + [rows[1]] * 19, "vec_id bigint, embedding array<float>")
    got = sorted(forest.nearest(df, df.where("vec_id = 0"), trees=1, depth=1).collect(), key=lambda r: r["rank"])
    d = np.sqrt(((x.astype(float) - x[0].astype(float)) ** 2).sum(1))
    d[0] = np.inf
    assert [r.vec_id for r in got] == np.lexsort((np.arange(60), d))[:10].tolist()


def test_vectors_of_one_id_at_one_distance_take_one_place(spark):
    rows = [(0, [1.0] + [0.0] * 15), (5, [1.0, 9.0] + [0.0] * 14)]
    for k in range(1, 16):
        rows.append((1, [1.0] + [0.5 if j == k else 0.0 for j in range(1, 16)]))
        rows.append((100 + k, [1.0 + k] + [0.0] * 15))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted(forest.nearest(df, df.where("vec_id = 0"), trees=1, depth=1).collect(), key=lambda r: r["rank"])
    assert [r.vec_id for r in got] == [1, 101, 102, 103, 104, 105, 106, 107, 108, 5]


def test_any_white_space_parts_words():
    scorer = toxicity.ClauseScorer({"moron": 2.0})
    f = lambda t: dict(zip(toxicity.FEATURES, np.expm1(scorer.features(t)).round(6)))
    assert f("what\na\nmoron\nhe\nis")["plain"] == 2.0
    assert f("you\tare a\u00a0moron")["targeted"] == 2.0
    assert f("you \r\n moron")["plain"] == 2.0 and f("not you\n\nmoron")["plain"] == 2.0
    assert f(" \n ")["plain"] == 0.0
    assert toxicity.terms_of("what\na\tmoron\n") == {"what", "a", "moron", "moro*"}
    assert toxicity.terms_of("he is not a moron. she said scum") == {"he", "is", "not", "she", "said"}


def test_only_copies_leave_the_labelled_rows(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(500)}" for _ in range(200)]
    near = [*base[:190], *(f"n{k}" for k in range(10))]
    half = [*base[:100], *(f"h{k}" for k in range(100))]
    texts = [" ".join(base), " ".join(base), " ".join(near), " ".join(half), "moron", "idiot", "", None, "moron", "a b", "c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = [(k, 1, 2) for k in range(len(texts))]
    kept = [r[0] for r in toxicity.unlike(docs, rows, "doc_id", "text")]
    assert kept == [0, 3, 4, 5, 6, 9, 10]
    assert [r[0] for r in toxicity.unlike(docs, [(0, 1, 2), (1, 0, 2)], "doc_id", "text")] == [0, 1]  # labels that differ are no copies
    assert [len(toxicity.minima(t)) for t in ("", "x", "x y " * 20_000)] == [toxicity.MINIMA] * 3
