"""Token counts, packing and byte-level BPE against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from pointloom.llm import byte_bpe, packing, token_counts

SCHEMA = "doc_id bigint, text string, ids string, lost string"
ODD = ["", None, " ", "\n\n  \n", "a", "Hello, world!  It's  fine.\n", "naïve café ß \U0001f600 漢字", "<|endoftext|> and <s> text", "x" * 700, "ab " * 900, "\x00\x1c\x1d tab\t", "don't we'll I'm 12345"]


def texts(n=60, seed=3):
    rnd = random.Random(seed)
    words = ["the", "tion", " and", "naïve", "Zü", "\n", "  ", "42", "!?", "漢", "é", "'s"]
    return ODD + ["".join(rnd.choice(words) + rnd.choice([" ", "", "\t"]) for _ in range(rnd.randint(1, 400))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "x", "y") for k, t in enumerate(texts())]
    return spark.createDataFrame(rows + [rows[5], (None, "no id", "x", "y")], SCHEMA)


def test_token_counts_follow_the_library(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for chunk in (token_counts.CHUNK, 200):
        got = token_counts.token_counts(docs, P.path("piece_bpe_32k.model"), limit=50, chunk=chunk).collect()
        want = sorted((-1 if r.doc_id is None else r.doc_id, len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in docs.collect())
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 50) for r in got)


def test_overlaps_widen_where_no_boundary_is_proven():
    counter = token_counts.PieceCounter(P.path("piece_bpe_32k.model"), chunk=120, overlap=4)
    for t in ["a" * 3000, "abcdefgh" * 300, "漢" * 900, " " * 1500, "x y" * 500, "".join(random.Random(2).choice("ab éz") for _ in range(4000))]:
        assert counter.spliced(t) == len(counter.sp.encode(t))
    assert counter.widened


def test_packing_places_each_id_once(spark, docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    args = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rows = docs.where("doc_id <> 5 or doc_id is null")
    got = packing.packed(rows, *args, window=128, with_ids=True).collect()
    want = {r.doc_id: lib.encode(r.text or "", add_special_tokens=False).ids + [0] for r in rows.collect()}
    for doc, ids in want.items():
        pieces = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert [i for r in pieces for i in r.ids] == ids
        assert all(r.doc_tokens == len(ids) and r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in pieces)
        at = 0
        for r in pieces:
            assert r.start == at
            at += r.length
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 128 and (at == 128 or at & (at - 1) == 0)


def test_packing_prefers_the_level_of_least_squares():
    p = packing.SumOfSquares(window=10)
    for k, n in enumerate((6, 6, 4, 4)):
        p.add(k, b"\1\0\0\0" * n)
    assert sorted(sorted(d for d, *_ in held) for held in p.closed) == [[0, 3], [1, 2]] and p.open == 0
    q = packing.SumOfSquares(window=10)
    for k, n in enumerate((4, 4)):  # 0 for going on to level 8, 3 for a second window at level 4
        q.add(k, b"\1\0\0\0" * n)
    assert q.counts[8] == 1 and q.open == 1
    p.add(9, b"\1\0\0\0" * 23)
    assert len(p.closed) == 4 and p.counts[3] == 1
    p.finish()
    assert sorted(sum(len(i) // 4 for _, _, i, _ in held) for held in p.closed[4:]) == [1, 2]


def test_byte_bpe_follows_the_library(spark, docs):
    import tiktoken

    ranks = byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True).collect()
    assert len(got) == docs.count()
    want = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in got:
        text = want[r.doc_id]
        ids = enc.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids) and r.is_utf8
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_transducer_on_random_bytes():
    ranks = byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    machine, rnd = byte_bpe.MergeTransducer(ranks), random.Random(4)
    for _ in range(400):
        data = bytes(rnd.choice(b"the ationing\xc3\xa9\xff\x00") for _ in range(rnd.randint(1, 40)))
        assert machine.tokens(data) == machine.merged(data)


def test_decoder_tells_cut_characters():
    ranks = byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    decoder = byte_bpe.StreamDecoder(ranks)
    one = lambda b: ranks[bytes([b])]
    assert decoder.decode(np.array([one(0xE6), one(0xBC), one(0xA2)])) == ("漢".encode(), True)
    assert decoder.decode(np.array([one(0xE6), one(0x41), one(0xA2)]))[1] is False
    assert decoder.decode(np.array([one(0xE6)]))[1] is False
    assert decoder.decode(np.array([one(0xED), one(0xA0), one(0x80)]))[1] is False


@pytest.mark.parametrize("f", [
    lambda d: token_counts.token_counts(d, P.path("piece_bpe_32k.model")),
    lambda d: packing.packed(d, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN),
    lambda d: byte_bpe.encode_decode(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN),
])
def test_empty_tables(spark, f):
    assert f(spark.createDataFrame([], SCHEMA)).count() == 0
