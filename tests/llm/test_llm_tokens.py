"""Byte-level BPE, length histogram, packing and SentencePiece against the libraries."""

import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import SCHEMA, odd_rows
from wxlake.llm import bpe, packing, pieces, queries, token_counts

SF = "/root/testdata/sf0.001"
BITS = ["a", "b", " ", "  ", "\n", "\t", "é", "中", "1", "▁", "the", "ing", "'s", "!", "\u00a0", "\x00"]
TEXT = st.lists(st.sampled_from(BITS), max_size=60).map("".join)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def numbers(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_units_encode_as_the_library(library):
    coder = bpe.encoder()

    @settings(max_examples=150, deadline=None)
    @given(st.lists(TEXT, max_size=4))
    def check(texts):
        assert [numbers(x) for x in coder.encode(texts)] == [library(t) for t in texts]

    check()
    texts = [r[1] or "" for r in odd_rows()]
    assert [numbers(x) for x in coder.encode(texts)] == [library(t) for t in texts]


def test_vocabulary_of_the_file(tmp_path):
    ranks, special = bpe.read_vocabulary(bpe.VOCABULARY)
    assert special == {"<|endoftext|>": 50256} and len(ranks) == 50256 and sorted(ranks.values()) == list(range(50256))
    assert {bytes([b]) for b in range(256)} <= set(ranks)
    swapped = {"model": {"vocab": {"a": 0, "b": 1, "aa": 257, "bb": 256}, "merges": [["a", "a"], ["b", "b"]]}, "added_tokens": []}
    (tmp_path / "swapped.json").write_text(json.dumps(swapped))
    with pytest.raises(ValueError, match="order of their merges"):
        bpe.read_vocabulary(str(tmp_path / "swapped.json"))


def test_units_start_anew_when_there_are_many(library):
    coder = bpe.UnitEncoder(keep=3)
    for text in ("a bc d ef", "gh i bc d", "a a a"):
        assert numbers(coder.encode([text])[0]) == library(text)


def test_suffix_sums_answer_every_limit(spark, library):
    rows = odd_rows()
    sums = token_counts.suffix_sums(token_counts.length_histogram(
        token_counts.token_lengths(spark.createDataFrame(rows, SCHEMA))), block=16)
    lengths = [len(library(r[1])) for r in rows]
    for r in sums.collect():
        n = r.n_tokens
        assert r.n_docs == lengths.count(n) and r.docs_up_to == sum(x <= n for x in lengths)
        assert r.docs_at_least == sum(x >= n for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.truncated_tokens == sum(min(x, n) for x in lengths) and r.total_tokens == sum(lengths)
    limits = [1, 2, 5, 100, 2048, 10**6]
    found = {r.context: r for r in token_counts.at_limits(sums, limits).collect()}
    for limit in limits:
        assert found[limit].truncated_tokens == sum(min(x, limit) for x in lengths)
        assert found[limit].docs_cut == sum(x > limit for x in lengths)
    assert token_counts.quantile_length(sums, 0.5).first()[0] == sorted(lengths)[-(-len(lengths) // 2) - 1]
    empty = token_counts.token_lengths(spark.createDataFrame([], SCHEMA))
    assert token_counts.suffix_sums(token_counts.length_histogram(empty)).count() == 0


def test_best_fit_fills_sequences_without_gaps():
    pick = random.Random(3)
    for _ in range(30):
        capacity = pick.choice([5, 16, 64])
        counts = Counter(pick.randint(1, capacity) for _ in range(pick.randint(0, 400)))
        filled = defaultdict(list)
        for length, first, last, copies, sequence, offset in packing.best_fit(counts, capacity):
            for i in range(last - first + 1):
                filled[sequence + i // copies].append((offset + i % copies * length, length))
        seen = Counter(length for own in filled.values() for _, length in own)
        assert seen == counts
        for own in filled.values():
            end = 0
            for offset, length in sorted(own):
                assert offset == end
                end += length
            assert end <= capacity
        # As best fit one by one.
        free = []
        for length in sorted(counts.elements(), reverse=True):
            fits = [f for f in free if f >= length]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - length)
            else:
                free.append(capacity - length)
        assert len(filled) == len(free)


def check_packing(rows, found, library, capacity=1024):
    tokens = defaultdict(list)
    for doc, text, *_ in rows:
        tokens[doc].append([*library(text), 2])
    want = Counter()
    for doc, own in tokens.items():
        for ids in own:
            for i, (start, length) in enumerate(packing.cut(len(ids), capacity)):
                part = np.array(ids[start : start + length], "<u4").tobytes()
                want[doc, i, start, length, zlib.crc32(part)] += 1
            assert sum(n for _, n in packing.cut(len(ids), capacity)) == len(ids)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity


def test_packing_of_odd_rows_and_of_a_table(spark, library):
    rows = odd_rows()
    check_packing(rows, packing.pack(spark.createDataFrame(rows, SCHEMA)).collect(), library)
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op4_best_fit_packing"](spark, SF).collect()
    check_packing(docs, found, library)
    used, least = len({r.sequence_id for r in found}), -(-sum(r.length for r in found) // 1024)
    assert used <= 1.05 * least + 1


def test_token_count_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()
    want = Counter(len(library(r.text)) for r in docs)
    found = queries.QUERIES["op1_token_counts"](spark, SF).collect()
    assert {r.n_tokens: r.n_docs for r in found} == dict(want)


def test_pieces_as_the_library(model):
    coder = pieces.PieceCoder(keep=50)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(TEXT, max_size=4))
    def encode(texts):
        found = coder.encode(texts)
        assert [numbers(x) for x in found] == [model.encode(t) for t in texts]
        assert [d.decode() for d in coder.decode(found)] == [model.decode(numbers(x)) for x in found]

    ids = st.lists(st.one_of(st.integers(1, 258), st.integers(259, 31999), st.sampled_from([1, 2, 259, 28705])), max_size=12)

    @settings(max_examples=200, deadline=None)
    @given(ids)
    def decode(own):
        assert coder.decode([np.array(own, "<u4").tobytes()])[0].decode() == model.decode(own)

    encode()
    decode()
    texts = ["ab" * 400, "a" * 999, "▁" * 77 + "x", " " * 300, "1234567890" * 30, *[r[1] or "" for r in odd_rows()]]
    assert [numbers(x) for x in coder.encode(texts)] == [model.encode(t) for t in texts]


def test_merges_of_pairs_that_make_better_ones():
    """Ties and new pairs of better rank are merged one after another."""
    coder = pieces.coder()
    own = pieces.PieceCoder.__new__(pieces.PieceCoder)
    own.__dict__.update(coder.__dict__)
    # Symbols 0..: aa -> 10 (rank 5), 10+b -> 11 (rank 1), b+a -> 12 (rank 5)
    table = {(0, 0): (5, 10), (10, 1): (1, 11), (1, 0): (5, 12), (12, 0): (5, 13)}
    own.pair_keys = np.array(sorted(a << pieces.SHIFT | b for a, b in table))
    own.pair_symbols = np.array([table[k >> pieces.SHIFT, k & (1 << pieces.SHIFT) - 1][1] for k in own.pair_keys.tolist()])
    own.pair_ranks = np.array([table[k >> pieces.SHIFT, k & (1 << pieces.SHIFT) - 1][0] for k in own.pair_keys.tolist()], np.int32)

    def plain(symbols):
        symbols = list(symbols)
        while True:
            best = min(((table[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in table), default=None)
            if best is None:
                return symbols
            i = best[1]
            symbols[i : i + 2] = [table[symbols[i], symbols[i + 1]][1]]

    pick = random.Random(4)
    for _ in range(300):
        texts = [[pick.randint(0, 1) for _ in range(pick.randint(1, 14))] for _ in range(4)]
        flat = np.array([s for t in texts for s in t])
        segment = np.repeat(np.arange(4), [len(t) for t in texts])
        place, symbols = own._merge(flat, segment)
        order = np.argsort(place)
        assert symbols[order].tolist() == [s for t in texts for s in plain(t)]


def test_sentencepiece_query(spark, model):
    rows = odd_rows()
    found = pieces.encode_and_decode(spark.createDataFrame(rows, SCHEMA)).collect()

    def digest(doc, text):
        ids = [1, *model.encode(text or ""), 2]
        return (doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(model.decode(ids).encode()).hexdigest())

    assert Counter(map(tuple, found)) == Counter(digest(r[0], r[1]) for r in rows)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op5_sentencepiece"](spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(digest(*r) for r in docs)
    assert pieces.encode_and_decode(spark.createDataFrame([], SCHEMA)).count() == 0
