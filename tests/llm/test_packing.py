import zlib
from collections import defaultdict

import cases
import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyframe.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
OWN = packing.ByteTokens(RANKS, public_tokenizers.PATTERN)


def same_ids(text):
    assert OWN.ids(text).tolist() == JSON.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_equal_the_tokenizer():
    for text in ["", " ", "  ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "a\n \nb", "\n\na  ", "I'm he'll 'tis", "x<|endoftext|>y <|endoftext|>", "<|endoftext|>", " a b 　c", "1,234.5 ½", "éé \U0001f600"]:
        same_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "word", ".", "é", "'s", "12", "<|endoftext|>", " ", "\x1c", "中"]), max_size=12).map("".join))
def test_ids_of_any_mix(text):
    same_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.sampled_from([8, 16, 32]))
def test_pieces_cover_and_fit(lengths, size):
    pieces = list(packing.pack(lengths, size))
    parts, used = defaultdict(list), defaultdict(list)
    for i, start, n, s, offset in pieces:
        assert n > 0
        parts[i].append((start, n))
        used[s].append((offset, n))
    for i, length in enumerate(lengths):
        at = 0
        for start, n in sorted(parts[i]):
            assert start == at
            at += n
        assert at == length
    for s in used:
        at = 0
        for offset, n in sorted(used[s]):
            assert offset == at
            at += n
        assert at <= size
    assert len(used) == -(-sum(lengths) // size) or not lengths or len(used) <= sum(x // size for x in lengths) + -(-sum(x % size for x in lengths) // size)


def test_costs_are_balanced():
    lengths = np.random.default_rng(1).integers(1, 400, 2000).tolist()
    costs, tokens = defaultdict(int), defaultdict(int)
    for _, _, n, s, _ in packing.pack(lengths, 1024):
        costs[s] += packing.cost(n)
        tokens[s] += n
    values = sorted(costs.values())
    assert values[-1] < 1.25 * values[len(values) // 2]
    assert sum(1024 - t for t in tokens.values()) < 1024


def test_table(spark):
    got = packing.pack_documents(cases.docs(spark, cases.AWKWARD, cases.AWKWARD_IDS), RANKS, public_tokenizers.PATTERN).collect()
    ids = [JSON.encode(t or "", add_special_tokens=False).ids + [0] for t in cases.AWKWARD]
    # documents by id and length, because ids repeat
    want = sorted((repr(i), len(x)) for i, x in zip(cases.AWKWARD_IDS, ids, strict=True) for _ in x)
    assert sorted((repr(r.doc_id), r.doc_tokens) for r in got for _ in range(r.length)) == want
    whole = {(i, len(x)): x for i, x in zip(cases.AWKWARD_IDS, ids, strict=True)}
    for r in got:
        part = whole[r.doc_id, r.doc_tokens][r.start : r.start + r.length]
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r.ids_crc32
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 1024


def test_empty(spark):
    assert packing.pack_documents(cases.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0
