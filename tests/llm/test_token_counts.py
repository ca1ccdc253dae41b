import cases
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
OWN = token_counts.PieceCounts(MODEL)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "   ", "\n", "\t", "the", "tion", "Word", "aaa", "é", "▁", "<s>", "</s>", "<0x0A>", "<unk>", "\U0001f600", "中", "1", ".", "　"]), max_size=14).map("".join))
def test_counts_equal_the_library(text):
    assert OWN.count(text) == len(LIBRARY.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(text):
    assert OWN.count(text) == len(LIBRARY.encode(text))


def test_table(spark):
    texts = [*cases.AWKWARD, "ab" * 4096]
    ids = [*cases.AWKWARD_IDS, 99]
    got = token_counts.count_tokens(cases.docs(spark, texts, ids), MODEL).collect()
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t in zip(ids, texts, strict=True)]
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_tokens) for r in got))) == sorted(map(repr, want))
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert any(r.over_limit for r in got)


def test_empty(spark):
    assert token_counts.count_tokens(cases.empty(spark), MODEL).count() == 0


def test_bounded_table(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_SEGMENTS", 3)
    counts = token_counts.PieceCounts(MODEL)
    text = " ".join(f"w{i}x" for i in range(50))
    assert counts.count(text) == len(LIBRARY.encode(text)) and len(counts.known) <= 3
