import hashlib

import cases
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from bayline.llm import bpe
from bayline.llm.common import table

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(bpe.VOCABULARY)
TEXTS = st.one_of(
    st.text(max_size=60), st.text(alphabet="aehinrst", max_size=40), st.text(alphabet="a😂❤️o", max_size=30),
    st.text(st.characters(max_codepoint=255), max_size=40),
    st.lists(st.sampled_from([
        "the", " ", "\n", "\t", "'s", "'S", "’s", "IT", "é", "É", "İ", "ß", "ΟΔΟΣ", "क़", "½", "12", "…", "--", ",", "\x00",
        "<|endoftext|>", "<|startoftext|>", "<|endof", "\x1c", "\x85", "\xa0", "　", "🎉", "日本", "_", "ǅ", "ﬁ", "\x7f", "²", "ª", "µ", "À", "×", "\xad", "¼",
    ]), max_size=12).map("".join))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.TextEncoder(PATH)


def wanted(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


@settings(max_examples=600, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_encodes_and_decodes_as_the_library(encoder, library, texts):
    assert encoder(texts) == [wanted(library, t) for t in texts]


def test_every_token_and_its_neighbours(encoder, library):
    tokens = [t.replace("</w>", "") for t in library.get_vocab()]
    texts = ["".join(tokens[i:i + 3]) for i in range(0, len(tokens), 7)]
    assert encoder(texts) == [wanted(library, t) for t in texts]


def test_merges_only_build_on_earlier_ones(encoder):
    """What makes the last token of a prefix unique."""
    model = encoder.model
    made = {}
    for (left, right), rank in model.ranks.items():
        assert made.setdefault(left + right, rank) == rank
    for (left, right), rank in model.ranks.items():
        assert made.get(left, -1) < rank and made.get(right, -1) < rank


@settings(max_examples=1000, deadline=None)
@given(st.data())
def test_tokens_follow_each_other_as_plain_merging_has_it(encoder, data):
    model = encoder.model
    some = [i for i, s in model.symbols.items() if len(s) < 7 and ord(s[-1]) < 0x1000]
    left, right = data.draw(st.sampled_from(some[:2000])), data.draw(st.sampled_from(some))
    if model.stands(left):
        tokens = [model.symbols[left], model.symbols[right]]
        assert model.may_follow(left, right) == (model.merged("".join(tokens)) == tokens)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abc", min_size=1, max_size=8), max_size=30))
def test_a_walk_of_the_trie_meets_every_word_once(words):
    words = words | {w * 30 for w in words}
    path, found = "", []
    for depth, label, is_word in bpe.Trie(words).walk():
        path = path[:depth] + label
        found += [path] * is_word
    assert sorted(found) == sorted(words)


def test_shared_prefixes_are_worked_out_once():
    words = ["abcdef" + x for x in "ghij"]
    assert sum(len(label) for _, label, _ in bpe.Trie(words).walk()) == 6 + 4
    long = ["x" * 100_000 + "y", "x" * 100_000]
    assert len(list(bpe.Trie(long).walk())) == bpe.Trie.DEEPEST + 2


def test_long_words_and_bounded_memory(encoder, library, monkeypatch):
    texts = ["ab" * 30_000, "x" * 70 + " " + "日本" * 500, "."]
    assert encoder(texts) == [wanted(library, t) for t in texts]
    assert not any(len(w) > 64 for w in encoder.ids)
    monkeypatch.setattr(bpe, "_KNOWN_WORDS", 5)
    monkeypatch.setattr(bpe, "_KNOWN_PAIRS", 5)
    texts = ["many different words are forgotten again", "different words"]
    assert encoder(texts) == encoder(texts) == [wanted(library, t) for t in texts]


def test_documents(spark, library):
    docs = table(spark, SF, "documents")
    found = {r.doc_id: tuple(r)[1:] for r in bpe.encode_decode(docs).collect()}
    for r in docs.collect():
        n, ids, decoded = wanted(library, r.text)
        assert found[r.doc_id] == (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_odd_rows(spark, library):
    found = bpe.encode_decode(cases.frame(spark), digests=False).collect()
    want = [(r[0], wanted(library, r[1])) for r in cases.rows()]
    assert sorted((str(r.doc_id), r.n_tokens, " ".join(map(str, r.ids)), r.decoded) for r in found) == sorted(
        (str(i), *w) for i, w in want)
    digests = bpe.encode_decode(cases.frame(spark))
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and digests.count() == len(want)
    assert bpe.encode_decode(cases.empty(spark)).count() == 0
