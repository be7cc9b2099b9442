import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caseloom.llm import tokens
from caseloom.llm.queries import QUERIES

from .samples import documents, empty

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as f:
        return tokens.PrefixCounter(f.read())


def total(counter, text):
    sums = counter.count(text)
    return int(sums[-1]) if len(sums) else 0


def test_query_counts_as_the_library(spark, library):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op2_tokens"](spark, folder).collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 2048)


@pytest.mark.parametrize("text", [
    "", "it's they'll WE'RE we'Ve !!'ll 'll 'l x'", "<|endoftext|>a<|startoftext|> b <|endoftext|", "aaaaaaa aaaaaaaaaaaaaaaa " * 3,
    "ΑΣ Σ ὈΔΥΣΣΕΎΣ İstanbul x\x85y\x1cz", "日本語テキスト 12345 ½ ² Ⅳ", "é Å ﬁ é", "the quick 3.14 http://ex.com/a?b=c \x00",
])
def test_hard_texts(counter, library, text):
    assert total(counter, text) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeinorst'!. <|>ÉéßΣ日1²\n"), max_size=40) | st.text(max_size=20).filter(lambda s: s.encode("utf-8", "ignore").decode() == s))
def test_any_text(counter, library, text):
    assert total(counter, text) == len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix(counter, library):
    text = counter.normal("It's they'll we're x'll !!'ll 'll café naïve antidisestablishment 12 ")
    want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    assert counter.at(text, range(len(text) + 1)) == want
    for limit in range(0, want[-1] + 1):
        k = counter.cut(text, limit)
        assert want[k] <= limit and (k == len(text) or want[k + 1] > limit)


def test_awkward_rows(spark, library):
    docs = documents(spark)
    got = tokens.count_tokens(docs, PATH, limit=50)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "score", "kept", "size", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
    want = {r["n_chars"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["n_tokens"] == want[r["n_chars"]] and r["over_limit"] == (r["n_tokens"] > 50) == (r["fit_chars"] is not None)
    assert tokens.count_tokens(empty(spark), PATH).count() == 0


def test_other_models_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises((ValueError, KeyError)):
        tokens.PrefixCounter(f.read())
