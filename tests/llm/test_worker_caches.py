"""What a Python worker keeps from one operator is gone once it serves another, so that an executor's memory doesn't add up."""

import numpy as np
import pyarrow as pa

from paymart.llm import common, prob_minhash, suffix_dedup, token_cache


def batches(n=3):
    return [pa.RecordBatch.from_pydict({"t": ["a b c d e f", "", None]}) for _ in range(n)]


def test_a_task_empties_the_caches_of_other_operators():
    encoder = token_cache.library_encoder(token_cache.default_tokenizer())
    prob_minhash.shingles("a b c d e f")
    suffix_dedup._powers(10)
    assert list(common.runs(batches(), "t", 1, "words")) and prob_minhash._WORD_HASHES
    assert not token_cache._ENCODERS and not suffix_dedup._POWERS
    assert [x.tolist() for x in suffix_dedup._powers(2)][0][0] == 1  # made anew
    assert token_cache.library_encoder(token_cache.default_tokenizer()) is not encoder
    rows = [r for batch in common.runs(batches(), "t", 4) for r in batch.column("t").to_pylist()]
    assert rows == ["a b c d e f", "", None] * 3
    assert not prob_minhash._WORD_HASHES and not token_cache._ENCODERS and not suffix_dedup._POWERS


def test_a_task_keeps_the_cache_that_it_uses():
    encoder = token_cache.library_encoder(token_cache.default_tokenizer())
    want = encoder.encode(["a b", ""])
    for _ in common.runs(batches(), "t", 4, "tokens"):
        assert token_cache.library_encoder(token_cache.default_tokenizer()) is encoder
    assert token_cache.library_encoder(token_cache.default_tokenizer()) is encoder and encoder.encode(["a b", ""]) == want


def test_words_are_bounded():
    for k in range(5):
        prob_minhash.shingles(" ".join(f"word{k}_{i}" for i in range(60_000)))
    assert len(prob_minhash._WORD_HASHES) <= 260_000


def test_words_are_encoded_once_whatever_their_case_and_marks():
    encoder = token_cache.LibraryEncoder(token_cache.default_tokenizer())
    given = []
    words = encoder._words
    encoder._words = lambda items: (given.extend(items), words(items))[1]
    text = "Éa Word, word WORD! (word) word.\nsecond été ÉTÉ... été; éa"
    want = np.array(encoder.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode([text, "", "word second;"])[0] == want
    assert sorted(given) == ["second", "word", "éa", "été"]
    assert encoder.encode([text]) == [want] and len(given) == 4
