"""Stretches of plain letters are encoded without looking for words in them, with the same result."""

from __future__ import annotations

import public_tokenizers

from tarmac.llm.trie_bpe import load


def test_plain_letters_are_not_searched_for_words():
    tokenizer = load(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["plain words only", "it's x2 été don't-stop İstanbul ǆa", "<|endoftext|>plain"]
    texts += ["a" * 300, "", "x\x1fy"]
    tokenizer.forget()
    looked_at: list[str] = []
    usual = tokenizer._words_of
    tokenizer._words_of = lambda chunk: looked_at.append(chunk) or usual(chunk)
    try:
        got = list(tokenizer.encode_batch(texts))
        assert "plain" not in looked_at and "it's" in looked_at
        tokenizer.forget()
        tokenizer.letters_stay = False
        assert list(tokenizer.encode_batch(texts)) == got
    finally:
        tokenizer.letters_stay = True
        del tokenizer._words_of
        tokenizer.forget()
