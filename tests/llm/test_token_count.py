from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

from tariffloom.llm.token_count import Counter, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_the_library_gives_the_same(spark, odd, odd_texts, none):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(odd, PATH).collect())
    counts = library([t or "" for _, t in odd_texts])
    assert got == sorted((str(i), len((t or "").encode()), n, n > 2048) for (i, t), n in zip(odd_texts, counts))
    assert token_counts(none, PATH).count() == 0


def test_odd_characters():
    rng = random.Random(1)
    chars = "abcdeéÉßöÄñ '!?.,-0123 \n\t<|>$%&* \u2019\u2013\u0130\u0131\u017f\u212a\u03a3\u03c2日е\u0301😀\u00ad\u00aa\u00ba²½\u01c5\u02b0\x00\x1c\x85\u00a0\u3000"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["<|endoftext|>a<|startoftext|><|ENDOFTEXT|>", "it's 'LL we'd", "a" * 3000, "etaoin" * 500, "abab" * 99]
    assert Counter(PATH).count(texts) == library(texts)


def test_leftmost_merging_is_the_same_where_both_are_right():
    words = [w.encode() for w in ("aaaaa", "banana", "thethethe", "x", "mississippi", "aa" * 40)]
    counter = Counter(PATH)
    assert counter.merges.together
    together = counter.merges.counts(words).tolist()
    counter.merges.together = False
    assert counter.merges.counts(words).tolist() == together
