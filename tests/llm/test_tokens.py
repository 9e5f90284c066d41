import random

import public_tokenizers
from filegate.llm.tokens import TokenCounter, count_tokens
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(texts):
    t = Tokenizer.from_file(PATH)
    return [len(t.encode(x, add_special_tokens=False)) for x in texts]


def odd_text(rng, n):
    parts = ["the", " river", "  ", "\n\n", "don't", "'re", "'", "<|endoftext|>", "<|end", "12345", " ,.;", "Ünï", "日本",
             "🙂", "x" * 40, " " * 30, "\t", "A", "'l", "l", "\x1c", "\x85", "᠎", "İ"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_chunks_are_spliced_without_a_difference():
    rng = random.Random(5)
    texts = [odd_text(rng, rng.randrange(1, 300)) for _ in range(150)]
    texts += ["x" * 3000, " " * 3000 + "a", "a" + " " * 3000, "<|endoftext|>" * 200, "ab " * 2000, "", "é" * 500]
    want = whole(texts)
    for chunk, overlap in ((80, 20), (200, 40), (700, 17)):
        assert TokenCounter(PATH, chunk, overlap).count(texts) == want
    assert TokenCounter(PATH).count(texts) == want


def test_table_counts(spark, odd, no_docs):
    rows = count_tokens(odd, PATH, chunk_chars=1000, overlap_chars=50).collect()
    texts = [r["text"] or "" for r in odd.collect()]
    assert sorted((len(t.encode()), n, n > 512) for t, n in zip(texts, whole(texts), strict=True)) == sorted(
        (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows)
    assert count_tokens(no_docs, PATH).collect() == []
