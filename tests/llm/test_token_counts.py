from __future__ import annotations

import random

from siftledger.llm import token_counts

ODD = [
    "a  b", "a\t b\n\nc  ", " x   y", "  lead", "trail ", "a\x1c b", "it's 're  's", "\n", "   ",
    "<|endoftext|> a <|endoftext|>b  <|endoftext|>", "a\u0085b\u0085 c", "a \n b", "՘ ՘x",
    "tab\tand nbsp   em", "日本語 テキスト", "😀 😀😀", "x.<|endoftext|>. y",
]


def test_pre_tokens_are_the_text_and_keep_its_token_count():
    tokenizer = token_counts.tokenizer_at("byte_bpe_50k.json")
    draw = random.Random(2)
    texts = ODD + ["".join(draw.choice("ab .\n\t,'sé") for _ in range(60)) for _ in range(300)]
    for text in texts:
        parts = token_counts.pre_tokens(text)
        assert "".join(parts) == text
        whole = tokenizer.encode(text, add_special_tokens=False)
        split = [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids]
        assert split == whole.ids, repr(text)


def test_counts_against_the_library(awkward, documents):
    tokenizer = token_counts.tokenizer_at("byte_bpe_50k.json")
    more = documents(*enumerate(ODD, start=100))
    rows = awkward.unionByName(more)
    for frequent in (0, 5, 100_000):  # all joined, some, none
        found = token_counts.token_counts(rows, limit=10, frequent=frequent).collect()
        expected = []
        for r in rows.collect():
            text = r["text"] or ""
            n = len(tokenizer.encode(text, add_special_tokens=False).ids)
            expected.append((r["doc_id"], len(text.encode()), n, n > 10))
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_empty_table(documents):
    assert token_counts.token_counts(documents()).count() == 0
