import random
from collections import Counter as Multiset

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyworks.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "b", "  ", "\n", "\t", " ", "é", "é", "ß", "1", "22", "'s", "'", "the", " The", "日本", "\x1c", "\x85", "　", "Σ",
          "ΑΣ", "İ", "🙂", "---", "====", "​", "aaaa", "<|endoftext|>", "<|startoftext|>", "<|", "́", "Å", "½", "²",
          "\x00", "ǅ", "ẞ", "'S", "ﬁ", "|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    draw = random.Random(4)
    made = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 50))) for _ in range(600)]
    made += ["".join(chr(draw.randint(1, 0x2FFF)) for _ in range(60)) for _ in range(100)]
    return [*made, "", " ", "a" * 30_000, "x y " * 40_000, "ab<|endoftext|>" * 300]


def test_counts_are_the_library_s(frame, library):
    rows = [(n, t) for n, t in enumerate(texts())] + [(None, None), (0, "twice"), (0, "twice")]
    found = token_counts.count_tokens(frame(rows, clash=True), PATH).collect()
    expected = Multiset()
    for doc, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected[doc, len((text or "").encode()), n, n > 2048] += 1
    assert Multiset((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found) == expected
    assert {r["key"] for r in found} == {"own"}
    assert token_counts.count_tokens(frame([]), PATH).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_chunks_compose(library, size):
    counter = token_counts.counter(PATH)
    for text in texts()[:300]:
        assert counter.count_long(text, size) == counter.count(text)


def test_prefixes_by_doubling():
    counter = token_counts.counter(PATH)
    text = "one two three<|endoftext|> four five-six seven 8 nine's ten" * 3
    maps = [counter.chunk(text[k:k + 5]) for k in range(0, len(text), 5)]
    for n, m in enumerate(counter.prefixes(maps)):
        assert counter.total(m) == counter.count(text[:5 * (n + 1)])


def test_starting_over_changes_nothing(monkeypatch):
    counter = token_counts.Counter(PATH)
    words = ["there", "theremin", "thereupon", "ion", "nation", "nations"]
    before = [counter.count(w) for w in words]
    monkeypatch.setattr(token_counts, "STATES", 3)
    monkeypatch.setattr(token_counts.Remembered, "REMEMBERED", 2)
    small = token_counts.Counter(PATH)
    assert [small.count(w) for w in words * 2] == before * 2
