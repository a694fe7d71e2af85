import base64
import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from tallyworks.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PIECES = ["a", "b", "  ", "\n", "\t", " ", "é", "ß", "1", "22", "'s", "'", "the", " the", "日本", "\x1c", "\x85", "　", "Σ", "🙂",
          "---", "====", "​", "aaaa", "<|endoftext|>", "\x00"]


@pytest.fixture(scope="module")
def coder():
    return bpe.coder(PATH, PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    draw = random.Random(1)
    made = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 80))) for _ in range(500)]
    made += ["".join(chr(draw.randint(1, 0x2FFF)) for _ in range(60)) for _ in range(100)]
    return [*made, "", " ", "a" * 20_000, "=" * 3000 + "x", "ab" * 5000, "the quick brown fox " * 2000]


def test_ids_are_the_library_s(frame, coder, library):
    rows = [(n, t) for n, t in enumerate(texts())] + [(None, None), (1, "twice"), (1, "twice")]
    docs = frame(rows, clash=True)
    found = bpe.encode(docs, PATH, PATTERN).select("text", "n_tokens", "ids", "decoded", "key").collect()
    assert len(found) == len(rows)
    for r in found:
        ids = library.encode_ordinary(r["text"] or "")
        assert (r["n_tokens"], bytes(r["ids"])) == (len(ids), array("I", ids).tobytes())
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["key"] == "own"


def test_digests(frame, library):
    rows = [(1, "Some text, some words."), (2, None)]
    found = {r["doc_id"]: r for r in bpe.digests(frame(rows), PATH, PATTERN).collect()}
    packed = array("I", library.encode_ordinary(rows[0][1])).tobytes()
    assert found[1]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
    assert found[1]["decoded_sha256"] == hashlib.sha256(rows[0][1].encode()).hexdigest()
    assert found[2]["n_tokens"] == 0 and found[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.digests(frame([]), PATH, PATTERN).count() == 0


def test_appends_and_edits_are_exact(coder):
    draw = random.Random(2)
    for _ in range(150):
        data = "".join(draw.choice("abcdehint ") for _ in range(draw.randint(0, 900))).encode()
        grown = bpe.PrefixEncoding(coder)
        for k in range(0, len(data), 7):
            grown.append(data[k:k + 7])
        assert grown.last == bpe.PrefixEncoding(coder, data).last
        start = draw.randint(0, len(data))
        end, new = min(len(data), start + draw.randint(0, 6)), b"then"[:draw.randint(0, 4)]
        computed = grown.replace(start, end, new)
        again = bpe.PrefixEncoding(coder, data[:start] + new + data[end:])
        assert (grown.data, grown.last, grown.ids()) == (again.data, again.last, again.ids())
        assert computed <= len(data) - start + len(new) + 1
    long = bpe.PrefixEncoding(coder, b"the thing " * 1000)
    assert long.replace(10, 12, b"x") < 600


def test_a_worker_keeps_a_bounded_share_of_an_executor(monkeypatch):
    own = bpe.Coder(PATH, PATTERN)
    for memory in (own.lasts, own.known):
        # entries of at most LONG bytes or so and their overhead: two halves of 20 MB
        assert memory.REMEMBERED * 2 * (2 * bpe.LONG + 192) <= 40 << 20
    monkeypatch.setattr(bpe.Pieces, "REMEMBERED", 3)
    for text in texts()[:40]:
        assert own.encode(text) == bpe.coder(PATH, PATTERN).encode(text)
        assert max(len(own.lasts), len(own.known)) <= 3
