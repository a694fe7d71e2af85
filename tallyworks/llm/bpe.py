"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For each prefix of a piece the encoder keeps the one valid last token of that prefix's encoding. The
last token of the next prefix is the token ending there that may stand beside the last token of what
is before it. So a piece grows by appends without a second look at its start, an edit re-encodes from the
edit on and stops where the last tokens agree with the former ones again, and the time is linear in
the length of the piece, however long a run without a break is.

Texts are split by a pattern first; each match is a piece of its own. Defined cases: a null text is
an empty one with no ids; rows are independent, so ties, repeats and extra columns change nothing.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyworks.llm.common import Remembered, whole_text
from tallyworks.llm.merges import NONE, byte_ranks


#: Bytes of a piece whose prefixes are shared with other pieces; a longer one has arrays of its own.
LONG = 64


class Pieces(Remembered):
    """Fewer results than other operators keep, as every core of an executor has a worker with its own."""

    REMEMBERED = 1 << 15


class PrefixEncoding:
    """A piece with the last token of each of its prefixes."""

    def __init__(self, coder: Coder, data: bytes = b""):
        self.coder, self.data, self.last = coder, b"", [NONE]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.coder.extend(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of bytes start..end; returns how many prefixes were computed anew.

        Last tokens before the edit stay. Behind it they are computed until as many agree with the
        former ones as the longest token is long; from there on nothing can differ.
        """
        old_last, old_data = self.last, self.data
        self.data = old_data[:start] + new + old_data[end:]
        self.last = old_last[: start + 1]
        shift, agreed, done = len(new) - (end - start), 0, 0
        while len(self.last) <= len(self.data):
            at = len(self.last)
            if at - start - len(new) > self.coder.longest and agreed >= self.coder.longest:
                self.last += old_last[at - shift:]
                break
            self.coder.extend(self.data, self.last, at)
            done += 1
            agreed = agreed + 1 if at > start + len(new) and self.last[at] == old_last[at - shift] else 0
        return done

    def ids(self) -> list[int]:
        out, at, lengths = [], len(self.data), self.coder.lengths
        while at:
            out.append(self.last[at])
            at -= lengths[out[-1]]
        return out[::-1]


class Coder:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        ids, self.merges = byte_ranks(path)
        self.tokens = {n: token for token, n in ids.items()}
        self.lengths = {n: len(token) for n, token in self.tokens.items()}
        self.longest = max(self.lengths.values())
        #: every ending of a token: its id, or NONE if it is an ending only
        self.endings: dict[bytes, int] = {token[k:]: NONE for token in ids for k in range(1, len(token))}
        self.endings |= ids
        # the libraries' white space is the Unicode property; Python's adds four control characters
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                     .replace(r"\S", r"\P{White_Space}"))
        self.lasts = Pieces(self._last)
        self.known = Pieces(self._packed)

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> None:
        """Add the last tokens of further prefixes to ``last``."""
        endings, beside, judged = self.endings, self.merges.beside, self.merges.judged
        for at in range(len(last), (len(data) if upto is None else upto) + 1):
            found = []
            start = at - 1
            while start >= 0:
                token = endings.get(data[start:at])
                if token is None:
                    break
                if token >= 0:
                    found.append((start, token))
                start -= 1
            for start, token in reversed(found):
                if start:
                    pair = last[start], token
                    if not (judged[pair] if pair in judged else beside(*pair)):
                        continue
                last.append(token)
                break
            else:
                raise ValueError(f"byte {data[at - 1]} has no token")

    def _last(self, data: bytes) -> int:
        """The last token of a short prefix; the last tokens before it are kept by prefix and shared by all pieces."""
        endings, judged, start, found = self.endings, self.merges.judged, len(data) - 1, []
        while start >= 0:
            token = endings.get(data[start:])
            if token is None:
                break
            if token >= 0:
                found.append((start, token))
            start -= 1
        while found:
            start, token = found.pop()
            if not start:
                return token
            pair = self.lasts[data[:start]], token
            if judged[pair] if pair in judged else self.merges.beside(*pair):
                return token
        raise ValueError(f"byte {data[-1]} has no token")

    def _packed(self, piece: str) -> bytes:
        """A piece's ids, packed."""
        data = piece.encode()
        if len(data) > LONG:
            return array("I", PrefixEncoding(self, data).ids()).tobytes()
        ids = []
        while data:
            ids.append(self.lasts[data])
            data = data[:-self.lengths[ids[-1]]]
        ids.reverse()
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        pieces = self.pattern.findall(text)
        if len(pieces) * LONG < len(text):  # a long run isn't worth remembering
            return b"".join(self.known[p] if len(p) <= LONG else self._packed(p) for p in pieces)
        return b"".join(map(self.known.__getitem__, pieces))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(packed).cast("I")))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The frame with ``n_tokens``, ``ids`` (packed little-endian unsigned 32-bit) and ``decoded`` bytes."""
    return _run(docs, path, pattern, [pa.field("n_tokens", pa.int64()), pa.field("ids", pa.binary()),
                                      pa.field("decoded", pa.binary())],
                "n_tokens long, ids binary, decoded binary", lambda ids, back: (len(ids) // 4, ids, back))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The frame without its text, with n_tokens and the digests of ids and decoded bytes."""
    def digest(ids: bytes, back: bytes) -> tuple:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

    return _run(docs, path, pattern, [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()),
                                      pa.field("decoded_sha256", pa.string())],
                "n_tokens long, ids_sha256 string, decoded_sha256 string", digest, keep_text=False)


def _run(docs: DataFrame, path: str, pattern: str, fields: list, ddl: str, made: object, keep_text: bool = True) -> DataFrame:
    """Rows go through Arrow with the text last; the other columns pass as they are."""
    new = [f.name for f in fields]
    others = [c for c in docs.columns if c not in new and (keep_text or c != "text")]
    sent = docs.select(*[docs[c] for c in others], whole_text(docs).alias("_whole"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            rows = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                ids = own.encode(text)
                rows.append(made(ids, own.decode(ids)))
            columns = list(zip(*rows, strict=True)) or [()] * len(fields)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*others, *new])

    schema = sent.drop("_whole").schema
    for name, kind in (x.split() for x in ddl.split(", ")):
        schema = schema.add(name, kind)
    return sent.mapInArrow(work, schema)
