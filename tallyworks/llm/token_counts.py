"""Token counts by a compiled finite-state transducer.

The transducer reads a word's bytes, the last one as an end-of-word symbol. Its states are what the
future can depend on: the bytes that may still be inside a longer token, and for each place among them the
last token up to there with how many tokens fewer it is. Each transition carries how many tokens it adds to the
count of the prefix (a longer token that takes up earlier ones takes their number back). States
and transitions are compiled when first met and are shared by all words of a worker.

White space ends every word and leaves the transducer in its start state, so a chunk of a text is a
map: the text before its first white space, the tokens between, the text behind its last. Maps
compose associatively, and a prefix scan over the chunks of a text by doubling gives the count up to
each chunk; no chunk waits for the one before it.

Texts are treated as the vocabulary's library does: special strings in a raw text count as one token, the
rest is composed (NFC), lower-cased letter by letter and split. Defined cases: a null text is empty
and has no tokens; rows are independent, so ties, repeats and extra columns change nothing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import Remembered, whole_text
from tallyworks.llm.merges import NONE, byte_letters, word_merges

#: The vocabulary's own split of a text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
SPACE = regex.compile(r"\p{White_Space}")
LAST_SPACE = regex.compile(r"(?r)\p{White_Space}")
#: Characters of a text that make one chunk.
CHUNK = 1 << 16
#: States that a worker keeps before it compiles afresh.
STATES = 1 << 17
LIMIT = 2048


class Transducer:
    """States are numbers; ``steps[state]`` maps a byte, or 256 + the word's last byte, to (state, tokens added)."""

    def __init__(self, path: str):
        ids, self.merges, mark, self.special = word_merges(path)
        letters = byte_letters()
        byte_of = {letter: b for b, letter in letters.items()}
        self.tokens: dict[tuple[int, ...], int] = {}
        for name, n in ids.items():
            if name in self.special:
                continue
            ends = name.endswith(mark)
            symbols = [byte_of[x] for x in (name.removesuffix(mark) if ends else name)]
            if ends:
                symbols[-1] += 256
            self.tokens[tuple(symbols)] = n
        self.beginnings = {t[:k] for t in self.tokens for k in range(1, len(t))} | {()}
        self.start_over()

    def start_over(self) -> None:
        self.states = [((), ((NONE, 0),))]
        self.numbers = {self.states[0]: 0}
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """Compile a transition: a state is (open bytes, (last token, tokens less or None) for each place among them)."""
        open_bytes, places = self.states[state]
        seen = (*open_bytes, symbol)
        for at, place in enumerate(places):
            if place is None:
                continue
            token = self.tokens.get(seen[at:])
            if token is not None and (place[0] == NONE or self.merges.beside(place[0], token)):
                added, last = place[1] + 1, token
                break
        else:
            raise ValueError(f"symbol {symbol} has no token")
        if symbol >= 256:
            made = 0
        else:
            kept = [None if p is None or seen[at:] not in self.beginnings else (p[0], p[1] - added)
                    for at, p in enumerate(places)] + [(last, 0)]
            first = next(k for k, p in enumerate(kept) if p is not None)
            key = (seen[first:], tuple(kept[first:]))
            made = self.numbers.setdefault(key, len(self.states))
            if made == len(self.states):
                self.states.append(key)
                self.steps.append({})
        self.steps[state][symbol] = made, added
        return made, added

    def count(self, word: bytes) -> int:
        if len(self.states) >= STATES:
            self.start_over()
        state = total = 0
        for symbol in word[:-1]:
            state, added = self.steps[state].get(symbol) or self.step(state, symbol)
            total += added
        last = word[-1] + 256
        return total + (self.steps[state].get(last) or self.step(state, last))[1]


class ChunkMap(NamedTuple):
    """What a chunk does to a text's count; without white space all its text is ``head``."""

    head: str
    count: int
    tail: str
    broken: bool


class Counter:
    def __init__(self, path: str):
        self.machine = Transducer(path)
        self.words = Remembered(lambda word: self.machine.count(word.encode()))
        self.split = regex.compile(SPLIT)
        self.special = regex.compile("|".join(map(regex.escape, self.machine.special)))
        self.marks = tuple(self.machine.special)

    def count(self, text: str) -> int:
        """Tokens of a text that white space or its own ends enclose."""
        n = 0
        if any(mark in text for mark in self.marks):
            plain = self.special.split(text)
            n = len(plain) - 1
        else:
            plain = (text,)
        for part in plain:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            n += sum(map(self.words.__getitem__, self.split.findall(part.lower())))
        return n

    def chunk(self, text: str) -> ChunkMap:
        first = SPACE.search(text)
        if first is None:
            return ChunkMap(text, 0, "", False)
        last = LAST_SPACE.search(text)
        return ChunkMap(text[:first.start()], self.count(text[first.start():last.end()]), text[last.end():], True)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if not a.broken and not b.broken:
            return ChunkMap(a.head + b.head, 0, "", False)
        if not a.broken:
            return ChunkMap(a.head + b.head, b.count, b.tail, True)
        if not b.broken:
            return ChunkMap(a.head, a.count, a.tail + b.head, True)
        return ChunkMap(a.head, a.count + self.count(a.tail + b.head) + b.count, b.tail, True)

    def prefixes(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """The maps of all prefixes of the chunks, by doubling the reach of each."""
        maps, reach = list(maps), 1
        while reach < len(maps):
            maps = maps[:reach] + [self.compose(maps[k - reach], maps[k]) for k in range(reach, len(maps))]
            reach *= 2
        return maps

    def total(self, m: ChunkMap) -> int:
        return self.count(m.head) + m.count + self.count(m.tail)

    def count_long(self, text: str, size: int = CHUNK) -> int:
        if len(text) <= size:
            return self.count(text)
        maps = [self.chunk(text[k:k + size]) for k in range(0, len(text), size)]
        return self.total(self.prefixes(maps)[-1])


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """The frame without its text, with n_bytes, n_tokens and over_limit."""
    others = [c for c in docs.columns if c not in ("text", "n_bytes", "n_tokens", "over_limit")]
    text = whole_text(docs)
    sent = docs.select(*[docs[c] for c in others], F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_whole"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            counts = [own.count_long(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            arrays = [pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays],
                                             names=[*others, "n_bytes", "n_tokens", "over_limit"])

    schema = sent.drop("_whole").schema.add("n_tokens", "long").add("over_limit", "boolean")
    return sent.mapInArrow(work, schema)
