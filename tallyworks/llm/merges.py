"""Byte-pair merges as tables, and which two tokens may stand side by side.

A merge joins two neighbouring symbols into one; a text is encoded by always doing the merge of
lowest rank, leftmost first. Two facts follow. A run of tokens is an encoding exactly if each two
neighbours alone encode to themselves, and each prefix of a text has one valid last token. They hold as
every symbol's merge ranks after the merges that made its parts, which the rank files keep.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

#: A token with no part to undo, and the rank after all others.
NONE, NEVER = -1, 1 << 60
#: Judged pairs that a worker remembers before it starts afresh.
REMEMBERED = 1 << 18


class Merges:
    """Token ids with their merges. ``symbols`` maps an id to its parts' names (bytes, or text with word ends)."""

    def __init__(self, parts: dict[int, tuple[int, int]], ranks: dict[tuple[int, int], int], own: dict[int, int]):
        self.parts, self.ranks, self.own = parts, ranks, own
        self.judged: dict[tuple[int, int], bool] = {}
        self._spines: dict[int, tuple[list[tuple[int, int]], list[tuple[int, int]]]] = {}

    def _spine(self, token: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """(token, rank at which it goes up into a larger one) at the right edge and at the left edge."""
        found = self._spines.get(token)
        if found is None:
            edges = []
            for side in (1, 0):
                edge, at, gone = [], token, NEVER
                while True:
                    edge.append((at, gone))
                    if at not in self.parts:
                        break
                    gone, at = self.own[at], self.parts[at][side]
                edges.append(edge)
            found = self._spines[token] = (edges[0], edges[1])
        return found

    def beside(self, left: int, right: int) -> bool:
        """Whether the texts of both, joined, are encoded as these two tokens.

        No merge across the border may come while both its sides exist. Of equal ranks the left one
        comes first, so a merge across the border beats one of its rank on its right.
        """
        key = (left, right)
        known = self.judged.get(key)
        if known is None:
            known, ranks = True, self.ranks
            for a, gone_a in self._spine(left)[0]:
                for b, gone_b in self._spine(right)[1]:
                    rank = ranks.get((a, b))
                    if rank is not None and rank < gone_a and rank <= gone_b:
                        known = False
                        break
                if not known:
                    break
            if len(self.judged) >= REMEMBERED:
                self.judged.clear()
            self.judged[key] = known
        return known


@lru_cache(maxsize=2)
def byte_ranks(path: str) -> tuple[dict[bytes, int], Merges]:
    """A rank file, its ids, and the merges that make each token of two others of lower rank."""
    with open(path, "rb") as lines:
        ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    parts, ranks = {}, {}
    merges = Merges(parts, ranks, {rank: rank for rank in ids.values()})
    for token, rank in sorted(ids.items(), key=lambda x: x[1]):
        cuts = [(ids.get(token[:k], NEVER), ids.get(token[k:], NEVER)) for k in range(1, len(token))]
        cuts = [(a, b) for a, b in cuts if a < rank and b < rank]
        ranks |= dict.fromkeys(cuts, rank)
        if len(token) > 1:
            made = next((cut for cut in cuts if _made_first(merges, *cut, rank)), None)
            if made is None:
                raise ValueError(f"token {rank} can't be reached by merges")
            parts[rank] = made
    return ids, merges


def _made_first(merges: Merges, a: int, b: int, rank: int) -> bool:
    """Whether both parts stand side by side until the merge of this rank joins them."""
    for x, gone_x in merges._spine(a)[0]:
        for y, gone_y in merges._spine(b)[1]:
            other = merges.ranks.get((x, y))
            if other is not None and other < rank and other < gone_x and other <= gone_y:
                return False
    return True


def byte_letters() -> dict[int, str]:
    """The visible letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def word_merges(path: str) -> tuple[dict[str, int], Merges, str, dict[str, int]]:
    """A json vocabulary: its ids, its merges, the mark of a word's end, and its special strings."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    ids, mark = held["model"]["vocab"], held["model"]["end_of_word_suffix"]
    parts, ranks, own = {}, {}, {}
    for rank, merge in enumerate(held["model"]["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        made = ids[a + b]
        ranks[ids[a], ids[b]] = rank
        parts[made], own[made] = (ids[a], ids[b]), rank
    return ids, Merges(parts, ranks, own), mark, {x["content"]: x["id"] for x in held["added_tokens"]}
