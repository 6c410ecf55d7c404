"""Token ids of whole texts by a public byte-level vocabulary.

The vocabulary's pattern never lets a token reach over a space that follows
something else than white space, so a text cut before such spaces gives the same
ids piece by piece. A task keeps the ids of the pieces it has seen and gathers a
batch of texts with vector operations. Texts in which white space precedes a space
are encoded whole.

The vocabulary's tokenizer has added tokens besides, which it finds in a text before
anything else. An encoder that is given them cuts texts there; one that isn't takes
their strings for ordinary text.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import lru_cache

import numpy as np

#: Ids and pieces a task remembers before it starts anew (4 bytes each id, about 200 each piece).
MEMORY_IDS, MEMORY_PIECES = 8_000_000, 250_000
_UNEVEN = re.compile(r"\s ")
_END = "  "  # no piece holds a space but for a leading one


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> tuple[tuple[str, int], ...]:
    """String and id of the tokens that the default vocabulary's tokenizer adds."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return tuple((x["content"], x["id"]) for x in json.load(file)["added_tokens"])


class _Pieces(dict):
    """Piece -> number of its entry; a missing piece is encoded."""

    def __init__(self, encode, end_id: int | None):
        super().__init__()
        self._encode = encode
        self.flat, self.starts = array("I"), array("q", [0])
        if end_id is None:
            self[_END] = self.add([])
        else:
            self[_END] = self.add([end_id])

    def add(self, ids: list[int]) -> int:
        self.flat.extend(ids)
        self.starts.append(len(self.flat))
        return len(self.starts) - 2

    def __missing__(self, piece: str) -> int:
        # The first piece of a text comes with a space in front, the others without theirs.
        ids = self._encode(piece[1:] if piece[:1] == " " else " " + piece)
        self[piece] = number = self.add(ids)
        return number


class Encoder:
    """Encodes batches of texts; `end_id`, if given, closes every text; `added` are tokens found first."""

    def __init__(self, vocabulary: str, end_id: int | None = None, added: tuple[tuple[str, int], ...] = ()):
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding(
            "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._end_id = end_id
        self._added = dict(added)
        strings = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(strings) + ")").split if strings else lambda text: (text,)
        self._pieces = _Pieces(self._encode, end_id)

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) one after another, and where each text's begin (one more at the end)."""
        if len(self._pieces.flat) > MEMORY_IDS or len(self._pieces) > MEMORY_PIECES:
            self._pieces = _Pieces(self._encode, self._end_id)
        known = self._pieces
        codes, counts = [], []
        for text in texts:
            numbers = []
            for k, part in enumerate(self._cut(text)):
                if k % 2:
                    numbers.append(known.add([self._added[part]]))
                elif _UNEVEN.search(part):
                    numbers.append(known.add(self._encode(part)))
                else:
                    pieces = part.split(" ")
                    pieces[0] = " " + pieces[0]
                    numbers += map(known.__getitem__, pieces)
            numbers.append(known[_END])
            codes += numbers
            counts.append(len(numbers))
        number = np.array(codes, dtype=np.int64)
        starts = np.frombuffer(known.starts, dtype=np.int64)
        lengths = starts[number + 1] - starts[number]
        ends = np.cumsum(lengths)
        ids = np.frombuffer(known.flat, dtype=np.uint32)
        at = np.repeat(starts[number] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return ids[at], bounds


@lru_cache(maxsize=2)
def encoder(vocabulary: str, end_id: int | None = None, added: tuple[tuple[str, int], ...] = ()) -> Encoder:
    """One encoder a Python worker."""
    return Encoder(vocabulary, end_id, added)
