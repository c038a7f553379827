"""Token ids of many short strings at once, from a bounded cache.

Strings of an Arrow batch are made distinct before any of them becomes a Python
string, and occurrences are expanded again with numpy, so the work per repeated
string does not depend on the tokenizer.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa

#: Strings kept in each of two generations, and the longest string kept, in characters.
KEPT, LONGEST = 500_000, 48
#: Strings handed to the tokenizer at once.
AT_ONCE = 20_000


def byte_letters(end: int = 0x250) -> dict[int, str]:
    """How byte-level vocabularies write the bytes of characters below ``end``: printable
    bytes as themselves, all others as characters from U+0100 on, in order."""
    themselves = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in themselves]
    letter = {b: chr(b) for b in themselves} | {b: chr(0x100 + k) for k, b in enumerate(others)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(end)}


LETTERS = byte_letters()


class PieceIds:
    """Each string's ids as it is encoded alone.

    Two generations of strings are kept: when the younger is full it becomes the
    older, from which strings that are used again move on; others are forgotten.
    Strings that match ``word`` are known to be one unit for a byte-level tokenizer, and
    go to its model without its general preparation of texts.
    """

    def __init__(self, path: str, word: str = "(?!)", kept: int = KEPT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.word, self.model = re.compile(word).fullmatch, self.tokenizer.model
        self.kept = kept
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, strings: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        code = "H" if self.width.itemsize == 2 else "I"
        for s in strings:
            out.append(array(code, [t.id for t in self.model.tokenize(s.translate(LETTERS))]).tobytes() if self.word(s) else None)
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k in range(0, len(rest), AT_ONCE):
            some = rest[k : k + AT_ONCE]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([strings[i] for i in some], add_special_tokens=False), strict=True):
                out[i] = array(code, e.ids).tobytes()
        return out

    def encode(self, strings: list[str]) -> list[bytes]:
        """Ids of distinct strings."""
        if len(self.young) > self.kept:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, strings))
        missing = [k for k, ids in enumerate(found) if ids is None]
        again = list(map(self.old.get, [strings[k] for k in missing]))
        new = [strings[k] for k, ids in zip(missing, again, strict=True) if ids is None]
        learnt = iter(self.learn(new))
        for k, ids in zip(missing, again, strict=True):
            found[k] = ids if ids is not None else next(learnt)
        self.young.update((strings[k], found[k]) for k in missing if len(strings[k]) <= LONGEST)
        return found

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings of a column, one after the other, and how many each has."""
        coded = column.dictionary_encode()
        strings = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        raw = self.encode(strings)
        return expand(np.frombuffer(b"".join(raw), self.width), np.array([len(r) for r in raw], np.int64) // self.width.itemsize, coded.indices.to_numpy())

    def rows(self, lists: pa.ListArray, end_id: int) -> list[bytes]:
        """For each list of strings the ids of all, and ``end_id`` behind them."""
        ids, sizes = self.of(lists.flatten())
        at = np.concatenate(([0], np.cumsum(sizes)))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        raw, w, end = ids.tobytes(), self.width.itemsize, np.array([end_id], self.width).tobytes()
        return [raw[a * w : b * w] + end for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def expand(flat: np.ndarray, lengths: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` (run k has ``lengths[k]`` values) with the numbers ``wanted``."""
    sizes = lengths[wanted]
    shift = (np.cumsum(lengths) - lengths)[wanted] - (np.cumsum(sizes) - sizes)
    at = np.repeat(shift, sizes)
    at += np.arange(len(at))
    return flat[at], sizes
