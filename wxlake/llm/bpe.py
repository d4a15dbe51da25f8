"""Byte-level BPE of whole texts, with a bounded memory of units.

Vocabulary, merges and special tokens are those of a file of the tokenizers library. Its tokens are numbered
in the order of their merges, so numbers serve as ranks for a coder that is about three times faster. Tests
compare the ids with the library's.
"""

from __future__ import annotations

import json
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> dict[str, int]:
    """Byte of each character that stands for one in the file: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks of the tokens' bytes, and ids of the special strings. A file whose numbers don't follow its merges is an error."""
    content = json.loads(Path(path).read_text("utf-8"))
    vocabulary, of = content["model"]["vocab"], byte_characters()
    numbers = [vocabulary[a + b] for a, b in content["model"]["merges"]]
    if any(a >= b for a, b in zip(numbers, numbers[1:])) or numbers and numbers[0] < 256:
        raise ValueError(f"{path}: tokens are not numbered in the order of their merges")
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    return {bytes(of[c] for c in token): number for token, number in vocabulary.items() if token not in special}, special


class UnitEncoder:
    """Encodes texts unit by unit.

    The pattern that splits text before the merges attaches a single space to
    what follows it, and no match of it runs from a visible character into a
    space. A text without two spaces in a row may therefore be cut before each
    space, and its units encode independently. Other texts are encoded whole.

    Ids are little-endian unsigned 32-bit integers. About ``keep`` units are
    remembered; then the memory starts anew.
    """

    def __init__(self, path: str = VOCABULARY, keep: int = 300_000):
        import tiktoken

        ranks, self.special = read_vocabulary(path)
        self.coder = tiktoken.Encoding(
            Path(path).name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.width = np.zeros(len(ranks), dtype=np.int64)
        self.width[list(ranks.values())] = [len(token) for token in ranks]
        self.keep = keep
        self.known: dict[str, bytes] = {}  # a unit without its space -> ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.coder.encode(text, allowed_special="all"), dtype="<u4").tobytes()

    def _learn(self, units: list[str]) -> None:
        """Encode units as one text and cut its ids where units end."""
        spaced = [" " + u for u in units]
        ids = np.array(self.coder.encode_ordinary("".join(spaced)), dtype="<u4")
        ends = np.cumsum([len(u.encode()) for u in spaced])
        cuts = (np.searchsorted(np.cumsum(self.width[ids]), ends) + 1).tolist()
        raw, start = ids.tobytes(), 0
        for unit, stop in zip(units, cuts):
            self.known[unit] = raw[4 * start : 4 * stop]
            start = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if len(self.known) > self.keep:
            self.known.clear()
        get, out, new = self.known.get, [], set()
        for text in texts:
            if "  " in text or text.endswith(" ") or any(s in text for s in self.special):
                out.append(self._whole(text))
                continue
            head, *rest = text.split(" ")
            found = [self._whole(head), *map(get, rest)]
            if None in found:
                new.update(u for u, ids in zip(rest, found[1:]) if ids is None)
                out.append((found, rest))
            else:
                out.append(b"".join(found))
        new = list(new)
        for start in range(0, len(new), 10_000):
            self._learn(new[start : start + 10_000])
        for i, own in enumerate(out):
            if isinstance(own, tuple):
                found, rest = own
                out[i] = found[0] + b"".join([get(u) if ids is None else ids for u, ids in zip(rest, found[1:])])
        return out


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY) -> UnitEncoder:
    """One encoder for each worker process."""
    return UnitEncoder(path)


def in_portions(texts: list, most: int = 2_000_000):
    """Slices of a list of texts with about ``most`` characters each."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= most:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
