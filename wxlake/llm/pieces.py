"""SentencePiece BPE encoding by vectorised merge rounds, and decoding."""

from __future__ import annotations

import codecs
import hashlib
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.llm.bpe import in_portions
from wxlake.llm.common import pin

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
NEVER = np.iinfo(np.int32).max
#: A pair of symbols, or of characters, is one integer.
SHIFT = 21

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _one_each(error):
    """Each byte that is no part of a valid character becomes one replacement character."""
    return "�", error.start + 1


codecs.register_error("wxlake-one-each", _one_each)


class PieceCoder:
    """The vocabulary of a BPE model with byte fallback, a space before each text and no other normalising.

    Symbols are piece ids; a character without piece is its code point above all ids.
    """

    def __init__(self, path: str = MODEL, keep: int = 600_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.keep, self.known = keep, {}  # a segment without its first space -> ids

        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(self.size)]
        pieces = {model.id_to_piece(i): i for i in range(self.size) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece reaches over a word's start")
        self.bytes = np.zeros(256, dtype=np.int64)
        surface = []
        for i in range(self.size):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(text[1:-1], 16)] = i
                surface.append(bytes([int(text[1:-1], 16)]))
            elif model.is_unknown(i):
                surface.append(" ⁇ ".encode())
            else:
                surface.append(b"" if special[i] else text.replace(SPACE, " ").encode())
        self.is_byte = np.array([model.is_byte(i) for i in range(self.size)])
        self.spaced = np.array([not special[i] and model.id_to_piece(i)[0] == SPACE for i in range(self.size)])
        self.is_control = np.array([model.is_control(i) for i in range(self.size)])
        self.widths = np.array([len(s) for s in surface])
        self.starts = np.cumsum(self.widths) - self.widths
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)

        # Better scores have lower ranks; equal scores share one.
        scores = np.array([-model.get_score(i) for i in range(self.size)])
        ranks = np.unique(scores, return_inverse=True)[1]
        single = {p: i for p, i in pieces.items() if len(p) == 1}
        self.symbol_of = np.full(0x110000, -1, dtype=np.int64)
        self.symbol_of[[ord(c) for c in single]] = list(single.values())
        unknown = self.symbol_of < 0
        self.symbol_of[unknown] = self.size + np.flatnonzero(unknown)

        def symbol(text):
            return pieces.get(text, self.size + ord(text) if len(text) == 1 else None)

        pairs, inside = {}, set()
        for text, own in pieces.items():
            for i in range(1, len(text)):
                a, b = symbol(text[:i]), symbol(text[i:])
                inside.add(ord(text[i - 1]) << SHIFT | ord(text[i]))
                if a is not None and b is not None:
                    pairs[a << SHIFT | b] = own
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_symbols = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.pair_ranks = ranks[self.pair_symbols].astype(np.int32)
        self.inside = np.array(sorted(inside), dtype=np.int64)

    def _pair(self, left, right):
        """Rank and merged symbol of pairs; NEVER where they make no piece."""
        keys = left << SHIFT | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        found = self.pair_keys[at] == keys
        return np.where(found, self.pair_ranks[at], NEVER), self.pair_symbols[at]

    def _merge(self, symbols, segment):
        """Merge until no pair is left. Yields the place of each surviving symbol, and the symbol.

        A round finds the best rank of each segment and merges its pairs of that rank, leftmost first and
        without overlap. That equals one merge after another as long as no new pair ranks as well as
        the merged ones; where one does, its segment merges only its leftmost pair in this round.
        """
        place = np.arange(len(symbols))
        done_places, done_symbols = [], []
        ranks = np.full(len(symbols), NEVER, dtype=np.int32)
        merged = np.zeros(len(symbols), dtype=np.int64)
        if len(symbols) > 1:
            ranks[:-1], merged[:-1] = self._pair(symbols[:-1], symbols[1:])
            ranks[:-1][segment[:-1] != segment[1:]] = NEVER
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            best = np.repeat(np.minimum.reduceat(ranks, starts), sizes)
            live = best < NEVER
            if not live.all():
                done_places.append(place[~live])
                done_symbols.append(symbols[~live])
                symbols, segment, place, ranks, merged, best = (
                    x[live] for x in (symbols, segment, place, ranks, merged, best))
                if not len(symbols):
                    break
            here = ranks == best
            chosen = self._alternate(here)
            at = np.flatnonzero(chosen)
            risky = self._risky(symbols, segment, merged, chosen, at, best)
            if len(risky):
                first = at[np.r_[True, segment[at][1:] != segment[at][:-1]]]
                at = at[~np.isin(segment[at], risky) | np.isin(at, first)]
                chosen = np.zeros_like(chosen)
                chosen[at] = True
            symbols[at] = merged[at]
            left = np.ones(len(symbols), dtype=bool)
            left[at + 1] = False
            new_at = np.cumsum(left)[at] - 1
            symbols, segment, place, ranks, merged = (x[left] for x in (symbols, segment, place, ranks, merged))
            changed = np.unique(np.r_[new_at, new_at - 1])
            changed = changed[changed >= 0]
            ranks[changed] = NEVER
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[segment[changed] == segment[changed + 1]]
            ranks[changed], merged[changed] = self._pair(symbols[changed], symbols[changed + 1])
        return np.concatenate(done_places or [place]), np.concatenate(done_symbols or [symbols])

    @staticmethod
    def _alternate(here):
        """Of each run of marked places every second one, from the first on."""
        marked = np.flatnonzero(here)
        new_run = np.r_[True, np.diff(marked) > 1]
        run_start = marked[new_run][np.cumsum(new_run) - 1]
        chosen = np.zeros(len(here), dtype=bool)
        chosen[marked[(marked - run_start) % 2 == 0]] = True
        return chosen

    def _risky(self, symbols, segment, merged, chosen, at, best):
        """Segments in which a merge of this round would make a pair of at least its rank."""
        new = symbols.copy()
        new[at] = merged[at]
        n, risky = len(symbols), []
        for others in (symbols, new):
            right = at + 2
            ok = right < n
            a, r = at[ok], right[ok]
            same = segment[a] == segment[r]
            a, r = a[same], r[same]
            risky.append(segment[a][self._pair(merged[a], others[r])[0] <= best[a]])
        # The symbol before: itself, or what a merge two places before has made.
        for back, kept in ((1, None), (2, True)):
            ok = at >= back
            a = at[ok]
            b = a - back
            same = segment[a] == segment[b]
            if kept:
                same &= chosen[b]
            a, b = a[same], b[same]
            risky.append(segment[a][self._pair(new[b] if kept else symbols[b], merged[a])[0] <= best[a]])
        return np.unique(np.concatenate(risky))

    def _learn(self, keys: list[str]) -> None:
        text = "".join([SPACE + k for k in keys])
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        lengths = np.array([len(k) + 1 for k in keys])
        key = np.repeat(np.arange(len(keys)), lengths)
        # No piece holds these two characters side by side, so no merge reaches over them.
        pair = codes[:-1] << SHIFT | codes[1:]
        at = np.minimum(np.searchsorted(self.inside, pair), len(self.inside) - 1)
        cut = np.r_[True, (self.inside[at] != pair) | (key[1:] != key[:-1])]
        places, symbols = self._merge(self.symbol_of[codes], np.cumsum(cut))
        order = np.argsort(places, kind="stable")
        places, symbols = places[order], symbols[order]
        owner = key[places]
        ids, owner = self._with_bytes(symbols, owner)
        stops = np.searchsorted(owner, np.arange(1, len(keys) + 1))
        raw, start = ids.astype("<u4").tobytes(), 0
        for k, stop in zip(keys, stops.tolist()):
            self.known[k] = raw[4 * start : 4 * stop]
            start = stop

    def _with_bytes(self, symbols, owner):
        """Characters without piece become the pieces of their bytes."""
        unknown = np.flatnonzero(symbols >= self.size)
        if not len(unknown):
            return symbols, owner
        encoded = [chr(c).encode() for c in (symbols[unknown] - self.size).tolist()]
        widths = np.ones(len(symbols), dtype=np.int64)
        widths[unknown] = [len(e) for e in encoded]
        ids = np.repeat(symbols, widths)
        ids[np.repeat(symbols >= self.size, widths)] = self.bytes[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
        return ids, np.repeat(owner, widths)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers, without begin and end ids."""
        if len(self.known) > self.keep:
            self.known.clear()
        get, out, new = self.known.get, [], set()
        for text in texts:
            if not text:
                out.append(b"")
                continue
            if "  " in text or text[0] == " " or SPACE in text:
                keys = re.findall(f"{SPACE}({SPACE}*[^{SPACE}]*)", SPACE + text.replace(" ", SPACE))
            else:
                keys = text.split(" ")
            found = list(map(get, keys))
            if None in found:
                new.update(k for k, ids in zip(keys, found) if ids is None)
                out.append((found, keys))
            else:
                out.append(b"".join(found))
        new = list(new)
        for start in range(0, len(new), 100_000):
            self._learn(new[start : start + 100_000])
        return [
            own if isinstance(own, bytes) else b"".join([get(k) if ids is None else ids for ids, k in zip(*own)])
            for own in out
        ]

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """Texts in UTF-8 of ids with or without begin and end ids."""
        ids = np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int64)
        if len(ids) and ids.max() >= self.size:
            raise IndexError("id beyond the vocabulary")
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        raw = self.surface[np.repeat(self.starts[ids] - (ends - widths), widths) + np.arange(int(widths.sum()))].tobytes()
        bounds = np.cumsum([len(e) // 4 for e in encoded])
        marks = np.r_[0, ends]
        out, first = [], 0
        for last in bounds.tolist():
            text = raw[marks[first] : marks[last]]
            text = self._checked(ids[first:last], text)
            out.append(text)
            first = last
        return out

    def _checked(self, ids, text: bytes) -> bytes:
        head = next((i for i in ids[:8].tolist() if not self.is_control[i]), None)
        if head is None:
            head = next((i for i in ids.tolist() if not self.is_control[i]), None)
        dropped = 1 if head is not None and self.spaced[head] else 0
        is_byte = self.is_byte[ids]
        if is_byte.any():
            parted = self.is_control[ids[1:-1]].any()
            try:
                text.decode()
            except UnicodeDecodeError:
                parted = True
            if parted:
                # Each run of byte pieces is decoded for itself.
                parts = np.split(ids, np.flatnonzero(np.diff(is_byte)) + 1)
                raw = (b"".join(self.surface[self.starts[i] : self.starts[i] + self.widths[i]].tobytes() for i in p.tolist()) for p in parts)
                text = "".join(r.decode(errors="wxlake-one-each") for r in raw).encode()
        return text[dropped:]


@lru_cache(maxsize=2)
def coder(path: str = MODEL) -> PieceCoder:
    """One coder for each worker process."""
    return PieceCoder(path)


def encode_and_decode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Digests of the ids of each whole text, with begin and end ids, and of the text that they decode to.

    One row per row. Null texts are empty, and an empty one has begin and end ids alone. A null ``doc_id`` stays null.
    """
    pin(docs.sparkSession)

    def digests(batches):
        own = coder(model)
        begin, end = (int(i).to_bytes(4, "little") for i in (own.begin, own.end))
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in in_portions(texts):
                encoded = [begin + ids + end for ids in own.encode(texts[part])]
                decoded = own.decode(encoded)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids[part], pa.int64()),
                    "n_tokens": pa.array([len(e) // 4 for e in encoded], pa.int64()),
                    "ids_sha256": [hashlib.sha256(e).hexdigest() for e in encoded],
                    "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded]})

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return whole.mapInArrow(digests, DIGESTS)
