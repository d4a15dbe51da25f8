"""Repeated passages by recompression: equal passages get equal symbols inside."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.llm.chunks import NAMES, Chunk, Named, Sizes, chunked, common_names
from wxlake.llm.fingerprints import mix, run_hashes, word_hashes, word_spans

#: Words of a passage.
WINDOW = 35
#: Rounds of pairs, and how many of the first also compress runs.
ROUNDS, RUN_ROUNDS = 7, 2
#: A symbol gets no longer by a pair, in words.
LONGEST = 14
#: Names sent per byte of text, to size the buckets: names of symbols, and hashes of windows with their checks.
NAME_BYTES, CHECK_BYTES = 0.25, 1.0

FAR = 1 << 40

KEPT = "doc_id long, n_words long, n_removed long, kept string"


class Symbols:
    """Symbols over the words of texts, one array entry each.

    ``low`` and ``high`` bound the words that decided on the symbol's existence and extent: wherever
    these words occur, the same symbol occurs. A text's edge is no word, so what depends on it is out of reach.
    """

    def __init__(self, names: np.ndarray, text: np.ndarray):
        n = len(names)
        self.names, self.text = names, text
        self.size = np.ones(n, dtype=np.int64)
        self.low = np.arange(n)
        self.high = np.arange(1, n + 1)

    def _edges(self):
        last = np.r_[self.text[1:] != self.text[:-1], True]
        return np.r_[True, last[:-1]], last

    def _keep(self, kept: np.ndarray) -> None:
        for field in ("names", "text", "size", "low", "high"):
            setattr(self, field, getattr(self, field)[kept])

    def runs(self) -> None:
        """Each run of equal symbols becomes one symbol, named by the symbol and its count."""
        first, last = self._edges()
        equal = np.r_[self.names[1:] == self.names[:-1], False] & ~last  # as the next
        low, high = np.r_[FAR, self.low[:-1]], np.r_[self.high[1:], -FAR]
        # A symbol knows both neighbours: that they differ, or belong to its run.
        low = np.where(first, -FAR, np.minimum(self.low, low))
        high = np.where(last, FAR, np.maximum(self.high, high))
        heads = np.flatnonzero(~np.r_[False, equal[:-1]])
        counts = np.diff(np.r_[heads, len(equal)])
        self.low, self.high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
        self.size = np.add.reduceat(self.size, heads)
        self.text, names = self.text[heads], self.names[heads]
        self.names = np.where(counts > 1, mix(names + mix(counts.astype(np.uint64), 3), 5), names)

    def pairs(self, turn: int) -> None:
        """Symbols of the left class take a neighbour of the right class to their right; a name's hash tells its class."""
        first, last = self._edges()
        right = (mix(self.names, turn + 11) >> np.uint64(63)).astype(bool)
        next_right = np.r_[right[1:], False] & ~last
        size = self.size + np.r_[self.size[1:], 0]
        joined = ~right & next_right & (size <= LONGEST)
        # Left symbols look at the next one, right symbols at the one before.
        low = np.where(right, np.minimum(self.low, np.r_[FAR, self.low[:-1]]), np.minimum(self.low, np.r_[self.low[1:], FAR]))
        high = np.where(right, np.maximum(self.high, np.r_[0, self.high[:-1]]), np.maximum(self.high, np.r_[self.high[1:], 0]))
        low = np.where(right & first, -FAR, np.where(~right & last, self.low, low))
        high = np.where(~right & last, FAR, np.where(right & first, self.high, high))
        following = np.r_[self.names[1:], np.uint64(0)]
        self.names = np.where(joined, mix(mix(self.names, 7) + following, 9), self.names)
        self.size = np.where(joined, size, self.size)
        self.low, self.high = low, high
        self._keep(~np.r_[False, joined[:-1]])

    @classmethod
    def compressed(cls, words: np.ndarray, text: np.ndarray) -> Symbols:
        own = cls(words, text)
        for turn in range(ROUNDS if len(words) else 0):
            if turn < RUN_ROUNDS:
                own.runs()
            own.pairs(turn)
        return own

    def telling(self, window: int) -> np.ndarray:
        """Symbols that a window can hold with all that decided on them."""
        return np.flatnonzero(self.high - self.low <= window)


class Words:
    """The words of a chunk as hashes, and the text that each belongs to."""

    def __init__(self, table: pa.Table):
        self.chunk = Chunk(table)
        starts, ends = word_spans(self.chunk.data, self.chunk.offsets)
        self.hashes = word_hashes(self.chunk.data, starts, ends)
        self.firsts = np.searchsorted(starts, self.chunk.offsets)
        self.text = np.repeat(np.arange(len(self.chunk)), np.diff(self.firsts))

    def windows(self, length: int) -> np.ndarray:
        """First words of the windows: those with enough words after them in their text."""
        ends = self.firsts[1:][self.text]
        return np.flatnonzero(np.arange(len(self.text)) + length <= ends)

    def telling(self, window: int) -> tuple[Symbols, np.ndarray, Named]:
        """Their symbols, those that tell, and the names of these."""
        symbols = Symbols.compressed(self.hashes, self.text)
        telling = symbols.telling(window)
        return symbols, telling, Named(symbols.names[telling])

    def suspects(self, window: int, told: pa.Table, buckets: int) -> tuple[np.ndarray, Named]:
        """First words of the windows that no unique symbol tells apart from all others, and their names."""
        symbols, telling, named = self.telling(window)
        unique = telling[~named.common(told, buckets)]
        # A window from low - or up to ``window`` words before high - holds the unique symbol's words: it occurs once.
        marks = np.zeros(len(self.hashes) + 2, dtype=np.int32)
        np.add.at(marks, np.maximum(symbols.high[unique] - window, 0), 1)
        np.add.at(marks, symbols.low[unique] + 1, -1)
        starts = self.windows(window)
        starts = starts[np.cumsum(marks)[starts] == 0]
        return starts, Named(run_hashes(self.hashes, window)[starts], run_hashes(self.hashes, window, salt=1)[starts])


def _symbol_names(window: int, buckets: int):
    def names(table: pa.Table) -> pa.Table:
        words = Words(table)
        return words.telling(window)[2].table(words.chunk.number, buckets)

    return names


def _window_names(window: int, of_symbols: int, of_windows: int):
    def names(table: pa.Table, told: pa.Table) -> pa.Table:
        """Hashes of the windows that no unique symbol tells apart from all others."""
        if not table.num_rows:
            return Named(np.zeros(0, np.uint64)).table(0, of_windows)
        words = Words(table)
        return words.suspects(window, told, of_symbols)[1].table(words.chunk.number, of_windows)

    return names


def _removed(window: int, of_symbols: int, of_windows: int):
    def removed(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                             "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
        words = Words(table)
        n = len(words.hashes)
        covered = np.zeros(n, dtype=bool)
        windows = told.filter(told.column("windows")) if told.num_rows else told
        if windows.num_rows:
            starts, named = words.suspects(window, told.filter(pc.invert(told.column("windows"))), of_symbols)
            starts = starts[named.common(windows, of_windows)]
            marks = np.zeros(n + 1, dtype=np.int32)
            np.add.at(marks, starts, 1)
            np.add.at(marks, starts + window, -1)
            covered = np.cumsum(marks[:-1]) > 0
        sums = np.r_[0, np.cumsum(covered)]
        gone = sums[words.firsts[1:]] - sums[words.firsts[:-1]]
        kept = []
        for i, text in enumerate(words.chunk.texts):
            own = text.as_py().split()
            if gone[i]:
                own = compress(own, ~covered[words.firsts[i] : words.firsts[i + 1]])
            kept.append(b" ".join(own).decode())
        return pa.table({
            "doc_id": pa.array(words.chunk.doc_ids, pa.int64()), "n_words": np.diff(words.firsts).astype(np.int64),
            "n_removed": gone.astype(np.int64), "kept": pa.array(kept, pa.string())})

    return removed


def without_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``: the words outside repeated windows, joined by one space.

    Words are runs of characters other than space and U+0009 to U+000D, compared unchanged. A word goes if one of
    its windows, ``window`` neighbouring words of one text, starts anywhere else in the table, in the
    same text included. Null texts are empty; a null ``doc_id`` stays null; repeated rows repeat each other.

    Symbols are named by hashes of their content, so all tasks give equal names without an exchange. One
    exchange counts the names of the last round. A symbol that occurs once proves that the windows
    that hold it, and all words that decided on it, occur once. Only the other windows are hashed (128 bits, all compared) and
    counted in a second exchange. A chunk makes its names anew and is told one bit for each. Equal names of
    different symbols can only send more windows there.
    """
    sizes = Sizes(docs, chunk_bytes)
    parts = chunked(docs, sizes.chunks)
    of_symbols, of_windows = sizes.buckets(NAME_BYTES), sizes.buckets(CHECK_BYTES)
    symbols = common_names(parts.groupBy("chunk").applyInArrow(_symbol_names(window, of_symbols), NAMES), of_symbols)
    windows = common_names(parts.groupBy("chunk").cogroup(symbols.groupBy("chunk")).applyInArrow(
        _window_names(window, of_symbols, of_windows), NAMES), of_windows)
    told = symbols.withColumn("windows", F.lit(False)).unionByName(windows.withColumn("windows", F.lit(True)))
    return parts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_removed(window, of_symbols, of_windows), KEPT)
