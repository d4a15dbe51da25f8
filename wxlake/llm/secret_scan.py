"""Secret scans: patterns, and a linear-chain conditional random field that learns from them."""

from __future__ import annotations

import hashlib
import random
import re
import string
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.llm.bpe import in_portions
from wxlake.llm.common import pin

# Letters in either case, ASCII only.
_KEYS = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in key)
    for key in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# A match is a whole run, so a run that is too short cannot hide another match.
ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
HEX = re.compile("[0-9a-f]{16,}")
ASSIGN_CHARS = 12
KINDS = ("assign", "access", "hex", "crf")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
REDACTED = "[REDACTED]"

#: Distinct texts of the training sample, those with the smallest hashes, and windows of each text.
SAMPLE_TEXTS, SAMPLE_WINDOWS, WINDOW = 3000, 4, 21
#: Distinct texts with a base match, those with the smallest hashes, that the sample holds besides.
SAMPLE_HOLDING = 300
#: Code points beyond which a word is remembered by its features alone.
LONG_WORD = 256
#: Characters and lengths of values that stand for the kinds of secrets that no pattern names.
SPELLINGS = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-")
SPELLED_LENGTHS = (20, 64)
#: Steps, step size and penalty of the training.
STEPS, STEP_SIZE, PENALTY = 150, 0.2, 1e-4

OUTSIDE, BEGIN, INSIDE = 0, 1, 2


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start and then kind."""
    spans = []
    if "=" in text or ":" in text:
        spans += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        spans += [Span("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


# ---- features -------------------------------------------------------------------------------

_CLASSES = str.maketrans(
    {c: "x" for c in "abcdefghijklmnopqrstuvwxyz"} | {c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    | {c: "9" for c in "0123456789"})
_HINT = re.compile("pass|pwd|secret|token|key|auth|credential|akia", re.IGNORECASE)
_RUNS = re.compile(r"(.)\1+")
_LETTERS_DIGITS = re.compile("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")
_UPPER_RUN, _HEX_RUN, _DIGIT_RUN = re.compile("[A-Z0-9]+"), re.compile("[0-9a-f]+"), re.compile("[0-9]+")


def _bucket(n: int) -> int:
    return min(n.bit_length(), 7)


def _longest(pattern, word: str) -> int:
    return _bucket(max(map(len, pattern.findall(word)), default=0))


def word_key(word: str) -> str:
    """Words with equal key have equal features: itself where digits or a hint occur, else the pattern of its classes.

    The key of a long word is a tab, which no word holds, and its features, so keys are bounded whatever the words are.
    """
    classes = word.translate(_CLASSES)
    plain = "9" not in classes and not _HINT.search(word)
    if len(word) > LONG_WORD:
        return "\t" + "\t".join(_features(word, classes, plain))
    return "\0" + classes if plain else word


def word_features(key: str) -> list[str]:
    """Shape features of a word, and hints that count for its neighbours, which start with ``n:``."""
    if key[0] == "\t":
        return key[1:].split("\t")
    plain = key[0] == "\0"
    word = key[1:] if plain else key
    return _features(word, word if plain else word.translate(_CLASSES), plain)


def _features(word: str, classes: str, plain: bool) -> list[str]:
    shape = _RUNS.sub(r"\1", classes)
    found = [f"length {_bucket(len(word))}", f"shape {shape}" if len(shape) <= 8 else f"long shape {_bucket(len(shape))}"]
    ending = "assigns" if word[-1] in "=:" else "ends" if word[-1] in ".,;" else "open"
    found += [f"n:{ending}", f"n:length {min(_bucket(len(word)), 4)}"]
    if not plain:
        hint = _HINT.search(word)
        found += [f"n:hint {hint[0].lower()}" if hint else "n:no hint",
                  f"switches {_bucket(len(_LETTERS_DIGITS.findall(word)))}", f"upper run {_longest(_UPPER_RUN, word)}",
                  f"hex run {_longest(_HEX_RUN, word)}", f"digit run {_longest(_DIGIT_RUN, word)}",
                  f"distinct {_bucket(len(set(word)))}", "holds =" if "=" in word[:-1] else "no ="]
    return found


def text_feature(digit_words: int, words: int) -> int:
    """Of a file: how common words with digits are."""
    return _bucket(int(64 * digit_words / words)) if words else 0


# ---- the model ------------------------------------------------------------------------------


class Model(NamedTuple):
    """Scores per label of a word's own features, of those as previous and as next word, of a file, and transitions."""

    own: dict[str, tuple[float, ...]]
    before: dict[str, tuple[float, ...]]
    after: dict[str, tuple[float, ...]]
    file: np.ndarray  # text feature x label
    step: np.ndarray  # label x label
    start: np.ndarray
    stop: np.ndarray


def silent() -> Model:
    """Without examples everything is outside."""
    return Model({}, {}, {}, np.tile([1.0, 0.0, 0.0], (8, 1)), np.zeros((3, 3)), np.zeros(3), np.zeros(3))


def respelled(value: str) -> str:
    """Another random value in its place, of one of SPELLINGS, the same for the same value."""
    pick = random.Random(hashlib.sha256(value.encode()).hexdigest())
    return "".join(pick.choices(pick.choice(SPELLINGS), k=pick.randint(*SPELLED_LENGTHS)))


def keyless(text: str, spell=respelled) -> tuple[str, list[Span]]:
    """The text with other values in place of its assignments, keys included, and the spans of those values and of the other patterns.

    Such a value tells the field what a secret looks like where no pattern shows it. Values without a digit or a
    letter can't be told from words and numbers; their assignments stay, with their spans.
    """
    parts, values, at, size = [], [], 0, 0
    for m in ASSIGN.finditer(text):
        value = m[2]
        if len(value) >= ASSIGN_CHARS and any(c in "0123456789" for c in value) and any(c.isalpha() for c in value):
            value = spell(value)
            parts += [text[at : m.start()], value]
            size += len(parts[-2]) + len(value)
            values.append(Span("assign", size - len(value), size))
            at = m.end()
    left = "".join(parts) + text[at:]
    others = [s for s in base_spans(left) if not any(s.start < v.end and v.start < s.end for v in values)] if values else []
    return left, sorted(values + others, key=lambda s: s.start)


def examples(text: str, windows: int = SAMPLE_WINDOWS, width: int = WINDOW) -> list[tuple[list[str], list[int], int]]:
    """Windows of a text: word keys, labels from the patterns, and the file feature; and those of the text without its keys.

    Up to ``windows`` windows around spans, and one around the middle word. From the patterns' matches alone the field would only
    learn the patterns, so a text with assignments has twins without the key words: one with the values as they are, one with values respelled.
    """
    out = _windows(text, base_spans(text), windows, width)
    for spell in (str, respelled):
        left, values = keyless(text, spell)
        out += _windows(left, values, windows, width) if values else []
    return out


def _windows(text: str, spans: list[Span], windows: int, width: int) -> list[tuple[list[str], list[int], int]]:
    spots = [m.span() for m in WORD.finditer(text)]
    words = [text[a:b] for a, b in spots]
    if not words:
        return []
    labels, at, centres = [OUTSIDE] * len(words), 0, [len(words) // 2]
    for span in spans:
        while at < len(spots) and spots[at][1] <= span.start:
            at += 1
        i = at
        while i < len(spots) and spots[i][0] < span.end:
            if labels[i] == OUTSIDE:
                labels[i] = BEGIN if i == at else INSIDE
            i += 1
        centres.append(at)
    centres = centres[:1] + centres[1:][:: max(1, (len(centres) - 1) // windows)][:windows]
    mark = text_feature(sum(any(c in "0123456789" for c in w) for w in words), len(words))
    out = []
    for centre in sorted(set(centres)):
        a = max(0, min(centre - width // 2, len(words) - width))
        out.append(([word_key(w) for w in words[a : a + width]], labels[a : a + width], mark))
    return out


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _marginals(scores, mask, step, start, stop):
    """Label and transition marginals of padded sequences by forward and backward sums."""
    n, width, _ = scores.shape
    last = mask.sum(1) - 1
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0] + start
    for t in range(1, width):
        new = _log_sum(forward[:, t - 1, :, None] + step, 1) + scores[:, t]
        forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
    backward[np.arange(n), last] = stop
    for t in range(width - 2, -1, -1):
        new = _log_sum((backward[:, t + 1] + scores[:, t + 1])[:, None, :] + step, 2)
        backward[:, t] = np.where((t < last)[:, None], new, backward[:, t])
    total = _log_sum(forward[np.arange(n), last] + stop, 1)
    labels = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
    pair = forward[:, :-1, :, None] + step + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
    moves = (np.exp(pair) * mask[:, 1:, None, None]).sum((0, 1))
    return labels, moves


def train(sample: list[tuple[list[str], list[int], int]]) -> Model:
    """Maximum conditional likelihood of the sample, with a quadratic penalty, by full-batch Adam steps."""
    sample = [s for s in sample if s[0]]
    if not any(any(labels) for _, labels, _ in sample):
        return silent()
    keys = sorted({k for words, _, _ in sample for k in words})
    number = {k: i + 1 for i, k in enumerate(keys)}  # 0: no word
    features, rows, columns = {}, [], []
    for k in keys:
        for f in word_features(k):
            rows.append(number[k])
            columns.append(features.setdefault(f, len(features)))
    rows, columns = np.array(rows), np.array(columns)
    beside = np.array([f.startswith("n:") for f in features])
    near = beside[columns]
    width, n = max(len(w) for w, _, _ in sample), len(sample)
    words = np.zeros((n, width + 2), dtype=np.int64)
    gold = np.full((n, width), -1)
    for i, (own, labels, _) in enumerate(sample):
        words[i, 1 : len(own) + 1] = [number[k] for k in own]
        gold[i, : len(own)] = labels
    marks = np.array([m for _, _, m in sample])
    mask = gold >= 0
    truth = (gold[:, :, None] == np.arange(3)) & mask[:, :, None]
    last = mask.sum(1) - 1
    roles = ((words[:, 1:-1], rows, columns), (words[:, :-2], rows[near], columns[near]), (words[:, 2:], rows[near], columns[near]))
    shapes = [(len(features), 3)] * 3 + [(8, 3), (3, 3), (3,), (3,)]
    weights = [np.zeros(s) for s in shapes]
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    seen_moves = np.zeros((3, 3))
    ok = mask[:, 1:]
    np.add.at(seen_moves, (gold[:, :-1][ok], gold[:, 1:][ok]), 1)
    for turn in range(1, STEPS + 1):
        scores = np.repeat(weights[3][marks][:, None, :], width, axis=1)
        for (at, r, c), w in zip(roles, weights):
            table = np.stack([np.bincount(r, w[c, j], minlength=len(keys) + 1) for j in range(3)], axis=1)
            scores = scores + table[at]
        labels, moves = _marginals(scores, mask, *weights[4:])
        gap = truth - labels
        slopes = []
        for at, r, c in roles:
            by_word = np.stack([np.bincount(at.ravel(), gap[:, :, j].ravel(), minlength=len(keys) + 1) for j in range(3)], axis=1)
            slopes.append(np.stack([np.bincount(c, by_word[r, j], minlength=len(features)) for j in range(3)], axis=1))
        of_file = np.zeros((8, 3))
        np.add.at(of_file, marks, gap.sum(1))
        slopes += [of_file, seen_moves - moves, gap[:, 0].sum(0), gap[np.arange(n), last].sum(0)]
        for i, slope in enumerate(slopes):
            slope = slope / n - PENALTY * weights[i]
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope * slope
            weights[i] = weights[i] + STEP_SIZE * (first[i] / (1 - 0.9**turn)) / (np.sqrt(second[i] / (1 - 0.99**turn)) + 1e-8)
    own, before, after = ({f: tuple(w[j].tolist()) for f, j in features.items()} for w in weights[:3])
    return Model(own, before, after, *weights[3:])


class Tagger:
    """Decodes with a model. Scores of words are remembered, about ``keep`` words of at most LONG_WORD code points."""

    def __init__(self, model: Model, keep: int = 200_000):
        self.model, self.keep = model, keep
        self._reset()

    def _reset(self):
        self.of_word: dict[str, int] = {}
        self.of_key: dict[str, int] = {}
        self.table = np.zeros((1024, 10))  # own, before, after, and whether it has a digit
        self.used = 1  # row 0: no word

    def _row(self, word: str) -> int:
        key = word_key(word)
        row = self.of_key.get(key)
        if row is None:
            row = self.of_key[key] = self.used
            if row == len(self.table):
                self.table = np.vstack([self.table, np.zeros_like(self.table)])
            m, zero = self.model, (0.0, 0.0, 0.0)
            for f in word_features(key):
                self.table[row, 0:3] += m.own.get(f, zero)
                if f.startswith("n:"):
                    self.table[row, 3:6] += m.before.get(f, zero)
                    self.table[row, 6:9] += m.after.get(f, zero)
            self.table[row, 9] = any(c in "0123456789" for c in word)
            self.used += 1
        if len(word) <= LONG_WORD:
            self.of_word[word] = row
        return row

    def tag(self, texts: list[list[str]]) -> list[list[tuple[int, int]]]:
        """First and last word of the secrets of each text, by Viterbi over its whole length.

        Where the score of outside beats both other labels by more than two transitions can
        make up, every best path passes through it; the sequence is cut there without change of the result.
        """
        if self.used > self.keep:
            self._reset()
        elif len(self.of_word) > self.keep:
            self.of_word.clear()  # the rows of their keys stay
        get, flat = self.of_word.get, []
        for words in texts:
            found = list(map(get, words))
            if None in found:
                # Looked up again, as a word may occur twice.
                found = [get(w) or self._row(w) if r is None else r for r, w in zip(found, words)]
            flat += found
        sizes = np.array([len(w) for w in texts])
        rows = np.array(flat, dtype=np.int64)
        if not len(rows):
            return [[] for _ in texts]
        text = np.repeat(np.arange(len(texts)), sizes)
        is_first = np.r_[True, text[1:] != text[:-1]]
        is_last = np.r_[is_first[1:], True]
        digits = np.bincount(text, self.table[rows, 9], minlength=len(texts))
        marks = np.array([text_feature(int(d), int(s)) for d, s in zip(digits, sizes)])
        before = np.where(is_first, 0, np.r_[0, rows[:-1]])
        after = np.where(is_last, 0, np.r_[rows[1:], 0])
        scores = self.table[rows, 0:3] + self.table[before, 3:6] + self.table[after, 6:9] + self.model.file[marks][text]
        m = self.model
        moves = np.r_[m.step.ravel(), m.start, m.stop]
        margin = scores[:, OUTSIDE] - scores[:, 1:].max(axis=1)
        unsure = np.flatnonzero(margin <= 2 * (moves.max() - moves.min()) + 1e-9)
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not len(unsure):
            return out
        new = np.r_[True, (np.diff(unsure) > 1) | is_first[unsure[1:]]]
        starts = unsure[new]
        lengths = np.diff(np.r_[np.flatnonzero(new), len(unsure)])
        labels = self._viterbi(scores, starts, lengths, is_first, is_last)
        firsts = np.cumsum(sizes) - sizes
        open_ = None
        for place, label in zip(unsure.tolist(), labels.tolist()):
            if label == OUTSIDE:
                open_ = None
                continue
            t = int(text[place])
            if label == INSIDE and open_ == (t, place - 1):
                first, _ = out[t][-1]
                out[t][-1] = (first, place - int(firsts[t]))
            else:
                out[t].append((place - int(firsts[t]),) * 2)
            open_ = (t, place)
        return out

    def _viterbi(self, scores, starts, lengths, is_first, is_last):
        """Best labels of runs of words, all runs at once, between words that are outside or the text's ends."""
        m = self.model
        order = np.argsort(-lengths, kind="stable")
        begins, sizes = starts[order], lengths[order]
        width = int(sizes[0])
        best = np.where(is_first[begins][:, None], m.start, m.step[OUTSIDE]) + scores[begins]
        back = np.zeros((width, len(begins), 3), dtype=np.int8)
        final = np.zeros((len(begins), 3))
        for t in range(width):
            alive = int(np.searchsorted(-sizes, -t, side="left"))  # runs longer than t
            if t:
                through = best[:alive, :, None] + m.step
                back[t, :alive] = through.argmax(1)
                best = through.max(1) + scores[begins[:alive] + t]
            ends = sizes[:alive] == t + 1
            closing = np.where(is_last[begins[:alive][ends] + t][:, None], m.stop, m.step[:, OUTSIDE])
            final[:alive][ends] = best[:alive][ends] + closing
            best = best[:alive]
        labels = np.zeros(int(lengths.sum()), dtype=np.int64)
        offsets = (np.cumsum(lengths) - lengths)[order]
        now = final.argmax(1)
        for t in range(width - 1, -1, -1):
            alive = sizes > t
            labels[offsets[alive] + t] = now[alive]
            if t:
                now = np.where(alive, back[t, np.arange(len(now)), now], now)
        return labels


# ---- whole tables ---------------------------------------------------------------------------

_EDGES = "\"'.,;:()[]{}<>`"


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and all spans: the tagged ones are added, without quotes and stops at their edges, but for those inside a base span.

    A tagged span may overlap base spans, which stay as they are: what it holds beyond them counts too.
    """
    tagged = tagger.tag([WORD.findall(t) for t in texts])
    out = []
    for text, found in zip(texts, tagged):
        base = base_spans(text)
        spans = list(base)
        if found:
            spots = [m.span() for m in WORD.finditer(text)]
            for first, last in found:
                start, end = spots[first][0], spots[last][1]
                while start < end and text[start] in _EDGES:
                    start += 1
                while end > start and text[end - 1] in _EDGES:
                    end -= 1
                if start < end and not any(b.start <= start and end <= b.end for b in base):
                    spans.append(Span("crf", start, end))
        out.append((base, sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))))
    return out


def redact(text: str, spans: list[Span]) -> str:
    """Each span, or group of overlapping spans, replaced by REDACTED."""
    parts, at, end = [], 0, -1
    for span in sorted(spans, key=lambda s: s.start):
        if span.start >= max(end, 0):
            parts += [text[at : span.start], REDACTED]
        end = max(end, span.end)
        at = end
    return "".join(parts) + text[at:]


def fit(docs: DataFrame, texts: int = SAMPLE_TEXTS, holding: int = SAMPLE_HOLDING) -> Model:
    """Train on a sample in two parts: the only part that a sample decides.

    The ``texts`` distinct texts with the smallest hashes show how common secrets are, and the ``holding`` ones
    of those with a base match are examples wherever the table has any, however rare. A text can be in both and counts once.
    The driver gets their windows, at most 3 (SAMPLE_WINDOWS + 1) of WINDOW word keys each; a key is at most a few hundred characters.
    """
    pin(docs.sparkSession)
    rows = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("mark"), "text")

    def matched(batches):
        for batch in batches:
            marks, own = (batch.column(i).to_pylist() for i in (0, 1))
            yield pa.RecordBatch.from_pydict({"mark": pa.array([m for m, t in zip(marks, own) if base_spans(t)], pa.int64())})

    chosen = rows.select("mark").distinct().orderBy("mark").limit(texts)
    matches = rows.mapInArrow(matched, "mark long").distinct().orderBy("mark").limit(holding)
    chosen = chosen.union(matches).distinct()

    def windows(batches):
        for batch in batches:
            rows = [(m, w, y, f) for m, t in zip(*(batch.column(i).to_pylist() for i in (0, 1))) for w, y, f in examples(t)]
            if rows:
                m, w, y, f = zip(*rows)
                yield pa.RecordBatch.from_pydict({
                    "mark": pa.array(m, pa.int64()), "words": pa.array(w, pa.list_(pa.string())),
                    "labels": pa.array(y, pa.list_(pa.int32())), "file": pa.array(f, pa.int32())})

    found = rows.join(F.broadcast(chosen), "mark", "left_semi").mapInArrow(
        windows, "mark long, words array<string>, labels array<int>, file int").distinct().orderBy("mark", "words")
    return train([(r.words, r.labels, r.file) for r in found.collect()])


#: The tagger of this worker process and the fit it belongs to.
_KEPT: tuple[str, Tagger] | None = None


class _Shared:
    """A broadcast model; a worker process keeps one tagger for it."""

    def __init__(self, docs: DataFrame, model: Model | None):
        model = model or fit(docs)
        self.number, self.model = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)

    def tagger(self) -> Tagger:
        global _KEPT
        if _KEPT is None or _KEPT[0] != self.number:
            _KEPT = (self.number, Tagger(self.model.value))
        return _KEPT[1]


DIGESTS = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Counts and digest of the base spans and the string of all spans, one row per row.

    Spans are ``kind:start:end`` in code points, by start, then kind. Null texts are empty and have none. A null ``doc_id`` stays null.
    """
    pin(docs.sparkSession)
    shared = _Shared(docs, model)

    def scanned(batches):
        tagger = shared.tagger()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in in_portions(texts):
                found = all_spans(texts[part], tagger)
                counts = {kind: pa.array([sum(s.kind == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS}
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[part], pa.int64()), "n_assign": counts["assign"],
                    "n_access": counts["access"], "n_hex": counts["hex"],
                    "base_sha256": [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found],
                    "spans": [_joined(spans) for _, spans in found]})

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return whole.mapInArrow(scanned, DIGESTS)


def redacted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every secret of its texts replaced; ``n_chars``, where there is one, follows. No row is dropped; null texts stay null."""
    pin(docs.sparkSession)
    shared = _Shared(docs, model)

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        tagger, values = shared.tagger(), texts.to_pylist()
        out = []
        for part in in_portions([v or "" for v in values]):
            own = values[part]
            found = all_spans([v or "" for v in own], tagger)
            out += [v if v is None else redact(v, spans) for v, (_, spans) in zip(own, found)]
        return pa.array(out, pa.string())

    out = docs.withColumn("text", cleaned("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
