"""Quality by labelling lines: a linear-chain conditional random field marks each line as content or boilerplate.

A line is described by shares and flags (``FEATURES``). The field scores a line's label by its features and by the label
of the line before; Viterbi decoding gives a document's best labelling as a whole, and the share of its words that are in
content lines decides whether it stays. Lines without a word are no part of the sequence.

There are labels of documents only, so lines are taught by them: those of a good document are content, those of a bad one
boilerplate unless a good document of the sample has the same line. The field is fitted to the likelihood of these
labellings by gradient steps over the forward and backward sums, on at most ``per_class`` documents of each label, those
of up to ``LINES_EACH`` lines. Labelling reads every whole text once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.lists import broadcast_if_short
from rowtide.llm.common import bounded_sample, ddl, id_and_text, per_slice, stored, tidy

PER_CLASS, LINES_EACH = 400, 500
ROUNDS, STEP, PENALTY = 200, 0.1, 1e-4
CONTENT_SHARE = 0.5
# Least words of a document, and the hundredths of its words that may be in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
# Bytes of a line whose words are listed at a time.
STRETCH = 4_000_000

SPACE, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
_CONTINUED = bytes(range(0x80, 0xC0))
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGITS, _STOPS = b"0123456789", b".?!,;:"
FEATURES = (
    "bias", "words", "few words", "symbols a word", "bars", "capitals", "exclamations a word", "digits",
    "ends a sentence", "starts with a capital", "length of words", "words like the one before", "line said before",
    "long without a stop", "first", "last",
)


def _words(line: bytes) -> Iterator[list[bytes]]:
    """The words of a line, a bounded stretch at a time."""
    at = 0
    while at < len(line):
        end = min(len(line), at + STRETCH)
        if end < len(line):
            # to the first blank beyond, so that no word is cut
            end = min((e for e in (line.find(b, end) for b in (b" ", b"\t", b"\v", b"\f", b"\r")) if e >= 0), default=len(line))
        yield line[at:end].split()
        at = end


def _count(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


@dataclass
class Measured:
    """A text's base measures, and its lines with a word: their features, numbers of words and digests."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: np.ndarray
    words: np.ndarray
    digests: list[bytes]

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


def _repeated(ids: np.ndarray, known: int) -> int:
    """Words in windows of three that are found twice or more."""
    if len(ids) < 4:
        return 0
    windows = ids[:-2] * known + ids[1:-1]
    if known**3 >= 1 << 63:
        windows = np.unique(windows, return_inverse=True)[1]
    windows = windows * known + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    found = np.zeros(len(ids), bool)
    for either in (order[1:][same], order[:-1][same]):
        for place in range(3):
            found[either + place] = True
    return int(found.sum())


def measure(text: bytes) -> Measured:
    numbers: dict[bytes, int] = {}
    seen: set[bytes] = set()
    every, features, sizes, digests, again = [], [], [], [], 0
    for line in text.split(b"\n"):
        bare = line.strip(SPACE)
        if not bare:
            continue
        # of a long line only a digest is kept
        name = line if len(line) < 64 else hashlib.blake2b(line, digest_size=32).digest()
        said = name in seen
        again += said
        seen.add(name)
        digests.append(name)
        ids = np.array([numbers.setdefault(w, len(numbers)) for part in _words(line) for w in part], np.int64)
        every.append(ids)
        count = len(ids)
        sizes.append(count)
        chars = len(line.translate(None, SPACE + _CONTINUED))
        upper, lower = _count(line, _UPPER), _count(line, _LOWER)
        features.append((
            1.0,
            min(1.0, np.log1p(count) / 5),
            float(count < 4),
            min(1.0, _count(line, SYMBOLS) / count),
            min(1.0, _count(line, b"|<>") / count),
            upper / max(1, upper + lower),
            min(1.0, line.count(b"!") / count),
            _count(line, _DIGITS) / chars,
            float(bare[-1] in b".?!"),
            float(bare[0] in _UPPER or bare[0] >= 0x80),
            min(1.0, chars / count / 15),
            float((ids[1:] == ids[:-1]).sum()) / count,
            float(said),
            float(count >= 8 and not _count(line, _STOPS)),
            0.0,
            0.0,
        ))
    lines = np.array(features, np.float32).reshape(-1, len(FEATURES))
    if len(lines):
        lines[0, -2] = lines[-1, -1] = 1.0
    ids = np.concatenate(every) if every else np.zeros(0, np.int64)
    return Measured(
        len(ids),
        len(text.translate(None, SPACE + _CONTINUED)),
        _count(text, SYMBOLS),
        again,
        _repeated(ids, len(numbers)),
        lines,
        np.array(sizes, np.int64),
        digests,
    )


@dataclass
class Field:
    """Labels 0 content, 1 boilerplate. ``line`` weighs the features for boilerplate, ``step[a, b]`` a line of label
    ``b`` after one of label ``a``."""

    line: np.ndarray
    step: np.ndarray

    def boilerplate(self, features: np.ndarray) -> np.ndarray:
        """The best labelling; of equal ones that with content first."""
        if not len(features):
            return np.zeros(0, bool)
        ((cc, cb), (bc, bb)) = self.step.tolist()
        scores = (features @ self.line).tolist()
        content, other = 0.0, scores[0]
        came_to_content, came_to_other = [], []
        for score in scores[1:]:
            to_content, to_other = other + bc > content + cc, other + bb > content + cb
            came_to_content.append(to_content)
            came_to_other.append(to_other)
            content, other = (
                other + bc if to_content else content + cc,
                (other + bb if to_other else content + cb) + score,
            )
        label = other > content
        labels = [label]
        for to_content, to_other in zip(reversed(came_to_content), reversed(came_to_other)):
            label = to_other if label else to_content
            labels.append(label)
        return np.array(labels[::-1], bool)


def train(sequences: list[np.ndarray], labels: list[np.ndarray]) -> Field:
    """Fit to labelled sequences, all of them at once: place by place over those that are as long."""
    field = Field(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    if not sequences:
        field.line[0] = -1.0  # nothing is known, all is content
        return field
    order = sorted(range(len(sequences)), key=lambda n: -len(sequences[n]))
    sequences, labels = [sequences[n] for n in order], [labels[n].astype(int) for n in order]
    length = np.array([len(s) for s in sequences])
    longest, count = int(length[0]), len(sequences)
    features = np.zeros((count, longest, len(FEATURES)))
    truth = np.zeros((count, longest), int)
    for n, (s, y) in enumerate(zip(sequences, labels)):
        features[n, : len(s)], truth[n, : len(s)] = s, y
    # how many of the sequences, longest first, reach a place
    reach = [int((length > t).sum()) for t in range(longest)]
    filled = np.arange(longest) < length[:, None]
    true_line = np.einsum("ntf,nt->f", features, truth * filled)
    both = filled[:, 1:]
    true_step = np.array([[((truth[:, :-1] == a) & (truth[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)])
    total = length.sum()
    moments = [[np.zeros_like(field.line), np.zeros_like(field.line)], [np.zeros((2, 2)), np.zeros((2, 2))]]
    for number in range(1, ROUNDS + 1):
        node = np.zeros((count, longest, 2))
        node[:, :, 1] = features @ field.line
        ahead, back = np.zeros_like(node), np.zeros_like(node)
        ahead[:, 0] = node[:, 0]
        for t in range(1, longest):
            n = reach[t]
            ahead[:n, t] = np.logaddexp(*(ahead[:n, t - 1, a, None] + field.step[a] for a in (0, 1))) + node[:n, t]
        for t in range(longest - 2, -1, -1):
            n = reach[t + 1]
            after = back[:n, t + 1] + node[:n, t + 1]
            back[:n, t] = np.logaddexp(*(after[:, b, None] + field.step[:, b] for b in (0, 1)))
        norm = np.logaddexp(*ahead[np.arange(count), length - 1].T)[:, None]
        chance = np.exp(ahead[:, :, 1] + back[:, :, 1] - norm) * filled
        slope_line = (np.einsum("ntf,nt->f", features, chance) - true_line) / total + PENALTY * field.line
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                pair = ahead[:, :-1, a] + field.step[a, b] + node[:, 1:, b] + back[:, 1:, b] - norm
                expected[a, b] = np.exp(np.where(both, pair, -np.inf)).sum()
        slope_step = (expected - true_step) / total + PENALTY * field.step
        for value, slope, (mean, square) in zip((field.line, field.step), (slope_line, slope_step), moments):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            value -= STEP * (mean / (1 - 0.9**number)) / (np.sqrt(square / (1 - 0.99**number)) + 1e-8)
    return field


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = PER_CLASS,
) -> Field:
    """Learn from the rows of ``labels`` (``id_col``, ``label_col`` 1 good or 0 bad) whose document is in ``docs``.

    Rows with a null id or label are left out, of contradicting labels the larger counts. Without labelled lines every
    line is content.
    """
    marked = labels.select(id_col, F.col(label_col).cast("int").alias("good")).filter("good in (0, 1)")
    marked = marked.groupBy(id_col).agg(F.max("good").alias("good"))
    chosen = stored(bounded_sample(marked, id_col, "good", per_class), "lines-sample")
    texts = id_and_text(docs, id_col, text_col).join(broadcast_if_short(chosen.withColumnRenamed(id_col, "id")), "id")
    texts = texts.select("good", "text", F.xxhash64("id", "text").alias("turn"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py() or b"") for t in batch.column(1)]
            short = pa.array([0 < len(m.words) <= LINES_EACH for m in found], pa.bool_())
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array([m.features.tobytes() if len(m.words) <= LINES_EACH else b"" for m in found], pa.binary()),
                pa.array([m.digests if len(m.words) <= LINES_EACH else [] for m in found], pa.list_(pa.binary())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["good", "turn", "features", "digests"]).filter(short)

    # at most 2 x per_class rows of LINES_EACH lines
    learned = texts.mapInArrow(tidy(describe), "good int, turn long, features binary, digests array<binary>").collect()
    learned.sort(key=lambda r: (r["turn"], r["good"], bytes(r["features"])))
    known = {bytes(d) for r in learned if r["good"] for d in r["digests"]}
    sequences = [np.frombuffer(r["features"], np.float32).reshape(-1, len(FEATURES)) for r in learned]
    said = [np.array([not r["good"] and bytes(d) not in known for d in r["digests"]], bool) for r in learned]
    return train(sequences, said)


def judge(
    docs: DataFrame,
    field: Field,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_share: float = CONTENT_SHARE,
) -> DataFrame:
    """``<id_col>, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share,
    n_content_lines`` for every row.

    Words are what blanks (space and \\t to \\r) part. ``n_dup_lines`` counts lines with a word that equal an earlier
    line, ``n_repeat_words`` the words in windows of three words that the text has twice or more. A document fails at once
    below ``LEAST_WORDS`` words or with more than ``MOST_REPEATED`` hundredths of them in such windows; else it is kept if
    at least ``content_share`` of its words are in content lines. A null text has no words and fails; its share is 0.
    Null ids and repeated rows stay, other columns are not looked at, an empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(9)]
        for text in batch.column(1):
            found = measure(text.as_py() or b"")
            content = ~field.boilerplate(found.features)
            share = float(found.words[content].sum()) / found.n_words if found.n_words else 0.0
            kept = not found.base_failed and share >= content_share
            values = [getattr(found, n) for n in names]
            for column, value in zip(out, [*values, found.base_failed, kept, share, int(content.sum())]):
                column.append(value)
        types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(out, types))],
            ["id", *names, "base_failed", "kept", "content_share", "n_content_lines"],
        )

    columns = ", ".join(f"{n} long" for n in names)
    schema = f"id {ddl(rows, 'id')}, {columns}, base_failed boolean, kept boolean, content_share double, n_content_lines long"
    return rows.mapInArrow(per_slice(work), schema).withColumnRenamed("id", id_col)
