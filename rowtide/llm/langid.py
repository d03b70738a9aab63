"""Language of texts and of the spans inside a text.

Script ranges narrow the languages a word can have: those whose training texts use its script. Every word gets a score
per language from hashed character trigrams (its edges count as blanks), and a Viterbi pass with a penalty per change of
language labels the words, so mixed texts come out as spans.

The counts are fitted on at most ``per_language`` texts of each language, chosen by a hash of their id, so the model and
the fit have a bounded size. Texts are labelled in full.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.lists import broadcast_if_short
from rowtide.llm.common import BATCH_ROWS, bounded_sample, carried_row, ddl, small_batches, stored, tidy

# Scripts and their main ranges of code points. What lies in none of them is script 0, "other".
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF), (0xFB1D, 0xFB4F))),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("gurmukhi", ((0xA00, 0xA7F),)),
    ("gujarati", ((0xA80, 0xAFF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("telugu", ((0xC00, 0xC7F),)),
    ("kannada", ((0xC80, 0xCFF),)),
    ("malayalam", ((0xD00, 0xD7F),)),
    ("sinhala", ((0xD80, 0xDFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("lao", ((0xE80, 0xEFF),)),
    ("tibetan", ((0xF00, 0xFFF),)),
    ("myanmar", ((0x1000, 0x109F),)),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("ethiopic", ((0x1200, 0x139F),)),
    ("khmer", ((0x1780, 0x17FF),)),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("han", ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)
UNKNOWN = "und"
FEATURES = 1 << 14
PER_LANGUAGE = 2000
SWITCH_PENALTY = 12.0
# A language is a candidate for a script that holds at least this share of its training letters.
SCRIPT_SHARE = 0.01
# Code points handled at a time; one longer text is handled alone.
CHARS_AT_A_TIME = 1_500_000


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: whether it is part of a word (letter or mark), whether it is a letter, its lower case, its script."""
    every = range(sys.maxunicode + 1)
    category = [unicodedata.category(chr(c))[0] for c in every]
    word = np.array([c in "LM" for c in category])
    lower = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in np.flatnonzero(word).tolist():
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    script = np.zeros(sys.maxunicode + 1, np.uint8)
    for number, (_, ranges) in enumerate(SCRIPTS, 1):
        for first, last in ranges:
            script[first : last + 1] = number
    return word, np.array([c == "L" for c in category]), lower, script


@dataclass
class Words:
    """The words of several texts, one after another."""

    starts: np.ndarray  # code point at which a word begins, in its text
    lengths: np.ndarray
    letters: np.ndarray  # a word of marks alone has none
    scripts: np.ndarray
    features: np.ndarray  # one per letter
    first_feature: np.ndarray  # per word
    first_word: np.ndarray  # per text, and the number of words at the end


def read_words(texts: list[str]) -> Words:
    is_word, is_letter, lower, script = _characters()
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
    inside = is_word[points]
    small = np.where(inside, lower[points], np.uint32(0))
    hashed = small * np.uint32(0x9E3779B1)
    hashed[1:] += small[:-1] * np.uint32(0x85EBCA6B)
    hashed[:-1] += small[1:] * np.uint32(0xC2B2AE35)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    at = np.flatnonzero(inside)
    features = (hashed[at] >> np.uint32(18)).astype(np.uint16)
    opens = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    begin = at[opens]
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    first_word = np.searchsorted(begin, offsets)
    text_of = np.repeat(np.arange(len(texts)), np.diff(first_word))
    lengths = np.diff(np.append(opens, len(at)))
    letters = np.add.reduceat(is_letter[points[at]].astype(np.int64), opens) if len(opens) else lengths
    return Words(begin - offsets[text_of], lengths, letters, script[points[begin]], features, opens, first_word)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # language x feature: log probability
    candidates: np.ndarray  # script x language

    def score(self, words: Words) -> np.ndarray:
        """Word x language."""
        out = np.zeros((len(words.starts), len(self.languages)), np.float32)
        if len(out):
            for number, weights in enumerate(self.weights):
                out[:, number] = np.add.reduceat(weights[words.features], words.first_feature)
        known = self.candidates.any(1)
        # a word in a script that no language uses says nothing
        out[~known[words.scripts]] = 0
        barred = known[:, None] & ~self.candidates
        out[barred[words.scripts]] -= 1e6
        return out

    def label(self, words: Words, penalty: float) -> np.ndarray:
        """The language of every word: the best path through its text, all texts of a batch step by step."""
        scores = self.score(words)
        first, counts = words.first_word[:-1], np.diff(words.first_word)
        order = np.argsort(-counts, kind="stable")
        first, counts = first[order], counts[order]
        active = np.searchsorted(-counts, -np.arange(1, (counts.max() if len(counts) else 0) + 1), side="right")
        stay = np.zeros(scores.shape, bool)
        best = np.zeros(len(scores), np.int16)
        path = np.zeros((len(first), len(self.languages)))
        for step, n in enumerate(active.tolist()):
            here, now = first[:n] + step, path[:n]
            if step:
                top = now.argmax(1)
                jump = now[np.arange(n), top] - penalty
                keep = now >= jump[:, None]
                stay[here], best[here] = keep, top
                now = np.where(keep, now, jump[:, None])
            path[:n] = now + scores[here]
        label = np.zeros(len(scores), np.int16)
        state = path.argmax(1)
        for step in range(len(active) - 1, -1, -1):
            n = active[step]
            here, now = first[:n] + step, state[:n]
            label[here] = now
            if step:
                state[:n] = np.where(stay[here, now], now, best[here])
        return label


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Learn from rows with a language. Without any the model knows no language and labels everything ``und``."""
    sample = stored(bounded_sample(docs, id_col, lang_col, per_language), "langid-sample").distinct()
    texts = small_batches(docs).select(id_col, lang_col, text_col).join(broadcast_if_short(sample), [id_col, lang_col], "left_semi")
    size = len(SCRIPTS) + 1 + FEATURES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = read_words([text or ""])
                total = sums.setdefault(lang, np.zeros(size, np.int64))
                total[: len(SCRIPTS) + 1] += np.bincount(
                    words.scripts, words.lengths, minlength=len(SCRIPTS) + 1
                ).astype(np.int64)
                total[len(SCRIPTS) + 1 :] += np.bincount(words.features, minlength=FEATURES)
        for lang, total in sums.items():
            slots = np.flatnonzero(total)
            columns = [pa.array([lang] * len(slots)), pa.array(slots), pa.array(total[slots])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "slot", "n"])

    counted = texts.select(F.col(lang_col).cast("string"), text_col).mapInArrow(count, "lang string, slot long, n long")
    # languages x (features + scripts) numbers, whatever the size of the corpus
    totals = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    langs = sample.select(F.col(lang_col).cast("string")).distinct()
    languages = sorted(row[0] for row in langs.toLocalIterator())
    counts = np.zeros((len(languages), size))
    if languages:
        number = {lang: i for i, lang in enumerate(languages)}
        rows = [number[lang] for lang in totals.column("lang").to_pylist()]
        counts[rows, totals.column("slot").to_numpy()] = totals.column("n").to_numpy()
    by_script, by_feature = counts[:, : len(SCRIPTS) + 1], counts[:, len(SCRIPTS) + 1 :] + 0.5
    share = by_script / np.maximum(1, by_script.sum(1, keepdims=True))
    weights = np.log(by_feature / by_feature.sum(1, keepdims=True)).astype(np.float32)
    return Model(languages, weights, (share >= SCRIPT_SHARE).T)


def _batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for number, text in enumerate(texts):
        if size and size + len(text) > CHARS_AT_A_TIME:
            yield start, number
            start, size = number, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def _spans(label: np.ndarray, starts: np.ndarray, lengths: np.ndarray, languages: list[str]) -> list[dict]:
    cut = np.flatnonzero(np.diff(label, prepend=-1))
    last = np.append(cut[1:], len(label)) - 1
    ends = starts[last] + lengths[last]
    return [{"start": int(s), "end": int(e), "lang": languages[n]} for s, e, n in zip(starts[cut], ends, label[cut])]


def identify(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    penalty: float = SWITCH_PENALTY,
    spans: bool = True,
    carry: bool = False,
) -> DataFrame:
    """``<id_col>, lang_pred, score`` and ``spans`` (array of start, end, lang in code points) for every row.

    ``lang_pred`` is the language of most letters (ties: the first by name) and ``score`` its share of them. Letters of
    scripts that no learned language uses are nobody's: they lower the share, to 0 where there are no others. A text
    that is null or has no letter is ``und`` with score 0 and no spans; marks are no letters. Null ids and repeated rows are kept, other
    columns are not looked at, an empty table gives no rows. With ``carry`` the whole row comes along as a struct
    ``row``.
    """
    text = docs[text_col].cast("string").alias("text")
    # a carried row has the text in it
    rows = small_batches(docs).select(docs[id_col].alias("id"), *(carried_row(docs, True) if carry else [text]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
    names = ["id", "lang_pred", "score", *["spans"] * spans, *["row"] * carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                column = batch.column("row").field(text_col) if carry else batch.column("text")
                texts = ["" if t is None else str(t) for t in column.to_pylist()]
                for a, b in _batches(texts):
                    words = read_words(texts[a:b])
                    label = known.label(words, penalty) if known.languages else None
                    ours = words.letters * known.candidates.any(1)[words.scripts] if known.languages else words.letters
                    langs, shares, found = [], [], []
                    for i, j in zip(words.first_word[:-1].tolist(), words.first_word[1:].tolist()):
                        every = words.letters[i:j].sum()
                        if not every or label is None:
                            langs.append(UNKNOWN), shares.append(0.0), found.append([])
                            continue
                        letters = np.bincount(label[i:j], ours[i:j])
                        top = int(letters.argmax())
                        langs.append(known.languages[top])
                        shares.append(float(letters[top] / every))
                        if spans:
                            found.append(_spans(label[i:j], words.starts[i:j], words.lengths[i:j], known.languages))
                    columns = [batch.column("id").slice(a, b - a), pa.array(langs, pa.string()), pa.array(shares, pa.float64())]
                    columns += [pa.array(found, kind)] * spans + ([batch.column("row").slice(a, b - a)] if carry else [])
                    yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {ddl(rows, 'id')}, lang_pred string, score double"
    schema += ", spans array<struct<start: bigint, end: bigint, lang: string>>" if spans else ""
    schema += f", row {ddl(rows, 'row')}" if carry else ""
    return rows.mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)
