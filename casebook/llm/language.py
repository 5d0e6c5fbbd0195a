"""Language identification of mixed-language text.

Script ranges narrow the languages a word may have, letter n-grams score each word, and Viterbi
decoding with a penalty per change labels spans of words.

* Training: letter 3- and 4-grams (hashed into ``BUCKETS``) of about ``per_language`` labelled texts
  of each language, those with the lowest hashes. The model is a fixed-size table of log odds.
* Prediction: every whole text. Long texts are scored in pieces of about ``PIECE`` characters, cut between words;
  the scores of the last word are carried into the next piece, and a byte per word and language is kept to trace the best
  labels back through the whole text. So labels do not depend on the pieces.
* Null text, or text without a letter: language ``und``, score 0, no span. No labelled row at all:
  every text is ``und``. Equal texts get equal results; extra columns are neither read nor kept.
* Languages tie: the first in alphabetical order. The score is the language's share of the letters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm.common import flat, narrow, place, query, table, text_batches

BUCKETS = 1 << 17
PER_LANGUAGE = 4000  # labelled texts that the model is fitted on, per language
SWITCH_PENALTY = 8.0  # natural log units that a change of language must gain
SMOOTHING = 0.05
PIECE = 1 << 19
UNDETERMINED = "und"

# First and last code point of the ranges of each script.
SCRIPTS = [
    ("latin", [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("armenian", [(0x531, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF), (0xFB1D, 0xFB4F)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("devanagari", [(0x900, 0x97F), (0xA8E0, 0xA8FF)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)]),
    ("hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)]),
    ("kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)]),
]


def letter_table() -> np.ndarray:
    """Per code point: 0 for no letter, 1 for a letter of no listed script, 2 and up for the scripts."""
    kinds = np.zeros(0x110000, np.uint8)
    for start in range(0, 0x110000, 0x1000):
        if 0xD800 <= start < 0xE000:
            continue
        kinds[start : start + 0x1000] = [chr(c).isalpha() for c in range(start, start + 0x1000)]
    for number, (_, ranges) in enumerate(SCRIPTS, 2):
        for first, last in ranges:
            part = kinds[first : last + 1]
            part[part > 0] = number
    return kinds


@dataclass
class Letters:
    """The letters of some texts in one row: n-gram buckets of each, and where words start."""

    grams: list[np.ndarray]
    word_start: np.ndarray  # index into the letters
    word_at: np.ndarray  # index into the characters
    word_script: np.ndarray
    word_size: np.ndarray


def letters_of(chars: np.ndarray, kinds: np.ndarray) -> Letters:
    """``chars``: lower-case code points; other characters than letters end words."""
    kind = np.concatenate([[0, 0], kinds[chars], [0, 0]]).astype(np.uint8)
    code = np.where(kind > 0, np.concatenate([[0, 0], chars, [0, 0]]), 0).astype(np.uint64)
    at = np.flatnonzero(kind)
    before, after = code[at - 1], code[at + 1]
    before2 = np.where(before > 0, code[at - 2], 0).astype(np.uint64)
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    trigram = (before * a + code[at] * b) ^ (after * c)
    fourgram = trigram * b + before2 * a + np.uint64(1)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    start = np.flatnonzero(kind[at - 1] == 0)
    return Letters(
        grams=[((g * a) >> shift).astype(np.int32) for g in (trigram, fourgram)],
        word_start=start,
        word_at=at[start] - 2,
        word_script=kind[at[start]],
        word_size=np.diff(np.append(start, len(at))),
    )


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


@dataclass
class Model:
    """Log odds of each n-gram bucket per language, and the languages of each script."""

    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages, float32
    allowed: np.ndarray  # scripts + 2 x languages

    def word_scores(self, letters: Letters) -> np.ndarray:
        if not len(letters.word_start):
            return np.zeros((0, len(self.languages)), np.float32)
        each = self.weights[letters.grams[0]]
        each += self.weights[letters.grams[1]]
        scores = np.add.reduceat(each, letters.word_start, axis=0)
        scores[~self.allowed[letters.word_script]] = -1e4
        return scores


def forward(scores: np.ndarray, size: np.ndarray, begins: np.ndarray, first: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word and language the best language of the word before, the scores after the last words, and the live texts.

    ``size`` has the words of each text, longest first, ``begins`` the row of its first word, ``first`` the scores
    carried in. Step t works on the texts that have a t-th word.
    """
    state = first.copy()
    back = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32)
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    own = np.arange(scores.shape[1])
    for t in range(longest):
        n = live[t]
        s = state[:n]
        best = s.argmax(axis=1)
        top = s[np.arange(n), best] - penalty
        stay = s >= top[:, None]
        rows = begins[:n] + t
        back[rows] = np.where(stay, own, best[:, None])
        state[:n] = np.where(stay, s, top[:, None]) + scores[rows]
        state[:n] -= state[:n].max(axis=1, keepdims=True)
    return back, state, live


def decode(scores: np.ndarray, size: np.ndarray, first: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Best language of each word of several texts at once, and the scores after the last word."""
    order = np.argsort(-size, kind="stable")
    begins = (np.cumsum(size) - size)[order]
    back, state, live = forward(scores, size[order], begins, first[order], penalty)
    label = np.zeros(len(scores), np.int64)
    now = state.argmax(axis=1)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        rows = begins[:n] + t
        label[rows] = now[:n]
        now[:n] = back[rows, now[:n]]
    last = np.empty_like(state)
    last[order] = state
    return label, last


def pieces(text: str, size: int):
    """Parts of about ``size`` characters that end between words; a longer word is in one part."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while end > start + 1 and text[end - 1].isalpha() and text[end].isalpha():
            end -= 1
        if end == start + 1:
            end = start + size
            while end < len(text) and text[end].isalpha():
                end += 1
        yield start, text[start:end]
        start = end
    yield start, text[start:]


def lowered(text: str) -> str:
    """Lower case of the same length; ``lower`` can change the number of characters, but places are taken in the text as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def label_long(text: str, model: Model, kinds: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, place and size of each word of one text, scored piece by piece and traced back as a whole."""
    state, parts = np.zeros((1, len(model.languages)), np.float32), []
    for start, part in pieces(text, PIECE):
        letters = letters_of(points(lowered(part)), kinds)
        back, state, _ = forward(model.word_scores(letters), np.array([len(letters.word_at)]), np.zeros(1, np.int64), state, penalty)
        parts.append((back, letters.word_at + start, letters.word_size))
    now, labels = int(state.argmax()), []
    for back, _, _ in reversed(parts):
        label = np.zeros(len(back), np.int64)
        for t in range(len(back) - 1, -1, -1):
            label[t] = now
            now = int(back[t, now])
        labels.append(label)
    return np.concatenate(labels[::-1]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])


def label_texts(texts: list[str], model: Model, kinds: np.ndarray, penalty: float, spans: bool):
    """Per text: letters of each language, and with ``spans`` the labelled ranges."""
    k = len(model.languages)
    counts = np.zeros((len(texts), k), np.int64)
    found: list[list] = [[] for _ in texts]

    def note(of: np.ndarray, label: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        """Words of the texts ``of``, at their places."""
        np.add.at(counts, (of, label), size)
        if spans and len(of):
            cut = np.flatnonzero(np.diff(of, prepend=-1) | np.diff(label, prepend=-1))
            end = np.append(cut[1:], len(of)) - 1
            for c, e in zip(cut, end):
                found[of[c]].append({"start": int(at[c]), "end": int(at[e] + size[e]), "lang": model.languages[label[c]]})

    groups, held = [], 0
    for i, text in enumerate(texts):
        if len(text) > PIECE:
            label, at, size = label_long(text, model, kinds, penalty)
            note(np.full(len(label), i), label, at, size)
            continue
        if not groups or held + len(text) > PIECE:
            groups.append([])
            held = 0
        groups[-1].append(i)
        held += len(text) + 1
    for group in groups:
        parts = [lowered(texts[i]) for i in group]
        letters = letters_of(points("\n".join(parts)), kinds)
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        size = np.diff(np.searchsorted(letters.word_at, begins))
        label, _ = decode(model.word_scores(letters), size, np.zeros((len(group), k), np.float32), penalty)
        note(np.repeat(group, size), label, letters.word_at - np.repeat(begins[:-1], size), letters.word_size)
    return counts, found


def fit(labelled: DataFrame, text: str, lang: str, per_language: int = PER_LANGUAGE) -> Model:
    """Fits the model on about ``per_language`` distinct texts of each language, those with the lowest hashes.

    The share of texts that makes so many is counted first, so that only chosen texts are moved. The
    result has a fixed size per language.
    """
    text_batches(labelled.sparkSession)
    rows = narrow(labelled, text, lang).toDF("text", "lang").where("text is not null and lang is not null")
    hashed = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    share = F.lit(0)
    for name, n in rows.groupBy("lang").agg(F.approx_count_distinct(hashed)).collect():  # one row per language
        share = F.when(F.col("lang") == name, F.lit(int((1 << 40) * min(1.0, per_language / max(n, 1))))).otherwise(share)
    chosen = rows.where(hashed < share).groupBy("lang", hashed.alias("hash")).agg(F.first("text").alias("text")).select("lang", "text")
    scripts = len(SCRIPTS) + 2

    def count(batches):
        kinds = letter_table()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                total = sums.setdefault(name, np.zeros(BUCKETS + scripts, np.int64))
                for _, part in pieces(value, PIECE):
                    letters = letters_of(code_points(part), kinds)
                    for grams in letters.grams:
                        total[:BUCKETS] += np.bincount(grams, minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(letters.word_script, weights=letters.word_size, minlength=scripts).astype(np.int64)
        for name, total in sums.items():
            slot = np.flatnonzero(total)
            yield pa.record_batch({"lang": pa.array([name] * len(slot)), "slot": pa.array(slot, pa.int32()), "n": pa.array(total[slot])})

    parts = chosen.repartition(8).mapInArrow(count, "lang string, slot int, n long")
    sums = parts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    totals = np.zeros((BUCKETS + scripts, len(languages)))
    totals[sums["slot"], [languages.index(x) for x in sums["lang"]]] = sums["n"]
    grams, script = totals[:BUCKETS], totals[BUCKETS:]
    share = (grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS) if languages else grams
    logs = np.log(share) if languages else grams
    weights = (logs - logs.mean(axis=1, keepdims=True) if languages else logs).astype(np.float32)
    allowed = script >= 0.01 * np.maximum(script.sum(axis=0), 1) if languages else script > 0
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, weights, allowed)


def identify(docs: DataFrame, model: Model, text: str = "text", penalty: float = SWITCH_PENALTY, spans: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``docs`` in ``keep``, ``lang_pred``, ``score``, and with ``spans`` an array of ``(start, end, lang)`` in code points."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.allowed))  # plain values: broadcasts are not pickled by value
    places, own = [place(docs, c) for c in keep], place(docs, text)
    sent_once = own in places and dict(flat(docs).dtypes)[own] == "string"  # the kept column is the text
    source = flat(docs).select(*places, *([] if sent_once else [F.col(own).cast("string").alias("text")]))
    text_at, kept = places.index(own) if sent_once else len(places), source.schema.fields[: len(places)]

    def run(batches):
        model, kinds = Model(*shared.value), letter_table()
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for whole in batches:
            for offset in range(0, whole.num_rows, 1000):
                batch = whole.slice(offset, 1000)
                texts = [t or "" for t in batch.column(text_at).to_pylist()]
                if model.languages:
                    counts, found = label_texts(texts, model, kinds, penalty, spans)
                    total, best = counts.sum(axis=1), counts.argmax(axis=1)
                    name = [model.languages[b] if n else UNDETERMINED for b, n in zip(best, total)]
                    score = np.where(total > 0, counts.max(axis=1) / np.maximum(total, 1), 0.0)
                else:
                    name, score, found = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
                columns = [batch.column(i) for i in range(len(kept))] + [pa.array(name, pa.string()), pa.array(score)]
                names = [f.name for f in kept] + ["lang_pred", "score"]
                if spans:
                    columns.append(pa.array(found, span_type))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())])
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    added += [T.StructField("spans", T.ArrayType(span))] * spans
    return source.mapInArrow(run, T.StructType([*kept, *added])).toDF(*keep, *[f.name for f in added])


def remainder(key: str):
    return F.crc32(F.col(key).cast("string")) % 5


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(remainder("doc_id") != 0), "text", "lang")
    found = identify(docs, model, keep=("doc_id",))
    return found.select("doc_id", (F.coalesce(remainder("doc_id"), F.lit(-1)) == 0).alias("held_out"), "lang_pred", "score")
