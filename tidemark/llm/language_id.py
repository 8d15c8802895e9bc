"""Language identification by unigram models whose segmentations are summed out.

Every language has a probability for each piece of one fixed public vocabulary. A word has the probability of all its
segmentations into pieces together, which a forward pass adds up; a text has that of its words (runs of letters, in
lower case) one after another. The language with the largest posterior wins (of equals the first by name).

Training runs expectation-maximisation on the word counts of each language: a forward and a backward pass give the
expected use of every piece. It sees about ``SAMPLE`` different labelled texts (all, if there are no more; copies count
once). Every language has the same part of them, or all its texts if they are fewer: those whose hash lies in as small a
part of all hashes. However many languages there are, a part is at least ``LEAST`` texts. These bounds, the number of
languages and the vocabulary bound what the driver holds. Scoring covers whole texts, and words already scored are
remembered by the worker.

Null texts and texts without a letter are ``und`` with score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE, LEAST = 3000, 100
ROUNDS = 4
#: Added to the expected use of each piece, so that no piece is impossible.
SMOOTHING = 0.02
#: Longest piece that is used, and longest stretch of a word that is scored in one go, in bytes; longer words
#: are scored stretch by stretch.
PIECE_BYTES, STRETCH = 16, 48
#: Probabilities below this are scaled, so that no stretch underflows.
TINY = 1e-100
REMEMBERED = 300_000
#: Stretches that are worked on together; they bound the memory of training and scoring.
TOGETHER = 2000
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x100000001B3)


class Model(NamedTuple):
    """Piece hashes in ascending order, log probabilities (pieces by languages), log priors, languages."""

    keys: np.ndarray
    log_p: np.ndarray
    prior: np.ndarray
    languages: list[str]


def vocabulary(path: str) -> np.ndarray:
    """The sorted hashes of the pieces of a sentencepiece model, and of every single byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).replace("▁", " ").lower().encode()
            if 0 < len(piece) <= PIECE_BYTES:
                pieces.add(piece)
    return np.unique(np.array([_hash(p) for p in pieces], dtype=np.uint64))


def _hash(piece: bytes) -> int:
    value = 0
    for b in piece:
        value = (value * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return value


def _stretches(words: list[str]) -> tuple[list[bytes], list[int]]:
    """A space and the word, cut into stretches, and the word that each belongs to."""
    parts, owner = [], []
    for i, word in enumerate(words):
        data = b" " + word.encode()
        for at in range(0, len(data), STRETCH):
            parts.append(data[at : at + STRETCH])
            owner.append(i)
    return parts, owner


def _lattice(parts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, dict]:
    """Lengths of the parts, and for each (start, length) the parts that have a piece there and which."""
    lengths = np.array([len(p) for p in parts])
    wide = int(lengths.max())
    data = np.frombuffer(b"".join(p.ljust(wide, b"\0") for p in parts), np.uint8).reshape(len(parts), wide).astype(np.uint64)
    edges = {}
    for start in range(wide):
        value = np.zeros(len(parts), np.uint64)
        for length in range(1, min(PIECE_BYTES, wide - start) + 1):
            value = value * _BASE + data[:, start + length - 1] + np.uint64(1)
            fits = np.flatnonzero(lengths >= start + length)
            if not len(fits):
                break
            at = np.minimum(np.searchsorted(keys, value[fits]), len(keys) - 1)
            hit = keys[at] == value[fits]
            if hit.any():
                edges[start, length] = (fits[hit], at[hit])
    return lengths, edges


def _lift(values: np.ndarray, level: np.ndarray, at: int, places: slice) -> bool:
    """Scale the places of the parts whose value at a position is near to nothing; ``level`` holds the logarithms of the scales."""
    small = (values[:, at] > 0) & (values[:, at] < TINY)
    rows = np.flatnonzero(small.any(axis=1))
    if len(rows):
        scale = np.where(small[rows], values[rows, at], 1)[:, None]
        values[rows, places] /= scale
        level[rows, places] += np.log(scale)
    return len(rows) > 0


def _forward(lengths: np.ndarray, edges: dict, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """alpha[part, position, language], the probability of all segmentations up to a position, level, and if any was lifted.

    The probability is alpha times the exponential of level.
    """
    wide = int(lengths.max())
    alpha = np.zeros((len(lengths), wide + 1, p.shape[1]))
    level = np.zeros(alpha.shape)
    alpha[:, 0] = 1
    lifted = False
    for start in range(wide):
        lifted |= _lift(alpha, level, start, slice(start, None))
        for length in range(1, PIECE_BYTES + 1):
            if (start, length) in edges:
                rows, piece = edges[start, length]
                alpha[rows, start + length] += alpha[rows, start] * p[piece]
    return alpha, level, lifted


def word_scores(words: list[str], model: Model) -> np.ndarray:
    """The log probability of each word in each language."""
    out = np.zeros((len(words), len(model.languages)))
    if not words:
        return out
    parts, owner = _stretches(words)
    p = np.exp(model.log_p)
    for at in range(0, len(parts), TOGETHER):
        some = parts[at : at + TOGETHER]
        lengths, edges = _lattice(some, model.keys)
        alpha, level, _ = _forward(lengths, edges, p)
        ends = np.arange(len(some)), lengths
        np.add.at(out, owner[at : at + TOGETHER], np.log(alpha[ends]) + level[ends])
    return out


def fit(counts: pd.DataFrame, keys: np.ndarray, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> Model:
    """A model from the columns lang, word, n (occurrences)."""
    languages = sorted(counts["lang"].unique())
    words = sorted(counts["word"].unique())
    weight = np.zeros((len(words), len(languages)))
    weight[np.searchsorted(words, counts["word"]), np.searchsorted(languages, counts["lang"])] = counts["n"]
    parts, owner = _stretches(words)
    p = np.full((len(keys), len(languages)), 1 / len(keys))
    for _ in range(rounds):
        used = np.full(p.shape, smoothing)
        for at in range(0, len(parts), TOGETHER):
            some, share = parts[at : at + TOGETHER], weight[owner[at : at + TOGETHER]]
            lengths, edges = _lattice(some, keys)
            alpha, level, lifted = _forward(lengths, edges, p)
            beta, below = np.zeros(alpha.shape), np.zeros(alpha.shape)
            beta[np.arange(len(some)), lengths] = 1
            for start in range(int(lengths.max()) - 1, -1, -1):
                for length in range(PIECE_BYTES, 0, -1):
                    if (start, length) in edges:
                        rows, piece = edges[start, length]
                        beta[rows, start] += beta[rows, start + length] * p[piece]
                lifted |= _lift(beta, below, start, slice(0, start + PIECE_BYTES + 1))
            total = np.maximum(beta[:, 0], 1e-300)
            for (start, length), (rows, piece) in edges.items():
                before, behind = alpha[rows, start], beta[rows, start + length]
                if lifted:
                    with np.errstate(divide="ignore"):
                        part = np.log(before) + level[rows, start] + np.log(behind) + below[rows, start + length]
                    np.add.at(used, piece, share[rows] * np.exp(part + np.log(p[piece]) - np.log(total[rows]) - below[rows, 0]))
                else:
                    np.add.at(used, piece, share[rows] * before * p[piece] * behind / total[rows])
        p = used / used.sum(axis=0)
    prior = np.log(np.full(len(languages), 1 / max(1, len(languages))))
    return Model(keys, np.log(p), prior, languages)


def shared_out(sizes: list[int], total: int) -> int:
    """The most that each may take so that all take ``total`` together, but at least ``LEAST``."""
    left = total
    for k, size in enumerate(sorted(sizes)):
        each = left // (len(sizes) - k)
        if size > each:
            return max(LEAST, each)
        left -= size
    return max(sizes, default=0)


def train(
    docs: DataFrame,
    vocabulary_path: str,
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    rounds: int = ROUNDS,
) -> Model:
    """Learn from the text and non-null language of ``docs``; all other columns are ignored."""
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    hashed = F.xxhash64("text")
    sizes = labelled.select(hashed, "lang").distinct().groupBy("lang").count().collect()
    most = shared_out([r["count"] for r in sizes], sample)
    limits = [(r["lang"], min(round((min(1.0, most / r["count"]) - 0.5) * 2.0**64), (1 << 63) - 1)) for r in sizes]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, least long")
    # Every task picks its own rows, and copies of a text meet before the shuffle; they do not count for the part.
    chosen = labelled.join(F.broadcast(limits), "lang").where(hashed <= F.col("least")).select("text", "lang").distinct()
    counts = chosen.mapInArrow(_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    table = counts.toPandas()
    if table.empty:
        return Model(vocabulary(vocabulary_path), np.zeros((0, 0)), np.zeros(0), [])
    return fit(table, vocabulary(vocabulary_path), rounds)


def letters(text: str | None) -> list[str]:
    """The words of a text; none, if all they hold are numbers such as fractions and Roman numerals."""
    return _LETTERS.findall(text.lower()) if isinstance(text, str) and any(map(str.isalpha, text)) else []


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[tuple[str, str], int] = {}
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            for word in letters(text.as_py()):
                found[lang, word] = found.get((lang, word), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(found.values(), pa.int64())],
            names=["lang", "word", "n"],
        )


def predictor(model: Model):
    """A column function: text to (lang_pred, score)."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        number: dict[str, int] = {}
        scores = np.zeros((0, len(model.languages)))
        for texts in series:
            out: list[tuple[str, float]] = []
            at = 0
            while at < len(texts):  # groups of texts of about a megabyte, so that new words are scored together
                group, held = [], 0
                while at < len(texts) and (not group or held < 1 << 20):
                    group.append(letters(texts.iat[at]))
                    held += 8 * len(group[-1])
                    at += 1
                if len(number) > REMEMBERED:
                    number, scores = {}, scores[:0]
                new = [w for w in dict.fromkeys(w for words in group for w in words) if w not in number]
                if new and model.languages:
                    number.update(zip(new, range(len(number), len(number) + len(new)), strict=True))
                    scores = np.vstack([scores, word_scores(new, model)])
                for words in group:
                    if not words or not model.languages:
                        out.append((UNDETERMINED, 0.0))
                        continue
                    total = scores[np.fromiter(map(number.__getitem__, words), np.int64, len(words))].sum(axis=0) + model.prior
                    best = int(total.argmax())
                    out.append((model.languages[best], float(1 / np.exp(total - total[best]).sum())))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return F.pandas_udf(run, kind)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior probability), found from the text alone."""
    found = docs.withColumn("__language", predictor(model)(F.col(text_col)))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return found.select(*kept, F.col("__language.lang_pred"), F.col("__language.score"))
