"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated without labels.

Every rule looks at one figure of the text and says keep, reject, or nothing. Most look for a defect: that it is absent
says nothing, so they reject or abstain. Expectation-maximisation over the vote patterns of the whole table (their number
is bounded by 3 to the power of the rules, whatever the number of texts) estimates for good and for bad texts how often
each rule keeps, rejects and abstains, which is its accuracy and coverage on either kind, and the share of good texts. The
posterior probability of good quality given all votes takes the place of passing every rule.

Figures are counted over whole texts. Words are ``[^\\x20\\x09-\\x0D]+``. Null texts have no words; without words every rule
abstains, and the base check fails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import grams, slices, words_of
from tidemark.session import settled

ROUNDS = 60
#: What is believed before any text is seen, and the share of the texts that this belief weighs: how often a rule
#: rejects, abstains and keeps on bad texts and on good ones, and the share of good texts.
BELIEF = {"bad": (0.4, 0.5, 0.1), "good": (0.02, 0.4, 0.58)}
BELIEF_SHARE, GOOD = 0.005, 0.8

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_bare", "n_ends", "n_loud", "n_letters")
_SYMBOLS = b"#*$%&|<>"


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWER = _set(bytes(range(65, 91))), _set(bytes(range(97, 123)))
_LETTER = _UPPER | _LOWER | (np.arange(256) >= 0x80)
_SOLID = _LETTER | _set(b"0123456789")
_END, _LOUD = _set(b".?!"), _set(b"!")
_IS_SYMBOL = _set(_SYMBOLS)


def _per_row(row: np.ndarray, rows: int, value: np.ndarray) -> np.ndarray:
    return np.bincount(row, weights=value, minlength=rows).astype(np.int64)


def _inside(flags: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[stop] - sums[start]


def _repeated(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a (row, value) occurs more than once, and whether it is the first of its kind."""
    order = np.lexsort((value, row))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (value[order][1:] != value[order][:-1])
    size = np.diff(np.r_[np.flatnonzero(new), len(order)]) if len(order) else np.zeros(0, np.int64)
    many, first = np.empty(len(order), dtype=bool), np.empty(len(order), dtype=bool)
    many[order], first[order] = np.repeat(size > 1, size), new
    return many, first


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for row, data, offsets in slices(batch.column("text")):
            words, rows = words_of(data, offsets), len(offsets) - 1
            at, gram = grams(words, 3)
            many, _ = _repeated(words.row[at], gram)
            covered = np.zeros(len(words.row), dtype=bool)
            for step in range(3):
                covered[at[many] + step] = True
            _, first = _repeated(words.row, words.hash)
            chars = _inside((data & 0xC0) != 0x80, words.start, words.stop)
            upper, lower = (_inside(kind[data], words.start, words.stop) for kind in (_UPPER, _LOWER))
            bare = _inside(_SOLID[data], words.start, words.stop) == 0
            lines = np.array([_lines(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]).reshape(-1, 2)
            per = lambda value: _per_row(words.row, rows, value)  # noqa: B023, E731
            columns = [
                words.count,
                per(chars),
                _inside(_IS_SYMBOL[data], offsets[:-1], offsets[1:]),
                lines[:, 1],
                per(covered),
                lines[:, 0],
                per(first),
                per((upper > 0) & (lower == 0)),
                per(bare),
                per(_END[data[words.stop - 1]]),
                _inside(_LOUD[data], offsets[:-1], offsets[1:]),
                _inside(_LETTER[data] & ((data & 0xC0) != 0x80), offsets[:-1], offsets[1:]),
            ]
            yield pa.RecordBatch.from_arrays([ids.slice(row, rows), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", *FIGURES])


def _vote(figure: Column, keep: tuple[float, float] | None = None, below: float | None = None, above: float | None = None) -> Column:
    """-1 if the figure is under ``below`` or over ``above``, 1 inside ``keep`` (both ends included), else 0."""
    vote = F.when(F.lit(False), 0)
    if below is not None:
        vote = vote.when(figure < below, -1)
    if above is not None:
        vote = vote.when(figure > above, -1)
    if keep is not None:
        vote = vote.when(figure.between(*keep), 1)
    return F.coalesce(vote.otherwise(0), F.lit(0)).cast("int")


def rules() -> dict[str, Column]:
    """The vote of each rule on the figures of a text."""
    ratio = lambda part, whole="n_words": F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))
    enough = lambda vote, least=20, of="n_words": F.when(F.col(of) >= least, vote).otherwise(0)
    return {
        "sentences": enough(_vote(ratio("n_ends"), keep=(0.02, 0.3), below=0.005, above=0.6)),
        "letters": _vote(ratio("n_letters", "word_chars"), keep=(0.93, 1), below=0.8),
        "symbols": _vote(ratio("n_symbols"), above=0.2),
        "repeats": _vote(ratio("n_repeat_words"), above=0.3),
        "lines": enough(_vote(ratio("n_dup_lines", "n_lines"), above=0.3), 3, "n_lines"),
        "capitals": _vote(ratio("n_upper"), above=0.3),
        "length": _vote(ratio("word_chars"), below=2.5, above=8),
        "variety": enough(_vote(ratio("n_distinct"), below=0.15)),
        "bare": _vote(ratio("n_bare"), above=0.15),
        "loud": _vote(ratio("n_loud"), above=0.3),
    }


def estimate(votes: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """The share of good texts, and log odds of good over bad for each rule and vote (-1, 0, 1), from vote patterns."""
    total = max(1.0, float(count.sum()))
    belief = BELIEF_SHARE * total
    bad, fine = (np.repeat(np.array([BELIEF[k]]), votes.shape[1], axis=0) for k in ("bad", "good"))
    good, odds = GOOD, np.log(fine / bad)
    for _ in range(rounds):
        share = posterior(votes, good, odds) * count
        rates = []
        for weight, prior in ((count - share, BELIEF["bad"]), (share, BELIEF["good"])):
            used = np.stack([weight @ (votes == v) for v in (-1, 0, 1)], axis=1) + belief * np.array(prior)
            rates.append(used / used.sum(axis=1, keepdims=True))
        odds = np.log(rates[1] / rates[0])
        good = (share.sum() + GOOD * belief) / (total + belief)
    return float(good), odds


def posterior(votes: np.ndarray, good: float, odds: np.ndarray) -> np.ndarray:
    total = np.log(good / (1 - good)) + odds[np.arange(votes.shape[1]), votes + 1].sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, the figures, the votes (``vote_<rule>``) and ``quality``, the posterior probability, of every row."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in FIGURES)
    named = rules()
    votes = [f"vote_{name}" for name in named]
    table = settled(
        texts.mapInArrow(_figures, schema).select("*", *(vote.alias(f"vote_{name}") for name, vote in named.items())), "votes"
    )
    patterns = table.where("n_words > 0").groupBy(*votes).agg(F.count("*").alias("n")).toPandas()
    good, odds = estimate(patterns[votes].to_numpy(np.int64).reshape(-1, len(votes)), patterns["n"].to_numpy(np.float64), rounds)
    total = F.lit(float(np.log(good / (1 - good))))
    for name, (reject, abstain, keep) in zip(votes, odds.tolist(), strict=True):
        total = total + F.when(F.col(name) == -1, reject).when(F.col(name) == 1, keep).otherwise(abstain)
    return table.withColumn("quality", 1 / (1 + F.exp(-total)))
