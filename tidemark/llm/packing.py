"""Concatenate and cut: token sequences of one fixed length, without padding between documents.

Pass 1 tokenises every document once, in the partition it is read in, and writes the ids with the running offset
inside that partition (the *block*) to the shared folder. Pass 2 sums the token totals of the blocks; their prefix
sums are the global offset of each block, one number per partition. Then every document knows its place in the
endless row of tokens, and fixed windows cut it into pieces without moving any row. Pieces carry whether they are
the first and last of their document, which are the boundary records of a sequence.

The order of documents is the order in which they were written, which is fixed once pass 1 has committed.
Only the last sequence is padded. Null and empty texts have the end id alone; repeated rows are packed one by one; a very
long text is a group of its own. Other columns are ignored, whatever their names. An empty table has no pieces.

Ids are those of the tokenizer for the whole text. Its rules never cross white space, so words between ASCII white
space are taken out, a megabyte of text at a time, and every different one is looked at once; its parts come from a table
that each task fills as it goes. Words outside Latin letters, or that may hold special tokens, go through the tokenizer
whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled

TOKENS = 4096
END = 2
#: Parts of words that a task remembers before it starts over: about 200 bytes each.
REMEMBERED = 400_000
#: Bytes of text whose words are looked at together.
TOGETHER = 1 << 20

TOKENISED = "doc_id long, block int, at long, n long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, is_first boolean, is_last boolean"
)
#: Latin letters with their accents, and printable ASCII: lower case and composition act on each by itself.
#: Words of anything else, or that may hold special tokens, are odd.
_ODD = re.compile(r"^[^\n]*?(?:<\||[^!-~¡-¬®-įı-ſ\n])[^\n]*", re.M)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next letter from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


@cache
def _rules(path: str):
    """The tokenizer of a file, and the pattern of its parts of words and of line ends if its other rules are the known ones."""
    import regex
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or []
    names = [n.get("type") for n in (rules.get("normalizer") or {}).get("normalizers") or []]
    known = names == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
    return Tokenizer.from_file(path), regex.compile(steps[0]["pattern"]["Regex"] + r"|\n") if known else None


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` that ``index`` names, one after another, and where each ends."""
    chosen = sizes[index]
    ends = np.cumsum(chosen)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[index] - (ends - chosen), chosen) + np.arange(total)], ends


class Tokens:
    """Ids of texts: every different word of a group of texts is looked at once, every different part of a word is remembered.

    Words are taken apart here only for the rules that are known; with any other file they go through the
    tokenizer whole.
    """

    def __init__(self, path: str):
        self.tokenizer, self.split = _rules(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        codes, width = np.arange(size, dtype=self.kind).tobytes(), self.kind.itemsize
        self.codes = [codes[i : i + width] for i in range(0, len(codes), width)]
        self.letters = _byte_letters() | {ord("\n"): "\n"}
        self.parts: dict[str, bytes] = {"\n": b""}

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text ends."""
        cut = pc.ascii_split_whitespace(texts.fill_null(""))
        words = cut.flatten().dictionary_encode()
        ids, ends = _gathered(*self._words(words.dictionary), words.indices.to_numpy())
        offsets = cut.offsets.to_numpy()
        return ids, np.append(0, ends)[offsets[1:] - offsets[0]]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, where those of each word start, and how many they are.

        Words hold no white space, so a line end parts them through all the steps.
        """
        if self.split:
            lines = _ODD.sub("", "\n".join([*words.to_numpy(zero_copy_only=False), ""]))
            found = pa.array(self.split.findall(unicodedata.normalize("NFC", lines).lower()), pa.string()).dictionary_encode()
            parts, index = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
            self._learn(parts)
            codes = [self.parts[p] for p in parts]
            flat = np.frombuffer(b"".join(codes), self.kind)
            sizes = np.array([len(c) for c in codes], np.int64) // self.kind.itemsize
            flat, ends = _gathered(flat, np.cumsum(sizes) - sizes, sizes, index)
            closing = np.flatnonzero(index == parts.index("\n")) if parts else np.zeros(0, np.int64)
            ends = ends[closing]
            empty = np.flatnonzero(np.diff(closing, prepend=-1) == 1)
        else:
            flat, ends = np.zeros(0, self.kind), np.zeros(len(words), np.int64)
            empty = np.arange(len(words))
        starts = np.append(0, ends[:-1])[: len(ends)]
        sizes = ends - starts
        others, at = [flat], len(flat)
        for i in empty.tolist():
            own = np.array(self.tokenizer.encode(words[i].as_py(), add_special_tokens=False).ids, self.kind)
            starts[i], sizes[i] = at, len(own)
            others.append(own)
            at += len(own)
        return np.concatenate(others), starts, sizes

    def _learn(self, parts: list[str]) -> None:
        if len(self.parts) > REMEMBERED:
            self.parts = {"\n": b""}
        new = [p for p in parts if p not in self.parts]
        if new:
            letters = "\n".join(new).encode().decode("latin-1").translate(self.letters).split("\n")
            tokenize, codes = self.tokenizer.model.tokenize, self.codes
            for part, spelled in zip(new, letters, strict=True):
                self.parts[part] = b"".join([codes[t.id] for t in tokenize(spelled)])


def _groups(texts: pa.Array) -> Iterator[slice]:
    """Ranges of texts of about a megabyte, or of one longer text."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + TOGETHER, "right")))
        yield slice(at, to)
        at = to


def _tokenised(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, block, at = Tokens(path), TaskContext.get().partitionId(), 0
        names = ["doc_id", "block", "at", "n", "ids"]
        for batch in batches:
            docs, texts = batch.column("doc_id"), batch.column("text")
            for group in _groups(texts):
                ids, ends = table.of(texts[group])
                ids = np.insert(ids, ends, end)
                ends = ends + np.arange(1, len(ends) + 1)
                sizes = np.diff(ends, prepend=0)
                offsets = np.append(0, ends * table.kind.itemsize).astype(np.int32)
                held = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                blocks = pa.array(np.full(len(ends), block, np.int32))
                columns = [docs[group], blocks, pa.array(at + ends - sizes), pa.array(sizes), held]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at += int(ends[-1])

    return run


def tokenised(docs: DataFrame, tokenizer: str, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass 1: doc_id, block, offset in the block, number of ids and the ids, from the shared folder."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return settled(texts.mapInArrow(_tokenised(tokenizer, end), TOKENISED), "tokens")


def _offsets(tokens: DataFrame) -> dict[int, int]:
    """Where each block begins in the row of all tokens: the prefix sums of the totals."""
    totals = tokens.groupBy("block").agg(F.sum("n").alias("n")).orderBy("block").collect()
    sums = np.cumsum([0, *(r["n"] for r in totals)])
    return {r["block"]: int(s) for r, s in zip(totals, sums, strict=False)}


def _cut(first: dict[int, int], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.bool_()] * 2
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for doc, block, at, n, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "block", "at", "n", "ids")), strict=True):
                place = first[block] + at
                wide = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(place + start, length)
                    size = min(n - start, length - offset)
                    crc = zlib.crc32(wide[start : start + size].tobytes())
                    piece = (doc, start, size, crc, n, sequence, offset, start == 0, start + size == n)
                    for column, value in zip(columns, piece, strict=True):
                        column.append(value)
                    start += size
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = TOKENS,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: its document, its range of that document's ids, its CRC-32, and its place in a sequence.

    The driver reads one total per partition of the input, and sends back one offset per partition.
    """
    tokens = tokenised(docs, tokenizer, end, id_col, text_col)
    return tokens.mapInArrow(_cut(_offsets(tokens), length), PIECES)


def sequences(docs: DataFrame, tokenizer: str, length: int = TOKENS, end: int = END, pad: int = 0, **columns) -> DataFrame:
    """sequence_id and the ids of each packed sequence, padded to ``length``; what a trainer reads.

    Pieces travel to their sequence, at most ``length`` ids each, so a group holds ``length`` ids.
    """
    tokens = tokenised(docs, tokenizer, end, **columns)
    first = _offsets(tokens)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, at, n, ids in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "n", "ids")), strict=True):
                place, start = first[block] + at, 0
                wide = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype(np.int32)
                while start < n:
                    sequence, offset = divmod(place + start, length)
                    size = min(n - start, length - offset)
                    rows.append({"sequence_id": sequence, "offset": offset, "ids": wide[start : start + size]})
                    start += size
            kinds = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    cut = tokens.mapInArrow(pieces, "sequence_id long, offset long, ids array<int>")
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]))
    return (
        cut.groupBy("sequence_id")
        .agg(joined.alias("ids"))
        .select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad), F.lit(length) - F.size("ids"))).alias("ids"))
    )
