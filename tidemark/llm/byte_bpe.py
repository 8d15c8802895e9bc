"""Byte-level BPE: texts to token ids and back, with the place of every token.

Texts are cut into words without a regular expression: code points become classes, what the pattern must look ahead for
is folded into them by shifted arrays, and a small automaton reads the classes.  Its transitions are functions from
state to state that compose associatively, so the ends of all stretches of a block are read at once for every entry state;
where that leaves a state open, whole stretches are read and chained by a prefix scan.  One more pass marks where words begin.  Words are merged by rank, lowest and
leftmost first; short ones are kept in a table of each worker process.

Memory: a block of text, the vocabulary, a bounded table, and the ids of one slice of rows (a longer text is a slice of
its own).  No shuffle.

Rows: a null text reads as empty, an empty text has no tokens; repeated rows are encoded one by one; other columns are
carried along (``encoded``) under their own names, whatever they are.  An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.words import slices

#: Bytes of a block, code points of a stretch, bytes of a word that is remembered, and remembered words per process.
BLOCK, STRETCH, SHORT, REMEMBERED = 1 << 20, 512, 48, 1 << 18
#: Code points before a stretch that mostly tell its entry state, and ids that are turned into bytes at once.
TAIL, AT_ONCE = 8, 1 << 20
#: Words that merge side by side, and what is no rank.
TOGETHER, NEVER = 1 << 13, 1 << 40

#: Classes of code points ...
LETTER, NUMBER, OTHER, SPACE, WHITE, QUOTE = range(6)
#: ... and what follows from the next ones: a suffix of one or two letters after the quote, white space that ends its run.
SUFFIX1, SUFFIX2, LAST_SPACE, LAST_WHITE = range(6, 10)
KINDS = 10
#: States: a word just ended; in letters, numbers, others; after the space before a word; in white space; in a suffix.
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, BEFORE, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)
STATES = 8


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a word begins, by (begins a text, class) and state."""
    opened = {
        LETTER: IN_LETTERS,
        NUMBER: IN_NUMBERS,
        OTHER: IN_OTHERS,
        QUOTE: IN_OTHERS,
        SPACE: IN_WHITE,
        WHITE: IN_WHITE,
        SUFFIX1: ONE_LEFT,
        SUFFIX2: TWO_LEFT,
        LAST_SPACE: BEFORE,
        LAST_WHITE: DONE,
    }
    signs = (OTHER, QUOTE, SUFFIX1, SUFFIX2)
    joins = {(IN_LETTERS, LETTER): IN_LETTERS, (IN_NUMBERS, NUMBER): IN_NUMBERS, (BEFORE, LETTER): IN_LETTERS}
    joins |= {(BEFORE, NUMBER): IN_NUMBERS, (IN_WHITE, SPACE): IN_WHITE, (IN_WHITE, WHITE): IN_WHITE}
    joins |= {(state, sign): IN_OTHERS for state in (IN_OTHERS, BEFORE) for sign in signs}
    joins |= {(ONE_LEFT, kind): DONE for kind in range(KINDS)} | {(TWO_LEFT, kind): ONE_LEFT for kind in range(KINDS)}
    following = np.zeros((2 * KINDS, STATES), np.uint8)
    begins = np.ones((2 * KINDS, STATES), bool)
    for kind in range(KINDS):
        following[kind] = following[kind + KINDS] = opened[kind]
        for state in range(STATES):
            if (state, kind) in joins:
                following[kind, state], begins[kind, state] = joins[state, kind], False
    return following, begins


FOLLOWING, BEGINS = _tables()
#: By the first byte of a code point: its bytes, and the bits that byte adds.
WIDTH = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10, np.uint8)
FIRST_BITS = np.array([b if WIDTH[b] == 1 else b & (0x7F >> int(WIDTH[b])) for b in range(256)], np.int32)


def class_ranges() -> list[tuple[int, int, int]]:
    """(first, last, class) of code points that are no OTHER: letters and numbers as the library's own tables have them."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    found = []
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        listed = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        points = np.frombuffer(bytes(listed.encode_ordinary(every)).decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        cuts = np.flatnonzero(np.diff(points) > 1)
        firsts, lasts = points[np.r_[0, cuts + 1]], points[np.r_[cuts, len(points) - 1]]
        found += [(int(a), int(b), kind) for a, b in zip(firsts, lasts, strict=True)]
    return [*found, (0x20, 0x20, SPACE), (0x27, 0x27, QUOTE)]


def _points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte each begins at."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    point = FIRST_BITS[lead]
    more, size = np.flatnonzero(lead >= 0xC0), WIDTH[lead]
    for k in (1, 2, 3):
        more = more[size[more] > k]
        point[more] = (point[more] << 6) | (data[at[more] + k] & 0x3F)
    return point, at


def _classes(points: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Classes with the look ahead folded in; ``first`` marks code points that begin a text."""
    kind = table[points]
    ended = np.ones(len(kind), bool)  # the text ends after this code point
    ended[:-1] = first[1:]
    white = (kind == SPACE) | (kind == WHITE)
    goes_on = np.zeros(len(kind), bool)
    goes_on[:-1] = ~white[1:] & ~ended[:-1]
    out = kind.copy()
    out[(kind == SPACE) & goes_on] = LAST_SPACE
    out[(kind == WHITE) & goes_on] = LAST_WHITE
    quotes = np.flatnonzero((kind == QUOTE) & ~ended)
    if len(quotes):
        one = points[quotes + 1]
        out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SUFFIX1
        inner = quotes[~ended[quotes + 1]]
        pair = points[inner + 1] * 128 + np.minimum(points[inner + 2], 127)
        pairs = [ord(a) * 128 + ord(b) for a, b in ("re", "ve", "ll")]
        out[inner[np.isin(pair, pairs) & (points[inner + 1] < 128)]] = SUFFIX2
    return out + KINDS * first.astype(np.uint8)


def _scanned(kinds: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Where words begin, and the state after the last class."""
    n = len(kinds)
    rows = -(-n // STRETCH)
    padded = np.full(rows * STRETCH, KINDS + LAST_WHITE, np.uint8)
    padded[:n] = kinds
    grid = np.ascontiguousarray(padded.reshape(rows, STRETCH).T).astype(np.intp) * STATES
    step = FOLLOWING.ravel()
    entry = np.full(rows, state, np.intp)
    if rows > 1:
        tail = 0
        while tail < STRETCH:  # the last code points mostly lead every state to the same one
            tail = min(4 * tail or TAIL, STRETCH)
            maps = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))  # of each stretch: entry state to exit state
            for column in grid[-tail:]:
                maps = step[column[:, None] + maps]
            certain = (maps[:-1] == maps[:-1, :1]).all()
            if certain:
                break
        reach = 1
        while reach < rows and not certain:  # prefix scan: each map after all those before it
            joined = maps.copy()
            joined[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
            maps, reach = joined, 2 * reach
        entry[1:] = maps[:-1, state]
    marks = np.empty((STRETCH, rows), bool)
    begins = BEGINS.ravel()
    now, stop = entry, (n - 1) % STRETCH
    last = state
    for t, column in enumerate(grid):
        at = column + now
        marks[t] = begins[at]
        now = step[at]
        if t == stop:
            last = int(now[-1])
    return marks.T.ravel()[:n], last


def word_starts(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The byte each word begins at, in rows of UTF-8 bytes that lie one after another at ``offsets``."""
    begins_text = np.zeros(len(data) + 1, bool)
    begins_text[offsets] = True
    found, at, state = [], 0, DONE
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        while stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop += 1
        ahead = min(stop + 16, len(data))  # the look ahead is two code points
        while ahead < len(data) and data[ahead] & 0xC0 == 0x80:
            ahead += 1
        points, places = _points(data[at:ahead])
        own = int(np.searchsorted(places, stop - at))
        kinds = _classes(points, begins_text[at + places], table)[:own]
        marks, state = _scanned(kinds, state)
        found.append(at + places[:own][marks])
        at = stop
    return np.concatenate(found) if found else np.zeros(0, np.int64)


class Vocabulary:
    """Ranks of a file in tiktoken's form, and the classes of code points; one per path and worker process."""

    known: dict[tuple[str, bool], Vocabulary] = {}

    def __init__(self, path: str, ranges: list[tuple[int, int, int]]) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.table = np.full(0x110000, OTHER, np.uint8)
        for first, last, kind in ranges:
            self.table[first : last + 1] = kind
        self.size = np.zeros(max(self.tokens, default=0) + 1, np.int64)
        for rank, token in self.tokens.items():
            self.size[rank] = len(token)
        self.bytes = np.frombuffer(b"".join(self.tokens[rank] for rank in sorted(self.tokens)), np.uint8)
        self.begin = np.cumsum(self.size) - self.size
        self.single = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.remembered: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        if ranges:
            self.pair_keys, self.pair_ids = self._pairs()
            self.pair_of_bytes = self._joined(*np.broadcast_arrays(self.single[:, None], self.single))

    @classmethod
    def of(cls, path: str, ranges: list[tuple[int, int, int]]) -> Vocabulary:
        """One with ranges encodes; without any, it only turns ids into bytes."""
        kind = path, bool(ranges)
        if kind not in cls.known:
            cls.known[kind] = cls(path, ranges)
        return cls.known[kind]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every pair of tokens that is a token, as sorted keys, and that token's id."""
        found = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        keys = np.array(sorted(found), np.int64)
        return np.append(keys, np.iinfo(np.int64).max), np.array([*(found[k] for k in keys.tolist()), NEVER], np.int64)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of pairs of ids, ``NEVER`` where they make no token or one of them is padding."""
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ids[at], NEVER)

    def ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of several different words, as little-endian 32-bit numbers."""
        known, older, ranks = self.remembered, self.older, self.ranks
        found, new = [*map(known.get, words)], []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = older.get(word)
            if ids is None and word in ranks:
                ids = ranks[word].to_bytes(4, "little")
            elif ids is None and len(word) > SHORT:
                ids = np.array(self._merged_long(word), "<u4").tobytes()
            if ids is None:
                new.append(i)
            else:
                found[i] = ids
                if len(word) <= SHORT:
                    known[word] = ids
        new.sort(key=[*map(len, words)].__getitem__)
        for at in range(0, len(new), TOGETHER):
            part = new[at : at + TOGETHER]
            for i, ids in zip(part, self._merged([words[i] for i in part]), strict=True):
                found[i] = known[words[i]] = ids
        if len(known) > REMEMBERED:  # words in use come back from the older half
            self.older, self.remembered = known, {}
        return found

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """Many words at once: in each round every word merges its pair of lowest rank, the leftmost of equal ones."""
        size = np.array([len(word) for word in words])
        width = int(size.max())
        inside = np.arange(width) < size[:, None]
        single = np.frombuffer(b"".join(words), np.uint8)
        parts = np.full(inside.shape, -1, np.int64)
        parts[inside] = self.single[single]
        done, rows = np.full(inside.shape, -1, np.int64), np.arange(len(words))
        pairs = np.full(inside.shape, NEVER)  # what a part makes with the next one
        pairs[inside] = self.pair_of_bytes[single, np.append(single[1:], 0)]
        pairs[rows, size - 1] = NEVER
        while len(rows):
            at = pairs.argmin(axis=1)
            least = pairs[np.arange(len(rows)), at]
            merges = least < NEVER
            if not merges.all():
                done[rows[~merges], :width] = parts[~merges]
                rows, at, least, parts, pairs = rows[merges], at[merges], least[merges], parts[merges], pairs[merges]
            if not len(rows):
                break
            # every word that is left loses a part, so that the last column goes
            each, width = np.arange(len(rows)), width - 1
            stays = np.ones(parts.shape, bool)
            stays[each, at + 1] = False
            parts, pairs = parts[stays].reshape(-1, width), pairs[stays].reshape(-1, width)
            parts[each, at] = least
            after = np.where(at + 1 < width, parts[each, np.minimum(at + 1, width - 1)], -1)
            pairs[each, at] = self._joined(least, after)
            left = np.flatnonzero(at)
            pairs[left, at[left] - 1] = self._joined(parts[left, at[left] - 1], least[left])
        kept = done >= 0
        packed, ends = done[kept].astype("<u4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _merged_long(self, word: bytes) -> list[int]:
        """One word by a heap, which keeps long words from taking squared time."""
        ranks = self.ranks
        n = len(word)
        stop, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, middle, right = heapq.heappop(heap)
            if stop[left] != middle or middle >= n or stop[middle] != right:
                continue  # one of the two has merged since
            stop[left], stop[middle] = right, -1
            if right < n:
                before[right] = left
                rank = ranks.get(word[left : stop[right]])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, right, stop[right]))
            if left:
                first = before[left]
                rank = ranks.get(word[first:right])
                if rank is not None:
                    heapq.heappush(heap, (rank, first, left, right))
        found, at = [], 0
        while at < n:
            found.append(ranks[word[at : stop[at]]])
            at = stop[at]
        return found

    def encoded(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all rows, the byte within its row that each begins at, and the first id of each row."""
        cuts = np.r_[word_starts(data, offsets, self.table), len(data)].astype(np.int64)
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))]
        words = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).dictionary_encode()
        _, bounds, text = words.dictionary.buffers()
        bounds, text = np.frombuffer(bounds, np.int64)[: len(words.dictionary) + 1].tolist(), text.to_pybytes() if text else b""
        once = self.ids([text[a:b] for a, b in zip(bounds, bounds[1:])])
        size, at = np.array([len(ids) // 4 for ids in once], np.int64), words.indices.to_numpy()
        first = (np.cumsum(size) - size)[at]
        size = size[at]
        first -= np.cumsum(size) - size
        found = np.frombuffer(b"".join(once), "<u4")[np.repeat(first, size) + np.arange(size.sum())]
        ends = np.cumsum(self.size[found])
        place = ends - self.size[found]
        bounds = np.searchsorted(place, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        return found.astype(np.int32), place - offsets[row], bounds

    def decoded(self, ids: np.ndarray) -> bytes:
        found = []
        for first in range(0, len(ids), AT_ONCE):
            part = ids[first : first + AT_ONCE]
            size = self.size[part]
            ends = np.cumsum(size)
            found.append(self.bytes[np.repeat(self.begin[part] - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(found)


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``offsets`` (array<int>, array<long>) in place of the text: a token, and its first byte.

    ``path`` is a file of ranks that every executor can read.  Columns named so already are replaced.
    """
    ranges = class_ranges()
    kept = [f for f in docs.schema.fields if f.name not in (text, "ids", "offsets")]
    ids, offsets = T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("offsets", T.ArrayType(T.LongType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(path, ranges)
        names = [*(f.name for f in kept), "ids", "offsets"]
        for batch in batches:
            for row, data, bounds in slices(batch.column(text)):
                found, place, first = vocabulary.encoded(data, bounds)
                part = batch.slice(row, len(bounds) - 1)
                cuts = pa.array(first, pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (found, place.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *lists], names)

    return docs.select(*(f.name for f in kept), text).mapInArrow(run, T.StructType([*kept, ids, offsets]))


def digests(tokens: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): the ids as little-endian 32-bit numbers, and the bytes they stand for."""
    kind = tokens.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(path, [])
        for batch in batches:
            lists = batch.column("ids")
            values, cuts = lists.flatten().to_numpy().astype("<u4"), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
            rows = [values[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            columns = [
                batch.column(key),
                pa.array(np.diff(cuts), pa.int64()),
                pa.array([hashlib.sha256(r.tobytes()).hexdigest() for r in rows], pa.string()),
                pa.array([hashlib.sha256(vocabulary.decoded(r)).hexdigest() for r in rows], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    shape = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return tokens.select(key, "ids").mapInArrow(run, shape)


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with their ``text`` in place of ``ids`` and ``offsets``; bytes that are no UTF-8 become U+FFFD."""
    kept = [f for f in tokens.schema.fields if f.name not in ("ids", "offsets", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(path, [])
        for batch in batches:
            lists = batch.column("ids")
            texts = [vocabulary.decoded(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in lists.to_pylist()]
            columns = [*(batch.column(f.name) for f in kept), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), "text"])

    shape = T.StructType([*kept, T.StructField("text", T.StringType())])
    return tokens.select(*(f.name for f in kept), "ids").mapInArrow(run, shape)
