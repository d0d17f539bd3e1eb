"""Byte-level BPE: texts to token ids and back, by a vectorised scan and cached pair merging.

1. Code points get a class from one array: letter, number, space, other white space, anything else.
   An apostrophe that one or two further code points complete to a contraction has a class of its own.
2. Each class is a transition function of a small automaton (:data:`STEPS`). Functions compose
   associatively, and all compositions form a finite set (:class:`Scan`), so the state before every
   code point comes from a prefix scan over table look-ups: blocks side by side, then their totals.
3. State and class say where a pre-token starts; no regular expression is used. Texts are scanned in windows
   of ``WINDOW`` bytes with the state carried on, so memory does not follow the longest text.
4. Every different pre-token of a window is merged once and remembered by its bytes; a worker's memory of
   words starts anew beyond ``KNOWN_WORDS``. Long pre-tokens are first cut where no id can reach across.
5. With the ids go ``marks``, the byte offset of every ``STRIDE``-th id in its text. The decoder gathers the
   bytes of the ids in blocks and holds them against the marks; :func:`byte_range` starts at a mark.

Defined results: the pre-tokens are those of the public pattern in ``PATTERN_TEXT``; null and empty texts have
no ids and decode to no bytes; no text is special; repeated rows and null ids are rows as they come; columns
other than the id and the text are ignored; an empty table gives an empty one. Decoding an id outside the
vocabulary, or ids that do not fit their marks, is an error. A pre-token of many bytes without a place where
it may be cut (one letter repeated a million times) takes about 250 bytes of memory per byte.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from salesflow.llm.textscan import pieces, span_hashes

# What the scan stands for (fixed value of the vocabulary).
PATTERN_TEXT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

WINDOW = 1 << 20  # bytes that are scanned at once
AHEAD = 12  # bytes after a window that its last decisions look at: at least three code points
STRIDE = 1024
KNOWN_WORDS = 400_000
LONG_WORD = 128  # bytes from which a pre-token is cut before it is merged, and not remembered
GATHER = 1 << 18  # ids whose bytes are gathered at once

# --- classes of code points ---------------------------------------------------------

LETTER, NUMBER, OTHER, SPACE, WHITE, SHORT, LONG = range(7)  # SHORT, LONG: apostrophes of contractions
KINDS = 7

# White space of the pattern (fixed values: the Unicode property White_Space, but for the space itself).
_WHITE_RANGES = [(0x09, 0x0D), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                 (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]

# Letters and numbers that are new in Unicode 16 (fixed values); Python 3.13 has Unicode 15.1.
_NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0)]
_NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
                (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


def _class_table() -> np.ndarray:
    by_category = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((by_category.get(unicodedata.category(chr(p))[0], OTHER) for p in range(0x110000)),
                        np.uint8, 0x110000)
    for kind, ranges in ((LETTER, _NEW_LETTERS), (NUMBER, _NEW_NUMBERS), (WHITE, _WHITE_RANGES)):
        for first, last in ranges:
            table[first:last + 1] = kind
    table[0x20] = SPACE
    return table


_classes: list[np.ndarray] = []  # of this worker, built when first needed


def classes() -> np.ndarray:
    if not _classes:
        _classes.append(_class_table())
    return _classes[0]


# --- the automaton and its scan -----------------------------------------------------

# States: what the last code point was part of. TWO, ONE: letters of a contraction still to come; DONE: none.
IN_LETTERS, IN_NUMBERS, IN_OTHER, AT_SPACE, AT_WHITE, TWO, ONE, DONE = range(8)
STATES = 8


def _step(state: int, kind: int) -> int:
    if kind in (SHORT, LONG):
        inside = state in (IN_OTHER, AT_SPACE)  # then the apostrophe belongs to a run of other characters
        return IN_OTHER if inside else ONE if kind == SHORT else TWO
    if kind == LETTER and state in (TWO, ONE):
        return ONE if state == TWO else DONE
    return (IN_LETTERS, IN_NUMBERS, IN_OTHER, AT_SPACE, AT_WHITE)[kind]


def _starts(state: int, kind: int) -> bool:
    """Whether a pre-token starts at a code point; white space may also start one for what follows it."""
    if kind in (SPACE, WHITE):
        return state not in (AT_SPACE, AT_WHITE)
    if state == AT_SPACE:
        return False
    same = {LETTER: (IN_LETTERS, TWO, ONE), NUMBER: (IN_NUMBERS,)}.get(kind, (IN_OTHER,))
    return state not in same


class Scan:
    """The states of an automaton along a sequence, by composing transition functions.

    ``steps[k]`` holds the next state of every state for symbol ``k``. All their compositions are numbered;
    ``compose[f, g]`` is the number of "f, then g".
    """

    BLOCK = 256

    def __init__(self, steps: list[tuple[int, ...]]) -> None:
        states = len(steps[0])
        known = {tuple(range(states)): 0}
        for step in steps:
            known.setdefault(step, len(known))
        found = list(known)
        for f in found:  # grows while it is read
            for g in steps:
                both = tuple(g[s] for s in f)
                if both not in known:
                    known[both] = len(known)
                    found.append(both)
        if len(found) > 256:
            raise ValueError("the automaton has too many compositions for a byte")
        self.states, self.count = states, len(found)
        self.symbol = np.array([known[s] for s in steps], np.uint8)
        self.apply = np.array(found, np.uint8).reshape(-1)
        self.compose = np.array([known[tuple(g[s] for s in f)] for f in found for g in found], np.uint8)

    def before(self, functions: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """The state before each function of a sequence that starts in ``state``, and the last state."""
        if len(functions) <= self.BLOCK:
            out = np.empty(len(functions), np.uint8)
            for i, f in enumerate(functions.tolist()):
                out[i] = state
                state = int(self.apply[f * self.states + state])
            return out, state
        rows = -(-len(functions) // self.BLOCK)
        grid = np.zeros(rows * self.BLOCK, np.uint8)  # 0 is the identity
        grid[:len(functions)] = functions
        grid = np.ascontiguousarray(grid.reshape(rows, self.BLOCK).T)
        prefix = np.empty_like(grid)
        so_far = np.zeros(rows, np.uint8)
        for column, into in zip(grid, prefix, strict=True):  # one step of all blocks at once
            into[:] = so_far
            so_far = self.compose[so_far.astype(np.uint16) * self.count + column]
        entry, last = self.before(so_far, state)
        states = self.apply[prefix.astype(np.uint16) * self.states + entry]
        return states.T.reshape(-1)[:len(functions)], last


# A text's first code point forgets what came before: a constant function, as from the end of a contraction.
_STEPS = [tuple(_step(s, k) for s in range(STATES)) for k in range(KINDS)]
SCAN = Scan(_STEPS + [(_step(DONE, k),) * STATES for k in range(KINDS)])
_STARTS = np.array([_starts(s, k) for s in range(STATES) for k in range(KINDS)])


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offset of each) of UTF-8 bytes; the last one may be cut off."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    point = data[lead].astype(np.int32)
    wide = np.flatnonzero(point >= 0x80)
    if len(wide):
        long = np.concatenate([data, np.zeros(3, np.uint8)])
        at, first = lead[wide], point[wide]
        rest = [long[at + k].astype(np.int32) & 0x3F for k in (1, 2, 3)]
        two = (first & 0x1F) << 6 | rest[0]
        three = (first & 0x0F) << 12 | rest[0] << 6 | rest[1]
        four = (first & 0x07) << 18 | rest[0] << 12 | rest[1] << 6 | rest[2]
        point[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, np.minimum(four, 0x10FFFF)))
    return point, lead


def _contractions(points: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> None:
    """Give the apostrophes of 's 't 'm 'd and 're 've 'll their own classes."""
    at = np.flatnonzero(points == 0x27)
    if not len(at):
        return
    after = np.concatenate([points, np.zeros(2, points.dtype)])
    new = np.concatenate([first, np.ones(2, bool)])
    one, two = np.where(new[at + 1], 0, after[at + 1]), np.where(new[at + 1] | new[at + 2], 0, after[at + 2])
    kinds[at[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    pairs = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | (
        (one == ord("l")) & (two == ord("l")))
    kinds[at[pairs]] = LONG


def pre_tokens(data: np.ndarray, borders: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, starts of pre-tokens in between), window by window, for texts that lie in ``data``.

    Text i is ``data[borders[i]:borders[i + 1]]``.
    """
    begins = np.unique(borders[:-1][np.diff(borders) > 0])
    state, a = DONE, 0
    while a < len(data):
        b = min(a + WINDOW, len(data))
        while b < len(data) and (data[b] & 0xC0) == 0x80:
            b += 1
        points, at = code_points(data[a:b + AHEAD])
        here = int(np.searchsorted(at, b - a))
        some = begins[np.searchsorted(begins, a):np.searchsorted(begins, b + AHEAD)] - a
        first = np.zeros(len(points), bool)
        first[np.searchsorted(at, some[some <= at[-1]])] = True
        kinds = classes()[points]
        _contractions(points, first, kinds)
        own = kinds[:here]
        states, state = SCAN.before(SCAN.symbol[own + KINDS * first[:here].astype(np.uint8)], state)
        starts = _STARTS[states * np.uint8(KINDS) + own] | first[:here]
        # the last white space before a word is the word's if it is a space, and alone if not
        blank = (kinds == SPACE) | (kinds == WHITE)
        followed = np.zeros(here, bool)
        n = min(here, len(points) - 1)
        followed[:n] = ~blank[1:n + 1] & ~first[1:n + 1]
        starts |= blank[:here] & followed
        yield a, b, at[:here][starts] + a
        a = b


# --- pair merging ------------------------------------------------------------------


class Vocabulary:
    """Ranks of byte strings: ids, their bytes, and where a word may be cut."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(word): int(rank) for word, rank in pairs}
        words = sorted((r, w) for w, r in self.ranks.items())
        self.size = words[-1][0] + 1
        self.lengths = np.zeros(self.size, np.int64)
        self.lengths[[r for r, _ in words]] = [len(w) for _, w in words]
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(w for _, w in words), np.uint8)
        self.longest = int(self.lengths.max())
        self.joined = np.zeros((256, 256), bool)  # byte pairs that stand inside some id
        ends = np.zeros(len(self.flat), bool)
        ends[(self.begins + self.lengths)[self.lengths > 0] - 1] = True
        left = np.flatnonzero(~ends)
        self.joined[self.flat[left], self.flat[left + 1]] = True

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token: the pair of lowest rank is joined first, the leftmost of equals."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        if len(word) < LONG_WORD:
            return self._merge_short(word)
        raw = np.frombuffer(word, np.uint8)
        cuts = np.flatnonzero(~self.joined[raw[:-1], raw[1:]]) + 1  # no id reaches across these
        ids: list[int] = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(word)], strict=True):
            ids += self._merge_short(word[a:b]) if b - a < LONG_WORD else self._merge_long(word[a:b])
        return ids

    def _merge_short(self, word: bytes) -> list[int]:
        ranks, none = self.ranks, self.size
        parts = [word[i:i + 1] for i in range(len(word))]
        joined = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while joined:
            best = min(joined)
            if best == none:
                break
            i = joined.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del joined[i]
            if i:
                joined[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
            if i < len(joined):
                joined[i] = ranks.get(parts[i] + parts[i + 1], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list; pairs that have changed are passed over."""
        n, ranks = len(word), self.ranks
        end = array("q", range(1, n + 1))  # of the part that starts here; 0: none does
        before = array("q", range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and end[j] - i <= self.longest:
                rank = ranks.get(word[i:end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        ids, i = [], 0
        while i < n:
            ids.append(ranks[word[i:end[i]]])
            i = end[i]
        return ids

    def gather(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, one after the other."""
        return gather(self.flat, self.begins, self.lengths, ids)


def gather(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` that ``ids`` name, one after the other; block by block."""
    blocks = []
    for a in range(0, len(ids), GATHER):
        some = ids[a:a + GATHER]
        size = lengths[some]
        ends = np.cumsum(size)
        blocks.append(flat[np.repeat(begins[some] - (ends - size), size) + np.arange(ends[-1])])
    return np.concatenate(blocks) if blocks else np.zeros(0, np.uint8)


class Encoder:
    """Ids of many texts; remembers the ids of the pre-tokens that it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = array("i")
        self.begin, self.count = array("q"), array("q")

    def _place(self, word: bytes) -> int:
        place = self.known.get(word)
        if place is None:
            ids = self.vocabulary.merge(word)
            place = len(self.begin)
            self.begin.append(len(self.ids))
            self.count.append(len(ids))
            self.ids.extend(ids)
            if len(word) < LONG_WORD:
                self.known[word] = place
        return place

    def _slices(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                by_hash: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each slice)."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.known) > KNOWN_WORDS or len(self.ids) > 8 * KNOWN_WORDS:
            self._forget()
        if by_hash:
            a, b = int(starts[0]), int(ends[-1])
            hashes = span_hashes(data[a:b], starts - a, ends - a)
            _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        else:
            at = back = np.arange(len(starts))
        raw = data[starts[0]:ends[-1]].tobytes()
        offset = int(starts[0])
        place = np.fromiter((self._place(raw[x - offset:y - offset]) for x, y in
                             zip(starts[at].tolist(), ends[at].tolist(), strict=True)), np.int64, len(at))[back]
        begin, count = np.array(self.begin), np.array(self.count)
        flat = np.array(self.ids, np.int32)
        size = count[place]
        last = np.cumsum(size)
        return flat[np.repeat(begin[place] - (last - size), size) + np.arange(last[-1])], size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text)."""
        text = pc.fill_null(texts.cast(pa.large_string()), "")
        if isinstance(text, pa.ChunkedArray):
            text = text.combine_chunks()
        borders = np.frombuffer(text.buffers()[1], np.int64, text.offset + len(text) + 1)[text.offset:]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[borders[0]:borders[-1]]
        borders = borders - borders[0]
        ids, counts = self._encoded(data, borders, True)
        if not self._same(ids, data):  # two words of one window share a hash
            ids, counts = self._encoded(data, borders, False)
        return ids, counts

    def _encoded(self, data: np.ndarray, borders: np.ndarray, by_hash: bool) -> tuple[np.ndarray, np.ndarray]:
        counts = np.zeros(len(borders) - 1, np.int64)
        parts: list[np.ndarray] = [np.zeros(0, np.int32)]
        open_at = 0  # where the pre-token starts that no window has ended yet

        def add(starts: np.ndarray, ends: np.ndarray, by_hash: bool) -> None:
            ids, size = self._slices(data, starts, ends, by_hash)
            parts.append(ids)
            row = np.searchsorted(borders, starts, side="right") - 1
            np.add.at(counts, row, size)

        for a, b, starts in pre_tokens(data, borders):
            if b == len(data):
                starts = np.append(starts, b)
            if not len(starts):
                continue
            if starts[0] > open_at:  # a pre-token that began in an earlier window
                add(np.array([open_at]), starts[:1], False)
            add(starts[:-1], starts[1:], by_hash)
            open_at = int(starts[-1])
        return np.concatenate(parts), counts

    def _same(self, ids: np.ndarray, data: np.ndarray) -> bool:
        """Whether the ids stand for exactly these bytes."""
        words, done = self.vocabulary, 0
        for a in range(0, len(ids), GATHER):
            back = words.gather(ids[a:a + GATHER])
            if not np.array_equal(back, data[done:done + len(back)]):
                return False
            done += len(back)
        return done == len(data)


# --- batches and tables ----------------------------------------------------------------

_vocabularies: dict[str, Vocabulary] = {}  # of this worker process
_encoders: dict[str, Encoder] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(vocabulary(path))
    return _encoders[path]


def _runs(begins: np.ndarray, counts: np.ndarray, step: int) -> np.ndarray:
    """begin, begin + step, ..: ``counts`` numbers for each begin."""
    ends = np.cumsum(counts)
    return np.repeat(begins - step * (ends - counts), counts) + step * np.arange(ends[-1] if len(ends) else 0)


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, stride: int = STRIDE) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, ids, marks)."""
    tokens = encoder(path)
    for batch in batches:
        for row, texts in pieces(batch.column(1)):
            ids, counts = tokens.encode(texts)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            places = np.cumsum(tokens.vocabulary.lengths[ids])  # ends of the ids among the piece's bytes
            starts = np.concatenate([[0], places])
            marked = -(-counts // stride)
            at = _runs(bounds[:-1], marked, stride)
            marks = starts[at] - np.repeat(starts[bounds[:-1]], marked)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(texts)),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(marked)].astype(np.int32)), pa.array(marks))],
                names=[batch.schema.field(0).name, "ids", "marks"])


def decode_batches(batches: Iterator[pa.RecordBatch], path: str, stride: int = STRIDE) -> Iterator[pa.RecordBatch]:
    """(id, ids, marks) to (id, ids, decoded)."""
    words = vocabulary(path)
    for batch in batches:
        lists, marks = pc.fill_null(batch.column(1), []), pc.fill_null(batch.column(2), [])
        ids = np.asarray(lists.flatten())
        if len(ids) and (ids.min() < 0 or ids.max() >= words.size or not words.lengths[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        bounds = np.r_[0, np.cumsum(np.asarray(pc.list_value_length(lists)))].astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(words.lengths[ids])])
        borders = starts[bounds]
        counts = np.diff(bounds)
        marked = -(-counts // stride)
        kept = np.asarray(marks.flatten())
        if len(kept) != marked.sum() or not np.array_equal(
                starts[_runs(bounds[:-1], marked, stride)] - np.repeat(borders[:-1], marked), kept):
            raise ValueError("ids do not fit their marks")
        made = words.gather(ids)
        decoded = pa.Array.from_buffers(
            pa.large_binary(), len(lists), [None, pa.py_buffer(borders.tobytes()), pa.py_buffer(made.tobytes())])
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, decoded.cast(pa.binary())],
                                         names=[batch.schema.field(0).name, "ids", "decoded"])


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", stride: int = STRIDE) -> DataFrame:
    """(key, ids, marks) of every row of ``docs``; ``path`` names a file of base64 words and ranks."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        lambda b: encode_batches(b, path, stride), f"`{key}` {kind}, ids array<int>, marks array<bigint>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", stride: int = STRIDE) -> DataFrame:
    """(key, ids, decoded) of encoded rows."""
    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids", "marks").mapInArrow(
        lambda b: decode_batches(b, path, stride), f"`{key}` {kind}, ids array<int>, decoded binary")


def byte_range(ids: np.ndarray, marks: np.ndarray, words: Vocabulary, first: int, last: int,
               stride: int = STRIDE) -> bytes:
    """Bytes ``first`` to ``last`` of one text: decoding starts at the mark before and stops behind."""
    from_mark = max(int(np.searchsorted(marks, first, side="right")) - 1, 0)
    to_mark = int(np.searchsorted(marks, last, side="left"))
    if not len(marks) or last <= first:
        return b""
    some = words.gather(np.asarray(ids[from_mark * stride:to_mark * stride]))
    skip = int(marks[from_mark])
    return some[first - skip:last - skip].tobytes()
