"""Conversation structure repair by dynamic programming over grammar-compressed sequences.

A conversation must read ``(s?(ua)+)?`` in the initials of its roles. Each row has a symbol: its role's initial and
its first fault (blank, duplicate, truncated). Keeping a row costs 0, giving it the role user or assistant 1, deleting
it 2 (the only edit of blank and duplicate rows), inserting an empty turn 5; truncated rows that stay add 5.

1. The rows are range-partitioned and sorted, and numbered in that order; ``CELL`` numbers form a cell. What a
   conversation has in one cell is a word of at most ``CELL`` symbols, so a conversation of any length is cut up.
2. Words repeat between conversations: each different word is solved once. A task builds one Re-Pair grammar of its
   words (:func:`re_pair`). A symbol is a min-plus matrix over the automaton's states; each entry has the least
   cost and, as a rope, the audit string that is least among those of that cost (:class:`Rope`). The matrix of a rule is
   the product of its two sides, made once and used by all words.
3. Along each conversation a vector goes through the matrices of its words, in order; the way back gives
   each word its edits, which are joined to the rows.

The order of (cost, audit) is kept by products: two audits of equal cost over the same rows are never prefixes of one
another, since a longer one has more insertions.

Defined results: null roles and texts count as empty; rows go by turn, nulls first, then by a digest of role and text;
equal rows are rows of their own; rows with a null conv_id are one conversation; columns other than conv_id, turn,
role and text are ignored; an empty table gives empty results. A conversation's audit is one value, so the task
that follows it holds some bytes per row of it, but no texts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salesflow.session import stage

CELL_BITS = 12
BATCH_SYMBOLS = 200_000  # of one grammar

INITIALS = "sua"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
_ALPHABET = "abcdefghijklmnop"  # 4 * (place in INITIALS, or 3) + fault
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
NOT_BLANK, BLANKS = r"[^\x20\x09-\x0D]", " \t\n\x0b\x0c\r"

# States of the pattern: nothing yet, after the system turn, after a user, after an assistant.
STATES, ACCEPTED, AFTER_USER = 4, (0, 3), 2
NEXT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by initial: s, u, a, other


class Rope:
    """A string as a tree; equal parts are recognised by size and fingerprint."""

    __slots__ = ("left", "right", "size", "print")
    _MODULUS, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681
    _powers = [1]

    def __init__(self, left: Rope | str, right: Rope | None = None) -> None:
        self.left, self.right = left, right
        if right is None:
            self.size = len(left)
            self.print = 0
            for c in left:
                self.print = (self.print * self._BASE + ord(c)) % self._MODULUS
        else:
            self.size = left.size + right.size
            self.print = (left.print * self._power(right.size) + right.print) % self._MODULUS

    @classmethod
    def _power(cls, n: int) -> int:
        if n < 1 << 16:
            while len(cls._powers) <= n:
                cls._powers.append(cls._powers[-1] * cls._BASE % cls._MODULUS)
            return cls._powers[n]
        return pow(cls._BASE, n, cls._MODULUS)

    def __add__(self, other: Rope) -> Rope:
        return other if not self.size else self if not other.size else Rope(self, other)

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if node.right is None:
                out.append(node.left)
            else:
                stack += (node.right, node.left)
        return "".join(out)

    def less(self, other: Rope) -> bool:
        """Whether this string comes before the other; parts that are equal are passed over whole."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a.size == b.size and a.print == b.print:
                continue
            if a.right is None and b.right is None:
                n = min(a.size, b.size)
                if a.left[:n] != b.left[:n]:
                    return a.left < b.left
                if a.size > n:
                    mine.append(Rope(a.left[n:]))
                if b.size > n:
                    theirs.append(Rope(b.left[n:]))
                continue
            if b.right is None or a.right is not None and a.size >= b.size:
                mine += (a.right, a.left)
                theirs.append(b)
            else:
                theirs += (b.right, b.left)
                mine.append(a)
        return bool(theirs)


Entry = tuple[int, Rope]
Matrix = list  # STATES * STATES entries, or None where a state can't be reached


def _better(cost: int, parts: tuple[Rope, Rope], best: Entry | None) -> Entry | None:
    """The lesser of ``best`` and (cost, both parts)."""
    if best is not None and cost > best[0]:
        return best
    made = parts[0] + parts[1]
    if best is None or cost < best[0] or made.less(best[1]):
        return cost, made
    return best


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: first ``a``, then ``b``."""
    out: Matrix = [None] * (STATES * STATES)
    for p in range(STATES):
        row = [(r, a[p * STATES + r]) for r in range(STATES) if a[p * STATES + r]]
        for q in range(STATES):
            found = None
            for r, first in row:
                second = b[r * STATES + q]
                if second:
                    found = _better(first[0] + second[0], (first[1], second[1]), found)
            out[p * STATES + q] = found
    return out


def _insertions() -> Matrix:
    """Any number of inserted turns between two rows; more than two are never cheapest."""
    one: Matrix = [None] * (STATES * STATES)
    for initial in (1, 2):
        for p, q in NEXT[initial].items():
            one[p * STATES + q] = (COST["I"], Rope("I"))
    none: Matrix = [(0, Rope("")) if p == q else None for p in range(STATES) for q in range(STATES)]
    upto = none
    for _ in range(2):
        longer = times(upto, one)
        upto = [_better(y[0], (y[1], Rope("")), x) if y else x for x, y in zip(upto, longer, strict=True)]
    return upto


INSERT = _insertions()


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions, then one row that is kept, given a role, or deleted."""
    initial, fault = divmod(_ALPHABET.index(symbol), 4)
    row: Matrix = [None] * (STATES * STATES)

    def offer(p: int, q: int, edit: str, extra: int) -> None:
        at = p * STATES + q
        row[at] = _better(COST[edit] + extra, (Rope(edit), Rope("")), row[at])

    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    for p in range(STATES):
        offer(p, p, "D", 0)
        if fault not in (BLANK, DUPLICATE):
            if p in NEXT[initial]:
                offer(p, NEXT[initial][p], "K", extra)
            for role in (1, 2):
                if p in NEXT[role]:
                    offer(p, NEXT[role][p], "R", extra)
    return times(INSERT, row)


def re_pair(words: Sequence[Sequence[int]], first_rule: int) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """(words over symbols and rules, rules): the most frequent pair becomes a rule until none occurs twice."""
    symbols: list[int] = []
    for word in words:
        symbols += word
        symbols.append(-1)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], set[int]] = {}
    for i in range(n - 1):
        if symbols[i] >= 0 and symbols[i + 1] >= 0:
            places.setdefault((symbols[i], symbols[i + 1]), set()).add(i)
    heap = [(-len(v), pair) for pair, v in places.items() if len(v) > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []

    def forget(i: int) -> None:
        if i >= 0 and after[i] < n:
            places.get((symbols[i], symbols[after[i]]), set()).discard(i)

    def note(i: int, touched: set[tuple[int, int]]) -> None:
        if i >= 0 and after[i] < n and symbols[i] >= 0 and symbols[after[i]] >= 0:
            pair = symbols[i], symbols[after[i]]
            places.setdefault(pair, set()).add(i)
            touched.add(pair)

    while heap:
        count, pair = heapq.heappop(heap)
        now = len(places.get(pair, ()))
        if now != -count:
            if now > 1:
                heapq.heappush(heap, (-now, pair))
            continue
        rule = first_rule + len(rules)
        rules.append(pair)
        touched: set[tuple[int, int]] = set()
        for i in sorted(places.pop(pair)):
            j = after[i]
            if j >= n or (symbols[i], symbols[j]) != pair:  # overlapped by the place before
                continue
            forget(before[i])
            forget(j)
            symbols[i], symbols[j] = rule, -2
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            note(before[i], touched)
            note(i, touched)
        for t in touched:
            if len(places.get(t, ())) > 1:
                heapq.heappush(heap, (-len(places[t]), t))
    out: list[list[int]] = [[]]
    i = 0
    while i < n:
        if symbols[i] == -1:
            out.append([])
        else:
            out[-1].append(symbols[i])
        i = after[i]
    return out[:-1], rules


def solve(words: Sequence[str]) -> list[Matrix]:
    """The matrix of each word; the words share one grammar and the matrices of its rules."""
    coded, rules = re_pair([[_ALPHABET.index(c) for c in w] for w in words], len(_ALPHABET))
    matrices = [symbol_matrix(c) for c in _ALPHABET]
    for a, b in rules:  # bottom-up: a rule's sides come before it
        matrices.append(times(matrices[a], matrices[b]))
    return [product([matrices[s] for s in word]) for word in coded]


def product(matrices: list[Matrix]) -> Matrix:
    """Of one or more, pairwise, so that ropes stay shallow."""
    while len(matrices) > 1:
        matrices = [times(matrices[i], matrices[i + 1]) if i + 1 < len(matrices) else matrices[i]
                    for i in range(0, len(matrices), 2)]
    return matrices[0]


def _legal(a: str, b: str) -> bool:
    pair = tuple(_ALPHABET.index(c) // 4 for c in (a, b))
    return pair in ((0, 1), (1, 2), (2, 1))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words to their matrices and counts, a grammar per ``BATCH_SYMBOLS``."""
    held: list[str] = []
    size = 0

    def flush() -> pa.RecordBatch:
        matrices = solve(held)
        faults = [[sum(_ALPHABET.index(c) % 4 == f for c in w) for f in range(4)] for w in held]
        illegal = [sum(not _legal(a, b) for a, b in zip(w, w[1:], strict=False)) for w in held]
        costs = [[e[0] if e else None for e in m] for m in matrices]
        audits = [[str(e[1]) if e else None for e in m] for m in matrices]
        made = pa.RecordBatch.from_arrays(
            [pa.array(held, pa.string()), pa.array(faults, pa.list_(pa.int64())), pa.array(illegal, pa.int64()),
             pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
            names=["word", "faults", "illegal", "costs", "audits"])
        held.clear()
        return made

    for batch in batches:
        for word in batch.column(0).to_pylist():
            if held and size + len(word) > BATCH_SYMBOLS:
                yield flush()
                size = 0
            held.append(word)
            size += len(word)
    if held:
        yield flush()


# --- along the conversations -------------------------------------------------------------


def edits(word: str, audit: str, state: int) -> tuple[list[str], int]:
    """(codes of each row, state behind): u, a inserted turns before it; K, U, A, D what becomes of it."""
    codes, held, row = [], "", 0
    for letter in audit:
        if letter == "I":
            initial = 2 if state == AFTER_USER else 1
            held += "a" if initial == 2 else "u"
            state = NEXT[initial][state]
            continue
        if letter == "R":
            initial = 2 if state == AFTER_USER else 1
            letter = "A" if initial == 2 else "U"
            state = NEXT[initial][state]
        elif letter == "K":
            state = NEXT[_ALPHABET.index(word[row]) // 4][state]
        codes.append(held + letter)
        held, row = "", row + 1
    return codes, state


@dataclass
class _Conversation:
    """The words of one conversation in order, and the vector that has gone through them."""

    key: str
    conv_id: object
    words: list[dict]
    back: list[list[int | None]]
    vector: list[Entry | None]

    @classmethod
    def begin(cls, key: str, conv_id: object) -> _Conversation:
        return cls(key, conv_id, [], [], [(0, Rope(""))] + [None] * (STATES - 1))

    def add(self, row: dict) -> None:
        vector: list[Entry | None] = [None] * STATES
        back: list[int | None] = [None] * STATES
        leaves = [Rope(a) if a is not None else None for a in row["audits"]]
        for p, so_far in enumerate(self.vector):
            for q in range(STATES) if so_far else ():
                at = p * STATES + q
                if leaves[at] is not None:
                    found = _better(so_far[0] + row["costs"][at], (so_far[1], leaves[at]), vector[q])
                    if found is not vector[q]:
                        vector[q], back[q] = found, p
        self.vector = vector
        self.words.append(row)
        self.back.append(back)

    def close(self) -> list[dict]:
        """One row per word; the last one has the report."""
        best, at, tail = None, 0, ""
        for p, so_far in enumerate(self.vector):
            for q in ACCEPTED if so_far else ():
                end = INSERT[p * STATES + q]
                if end:
                    found = _better(so_far[0] + end[0], (so_far[1], end[1]), best)
                    if found is not best:
                        best, at, tail = found, p, str(end[1])
        states = [at]
        for back in reversed(self.back):
            states.append(back[states[-1]])
        states.reverse()
        out, gone, last = [], [0] * 4, None
        turns, illegal = 0, 0
        ends = [w["low"] for w in self.words if w["low"] is not None], [w["high"] for w in self.words if w["high"] is not None]
        for row, p, q in zip(self.words, states, states[1:], strict=False):
            codes, state = edits(row["word"], row["audits"][p * STATES + q], p)
            out.append({"key": self.key, "cell": row["cell"], "start": row["start"], "codes": codes})
            gone = [a + b for a, b in zip(gone, row["faults"], strict=True)]
            illegal += row["illegal"]
            if last and not _legal(last["word"][-1], row["word"][0]):
                illegal += 1
            # turns are in order, so only the turn at the border of two words can be counted twice
            turns += row["turns"]
            if last and row["low"] is not None and last["high"] == row["low"]:
                turns -= 1
            last = row
        for _ in tail:
            out[-1]["codes"][-1] += "a" if state == AFTER_USER else "u"
            state = NEXT[2 if state == AFTER_USER else 1][state]
        gaps = max(ends[1]) - min(ends[0]) + 1 - turns if ends[0] else 0
        out[-1] |= {"conv_id": self.conv_id, "gaps": gaps, "blank": gone[BLANK], "duplicate": gone[DUPLICATE],
                    "truncated": gone[TRUNCATED], "illegal": illegal, "cost": best[0], "audit": str(best[1])}
        return out


def _follow(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    open_one: _Conversation | None = None
    done: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if open_one is None or row["key"] != open_one.key:
                if open_one:
                    done += open_one.close()
                open_one = _Conversation.begin(row["key"], row["conv_id"])
            open_one.add(row)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if open_one:
        yield pa.RecordBatch.from_pylist(open_one.close(), schema)


# --- the operator ----------------------------------------------------------------------------


def key_of(conv_id: Column | str) -> Column:
    """A text that stands for a conv_id and is never null."""
    column = F.col(conv_id) if isinstance(conv_id, str) else conv_id
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


@dataclass(frozen=True)
class Repaired:
    """``report``: conv_id_key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, one row per conversation.

    ``rows``: conv_id, place, step, edit, role, text of the repaired conversations, in order of (place, step);
    ``edit`` is K (kept), R (another role) or I (inserted).
    """

    report: DataFrame
    rows: DataFrame


def repair(conversations: DataFrame) -> Repaired:
    """Repair all conversations (conv_id, turn, role, text) at the least cost."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    order = ["key", F.col("turn").asc_nulls_first(), "mark", "salt"]
    ordered = stage(
        conversations.select(
            "conv_id", key_of("conv_id").alias("key"), "turn", role.alias("role"), text.alias("text"),
            F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("mark"),
            F.monotonically_increasing_id().alias("salt"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .drop("salt").withColumn("place", F.monotonically_increasing_id())
        .withColumn("cell", F.shiftright("place", CELL_BITS)), "repair-ordered")
    # a place is unique, so the join meets no frequent key, however often a turn is repeated
    firsts = ordered.groupBy("key", "mark").agg(F.min("place").alias("place")).select(
        "place", F.lit(True).alias("first"))
    fault = (F.when(~F.col("text").rlike(NOT_BLANK), BLANK).when(F.col("first").isNull(), DUPLICATE)
             .when(~F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1).isin(".", "!", "?"), TRUNCATED)
             .otherwise(OK))
    head, initial = F.substring("role", 1, 1), F.lit(3)
    for number, letter in enumerate(INITIALS):
        initial = F.when(head == letter, number).otherwise(initial)
    symbols = ordered.join(firsts, "place", "left").select(
        "key", "conv_id", "cell", "place", "turn",
        F.substr(F.lit(_ALPHABET), initial * 4 + fault + 1, F.lit(1)).alias("symbol"))
    words = stage(
        symbols.groupBy("key", "cell").agg(
            F.first("conv_id").alias("conv_id"), F.min("place").alias("start"), F.min("turn").alias("low"),
            F.max("turn").alias("high"), F.array_sort(F.collect_list(F.struct("place", "symbol", "turn"))).alias("s"))
        .select("key", "conv_id", "cell", "start", "low", "high",
                F.expr("size(array_distinct(filter(transform(s, x -> x.turn), t -> t is not null)))").alias("turns"),
                F.array_join(F.expr("transform(s, x -> x.symbol)"), "").alias("word")), "repair-words")
    matrices = words.select("word").distinct().mapInArrow(
        _solved, "word string, faults array<bigint>, illegal bigint, costs array<bigint>, audits array<string>")
    kind = conversations.schema["conv_id"].dataType
    fields = [("key", pa.string()), ("cell", pa.int64()), ("start", pa.int64()), ("codes", pa.list_(pa.string())),
              ("conv_id", to_arrow_type(kind)),
              *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
              ("audit", pa.string())]
    schema = pa.schema(fields)
    followed = stage(
        words.join(matrices, "word").repartition("key").sortWithinPartitions("key", "cell").mapInArrow(
            lambda b: _follow(b, schema),
            f"key string, cell bigint, start bigint, codes array<string>, conv_id {kind.simpleString()}, gaps bigint, "
            "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"),
        "repair-edits")
    report = followed.filter("audit IS NOT NULL").select(
        F.col("key").alias("conv_id_key"), "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    code = F.col("codes")[(F.col("place") - F.col("start")).cast("int")]
    step = (ordered.select("conv_id", "key", "cell", "place", "role", "text")
            .join(followed.select("key", "cell", "start", "codes"), ["key", "cell"])
            .select("conv_id", "place", "role", "text", F.posexplode(F.split(code, "")).alias("step", "code"))
            .filter("code <> 'D'"))
    lower = F.lower("code")
    rows = step.select(
        "conv_id", "place", "step",
        F.when(F.col("code") == "K", "K").when(lower == F.col("code"), "I").otherwise("R").alias("edit"),
        F.when(lower == "u", "user").when(lower == "a", "assistant").otherwise(F.col("role")).alias("role"),
        F.when(lower == F.col("code"), "").otherwise(F.col("text")).alias("text"))
    return Repaired(report, rows)
