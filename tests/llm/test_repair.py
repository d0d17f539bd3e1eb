"""Conversation repair against exhaustive search and a plain dynamic programme."""

import hashlib
import random
import re
import zlib
from itertools import product

import pyarrow.parquet as pq

from salesflow.llm import queries, repair

BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    """First fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(BLANKS)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else
                   "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def options(initial, fault):
    extra = 5 if fault == "truncated" else 0
    yield 2, "D", ""
    if fault not in ("blank", "duplicate"):
        yield extra, "K", initial or "x"
        yield 1 + extra, "R", "u"
        yield 1 + extra, "R", "a"


def exhaustive(symbols, most=2):
    """Least (cost, audit) over every choice of edits with at most ``most`` insertions per place."""
    gaps = [(5 * n, "I" * n, "".join(r)) for n in range(most + 1) for r in product("ua", repeat=n)]
    best = None
    steps = [gaps]
    for s in symbols:
        steps += [list(options(*s)), gaps]
    for chosen in product(*steps):
        if re.fullmatch("(s?(ua)+)?", "".join(c[2] for c in chosen)):
            found = sum(c[0] for c in chosen), "".join(c[1] for c in chosen)
            best = found if best is None else min(best, found)
    return best


def plain(symbols):
    """The same, row by row over the automaton, with whole strings."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def closed(states):
        for _ in range(2):
            for p, (c, a) in list(states.items()):
                for i in "ua":
                    if (p, i) in step:
                        q = step[p, i]
                        states[q] = min(states.get(q, (10 ** 9, "")), (c + 5, a + "I"))
        return states

    states = closed({"": (0, "")})
    for s in symbols:
        new = {}
        for p, (c, a) in states.items():
            for cost, edit, role in options(*s):
                q = p if edit == "D" else step.get((p, role))
                if q is not None:
                    new[q] = min(new.get(q, (10 ** 9, "")), (c + cost, a + edit))
        states = closed(new)
    return min(states[q] for q in ("", "a") if q in states)


def code(symbol):
    initial, fault = symbol
    return repair._ALPHABET[4 * ("sua".index(initial) if initial else 3)
                            + ["", "blank", "duplicate", "truncated"].index(fault)]


def total(matrix):
    ends = [repair.times(matrix, repair.INSERT)[q] for q in repair.ACCEPTED]
    return min((c, str(a)) for c, a in (e for e in ends if e))


def test_words_against_exhaustive_search():
    rng = random.Random(3)
    words = [[(rng.choice(["s", "u", "a", ""]), rng.choice(["", "", "blank", "duplicate", "truncated"]))
              for _ in range(rng.randint(1, 3))] for _ in range(60)]
    solved = repair.solve(["".join(map(code, w)) for w in words])
    for word, matrix in zip(words, solved, strict=True):
        assert total(matrix) == exhaustive(word) == plain(word), word


def test_long_words_share_one_grammar():
    rng = random.Random(4)
    words = [[(rng.choice("suaua"), rng.choice(["", "", "", "truncated", "blank"])) for _ in range(rng.choice([1, 7, 300]))]
             for _ in range(60)] + [[("u", ""), ("a", "")] * 500, [("u", "")] * 999]
    coded = [[repair._ALPHABET.index(code(s)) for s in w] for w in words]
    short, rules = repair.re_pair(coded, 16)

    def spelled(symbol):
        return [symbol] if symbol < 16 else spelled(rules[symbol - 16][0]) + spelled(rules[symbol - 16][1])

    assert [[x for s in w for x in spelled(s)] for w in short] == coded
    pairs = [p for w in short for p in zip(w, w[1:])]
    assert len(rules) < sum(map(len, coded)) / 4 and len(pairs) < sum(map(len, coded)) / 3
    for word, matrix in zip(words, repair.solve(["".join(map(code, w)) for w in words]), strict=True):
        assert total(matrix) == plain(word)


def test_ropes_compare_like_strings():
    rng = random.Random(5)
    ropes = [repair.Rope("")]
    for _ in range(300):
        ropes.append(repair.Rope("".join(rng.choices("DIK", k=rng.randint(0, 3)))) if rng.random() < 0.3
                     else rng.choice(ropes) + rng.choice(ropes))
        if ropes[-1].size > 5000:
            ropes.pop()
    for _ in range(3000):
        a, b = rng.choice(ropes), rng.choice(ropes)
        assert a.less(b) == (str(a) < str(b)) and len(str(a)) == a.size


def brute(rows):
    """(conv_id, turn, role, text) after damage: the whole result per conversation."""
    out, by = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(
            f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        said = [(r, t) for _, r, t in own]
        bad = faults(said)
        symbols = [(r[:1] if r[:1] in ("s", "u", "a") else "", f) for (r, _), f in zip(said, bad)]
        cost, audit = plain(symbols)
        made, state, left = [], "", list(zip(said, symbols))
        for edit in audit:
            wanted = ("assistant" if state == "u" else "user")
            if edit == "I":
                made.append((wanted, ""))
                state = wanted[0]
                continue
            (role, text), (initial, _) = left.pop(0)
            if edit != "D":
                made.append((role if edit == "K" else wanted, text))
                state = initial if edit == "K" else wanted[0]
        assert not left and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in made))
        turns = [t for t, _, _ in own if t is not None]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, bad.count("blank"),
                     bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, made)
    return out


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, place int, key string")
    fixed = repair.repair(df.repartition(parts))
    made = {}
    for r in sorted(fixed.rows.collect(), key=lambda r: (r.place, r.step)):
        made.setdefault(r.conv_id, []).append((r.role, r.text))
    return {r.conv_id: (*r[2:], made.get(r.conv_id, [])) for r in fixed.report.collect()}


def test_hand_made_conversations(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yo."), (2, None, "assistant", "A."), (2, 5, "user", "B"),
            (2, 9, None, None), (None, 0, "system", "S."), (None, 1, "assistant", "T!"), (3, 0, "", " \x0b"),
            (4, 0, "system", "only."), (5, 0, "uSER", "É?"), (5, 0, "uSER", "É?"), (5, 1, "a", "x. \x0c"),
            (6, 1, "user", " "), (6, 2, "assistant", "é.")]
    assert run(spark, rows) == brute(rows)


def test_a_long_conversation_in_many_cells(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(repair, "CELL_BITS", 3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", f"{t}.", f"{t}!"]))
            for c, n in ((1, 700), (2, 3), (None, 40)) for t in range(n)]
    rows += rows[:50] + [(1, None, "user", f"n{i}.") for i in range(20)]
    assert run(spark, rows, 5) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_query_against_brute_force(spark, sf_dir):
    rows, damaged = pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist(), []
    for r in rows:
        conv, turn, role, text = (" " if r[n] is None else r[n] for n in ("conv_id", "turn", "role", "text"))
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        damaged += [(r["conv_id"], r["turn"], role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = brute(damaged)
    wanted = {}
    for conv in {r["conv_id"] for r in rows}:
        *counts, audit, made = found.get(conv, (0, 0, 0, 0, 0, 0, "", []))
        text = "\n".join(f"{role}:{text}" for role, text in made)
        wanted[conv] = (*counts, audit, hashlib.sha256(text.encode()).hexdigest())
    got = queries.QUERIES["op11_conversation_repair"](spark, sf_dir).collect()
    assert len(got) == len(wanted) and {r[0]: tuple(r[1:]) for r in got} == wanted
