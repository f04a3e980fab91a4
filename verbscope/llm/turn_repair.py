"""Repair of conversation structure by a grammar-compressed dynamic program.

Per row only a symbol counts: the role's initial and the row's first fault (blank; duplicate: role and
text were seen earlier; truncated: no end mark). Edits keep a row, give it another role, delete it or
insert an empty turn; the cheapest edits are wanted that leave roles like ``(system? (user
assistant)+)?``. A row is then a matrix over the four states of that pattern (nothing yet, system,
user, assistant): the least (cost, edits' initials) from state to state, and a conversation is the
min-plus product of its rows' matrices. Equal costs go to the ASCII-least initials; products keep that
order, as among equal costs no string of one stretch begins another.

* Re-Pair: the most frequent pairs of neighbouring symbols, counted over all distinct sequences of the
  table, become rules round by round; of a round's pairs, none begins with what another ends with,
  so that replacing them all at once is unambiguous. A grammar has ``ROUNDS * PER_ROUND`` rules at
  most, whatever the table; what it doesn't cover stays as shorter symbols, results are the same.
* Each rule has one matrix, the product of its two parts', made bottom-up once per worker. Edits
  are ropes that share their parts, and are spelt out for the chosen result only.
* A conversation is folded over its rules. One byte a row meets in a task, as the edits are one
  value of a conversation; texts don't: kept rows get theirs by a join.

Defined results: turns go by ``turn`` (null first), then role and the text's digest; null role or
text is one blank; a null conversation id is a conversation of its own; roles with other initials
can't be kept as they are; other columns aren't read; an empty table gives empty tables.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbscope.llm.common import join_same, quoted, staged
from verbscope.llm.memo import Memo
from verbscope.llm.turn_order import with_position

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
ROUNDS, PER_ROUND = 8, 128
#: Rows whose symbols lie in one value before a conversation is folded.
BLOCK = 4096
LETTERS = "ABCDEFGHIJKLMNOP"  # 4 * role (system, user, assistant, other) + fault (none, truncated, blank, duplicate)
NONE, SYSTEM, USER, ASSISTANT = range(4)
Rope = tuple  # (text,) or (left, right)
Matrix = tuple  # four rows of four (cost, rope) or None


# ---- ropes and matrices ----

def spell(rope: Rope) -> Iterator[str]:
    rest = [rope]
    while rest:
        top = rest.pop()
        if len(top) == 1:
            yield top[0]
        else:
            rest += (top[1], top[0])


def comes_before(x: Rope, y: Rope) -> bool:
    """ASCII order of two ropes; parts that both share at the same place are skipped."""
    a, b = [x], [y]
    while a and b:
        p, q = a.pop(), b.pop()
        if p is q:
            continue
        if len(p) == 2:
            a += (p[1], p[0])
            b.append(q)
        elif len(q) == 2:
            b += (q[1], q[0])
            a.append(p)
        else:
            n = min(len(p[0]), len(q[0]))
            if p[0][:n] != q[0][:n]:
                return p[0][:n] < q[0][:n]
            if len(p[0]) > n:
                a.append((p[0][n:],))
            if len(q[0]) > n:
                b.append((q[0][n:],))
    return not any(any(spell(r)) for r in a) and any(any(spell(r)) for r in b)


def better(x, y):
    if x is None or y is None:
        return y if x is None else x
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return y if comes_before(y[1], x[1]) else x


def chain(x, y):
    if x is None or y is None:
        return None
    return x[0] + y[0], (y[1] if x[1] == ("",) else x[1] if y[1] == ("",) else (x[1], y[1]))


def times_row(row: tuple, m: Matrix) -> tuple:
    return tuple(functools.reduce(better, (chain(row[k], m[k][j]) for k in range(4))) for j in range(4))


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(times_row(row, b) for row in a)


def matrix_of(steps: list[tuple[int, int, int, str]]) -> Matrix:
    m = [[None] * 4 for _ in range(4)]
    for i, j, cost, edit in steps:
        m[i][j] = better(m[i][j], (cost, (edit,)))
    return tuple(map(tuple, m))


#: State after a turn of a role: a system turn comes first only, users and assistants alternate.
MOVES = {SYSTEM: ((NONE, SYSTEM),), USER: ((NONE, USER), (SYSTEM, USER), (ASSISTANT, USER)), ASSISTANT: ((USER, ASSISTANT),)}
INSERTS = matrix_of([(i, i, 0, "") for i in range(4)] + [
    (NONE, USER, INSERT, "I"), (NONE, ASSISTANT, 2 * INSERT, "II"), (SYSTEM, USER, INSERT, "I"), (SYSTEM, ASSISTANT, 2 * INSERT, "II"),
    (USER, ASSISTANT, INSERT, "I"), (ASSISTANT, USER, INSERT, "I")])
DELETED = 8  # symbol of rows that have to go; others: 2 * role + truncated
_TO_SYMBOL = {c: DELETED if k % 4 > 1 else 2 * (k // 4) + k % 4 for k, c in enumerate(LETTERS)}


def row_matrix(symbol: int) -> Matrix:
    """Any insertions, then the edits of one row."""
    steps = [(i, i, DELETE, "D") for i in range(4)]
    if symbol != DELETED:
        role, more = (SYSTEM, USER, ASSISTANT, None)[symbol // 2], TRUNCATED * (symbol % 2)
        steps += [(i, j, KEEP + more, "K") for i, j in MOVES.get(role, ())]
        steps += [(i, j, REROLE + more, "R") for to in (USER, ASSISTANT) for i, j in MOVES[to]]
    return times(INSERTS, matrix_of(steps))


# ---- the grammar ----

Grammar = tuple  # rounds of ((left, right), ...); rules are numbered from DELETED + 1 on, in order


def compress(symbols: list[int], grammar: Grammar) -> list[int]:
    number = DELETED + 1
    for pairs in grammar:
        rules = {pair: number + k for k, pair in enumerate(pairs)}
        number += len(pairs)
        out, k, n = [], 0, len(symbols)
        while k < n:
            rule = rules.get((symbols[k], symbols[k + 1])) if k + 1 < n else None
            out.append(symbols[k] if rule is None else rule)
            k += 1 if rule is None else 2
        symbols = out
    return symbols


def choose(counts: list[tuple[int, int, int]]) -> tuple:
    """Pairs of a round from (left, right, count) by falling count: no symbol both begins and ends chosen pairs."""
    left, right, chosen = set(), set(), []
    for a, b, _ in counts:
        if a == b and not chosen:
            return ((a, b),)  # overlaps itself: replaced from the left, alone
        if a != b and a not in right and b not in left:
            left.add(a)
            right.add(b)
            chosen.append((a, b))
    return tuple(chosen)


def grammar_of(sequences: DataFrame) -> Grammar:
    """Re-Pair rules of a staged table of symbols (letters) and n (how often a sequence occurs)."""
    grammar: Grammar = ()
    for _ in range(ROUNDS):
        def count(batches: Iterator[pa.RecordBatch], grammar: Grammar = grammar) -> Iterator[pa.RecordBatch]:
            pairs: Counter = Counter()
            for batch in batches:
                for letters, n in zip(*batch.to_pydict().values(), strict=True):
                    symbols = compress([_TO_SYMBOL[c] for c in letters], grammar)
                    for pair in zip(symbols, symbols[1:], strict=False):
                        pairs[pair] += n
            found = list(pairs.items())
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p, _ in found], pa.int32()), pa.array([p[1] for p, _ in found], pa.int32()),
                                              pa.array([n for _, n in found], pa.int64())], names=["a", "b", "n"])

        counts = (sequences.select("symbols", "n").mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
                  .where("n > 1").orderBy(F.col("n").desc(), "a", "b").limit(PER_ROUND).collect())
        pairs = choose([tuple(r) for r in counts])
        if not pairs:
            break
        grammar += (pairs,)
    return grammar


class Solver:
    """Matrices of all rules, bottom-up, and conversations folded over them."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.matrices = [row_matrix(s) for s in range(DELETED + 1)]
        for pairs in grammar:
            self.matrices += [times(self.matrices[a], self.matrices[b]) for a, b in pairs]
        self.short = Memo(lambda letters: self.solve(letters))

    def solve(self, letters: str) -> bytes:
        """Cost and edits, as ``cost:edits``."""
        row = ((0, ("",)), None, None, None)
        for rule in compress([_TO_SYMBOL[c] for c in letters], self.grammar):
            row = times_row(row, self.matrices[rule])
        row = times_row(row, INSERTS)
        cost, rope = better(row[NONE], row[ASSISTANT])
        return f"{cost}:{''.join(spell(rope))}".encode()

    def __call__(self, letters: str) -> tuple[int, str]:
        cost, edits = (self.short[letters] if len(letters) <= 64 else self.solve(letters)).decode().split(":")
        return int(cost), edits


@functools.lru_cache(maxsize=2)
def solver(grammar: Grammar) -> Solver:
    return Solver(grammar)


def repaired_rows(letters: str, copies: list[int], edits: str) -> Iterator[tuple[int | None, int, str | None, str]]:
    """(row or null if inserted, position, new role or null if kept, edit) of the turns that are left."""
    at, left, seen, position, first_system = 0, copies[0] if copies else 0, 0, 0, 0
    for edit in edits:
        row = None
        if edit != "I":
            while not left:
                at += 1
                left = copies[at]
            row, left, seen = at, left - 1, seen + 1
        if edit == "D":
            continue
        if edit == "K" and not position and LETTERS.index(letters[seen - 1]) < 4:
            first_system = 1
        role = None if edit == "K" else ("user", "assistant")[(position - first_system) % 2]
        yield row, position, role, edit
        position += 1


# ---- Spark ----

def structure(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One row per distinct (conv_id, turn, role, digest of the text): copies, letter of the first copy, letter of the others."""
    role, text = (F.coalesce(quoted(c), F.lit(" ")) for c in (role_col, text_col))
    bare = F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    fault = F.when(bare == "", 2).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.substring(role, 1, 1)
    class_ = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    rows = turns.select(quoted(conv_col).alias("conv_id"), quoted(turn_col).alias("turn"), role.alias("role"),
                        F.unhex(F.sha2(text, 256)).alias("digest"), (class_ * 4 + fault).alias("symbol"))
    rows = rows.groupBy("conv_id", "turn", "role", "digest").agg(F.count("*").alias("copies"), F.min("symbol").alias("symbol"))
    seen = rows.groupBy("conv_id", "role", "digest").agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("from_null"),
                                                         F.count("*").alias("n")).where("n > 1").drop("n")
    rows = join_same(rows, seen, ["conv_id", "role", "digest"], "left")
    later = F.coalesce((F.col("turn") > F.col("first")) | (F.col("from_null") & F.col("turn").isNotNull()), F.lit(False))
    repeat = F.when(F.col("symbol") % 4 == 2, F.col("symbol")).otherwise(F.col("symbol") - F.col("symbol") % 4 + 3)
    letter = lambda s: F.substring(F.lit(LETTERS), s + 1, F.lit(1))
    return rows.select("conv_id", "turn", "role", "digest", "copies", letter(F.when(later, repeat).otherwise(F.col("symbol"))).alias("letter"),
                       letter(repeat).alias("repeat"))


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(summary, repaired).

    summary, per conversation: conv_id, gaps, blank, duplicate, truncated, illegal (neighbours whose initials
    aren't su, ua or au), cost, audit (initials of the edits). repaired, per turn left: conv_id, position, role,
    text, edit.
    """
    rows = staged(with_position(structure(turns, conv_col, turn_col, role_col, text_col), "conv_id", ["turn", "role", "digest"]), "rows")
    block = F.floor(F.col("at") / BLOCK).cast("long")
    of_block = F.sort_array(F.collect_list(F.struct("at", "letter", "repeat", "copies")))
    blocks = rows.groupBy("conv_id", block.alias("block")).agg(of_block.alias("r"))
    said = F.array_join(F.transform("r", lambda x: F.concat(x["letter"], F.repeat(x["repeat"], (x["copies"] - 1).cast("int")))), "")
    blocks = staged(blocks.select("conv_id", "block", said.alias("symbols"), F.col("r.copies").alias("copies")), "symbols")
    grammar = grammar_of(staged(blocks.groupBy("symbols").agg(F.count("*").alias("n")), "sequences"))
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType)]).add("at", "long").add("position", "long").add(
        "role", "string").add("edit", "string").add("illegal", "long").add("blank", "long").add("duplicate", "long").add(
        "truncated", "long").add("cost", "long").add("audit", "string")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved, kind = solver(grammar), None
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        legal = {(0, 1), (1, 2), (2, 1)}

        def batch_of(found: list) -> pa.RecordBatch:
            cols = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind, *types), strict=True)], names=schema.names)

        def rows_of(conv, letters: str, copies: list[int]) -> Iterator[tuple]:
            cost, edits = solved(letters)
            pairs = Counter(zip(letters, letters[1:], strict=False))
            illegal = sum(n for (a, b), n in pairs.items() if (LETTERS.index(a) // 4, LETTERS.index(b) // 4) not in legal)
            faults = Counter({})
            for c, n in Counter(letters).items():
                faults[LETTERS.index(c) % 4] += n
            yield (conv, None, None, None, None, illegal, faults[2], faults[3], faults[1], cost, edits)
            for at, position, role, edit in repaired_rows(letters, copies, edits):
                yield (conv, at, position, role, edit, None, None, None, None, None, None)

        def conversations() -> Iterator[tuple]:
            nonlocal kind
            now, letters, copies = None, [], []
            for batch in batches:
                kind = batch.schema.field(0).type
                for conv, k, symbols, n in zip(*batch.to_pydict().values(), strict=True):
                    if k == 0 and letters:
                        yield now, "".join(letters), copies
                        letters, copies = [], []
                    now = conv
                    letters.append(symbols)
                    copies = copies + n if copies else n
            if letters:
                yield now, "".join(letters), copies

        found = []
        for conv, letters, copies in conversations():
            for row in rows_of(conv, letters, copies):
                found.append(row)
                if len(found) >= 4096:
                    yield batch_of(found)
                    found = []
        if found:
            yield batch_of(found)

    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "block", "symbols", "copies")
    solved = staged(ordered.mapInArrow(solve, schema), "solved")

    days = rows.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    summary = join_same(solved.where("position is null").select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
                        days, ["conv_id"]).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    kept = solved.where("at is not null").select("conv_id", "at", "position", F.col("role").alias("new_role"), "edit")
    kept = join_same(kept, rows.select("conv_id", "at", "turn", "role", "digest"), ["conv_id", "at"]).drop("at")
    texts = turns.select(quoted(conv_col).alias("conv_id"), quoted(turn_col).alias("turn"), F.coalesce(quoted(role_col), F.lit(" ")).alias("role"),
                         F.coalesce(quoted(text_col), F.lit(" ")).alias("text"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = ["conv_id", "turn", "role", "digest"]
    joined = join_same(texts.dropDuplicates(keys), kept, keys)
    inserted = solved.where("position is not null and at is null")
    repaired = joined.select("conv_id", "position", F.coalesce("new_role", "role").alias("role"), "text", "edit").union(
        inserted.select("conv_id", "position", "role", F.lit("").alias("text"), "edit"))
    return summary, repaired
