"""Re-Pair over many short sequences, and min-plus transfer matrices of its symbols.

A sequence is a string with a letter for each row. The pair of neighbours that occurs most often over all distinct
sequences becomes a new symbol, again and again; pairs without a common symbol are replaced in one round, as none of them
changes the other's count. Counting and replacing are DataFrame operations; the driver sees the best pairs of a round.

Every symbol has a matrix: the cheapest edits, as (cost, audit), that lead from a state of the role automaton to another
while its rows are read. The matrix of a rule is the min-plus product of its two symbols' matrices, made once per worker.
Among edits of equal cost the ASCII-least audit wins. Audits of equal cost for the same rows are never prefixes of each
other (each letter has its own cost), so the least of a whole is made of the least of its parts. Long audits are ropes: two
halves that are shared, not copied.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

#: Letters of rows: role initial (x: another role), upper case if truncated; D must be deleted.
LETTERS = "suaxSUAXD"
#: States: nothing yet, after the system row, after a user row, after an assistant row. The first and last may end.
STATES = range(4)
_ASKS, _ANSWERS = {0: 2, 1: 2, 3: 2}, {2: 3}
_KEEPS = {"s": {0: 1}, "u": _ASKS, "a": _ANSWERS, "x": {}}
_PLAIN = 256
_FIRST_RULE = 0xE000

Audit = "str | Rope"
Matrix = list[list[tuple[int, object] | None]]


class Rope:
    """Two audits one after the other."""

    __slots__ = ("left", "right", "size")

    def __init__(self, left, right):
        self.left, self.right, self.size = left, right, len(left) + len(right)

    def __len__(self) -> int:
        return self.size


def joined(left, right):
    if not len(left):
        return right
    if not len(right):
        return left
    if len(left) + len(right) <= _PLAIN and isinstance(left, str) and isinstance(right, str):
        return left + right
    return Rope(left, right)


def pieces(audit) -> Iterator[str]:
    """The strings of an audit in order."""
    stack = [audit]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += (top.right, top.left)


def less(a, b) -> bool:
    """Whether audit ``a`` sorts before ``b``; parts that both share are skipped."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if not isinstance(x, str) and (isinstance(y, str) or len(x) >= len(y)):
            left += (x.right, x.left)
            right.append(y)
        elif not isinstance(y, str):
            right += (y.right, y.left)
            left.append(x)
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            if x[n:]:
                left.append(x[n:])
            if y[n:]:
                right.append(y[n:])
    return not left and bool(right)


def better(a, b):
    """The cheaper of two (cost, audit), either of which may be None; of equal ones the ASCII-least."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def applied(row: list, matrix: Matrix) -> list:
    """A row of (cost, audit) for each state, carried through ``matrix``."""
    out: list = [None] * len(matrix)
    for start, known in zip(row, matrix, strict=True):
        if start is None:
            continue
        for j, more in enumerate(known):
            if more is not None and (out[j] is None or start[0] + more[0] <= out[j][0]):
                out[j] = better(out[j], (start[0] + more[0], joined(start[1], more[1])))
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    return [applied(row, b) for row in a]


def _inserts() -> Matrix:
    """Any number of inserted rows, 2 each; a third one would lead where the first did."""
    out: Matrix = [[None] * 4 for _ in STATES]
    for i in STATES:
        state, cost, audit = i, 0, ""
        while out[i][state] is None:
            out[i][state] = (cost, audit)
            state, cost, audit = (_ASKS | _ANSWERS)[state], cost + 2, audit + "I"
    return out


INSERTS = _inserts()


def letter_matrix(letter: str) -> Matrix:
    """Rows inserted before it, then keep, rerole or delete."""
    act: Matrix = [[None] * 4 for _ in STATES]
    for i in STATES:
        act[i][i] = (3, "D")
        if letter == "D":
            continue
        late = 1 if letter.isupper() else 0
        to = (_ASKS | _ANSWERS)[i]
        act[i][to] = (2 + late, "R")
        if (kept := _KEEPS[letter.lower()].get(i)) is not None:
            act[i][kept] = (late, "K")
    return product(INSERTS, act)


def finished(row: list) -> tuple[int, object]:
    """The best that ends in an accepting state, after rows inserted at the end."""
    ends = applied(row, INSERTS)
    return better(ends[0], ends[3])


class Grammar:
    """Matrices of letters and rules; ``rules`` are pairs of symbols, each rule after those it uses."""

    def __init__(self, rules: list[str]):
        self.matrices = {x: letter_matrix(x) for x in LETTERS}
        for i, pair in enumerate(rules):
            self.matrices[chr(_FIRST_RULE + i)] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def matrix(self, code: str) -> Matrix:
        first, *rest = code
        out = self.matrices[first]
        for symbol in rest:
            out = product(out, self.matrices[symbol])
        return out


def compress(sequences: DataFrame, rounds: int = 16, at_once: int = 32) -> tuple[DataFrame, list[str]]:
    """symbols and code of every distinct row of ``sequences`` (symbols: strings of ``LETTERS``), and the rules of the codes.

    Rounds end when no pair occurs twice, or after ``rounds`` of at most ``at_once`` rules; more would only shorten codes.
    """
    coded = materialise(sequences.select("symbols").distinct().withColumn("code", F.col("symbols")), "sequences")
    rules: list[str] = []
    for _ in range(rounds):
        pairs = coded.select(F.explode(F.regexp_extract_all("code", F.lit("(?s)(?=(..))"), 1)).alias("pair"))
        best = pairs.groupBy("pair").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * at_once).collect()
        used: set[str] = set()
        code = F.col("code")
        for pair in (r.pair for r in best):
            if used.isdisjoint(pair) and len(used) < 2 * at_once:
                used.update(pair)
                code = F.replace(code, F.lit(pair), F.lit(chr(_FIRST_RULE + len(rules))))
                rules.append(pair)
        if not used:
            break
        coded = materialise(coded.select("symbols", code.alias("code")), "codes")
    return coded, rules
