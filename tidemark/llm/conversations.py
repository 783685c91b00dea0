"""Conversation structure repair: faults of every row, and the cheapest edits that make the roles alternate.

A row is blank, a duplicate of an earlier one, truncated, or sound. Edits keep it, give it another role, delete it or insert
an empty row, so that the role initials read ``(s?(ua)+)?``; the costs are those of ``repair_grammar``. The steps:

1. Rows are sorted by conversation and turn in ranges, so a conversation with very many rows is spread over many
   tasks. A pass over each range writes the rows as letters, in blocks of at most ``BLOCK``, and counts faults; what
   crosses two blocks is settled from their ends. Rows with equal role and text are found by an aggregation before.
2. Distinct blocks are compressed by one Re-Pair grammar for all conversations, and each gets one min-plus matrix.
3. The blocks' matrices and the rows with their texts meet in one stream per conversation: first the matrices are folded
   into the audit, then the rows go by and are hashed. Nothing but the audit, one letter a row, is held.

Defined cases: null text, role, and null parts of the key of the damage are one blank; rows without an id are one
conversation; rows of one turn follow by role, then by a digest of their text, and equal rows stand together; a role whose initial
isn't s, u or a can't be kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repair_grammar as grammar
from tidemark.llm.shared import parallelism
from tidemark.session import materialise

BLOCK = 4096
_BLANK = " \t\n\x0b\x0c\r"
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_ENDS = ["first_role", "last_role", "first_turn", "last_turn"]
_LEGAL = {"su", "ua", "au"}
_BLOCK_SCHEMA = "conv_id long, block long, symbols string, blank long, duplicate long, truncated long, illegal long, turns long, first_role string, last_role string, first_turn long, last_turn long"


def plain(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with blanks for nulls in the last two."""
    own = [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]
    return conversations.select(*own, *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: a fifth of the rows, by a hash of id and turn, dropped, emptied, cut, repeated or given a role."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = plain(conversations).withColumn("harm", F.crc32(key.cast("binary")) % 20).where("harm <> 0")
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("harm") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies")).withColumn("copies", F.explode("copies")).drop("copies")


def _digested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _flagged(rows: DataFrame) -> DataFrame:
    """The rows without texts: conv_id, turn, role, digest, letter (as if no duplicate), blank, later (an equal row has an earlier turn)."""
    end = F.rtrim("text", F.lit(_BLANK))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    whole = F.substring(end, -1, 1).isin(".", "!", "?")
    small = _digested(rows).select("conv_id", "turn", "role", "digest", F.when(whole, letter).otherwise(F.upper(letter)).alias("letter"), (end == "").alias("blank"))
    # structs, as a row without a turn comes before all others
    seen = small.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last")).where("first <> last")
    keys = seen.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first")
    met = small["conv_id"].eqNullSafe(keys["_conv"]) & (small["role"] == keys["_role"]) & (small["digest"] == keys["_digest"])
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return small.join(keys, met, "left").select(*small.columns, later.alias("later"))


class _Block:
    """Letters and counts of successive rows of one conversation."""

    def __init__(self, conv_id, number: int):
        self.conv_id, self.number, self.letters = conv_id, number, []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.ends = dict.fromkeys(_ENDS)

    def add(self, turn, role: str, letter: str, fault: str | None) -> None:
        self.letters.append("D" if fault in ("blank", "duplicate") else letter)
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if len(self.letters) == 1:
            self.ends["first_role"] = initial
        elif self.ends["last_role"] + initial not in _LEGAL:
            self.counts["illegal"] += 1
        self.ends["last_role"] = initial
        if turn is not None and turn != self.ends["last_turn"]:
            self.counts["turns"] += 1
            if self.ends["first_turn"] is None:
                self.ends["first_turn"] = turn
            self.ends["last_turn"] = turn

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "block": self.number, "symbols": "".join(self.letters), **self.counts, **self.ends}


def blocks(flagged: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of letters with their counts and ends; a conversation's blocks are in order by number."""
    key = ["conv_id", "turn", "role", "digest"]

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(_parsed)
        number, now, last = TaskContext.get().partitionId() << 40, None, None
        for batch in batches:
            out = []
            for conv, turn, role, digest, letter, blank, later in zip(*[batch.column(c).to_pylist() for c in (*key, "letter", "blank", "later")], strict=True):
                if now is None or now.conv_id != conv or len(now.letters) >= block:
                    if now is not None:
                        out.append(now.row())
                    now, number = _Block(conv, number), number + 1
                same = (conv, turn, role, digest)
                fault = "blank" if blank else "duplicate" if later or same == last else "truncated" if letter.isupper() else None
                now.add(turn, role, letter, fault)
                last = same
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], schema=schema)

    spread = flagged.repartitionByRange(parallelism(flagged.sparkSession), *key).sortWithinPartitions(*key)
    _parsed = flagged.sparkSession.createDataFrame([], _BLOCK_SCHEMA).schema
    return spread.mapInArrow(write, _BLOCK_SCHEMA)


def matrices(sequences: DataFrame, rounds: int = 16) -> DataFrame:
    """symbols, costs and audits (four rows of four; null: no way) of every distinct sequence, by one grammar for all."""
    coded, rules = grammar.compress(sequences, rounds)

    def evaluate(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = grammar.Grammar(rules)
        for batch in batches:
            costs, audits = [], []
            for code in batch.column("code").to_pylist():
                cells = [cell for row in known.matrix(code) for cell in row]
                costs.append([None if c is None else c[0] for c in cells])
                audits.append([None if c is None else "".join(grammar.pieces(c[1])) for c in cells])
            yield pa.RecordBatch.from_arrays([batch.column("symbols"), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))], ["symbols", "costs", "audits"])

    return coded.mapInArrow(evaluate, "symbols string, costs array<long>, audits array<string>")


class _Repair:
    """One conversation's stream: blocks with matrices, then rows."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.row: list = [(0, ""), None, None, None]
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.least = self.greatest = self.last_role = None
        self.edits: Iterator[str] | None = None
        self.state, self.hash, self.lines = 0, hashlib.sha256(), 0

    def fold(self, block: dict) -> None:
        for name in _COUNTS:
            self.counts[name] += block[name]
        if self.last_role is not None and self.last_role + block["first_role"] not in _LEGAL:
            self.counts["illegal"] += 1
        self.last_role = block["last_role"]
        if block["first_turn"] is not None:
            if self.greatest is None:
                self.least = block["first_turn"]
            elif self.greatest == block["first_turn"]:
                self.counts["turns"] -= 1
            self.greatest = block["last_turn"]
        cells = [None if c is None else (c, a) for c, a in zip(block["costs"], block["audits"], strict=True)]
        self.row = grammar.applied(self.row, [cells[4 * i : 4 * i + 4] for i in grammar.STATES])

    def _decide(self) -> None:
        if self.edits is None:
            self.cost, audit = grammar.finished(self.row)
            self.audit = "".join(grammar.pieces(audit))
            self.edits = iter(self.audit)

    def _line(self, role: str, text: str) -> None:
        if self.lines:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.lines += 1

    def _turn(self, text: str, kept_role: str | None = None) -> None:
        asks = self.state != 2
        self._line(kept_role if kept_role is not None else "user" if asks else "assistant", text)
        self.state = 1 if kept_role is not None and kept_role[:1] == "s" else 2 if asks else 3

    def read(self, role: str, text: str) -> None:
        self._decide()
        for edit in self.edits:
            if edit == "I":
                self._turn("")
                continue
            if edit == "K":
                self._turn(text, role)
            elif edit == "R":
                self._turn(text)
            return

    def result(self) -> dict:
        self._decide()
        for _ in self.edits:
            self._turn("")
        gaps = 0 if self.least is None else self.greatest - self.least + 1 - self.counts["turns"]
        faults = {c: self.counts[c] for c in ("blank", "duplicate", "truncated", "illegal")}
        return {"conv_id": self.conv_id, "gaps": gaps, **faults, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.hash.hexdigest()}


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(rows: DataFrame, ids: DataFrame, block: int = BLOCK, rounds: int = 16) -> DataFrame:
    """One row for each conv_id of ``ids`` and of ``rows`` (conv_id, turn, role, text): counts of faults, cost, audit, digest.

    ``rows`` hold no nulls in role and text (``plain``). ``repaired_sha256`` is of the repaired ``role:text`` lines.
    """
    spark = rows.sparkSession
    made = materialise(blocks(materialise(_flagged(rows), "flagged"), block), "blocks")
    solved = materialise(matrices(made, rounds), "matrices")
    numbers = [*_COUNTS, *_ENDS]
    kinds = spark.createDataFrame([], f"conv_id long, kind int, block long, turn long, role string, digest binary, text string, {_BLOCK_SCHEMA.split('symbols string, ')[1]}, costs array<long>, audits array<string>")
    marks = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("kind", F.lit(0))
    known = made.join(solved, "symbols").select("conv_id", F.lit(1).alias("kind"), "block", *numbers, "costs", "audits")
    texts = _digested(rows).withColumn("kind", F.lit(2))
    stream = kinds
    for part in (marks, known, texts):
        stream = stream.unionByName(part, allowMissingColumns=True)
    spread = stream.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "block", "turn", "role", "digest")

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, now = to_arrow_schema(_parsed), None
        for batch in batches:
            out = []
            conv_ids, what = batch.column("conv_id").to_pylist(), batch.column("kind").to_pylist()
            for i, (conv, kind) in enumerate(zip(conv_ids, what, strict=True)):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        out.append(now.result())
                    now = _Repair(conv)
                if kind == 1:
                    now.fold({c: batch.column(c)[i].as_py() for c in (*numbers, "costs", "audits")})
                elif kind == 2:
                    now.read(batch.column("role")[i].as_py(), batch.column("text")[i].as_py())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema=schema)

    _parsed = spark.createDataFrame([], _RESULT).schema
    return spread.select(*kinds.columns).mapInArrow(read, _RESULT)
