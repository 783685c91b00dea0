"""Token counts of whole texts through the distinct pre-tokens of the corpus.

The tokenizer's own normalizer and pre-tokenizer say how often each pre-token occurs in each document. Pieces are
counted once per distinct pre-token, and a document's tokens are the sum of count times pieces. Ids never exist.

Frequencies follow a power law: a few ten thousand pre-tokens make up most entries. The ``head`` most frequent ones
(a bound, so they may travel to every task) are looked up where the text is read; only the others are shuffled and
joined. Their frequency is small by construction, so the join has no hot key.

Defined cases: null text counts as empty (0 tokens, 0 bytes); repeated ids give one row each; an empty table gives
none; a special string inside a text is one token, as the library has it; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.shared import texts_of
from tidemark.session import materialise

HEAD = 100_000  # pre-tokens looked up in memory, at most
_FLUSH = 600_000  # distinct pre-tokens a task keeps before it hands on their counts
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # no apostrophe: it may belong to what follows
_SPECIAL = "\0"  # marks a special string; no pre-token begins with it, as byte-level texts hold no NUL

_readers: dict[int, PreTokens] = {}


class PreTokens:
    """Pre-tokens of texts, found once per distinct run without white space."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        self.model, self.normalizer, self.pre_tokenizer = tokenizer.model, tokenizer.normalizer, tokenizer.pre_tokenizer
        special = [re.escape(x.content) for x in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(sorted(special, key=len, reverse=True)) + ")") if special else None
        self.sums: dict[str, int] = {}

    def of_run(self, run: str) -> list[str]:
        """Pre-tokens of a run; only what isn't plain letters and marks needs the library."""
        if run.isascii():
            if run.isalpha():
                return [run.lower()]
            letters = run.rstrip(_MARKS)
            if letters.isalpha():
                return [letters.lower(), run[len(letters) :]]
        out: list[str] = []
        for i, part in enumerate(self.special.split(run) if self.special else [run]):
            if i % 2:
                out.append(_SPECIAL + part)
            elif part:
                normal = self.normalizer.normalize_str(part) if self.normalizer else part
                out.extend([x for x, _ in self.pre_tokenizer.pre_tokenize_str(normal)])
        return out

    def of_runs(self, runs: dict[str, int]) -> dict[str, int]:
        out: dict[str, int] = {}
        for run, n in runs.items():
            for piece in self.of_run(run) if run else ():
                out[piece] = out.get(piece, 0) + n
        return out

    def known_sum(self, runs: list[str], look_up: dict[str, int]) -> tuple[int, dict[str, int]]:
        """Pieces of the runs whose pre-tokens are all in ``look_up``, and the pre-tokens of the others."""
        found = list(map(self.sums.get, runs))
        if None not in found:
            return sum(found), {}
        other: list[str] = []
        for run in [r for r, n in zip(runs, found, strict=True) if n is None]:
            pieces = [look_up.get(x) for x in (self.of_run(run) if run else [])]
            if None in pieces:
                other.append(run)
            else:
                if len(self.sums) > _FLUSH:
                    self.sums.clear()
                self.sums[run] = sum(pieces)
                found.append(sum(pieces))
        return sum(filter(None, found)), self.of_runs(Counter(other))

    def pieces(self, pre_token: str) -> int:
        return 1 if pre_token.startswith(_SPECIAL) else len(self.model.tokenize(pre_token))


def _reader(definition: str) -> PreTokens:
    key = hash(definition)
    if key not in _readers:
        _readers[key] = PreTokens(definition)
    return _readers[key]


def vocabulary(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Every distinct pre-token of the texts: pre_token, occurrences, pieces."""
    definition = tokens.definition_of(tokenizer_path)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        reader, seen = _reader(definition), Counter()

        def rows(found: dict[str, int]):
            words = list(found)
            for i in range(0, len(words), 50_000):
                part = words[i : i + 50_000]
                yield pa.RecordBatch.from_pydict({"pre_token": part, "occurrences": pa.array([found[x] for x in part], pa.int64())})

        for batch in batches:
            for text in texts_of(batch):
                seen.update(tokens.at_white_space(tokens.lowered(text)))
                if len(seen) > _FLUSH:
                    yield from rows(reader.of_runs(seen))
                    seen = Counter()
        yield from rows(reader.of_runs(seen))

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa

        reader = _reader(definition)
        for batch in batches:
            n = pa.array([reader.pieces(x) for x in batch.column("pre_token").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, n], ["pre_token", "occurrences", "pieces"])

    found = docs.select("text").mapInArrow(count, "pre_token string, occurrences long")
    distinct = found.groupBy("pre_token").agg(F.sum("occurrences").alias("occurrences"))
    return distinct.mapInArrow(pieces, "pre_token string, occurrences long, pieces int")


def frequent(words: DataFrame, head: int) -> DataFrame:
    """The most frequent of ``words``, ``head`` at most: whole bands of frequency, so that no task sorts or sends more."""
    band = F.floor(F.log2("occurrences") * 16)
    sizes = words.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()  # some hundred rows
    total, least = 0, None
    for row in sorted(sizes, reverse=True):
        total += row["n"]
        if total > head:
            break
        least = row["band"]
    return words.where(band >= least) if least is not None else words.limit(0)


def count_tokens(docs: DataFrame, tokenizer_path: str, head: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of ``docs`` (doc_id, text)."""
    definition = tokens.definition_of(tokenizer_path)
    words = materialise(vocabulary(docs, tokenizer_path), "pre-tokens")
    known = {x["pre_token"]: x["pieces"] for x in frequent(words, head).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def split(batches: Iterator) -> Iterator:
        import pyarrow as pa

        reader, look_up = _reader(definition), shared.value
        task, done = TaskContext.get().partitionId() << 36, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lengths, sums, rest, counts = [], [], [], []
                for text in texts_of(part):
                    lengths.append(len(text.encode()))
                    total, other = reader.known_sum(tokens.at_white_space(tokens.lowered(text)), look_up)
                    sums.append(total)
                    rest.append(list(other))
                    counts.append(list(other.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(task + done, task + done + part.num_rows), pa.int64()),
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                        pa.array(rest, pa.list_(pa.string())),
                        pa.array(counts, pa.list_(pa.int64())),
                    ],
                    ["row", "doc_id", "n_bytes", "total", "rest", "counts"],
                )
                done += part.num_rows

    schema = "row long, doc_id long, n_bytes long, total long, rest array<string>, counts array<long>"
    read = materialise(docs.select("doc_id", "text").mapInArrow(split, schema), "token-counts")
    entries = read.select("row", F.explode(F.arrays_zip("rest", "counts")).alias("e")).select("row", F.col("e.rest").alias("pre_token"), F.col("e.counts").alias("n"))
    rare = entries.join(words.select("pre_token", "pieces"), "pre_token").select("row", (F.col("n") * F.col("pieces")).alias("total"))
    more = rare.groupBy("row").agg(F.sum("total").alias("more"))
    return read.join(more, "row", "left").select("doc_id", "n_bytes", (F.col("total") + F.coalesce("more", F.lit(0))).alias("n_tokens"))
