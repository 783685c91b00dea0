"""Byte-level BPE of whole texts by tree concatenation, and back.

A text is cut into leaves anywhere, leaves are encoded by themselves, and neighbours are joined pair by pair up to the root. At
a join only a window is encoded again: the last tokens of the left side with the first of the right one. It is widened
until both sides agree with it exactly, and then the sides keep their tokens outside it. A side agrees

* at its outer end, when the window holds all of it, or
* at a joint, a single space between two characters that are not white space: no token crosses its front, whatever
  stands around it, or
* inside a run of letters, digits or marks that spans the cut and has no joint, when the window's outermost token is the
  side's own: a sequence of tokens is the BPE of a pre-token if and only if every two neighbours are, and all neighbours
  then stand together in the left side, the window or the right side.

So the ids are the library's. Texts of at most ``SEGMENT`` characters are one task's work, leaf by leaf; longer ones are cut
into segments that go to all tasks, and segments are joined level by level, with one shuffle of ids a level. Equal long texts
are encoded once. A text's ids come together in one row, four bytes a token, as its text does.

Defined cases: null text is the empty text, which has no token; special strings are tokens of their own, also across a cut;
equal rows count each; other columns are kept by ``round_trip`` only if named; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.shared import texts_of
from tidemark.session import materialise

LEAF = 1024
SEGMENT = 1 << 16
WINDOW = 8
_CHUNK = 1 << 16
_made: dict[int, TreeEncoder] = {}


class TreeEncoder:
    """Ids of texts as arrays of unsigned 32-bit numbers, and texts of ids."""

    def __init__(self, definition: str):
        self.encoder = tokens.encoder(definition, "spaces")
        library = self.encoder.tokenizer
        byte_of = {c: b for b, c in enumerate(tokens._BYTE)}
        special = {i: t.content.encode() for i, t in library.get_added_tokens_decoder().items()}
        names = {i: name for name, i in library.get_vocab(with_added_tokens=True).items()}
        self.bytes_of = [special[i] if i in special else bytes(byte_of[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.digits_of = [str(i).encode() for i in range(len(self.bytes_of))]
        self.pre_tokenizer = library.pre_tokenizer

    def _ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoder.encode(text), dtype="<u4")

    def encode(self, text: str, leaf: int = LEAF) -> np.ndarray:
        nodes = [self._ids(text[i : i + leaf]) for i in range(0, len(text), leaf)]
        while len(nodes) > 1:
            pairs = [self.join(nodes[i], nodes[i + 1]) for i in range(0, len(nodes) - 1, 2)]
            nodes = pairs + nodes[len(nodes) - len(nodes) % 2 :]
        return nodes[0] if nodes else np.zeros(0, dtype="<u4")

    def _inside(self, token: int) -> bool:
        """Whether a token begins within a character."""
        return 0x80 <= self.bytes_of[token][0] < 0xC0

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of two texts one after the other, from the ids of each."""
        if not len(left) or not len(right):
            return left if len(left) else right
        width = WINDOW
        while True:
            i, j = max(0, len(left) - width), min(len(right), width)
            while i > 0 and self._inside(left[i]):
                i -= 1
            while j < len(right) and self._inside(right[j]):
                j += 1
            before, after = self.text(left[i:]), self.text(right[:j])
            found = self._window(before, after, i == 0, j == len(right), left[i], right[j - 1])
            if found is not None:
                start, window, end = found
                head = len(left) - self._tokens_in(len(before[start:].encode()), left[::-1])
                tail = self._tokens_in(len(after[:end].encode()), right)
                return np.concatenate([left[:head], window, right[tail:]])
            width *= 2

    def _tokens_in(self, size: int, ids: np.ndarray) -> int:
        """How many of ``ids`` have ``size`` bytes together."""
        n = 0
        while size > 0:
            size -= len(self.bytes_of[ids[n]])
            n += 1
        if size < 0:
            raise ValueError("a window does not begin or end between tokens")
        return n

    def _window(self, before: str, after: str, all_left: bool, all_right: bool, first: int, last: int):
        """Where the window starts in ``before``, its ids, and where it ends in ``after``; None if a side doesn't agree."""
        both, cut = before + after, len(before)
        start = end = None
        for joint in tokens._JOINT.finditer(both):
            if joint.start() <= cut:
                start = joint.start()
            if joint.start() >= cut:
                end = joint.start()
                break
        agreed_left, agreed_right = start is not None or all_left, end is not None or all_right
        start, end = start or 0, len(both) if end is None else end
        window = both[start:end]
        ids = self._ids(window)
        if not (agreed_left and agreed_right):
            spans = [span for _, span in self.pre_tokenizer.pre_tokenize_str(window)]
            cut -= start
            if not agreed_left and not (spans[0][1] > cut and not window[0].isspace() and ids[0] == first):
                return None
            if not agreed_right and not (spans[-1][0] <= cut and not window[-1].isspace() and ids[-1] == last):
                return None
        return start, ids, end - len(before)

    def text(self, ids: np.ndarray) -> str:
        return b"".join([self.bytes_of[t] for t in ids.tolist()]).decode(errors="replace")

    def digests(self, ids: np.ndarray) -> tuple[str, str]:
        """SHA-256 of the ids in decimal, joined by commas, and of the decoded text."""
        listed, decoded = hashlib.sha256(), hashlib.sha256()
        rest = b""
        for i in range(0, len(ids), _CHUNK):
            part = ids[i : i + _CHUNK].tolist()
            listed.update((b"," if i else b"") + b",".join([self.digits_of[t] for t in part]))
            rest += b"".join([self.bytes_of[t] for t in part])
            whole = len(rest) if i + _CHUNK >= len(ids) else max(rest.rfind(b" "), 0)  # chunks end between characters
            decoded.update(rest[:whole].decode(errors="replace").encode())
            rest = rest[whole:]
        return listed.hexdigest(), decoded.hexdigest()


def tree_encoder(definition: str) -> TreeEncoder:
    """The worker's own, made once and used by all its tasks."""
    key = hash(definition)
    if key not in _made:
        _made[key] = TreeEncoder(definition)
    return _made[key]


_DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest_columns(made: TreeEncoder, found: Iterator[np.ndarray]) -> list:
    import pyarrow as pa

    rows = [(len(ids), *made.digests(ids)) for ids in found]
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]


def _names() -> list[str]:
    return ["n_tokens", "ids_sha256", "decoded_sha256"]


def segments(texts: DataFrame, definition: str, segment: int, leaf: int) -> DataFrame:
    """digest, node, ids of every segment of ``texts`` (digest, text); equal texts once."""
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{segment}}}"), 0)
    parts = texts.select("digest", F.posexplode(cut).alias("node", "text"))
    spread = parts.groupBy("digest", "node").agg(F.first("text").alias("text"))

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        made = tree_encoder(definition)
        for batch in batches:
            ids = pa.array([made.encode(t, leaf).tobytes() for t in texts_of(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("node"), ids], ["digest", "node", "ids"])

    return materialise(spread.mapInArrow(encode, "digest string, node int, ids binary"), "segments")


def concatenated(nodes: DataFrame, definition: str) -> DataFrame:
    """digest, node (0), ids: the segments of each text (digest, node, ids) joined level by level."""

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        made = tree_encoder(definition)
        for batch in batches:
            out = []
            for pair in batch.column("pair"):
                sides = [np.frombuffer(side["ids"].as_py(), dtype="<u4") for side in pair]
                out.append((made.join(*sides) if len(sides) == 2 else sides[0]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("node"), pa.array(out, pa.binary())], ["digest", "node", "ids"])

    most = nodes.agg(F.max("node")).first()[0] or 0
    while most:
        pairs = nodes.groupBy("digest", F.shiftright("node", 1).alias("node")).agg(F.sort_array(F.collect_list(F.struct(F.col("node").alias("at"), "ids"))).alias("pair"))
        nodes, most = pairs.mapInArrow(join, "digest string, node int, ids binary"), most >> 1
    return nodes


def round_trip(docs: DataFrame, path: str, *keep: Column | str, segment: int = SEGMENT, leaf: int = LEAF) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_tokens, ids_sha256 and decoded_sha256 of every whole text."""
    definition = tokens.definition_of(path)
    rows = docs.select(F.struct(*keep).alias("kept"), F.coalesce("text", F.lit("")).alias("text"))
    kept = rows.schema["kept"].dataType.simpleString()
    long = F.char_length("text") > segment

    def whole(batches: Iterator) -> Iterator:
        import pyarrow as pa

        made = tree_encoder(definition)
        for batch in batches:
            columns = _digest_columns(made, (made.encode(t, leaf) for t in texts_of(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("kept"), *columns], ["kept", *_names()])

    def finish(batches: Iterator) -> Iterator:
        import pyarrow as pa

        made = tree_encoder(definition)
        for batch in batches:
            columns = _digest_columns(made, (np.frombuffer(x.as_py(), dtype="<u4") for x in batch.column("ids")))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), *columns], ["digest", *_names()])

    short = rows.where(~long).mapInArrow(whole, f"kept {kept}, {_DIGESTS}")
    hashed = rows.where(long).select("kept", F.sha2("text", 256).alias("digest"), "text")
    roots = concatenated(segments(hashed.select("digest", "text"), definition, segment, leaf), definition)
    found = hashed.select("kept", "digest").join(roots.mapInArrow(finish, f"digest string, {_DIGESTS}"), "digest").select("kept", *_names())
    return short.union(found).select("kept.*", *_names())
