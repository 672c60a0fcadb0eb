"""Token counts of every prefix of a text, by dynamic programming over its characters.

A byte-pair encoding is the only one whose neighbouring tokens each encode to themselves
when they stand alone as a pair. The last token of a prefix is therefore the one token that
ends there and goes with the last token of what stands before it, and the prefix has one
token more than what stands before. One walk over the characters gives the exact count at
each of them, and what is asked later (does the text fit, where does it have to be cut, what
does it cost up to here) is read from the stored counts: nothing is encoded again.

Counts are stored as steps, one signed byte a character, since a longer prefix can also have
fewer tokens. Characters that no piece of the vocabulary holds side by side are never merged,
so a text falls into segments there, and a task keeps the steps of short segments.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tallyhouse.llm.text import text_of, whole

SPACE = "▁"  # stands for a blank inside pieces
CACHED_CHARS = 40  # steps of segments up to this length are kept
CACHED_SEGMENTS = 1 << 20
CACHED_STATES = 1 << 20
CACHED_PAIRS = 1 << 20


class PrefixCounter:
    """Steps of texts under one model file.

    Files of another kind than byte-pair encoding with byte fallback and unchanged
    characters are refused, because their prefixes do not count this way.
    """

    def __init__(self, path: str):
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("not a byte-pair model with byte fallback")
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not (normal.escape_whitespaces and normal.add_dummy_prefix):
            raise ValueError("the model changes characters of the text")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("pieces of the user's own are not supported")
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.near = {piece[i : i + 2] for piece in self.scores for i in range(len(piece) - 1)}
        # The longest piece that ends in these three characters.
        self.ends = {piece[-3:]: len(piece) for piece in sorted(self.scores, key=len) if len(piece) > 2}
        side_by_side = {c for piece in self.scores if len(piece) > 1 for c in piece}
        alone = "".join(re.escape(c) for c in map(chr, range(128)) if c not in side_by_side)
        if any(SPACE in piece.lstrip(SPACE) for piece in self.scores):
            alone = None  # blanks inside pieces: the text stays in one segment
        inner = f"[^{SPACE}{alone}]"
        self.segments = re.compile("(?s).+" if alone is None else f"{SPACE}+{inner}*|{inner}+|[{alone}]").findall
        self.known: dict[str, bytes] = {}
        self.states = {"": ("", 0)}  # last token and count of beginnings of segments
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The encoding by its definition: the best pair first, of equals the leftmost. For short texts."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            found = [(-scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
            if not found:
                break
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def together(self, left: str, right: str) -> bool:
        """Whether both stay as they are next to each other. `left` is empty at the start."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        found = self.pairs[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def segment(self, text: str) -> bytes:
        """Steps of a text that follows something it cannot merge with.

        What is known of its beginnings is taken over, so words share the walk over theirs.
        """
        scores, ends, pairs, together, states = self.scores, self.ends, self.pairs, self.together, self.states
        short, begin = len(text) <= CACHED_CHARS, 0
        if short:
            begin = len(text)
            while text[:begin] not in states:
                begin -= 1
        last, count = map(list, zip(*[states[text[:i]] for i in range(begin + 1)], strict=True))
        for end in range(begin + 1, len(text) + 1):
            # From the longest token that can end here down to the character itself.
            for start in range(max(0, end - ends.get(text[max(0, end - 3) : end], 2)), end):
                token = text[start:end]
                if token in scores or start == end - 1:
                    before = last[start]
                    goes = pairs.get((before, token))
                    if together(before, token) if goes is None else goes:
                        break
            # A character outside the vocabulary is spelled in bytes.
            last.append(token)
            count.append(count[start] + (1 if token in scores else len(token.encode("utf-8", "surrogatepass"))))
            if short:
                states[text[:end]] = token, count[-1]
        return array("b", map(int.__sub__, count[1:], count)).tobytes()

    def split(self, text: str) -> bytes:
        """Steps of a segment, which falls apart further between characters that no piece holds side by side."""
        near, begin, parts = self.near, 0, []
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in near:
                parts.append(text[begin:i])
                begin = i
        if not begin:
            return self.segment(text)
        return b"".join([self.kept(part, self.segment) for part in (*parts, text[begin:])])

    def kept(self, text: str, made: Callable[[str], bytes]) -> bytes:
        held = self.known.get(text)
        if held is None:
            if len(self.known) >= CACHED_SEGMENTS or len(self.states) >= CACHED_STATES:
                self.known.clear()
                self.states = {"": ("", 0)}
            held = made(text)
            if len(text) <= CACHED_CHARS:
                self.known[text] = held
        return held

    def steps(self, text: str) -> bytes:
        """One signed byte a character: by how much the count of the prefix that ends there changes."""
        if not text:
            return b""
        known, kept, split = self.known.get, self.kept, self.split
        steps = b"".join([known(piece) or kept(piece, split) for piece in self.segments(SPACE + text.replace(" ", SPACE))])
        # The blank put before the text counts with its first character.
        first = int.from_bytes(steps[:1], signed=True) + int.from_bytes(steps[1:2], signed=True)
        return first.to_bytes(1, signed=True) + steps[2:]


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def counts(steps: bytes) -> np.ndarray:
    """Tokens of every prefix, from the empty one to the whole text."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


def prefix_steps(path: str) -> Callable[[Column], Column]:
    """Column of texts → column of steps (empty for null and empty texts)."""

    def run(texts: pa.Array) -> pa.Array:
        steps = counter(path).steps
        return pa.array([steps(t) if t else b"" for t in texts.to_pylist()], pa.binary())

    udf = F.arrow_udf(run, "binary")
    return lambda text: udf(text_of(text))


def answers(limit: int) -> Callable[[Column], Column]:
    """Column of steps → n_tokens of the text and fit_chars, its longest prefix of at most `limit` tokens."""

    def run(stored: pa.Array) -> pa.Array:
        totals, fits = [], []
        for steps in stored.to_pylist():
            total, fit = int(np.frombuffer(steps, np.int8).sum(dtype=np.int64)), len(steps)
            if total > limit:
                fit = int(np.flatnonzero(counts(steps) <= limit)[-1])
            totals.append(total)
            fits.append(fit)
        return pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (totals, fits)], names=["n_tokens", "fit_chars"])

    return F.arrow_udf(run, "struct<n_tokens: bigint, fit_chars: bigint>")


def prefixed(docs: DataFrame, path: str) -> DataFrame:
    """Column `doc` with the given columns, `n_bytes` of the text, and its `steps`.

    Store this once; `budgeted` and `tokens_at` answer from it. Null and empty texts have
    no steps, repeated rows stay repeated, an empty table gives no rows, other columns may
    have any name. Texts are taken whole, whatever their length.
    """
    text = text_of(F.col("doc.text"))
    return whole(docs).select("doc", F.octet_length(text).cast("bigint").alias("n_bytes"), prefix_steps(path)(text).alias("steps"))


def budgeted(prefixes: DataFrame, limit: int) -> DataFrame:
    """`prefixes` with n_tokens, over_limit, and the characters that fit into `limit` tokens."""
    if limit < 0:
        raise ValueError("a limit of tokens is not negative")
    found = prefixes.withColumn("answer", answers(limit)(F.col("steps")))
    return found.select(*prefixes.columns, "answer.n_tokens", "answer.fit_chars", (F.col("answer.n_tokens") > limit).alias("over_limit"))


def truncated(prefixes: DataFrame, limit: int) -> DataFrame:
    """`budgeted` rows with `kept`, the longest beginning of the text that fits."""
    text = text_of(F.col("doc.text"))
    return budgeted(prefixes, limit).withColumn("kept", F.substring(text, F.lit(1), F.col("fit_chars").cast("int")))


def tokens_at(steps: Column, n_chars: Column) -> Column:
    """Tokens of the first `n_chars` characters; of the whole text where it is shorter."""

    def run(stored: pa.Array, lengths: pa.Array) -> pa.Array:
        pairs = zip(stored.to_pylist(), lengths.to_pylist(), strict=True)
        return pa.array([int(np.frombuffer(s[: max(n or 0, 0)], np.int8).sum(dtype=np.int64)) for s, n in pairs], pa.int64())

    return F.arrow_udf(run, "bigint")(steps, n_chars.cast("bigint"))
