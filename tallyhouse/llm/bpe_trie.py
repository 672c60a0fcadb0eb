"""BPE encoding by prefix-sharing trie traversal, and decoding.

The distinct words of a batch go into a trie. The encoding of a prefix is fixed by the
token that ends it and the encoding of what stands before that token, and a token may
follow another exactly if BPE, run over both, leaves the two as they are. A depth-first
walk hands this state (last token, where it starts) from node to node, so a prefix
that many words share is encoded once.

The library's own normalizer and splitter cut a text into words. White space is dropped
by them, so a text is cut at ASCII white space first and every distinct chunk is treated
once; a bounded cache keeps chunks between batches. No shuffle, no model training.
"""

from __future__ import annotations

import gc
import json
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm.text import text_of

CACHED_CHUNKS = 500_000  # in each of two generations
CACHED_MERGED = 300_000  # the same for `Merges`, where a miss costs little
GROUP_BYTES = 4 << 20
TRIE_WORDS = 8192  # of one walk; a node is a dictionary, so all words of a batch would be 100 MB
NEVER = 1 << 60
KNOWN_PAIRS = 300_000
# Chunks of these characters only are cut here by the file's own splitting rule; they
# are composed already, and only letters of these two blocks occur. All others go
# through the library. U+00D7 and U+00F7 are signs, not letters.
PLAIN = re.compile("[\x21-\x7e\xc0-\xff]*")
PLAIN_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\x20\x09-\x0da-z0-9\xdf-\xf6\xf8-\xff]+"
)


PLAIN_TEXT = re.compile("[\x20-\x7e\x09-\x0d\xc0-\xff]*")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others are numbered from 256.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]


class Vocabulary:
    """Merges of a tokenizer file, as the walk needs them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.letters = {c: bytes([b]) for b, c in enumerate(letters)}
        self.rank: dict[int, int] = {}  # left token, right token → place in the merge list
        self.parts: dict[int, tuple[int, int]] = {}  # merged token → its pair
        self.born = [-1] * (max(ids.values()) + 1)  # place of the merge that makes a token
        # A symbol is a byte, or 256 + a byte that ends its word.
        spelled = {ids[c]: (b,) for b, c in enumerate(letters)}
        spelled |= {ids[c + suffix]: (256 + b,) for b, c in enumerate(letters)}
        for place, (left, right) in enumerate(model["merges"]):
            a, b, both = ids[left], ids[right], ids[left + right]
            self.rank[a << 32 | b], self.parts[both], self.born[both] = place, (a, b), place
            spelled[both] = spelled[a] + spelled[b]
        self.single = {s: t for t, (s, *more) in spelled.items() if not more}
        self.made = {place: token for token, place in enumerate(self.born) if place >= 0}
        self.tokens: dict = {}  # trie of the tokens' symbols; -1 holds the token
        for token, symbols in spelled.items():
            node = self.tokens
            for s in symbols:
                node = node.setdefault(s, {})
            node[-1] = token
        self.known: dict[int, bool] = {}

    def follows(self, left: int, right: int) -> bool:
        """Whether BPE over both tokens' symbols gives back the two tokens.

        Both were built by merges of rising rank. Taken apart again from the latest
        merge on, two pieces face each other over the border in every state; if they
        form a pair that is merged before either piece grows further, the border falls.
        """
        born, parts = self.born, self.parts
        grown_left = grown_right = NEVER
        while True:
            rank = self.rank.get(left << 32 | right, NEVER)
            # At equal rank the pair further left is merged first.
            if rank < grown_left and rank <= grown_right and rank < NEVER:
                return False
            if born[left] > born[right]:
                grown_left, left = born[left], parts[left][1]
            elif right in parts:
                grown_right, right = born[right], parts[right][0]
            else:
                return True

    def spelled(self) -> Iterator[tuple[tuple[int, ...], int]]:
        """Every token with its symbols."""
        todo: list[tuple[tuple[int, ...], dict]] = [((), self.tokens)]
        while todo:
            symbols, node = todo.pop()
            for s, below in node.items():
                if s < 0:
                    yield symbols, below
                else:
                    todo.append(((*symbols, s), below))

    def encode_symbols(self, symbols: tuple[int, ...]) -> list[int]:
        """Plain BPE: the pair of lowest rank is merged, again and again."""
        row = [self.single[s] for s in symbols]
        while len(row) > 1:
            rank, at = min((self.rank.get(row[i] << 32 | row[i + 1], NEVER), i) for i in range(len(row) - 1))
            if rank == NEVER:
                break
            row[at : at + 2] = [self.made[rank]]
        return row

    def encode(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Packed token ids of every distinct word.

        Words that share a prefix are neighbours in order, so a part of that order at a
        time shares nearly as much as all of it, and its trie stays small.
        """
        ordered, found = sorted(words), {}
        for at in range(0, len(ordered), TRIE_WORDS):
            found.update(self._walked(ordered[at : at + TRIE_WORDS]))
        return found

    def _walked(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Encodings from one walk over the trie of sorted words.

        A node carries the tokens that could still end below it: where each starts and
        how far it has been followed in the trie of all tokens.
        """
        root: dict = {}
        for word in words:  # neighbours in the trie are neighbours in memory
            node = root
            for s in word[:-1]:
                node = node.setdefault(s, {})
            node.setdefault(256 + word[-1], {})[-1] = word
        found: dict[bytes, bytes] = {}
        tokens, known, follows = self.tokens, self.known, self.follows
        last, start = [0], [0]  # by depth on the current path
        todo = [(0, s, child, []) for s, child in root.items()]
        while todo:
            depth, symbol, node, open_tokens = todo.pop()
            ending, first, still_open = -1, 0, []
            ends_word = symbol > 255
            for begin, seen in (*open_tokens, (depth, tokens)):
                further = seen.get(symbol)
                if further is None:
                    continue
                if not ends_word:
                    still_open.append((begin, further))
                    if ending >= 0:
                        continue
                token = further.get(-1)
                if token is None:
                    continue
                if begin:
                    pair = last[begin] << 32 | token
                    fits = known.get(pair)
                    if fits is None:
                        if len(known) > KNOWN_PAIRS:
                            known.clear()
                        fits = known[pair] = follows(last[begin], token)
                    if not fits:
                        continue
                ending, first = token, begin
                if ends_word:
                    break
            if ends_word:
                ids, at = [ending], first
                while at:
                    ids.append(last[at])
                    at = start[at]
                found[node[-1]] = struct.pack(f"<{len(ids)}I", *ids[::-1])
                continue
            depth += 1
            if depth == len(last):
                last.append(ending)
                start.append(first)
            else:
                last[depth], start[depth] = ending, first
            for s, child in node.items():
                todo.append((depth, s, child, still_open))
        return found


class Merges:
    """The same encodings by a compiled merge loop, for words without the byte `END`.

    The loop merges neighbours whose joined symbols are a token, the lowest rank first.
    That is BPE as long as every token is what BPE makes of its own symbols, which is
    checked. A last symbol is its byte and `END`, merged before everything else.
    """

    END = "\x01"

    def __init__(self, vocabulary: Vocabulary):
        end = self.END.encode()
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + end: 256 + b for b in range(256)}
        ids = np.zeros(512 + len(vocabulary.born), np.uint32)
        self.closes = np.zeros(len(ids), bool)
        for symbols, token in vocabulary.spelled():
            if vocabulary.encode_symbols(symbols) != [token]:
                raise ValueError("a token of this file is not what its symbols merge to")
            spelling = b"".join(bytes([s]) if s < 256 else bytes([s - 256]) + end for s in symbols)
            rank = ranks.setdefault(spelling, 512 + vocabulary.born[token])
            ids[rank], self.closes[rank] = token, symbols[-1] > 255
        self.ids = ids
        self.core = tiktoken.Encoding("words", pat_str=f"[^{self.END}]*{self.END}", mergeable_ranks=ranks, special_tokens={})
        self.fallback = vocabulary
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        plain = [w for w in words if self.END.encode() not in w]
        found = self.fallback.encode({w for w in words if self.END.encode() in w})
        found.update(zip(plain, self._merged([w.decode() for w in plain]), strict=True))
        return found

    def _merged(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        ranks = self.core.encode_to_numpy(self.END.join(words) + self.END, disallowed_special=())
        packed = self.ids[ranks].astype("<u4").tobytes()
        stops = (4 * (np.flatnonzero(self.closes[ranks]) + 1)).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Encodings of whole texts that `PLAIN_TEXT` matches, without special tokens."""
        pieces = [PLAIN_PIECES.findall(t.lower()) for t in texts]
        seen: set[str] = set().union(*pieces)
        new = seen - self.young.keys()
        if len(self.young) + len(new) > CACHED_MERGED:
            self.older, self.young, new = self.young, {}, seen
        again = new & self.older.keys()
        self.young.update((w, self.older[w]) for w in again)
        fresh = list(new - again)
        self.young.update(zip(fresh, self._merged(fresh), strict=True))
        get = self.young.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


class Encoder:
    """Texts in UTF-8 to ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, trie: bool = True):
        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer, library.pre_tokenizer
        self.special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        self.mark = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.vocabulary = Vocabulary(path)
        self.words = self.vocabulary if trie else Merges(self.vocabulary)
        self.most = CACHED_CHUNKS if trie else CACHED_MERGED
        self.chunks: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def pieces(self, chunk: bytes) -> list[bytes | int]:
        """Words in order; special tokens, which are found before normalization, as ids."""
        if chunk.isalpha():  # ASCII letters
            return [chunk.lower()]
        if chunk[:-1].isalpha() and chunk[-1:] in b".,":
            return [chunk[:-1].lower(), chunk[-1:]]
        text = chunk.decode("utf-8", "replace")
        if "<|" not in text and PLAIN.fullmatch(text):
            return [word.encode() for word in PLAIN_PIECES.findall(text.lower())]
        found: list[bytes | int] = []
        letters = self.vocabulary.letters
        for part in self.mark.split(text):
            if part in self.special:
                found.append(self.special[part])
            elif part:
                cut = self.split.pre_tokenize_str(self.normal.normalize_str(part))
                found.extend(b"".join(map(letters.__getitem__, word)) for word, _ in cut)
        return found

    def learn(self, chunks: set[bytes]) -> None:
        """Encode chunks that are in neither generation of the cache.

        A word is a chunk, too: what words encode to is kept with the chunks.
        """
        cut = {c: self.pieces(c) for c in chunks}
        words = {p for parts in cut.values() for p in parts if not isinstance(p, int)}
        words -= self.chunks.keys()
        known = self.chunks
        for word in words & self.older.keys():
            known[word] = self.older[word]
        known.update(self.words.encode(words - known.keys()))
        for c, parts in cut.items():
            if c not in known:
                known[c] = b"".join([struct.pack("<I", p) if isinstance(p, int) else known[p] for p in parts])

    def forget(self) -> None:
        """Drop the cached chunks: a worker that waits for its next task is in its executor's memory."""
        self.chunks, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def batch(self, texts: list[bytes]) -> list[bytes]:
        if isinstance(self.words, Vocabulary):
            return self.by_chunks(texts)
        done: list[bytes] = []
        for group in grouped(texts):
            plain = {i: t.decode() for i, t in enumerate(group) if b"<|" not in t and utf8(t)}
            plain = {i: t for i, t in plain.items() if PLAIN_TEXT.fullmatch(t)}
            found = dict(zip(plain, self.words.texts(list(plain.values())), strict=True))
            rest = [i for i in range(len(group)) if i not in plain]
            found.update(zip(rest, self.by_chunks([group[i] for i in rest]), strict=True))
            done.extend(found[i] for i in range(len(group)))
        return done

    def by_chunks(self, texts: list[bytes]) -> list[bytes]:
        done: list[bytes] = []
        for group in grouped(texts):
            seen: set[bytes] = set()
            for text in group:
                seen.update(text.split())
            seen -= self.chunks.keys()
            if len(self.chunks) + len(seen) > self.most:
                self.older, self.chunks = self.chunks, {}
                seen = {c for text in group for c in text.split()}
            again = seen & self.older.keys()
            self.chunks.update((c, self.older[c]) for c in again)
            if seen := seen - again:
                with uncollected():
                    self.learn(seen)
            get = self.chunks.__getitem__
            done.extend(b"".join(map(get, text.split())) for text in group)
        return done


def utf8(text: bytes) -> bool:
    try:
        text.decode()
    except UnicodeDecodeError:
        return False
    return True


@contextmanager
def uncollected():
    """The trie is many small objects without cycles: searching them for cycles is half the work."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def grouped(texts: list[bytes]) -> Iterator[list[bytes]]:
    group: list[bytes] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


_loaded: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, trie: bool = True) -> Encoder:
    """One per tokenizer file and worker process."""
    if (path, trie) not in _loaded:
        _loaded[path, trie] = Encoder(path, trie)
    return _loaded[path, trie]


def id_limit(path: str) -> int:
    """All ids of a file are below this."""
    return Tokenizer.from_file(path).get_vocab_size()


def encoding(path: str, trie: bool = True) -> Callable[[Column], Column]:
    """Column of texts → column of packed ids (empty for null and empty texts)."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(encoder(path, trie).batch([t or b"" for t in texts.to_pylist()]), pa.binary())

    udf = F.arrow_udf(run, "binary")
    return lambda text: udf(text_of(text).cast("binary"))


def decoding(path: str) -> Callable[[Column], Column]:
    """Column of packed ids → the texts that the file's tokens spell.

    The file names no decoder, so tokens are joined by one space. An unknown id spells
    nothing, as in the library.
    """

    def run(ids: pa.Array) -> pa.Array:
        return pa.array(decoded([v or b"" for v in ids.to_pylist()], path), pa.binary())

    udf = F.arrow_udf(run, "binary")
    return lambda ids: udf(ids).cast("string")


_named: dict[str, list[bytes]] = {}


def _names(path: str) -> list[bytes]:
    if path not in _named:
        library = Tokenizer.from_file(path)
        if library.decoder is not None:
            raise ValueError("only tokenizer files without a decoder are supported")
        _named[path] = [(library.id_to_token(i) or "").encode() for i in range(library.get_vocab_size())]
    return _named[path]


def decoded(ids: list[bytes], path: str) -> list[bytes]:
    get = _names(path).__getitem__
    return [b" ".join(map(get, memoryview(v).cast("I"))) for v in ids]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """`docs` with `ids` (packed), `n_tokens` and `decoded` in place of `text`.

    Null and empty texts have no ids and decode to the empty text. Repeated rows stay
    repeated, an empty table gives no rows. Long texts are handled whole, in groups of
    some megabytes. Columns that already have one of the new names are replaced.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                ids = encoder(path).batch([t or b"" for t in texts.to_pylist()])
                columns = [pa.array(v, pa.binary()) for v in (ids, decoded(ids, path))]
                yield pa.StructArray.from_arrays(columns, names=["ids", "decoded"])
        finally:
            encoder(path).forget()

    # One function for both ways, so that a task keeps one vocabulary cache.
    both = F.arrow_udf(run, "struct<ids: binary, decoded: binary>")
    taken = {"text", "ids", "n_tokens", "decoded"}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    found = docs.select(*kept, both(text_of(F.col("text")).cast("binary")).alias("both"))
    count = F.floor(F.octet_length("both.ids") / 4).cast("bigint")
    return found.select(*kept, "both.ids", count.alias("n_tokens"), F.col("both.decoded").cast("string").alias("decoded"))
