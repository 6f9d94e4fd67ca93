"""Byte-level BPE encoding and decoding by traversal of a trie of words.

The encoding of a word is fixed, for every prefix of it, by one token: the
last token of the prefix's own encoding. Token t ends the encoding of a prefix
if its bytes end the prefix and the pair (last token of what precedes, t) is
stable, i.e. encoding the two together gives just these two. So the distinct
words of a stretch of text are put in order, which is the depth-first order of
their trie; the walk keeps the last token of every node on the path, and a
shared prefix is worked out once. A word's ids follow the last tokens back.

Words are what the tokenizer file's byte-level pattern splits off; strings of
added tokens in a text become their ids first, as the tokenizers library does
by default. Decoding joins the tokens' bytes and replaces invalid UTF-8.

Defined cases: a null text counts as empty (0 tokens); a long text is encoded
by stretches and a long word keeps two numbers a byte until its ids are read
back, so both cost time and memory in proportion; further columns pass through
untouched. A tokenizer file that asks for other steps is refused.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import slices

#: Fixed value: the byte-level pattern of public GPT-2-like tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space and what follows it: no word of PATTERN crosses such a chunk's edges (the classes leave out what only Python calls white space).
CHUNK = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
#: Chunks that surely are one word, or one and its punctuation.
PLAIN = re.compile(r"( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02AF]+)([.,;:!?]+)?")
#: Bytes of text whose words are put into one trie; words whose ids, and token pairs whose fit, are kept between tries.
TRIE_BYTES, CACHED_WORDS, CACHED_PAIRS = 2 << 20, 200_000, 400_000
#: Chunks of one text that are encoded at once, and bytes of the longest word that is kept between tries.
STRETCH, LONGEST_CACHED = 1 << 17, 64


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def supported(spec: dict) -> None:
    """Raise where the file asks for steps that ``ByteBpe`` doesn't take."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    asked = {
        "normalizer": spec.get("normalizer"),
        "pre-tokenizer": before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True),
        "decoder": (spec.get("decoder") or {}).get("type") != "ByteLevel",
        "flags of added tokens": any(t.get(f) for t in spec.get("added_tokens", []) for f in ("single_word", "lstrip", "rstrip", "normalized")),
        "kind of model": model.get("type", "BPE") != "BPE",
        **{f: model.get(f) for f in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")},
    }
    if odd := [name for name, is_asked in asked.items() if is_asked]:
        raise ValueError(f"the tokenizer file asks for what byte-level BPE here doesn't do: {', '.join(odd)}")


class ByteBpe:
    """Vocabulary and merges of a byte-level ``tokenizers`` file."""

    def __init__(self, spec: str) -> None:
        spec = json.loads(spec)
        supported(spec)
        model, symbol = spec["model"], byte_symbols()
        raw = lambda s: bytes(symbol[c] for c in s)
        self.ids = {raw(s): k for s, k in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): r for r, (a, b) in enumerate(pairs)}
        # By ids: rank of a merge, and how each token is merged from two.
        self.pair_rank = {self.ids[a] << 20 | self.ids[b]: r for (a, b), r in self.rank.items()}
        self.made = {self.ids[a + b]: (self.ids[a], self.ids[b], r) for (a, b), r in reversed(self.rank.items())}
        self.rising = all(r > max(self.made[x][2] if x in self.made else -1 for x in (self.ids[a], self.ids[b])) for (a, b), r in self.rank.items())
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = {k: b for b, k in self.ids.items()} | {k: s.encode() for s, k in self.added.items()}
        self.tails = {t[-k:] for t in self.ids for k in range(1, len(t) + 1)}
        self.split = regex.compile(PATTERN)
        self.at_added = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.stable: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.packed = {k: k.to_bytes(4, "little") for k in self.bytes}
        self.fixed = {s: np.array([k], "<u4").tobytes() for s, k in self.added.items()}
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def merged(self, word: bytes) -> list[bytes]:
        """The plain rule: merge the leftmost pair of lowest rank until none is left."""
        parts = [word[k : k + 1] for k in range(len(word))]
        while len(parts) > 1:
            best = min(((self.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(parts, parts[1:], strict=False))), default=(1 << 60, 0))
            if best[0] == 1 << 60:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts that stand at an edge of a token while it is merged, first to last, each with the rank that ends it."""
        out, ends = [], 1 << 60
        while True:
            out.append((token, ends))
            if token not in self.made:
                return out[::-1]
            *halves, ends = self.made[token]
            token = halves[side]

    def apart(self, before: int, token: int) -> bool:
        """Whether no merge crosses the seam of two tokens that each encode to themselves.

        Merges happen by rising rank, of equal ranks from the left, so the two
        parts at the seam meet until the rank at which either is merged away.
        """
        key = self.edges.get
        left = key((before, 1)) or self.edges.setdefault((before, 1), self.spine(before, 1))
        right = key((token, 0)) or self.edges.setdefault((token, 0), self.spine(token, 0))
        a = b = 0
        while True:
            (x, x_ends), (y, y_ends) = left[a], right[b]
            rank = self.pair_rank.get(x << 20 | y, 1 << 60)
            if rank < x_ends and rank <= y_ends and rank < 1 << 60:
                return False
            if x_ends <= y_ends:
                a += 1
            else:
                b += 1
            if a == len(left) or b == len(right):
                return True

    def fits(self, before: int, token: int) -> bool:
        """Whether the two stay apart when encoded together; before -1: the token stands first."""
        known = self.stable.get(before << 20 | token)
        if known is None:
            if before < 0:
                known = len(self.merged(self.bytes[token])) == 1
            elif not self.rising:
                known = self.merged(self.bytes[before] + self.bytes[token]) == [self.bytes[before], self.bytes[token]]
            else:
                known = self.fits(-1, token) and self.apart(before, token)
            if len(self.stable) > CACHED_PAIRS:
                self.stable.clear()
                self.edges.clear()
            self.stable[before << 20 | token] = known
        return known

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids (little-endian unsigned 32-bit) of distinct words, by depth-first walk of their trie."""
        ids, tails, fits, stable, out = self.ids, self.tails, self.fits, self.stable, {}
        # Of each prefix on the path, shortest first: its last token and that token's bytes.
        path: list[int] = []
        sizes: list[int] = []
        previous = b""
        for word in sorted(words):
            shared, most = 0, min(len(previous), len(word))
            while shared < most and previous[shared] == word[shared]:
                shared += 1
            del path[shared:], sizes[shared:]
            for end in range(shared + 1, len(word) + 1):
                # Exactly one token fits. Mostly it is the last one and a byte more.
                size = sizes[-1] + 1 if path else 1
                token = ids.get(word[end - size : end])
                before = path[end - size - 1] if size < end else -1
                if token is None or not (stable.get(before << 20 | token) or fits(before, token)):
                    size = 1
                    while size < end and word[end - size - 1 : end] in tails:
                        size += 1
                    while size:
                        token = ids.get(word[end - size : end])
                        if token is not None:
                            before = path[end - size - 1] if size < end else -1
                            if fits(before, token):
                                break
                        size -= 1
                    if not size:
                        raise ValueError(f"the vocabulary cannot encode {word[:64]!r}")
                path.append(token)
                sizes.append(size)
            out[word] = self.read_back(path, sizes)
            previous = word
        return out

    def read_back(self, path: list[int], sizes: list[int]) -> bytes:
        """The ids of a whole path: its last token, the last token of what precedes that one, and so on."""
        end, found, packed = len(path), [], self.packed
        while end:
            found.append(packed[path[end - 1]])
            end -= sizes[end - 1]
        found.reverse()
        return b"".join(found)

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of new chunks, whose distinct new words share one trie. Short ones are kept; the long ones are returned."""
        if len(self.chunks) > CACHED_WORDS:
            self.chunks.clear()
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        plain: dict[bytes, str] = {}
        mixed: dict[str, list[bytes]] = {}
        for chunk in chunks:
            if (m := PLAIN.fullmatch(chunk)) is None:
                mixed[chunk] = [w.encode() for w in self.split.findall(chunk)]
            elif m[2]:
                mixed[chunk] = [m[1].encode(), m[2].encode()]
            else:
                plain[chunk.encode()] = chunk
        words = {w for parts in mixed.values() for w in parts}
        words.update(plain)
        known = self.words
        found = self.encode_words(words.difference(known))
        known.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST_CACHED)
        long = {}
        for word, chunk in plain.items():
            (self.chunks if len(word) <= LONGEST_CACHED else long)[chunk] = found.get(word) or known[word]
        for chunk, parts in mixed.items():
            (self.chunks if len(chunk) <= LONGEST_CACHED else long)[chunk] = b"".join([found.get(w) or known[w] for w in parts])
        return long

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        parts = [[] if not t else [t] if self.at_added is None or self.at_added.search(t) is None else self.at_added.split(t) for t in texts]
        if sum(len(t) for t in texts if t) > 2 * TRIE_BYTES:
            return [b"".join(self.fixed[p] if k % 2 else self.stretched(p) for k, p in enumerate(ps)) for ps in parts]
        cut = [[[p] if k % 2 else CHUNK.findall(p) for k, p in enumerate(ps)] for ps in parts]
        return self.joined(cut)

    def joined(self, cut: list[list[list[str]]]) -> list[bytes]:
        """Ids of texts that are cut into chunks, every second piece an added token's string."""
        fresh: set[str] = set()
        for pieces in cut:
            for chunks in pieces[::2]:
                fresh.update(chunks)
        if len(self.chunks) <= CACHED_WORDS:
            fresh.difference_update(self.chunks)
        long = self.learn(fresh)
        get = self.chunks.__getitem__ if not long else lambda c: long[c] if c in long else self.chunks[c]
        return [b"".join(self.fixed[c[0]] if k % 2 else b"".join(map(get, c)) for k, c in enumerate(pieces)) for pieces in cut]

    def stretched(self, text: str) -> bytes:
        """Ids of a long text without added tokens, so many chunks at a time."""
        out, chunks = bytearray(), (m[0] for m in CHUNK.finditer(text))
        while some := list(islice(chunks, STRETCH)):
            out += self.joined([[some]])[0]
        return bytes(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _encode(batches: Iterator[pa.RecordBatch], spec) -> Iterator[pa.RecordBatch]:
    bpe = None
    for batch in batches:
        bpe = bpe or ByteBpe(spec.value)
        texts = batch.column(batch.num_columns - 1)
        for at, to in slices(texts, TRIE_BYTES):
            found = bpe.encode(texts.slice(at, to - at).to_pylist())
            sizes = pa.array([len(x) // 4 for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.slice(at, to - at).columns[:-1], pa.array(found, pa.binary()), sizes], names=[*batch.schema.names[:-1], "ids", "n_tokens"])


def _decode(batches: Iterator[pa.RecordBatch], spec) -> Iterator[pa.RecordBatch]:
    bpe = None
    for batch in batches:
        bpe = bpe or ByteBpe(spec.value)
        texts = pa.array((None if x is None else bpe.decode(x) for x in batch.column(batch.num_columns - 1).to_pylist()), pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*batch.schema.names[:-1], "decoded"])


def _digested(batches: Iterator[pa.RecordBatch], spec) -> Iterator[pa.RecordBatch]:
    """Encode, then decode, one text at a time, in the same worker."""
    bpe = None
    for batch in batches:
        bpe = bpe or ByteBpe(spec.value)
        texts = batch.column(1)
        for at, to in slices(texts, TRIE_BYTES):
            ids = bpe.encode(texts.slice(at, to - at).to_pylist())
            decoded = [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids]
            columns = [batch.column(0).slice(at, to - at), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array(decoded, pa.string()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])


def load(path: str) -> str:
    """The tokenizer file, read on the driver (a few MB) and broadcast."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns and ids (little-endian unsigned 32-bit integers) and n_tokens; columns of these names give way."""
    return _mapped(docs, path, text, _encode, {"ids": "binary", "n_tokens": "long"})


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``, the text of the ids (null for null ids)."""
    return _mapped(docs, path, ids, _decode, {"decoded": "string"})


def _mapped(docs: DataFrame, path: str, column: str, what, new: dict[str, str]) -> DataFrame:
    names = [c for c in docs.columns if c not in new]
    out = T.StructType([docs.schema[c] for c in names])
    for name, kind in new.items():
        out = out.add(name, kind)
    spec = docs.sparkSession.sparkContext.broadcast(load(path))
    return docs.select(*names, F.col(column).alias("__in")).mapInArrow(lambda it: what(it, spec), out)


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the text decoded from them; the ids too, if asked for."""
    spec = docs.sparkSession.sparkContext.broadcast(load(path))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"
    coded = docs.select("doc_id", F.col(text).alias("text")).mapInArrow(lambda it: _digested(it, spec), out)
    return coded if ids else coded.drop("ids")
