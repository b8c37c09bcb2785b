"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can end the
prefix's encoding. Storing that token for each prefix makes appending exact (the
table only grows), makes truncation free (the table is cut) and lets an edit
re-encode only the piece around it. A token t may end a prefix when the prefix
without t ends in a token s and BPE would never merge across the s|t border.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_rows, table

NO_LIMIT = 1 << 62
MOST_BORDERS = 300_000  # that one table of a piece remembers
PAIR_BITS = 19  # slots of an encoder's table of borders, as a power of two: 4.7 MB
SIDE_BY_SIDE = 64  # bytes; longer pieces get a table of their own


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of base64 token and rank per line (read on the driver)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class Vocabulary:
    """Tokens, the pair each token is merged from, and which tokens BPE can reach at all."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        self.longest = max(map(len, self.rank), default=1)
        #: A token of one byte is split into itself; None: BPE never makes this token.
        self.split: list[tuple[int, int] | None] = [None] * len(tokens)
        self.merged: dict[tuple[int, int], int] = {}
        for rank, token in enumerate(tokens):
            if len(token) == 1:
                self.split[rank] = (rank, rank)
        for rank, token in enumerate(tokens):
            if len(token) < 2:
                continue
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut], NO_LIMIT), self.rank.get(token[cut:], NO_LIMIT)
                if a < rank and b < rank and self.split[a] and self.split[b] and self._border_holds(a, b):
                    self.split[rank] = (a, b)
                    self.merged[a, b] = rank
                    break

    def _border_holds(self, a: int, b: int) -> bool:
        """Whether BPE keeps a border between tokens a and b.

        Undo the later of the two tokens' merges step by step. At each step the tokens that touch the border existed
        side by side; had they a merge that comes before the one just undone, BPE would have crossed the border.
        """
        merged, split, before = self.merged, self.split, NO_LIMIT
        while True:
            if merged.get((a, b), before) < before:
                return False
            left, right = split[a], split[b]
            # merges happen in rank order and, for equal ranks, from the left
            if a > b:
                if left[0] == left[1] == a and len(self.tokens[a]) == 1:
                    if len(self.tokens[b]) == 1:
                        return True
                    before, b = b + 1, right[0]
                else:
                    before, a = a, left[1]
            elif len(self.tokens[b]) > 1:
                before, b = b + 1, right[0]
            elif len(self.tokens[a]) > 1:
                before, a = a, left[1]
            else:
                return True


class PrefixEncoder:
    """The growing table of one piece: last[i] is the token that ends the encoding of the first i + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, borders: dict[int, bool] | None = None):
        self.v, self.data, self.last = vocabulary, bytearray(), []
        self.borders = borders if borders is not None else {}

    def append(self, data: bytes) -> PrefixEncoder:
        v, last, rank, split, borders = self.v, self.last, self.v.rank, self.v.split, self.borders
        start = len(self.data)
        self.data += data
        base = max(0, start - v.longest)  # no token reaches further back
        near = bytes(memoryview(self.data)[base:])
        for end in range(start + 1, len(self.data) + 1):
            for begin in range(max(0, end - v.longest), end):
                t = rank.get(near[begin - base : end - base])
                if t is None or split[t] is None:
                    continue
                if begin == 0:
                    last.append(t)
                    break
                s = last[begin - 1]
                key = s << 32 | t
                ok = borders.get(key)
                if ok is None:
                    if len(borders) > MOST_BORDERS:
                        borders.clear()
                    ok = borders[key] = v._border_holds(s, t)
                if ok:
                    last.append(t)
                    break
            else:
                raise ValueError(f"no token for byte {near[end - base - 1]}")
        return self

    def truncate(self, n: int) -> PrefixEncoder:
        del self.data[n:]
        del self.last[n:]
        return self

    def ids(self) -> list[int]:
        out, at = [], len(self.last)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.v.tokens[out[-1]])
        return out[::-1]


class TokenTable:
    """Token of a byte string, looked up for whole arrays: an open hash table over 64-bit keys of the strings.

    A string of up to 8 bytes is its own key; keys of longer ones are hashes, so what is found that way is compared
    with the strings themselves by the caller.
    """

    def __init__(self, vocabulary: Vocabulary):
        by_length: dict[int, list[int]] = {}
        for t, token in enumerate(vocabulary.tokens):
            if token and vocabulary.split[t]:
                by_length.setdefault(len(token), []).append(t)
        self.lengths = sorted(by_length)
        self.bits = max(4, int(np.log2(len(vocabulary.tokens) + 1)) + 3)
        self.keys, self.tokens = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        for n, own in by_length.items():
            flat = np.frombuffer(b"".join(vocabulary.tokens[t] for t in own), np.uint8)
            keys = self._salted(next(window_keys(flat, [n]))[1][::n], n)
            for key, at, t in zip(keys.tolist(), self._slots(keys).tolist(), own, strict=True):
                while self.tokens[at] >= 0:
                    at = (at + 1) & (len(self.tokens) - 1)
                self.keys[at], self.tokens[at] = key, t

    def _salted(self, keys: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)

    def _slots(self, salted: np.ndarray) -> np.ndarray:
        return (salted >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray, n: int) -> np.ndarray:
        """For keys of strings of n bytes the token, or -1."""
        keys = self._salted(keys, n)
        at = self._slots(keys)
        out = np.where(self.keys[at] == keys, self.tokens[at], -1)
        left = np.flatnonzero((out < 0) & (self.tokens[at] >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.tokens) - 1)
            own = at[left]
            hit = self.keys[own] == keys[left]
            out[left[hit]] = self.tokens[own[hit]]
            left = left[~hit & (self.tokens[own] >= 0)]
        return out


def window_keys(flat: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the lengths the 64-bit keys of all windows of so many bytes."""
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(flat) + 1, "<u8", padded.tobytes(), 0, (1,)).astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in lengths:
            m = len(flat) - n + 1
            if m <= 0:
                return
            if n <= 8:
                yield n, eight[:m] & np.uint64((1 << 8 * n) - 1)
            else:
                key = eight[:m].copy()
                for at in [*range(8, n - 8, 8), n - 8]:
                    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F) + eight[at : at + m]
                yield n, key


class Encoder:
    """Encodes texts, each match of the pattern separately; keeps a bounded store of the words seen.

    The store has two generations of at most `words` words and `store_bytes` bytes together: when the younger one is
    full it becomes the older one, and words found there are taken back, so words in use stay.
    """

    def __init__(self, vocabulary: Vocabulary, words: int = 200_000, store_bytes: int = 32_000_000):
        self.v, self.words, self.store_bytes = vocabulary, words, store_bytes
        self.find = regex.compile(vocabulary.pattern).findall
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        #: Borders already judged: a table of (pair, whether it holds) by a hash of the pair; newer pairs replace older ones.
        self.pairs, self.holds = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        self.table = TokenTable(vocabulary)
        self.lengths = np.array(list(map(len, vocabulary.tokens)), np.int64)
        self.unreached = [t for i, t in enumerate(vocabulary.tokens) if t and not vocabulary.split[i]]
        self.stops = {c: pack([vocabulary.rank[c.encode()]]) for c in ",."}

    def piece(self, data: bytes) -> list[int]:
        return np.frombuffer(self._piece(data), dtype="<u4").tolist() if data else []

    def _borders_hold(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        key = s.astype(np.int64) << 32 | t
        with np.errstate(over="ignore"):
            at = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        known = self.pairs[at] == key
        ok = self.holds[at]
        if not known.all():
            new, back = np.unique(key[~known], return_inverse=True)
            judged = np.fromiter((self.v._border_holds(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()), bool, len(new))[back]
            ok[~known] = judged
            self.pairs[at[~known]], self.holds[at[~known]] = key[~known], judged
            # where two new pairs share a slot, both arrays end with the last one written
        return ok

    def pieces(self, many: list[bytes]) -> list[bytes]:
        """Packed ids of many pieces that aren't empty."""
        sizes = np.fromiter(map(len, many), np.int64, len(many))
        return self._packed(b"".join(many), np.cumsum(sizes) - sizes, sizes) if many else []

    def _packed(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Packed ids of the pieces of data that begin at starts: their prefix tables are filled side by side."""
        order = np.argsort(-sizes, kind="stable")
        order = order[np.count_nonzero(sizes > SIDE_BY_SIDE) :]
        out = [b""] * len(sizes)
        if len(order):
            token, counts = self._side_by_side(np.frombuffer(data, np.uint8), starts[order], sizes[order])
            packed, ends = token.astype("<u4").tobytes(), np.cumsum(counts) * 4
            for k, at, end in zip(order.tolist(), (ends - counts * 4).tolist(), ends.tolist(), strict=True):
                out[k] = packed[at:end]
        for k in np.flatnonzero(sizes > SIDE_BY_SIDE).tolist():
            out[k] = pack(PrefixEncoder(self.v).append(data[starts[k] : starts[k] + sizes[k]]).ids())
        return out

    def _side_by_side(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each piece) of pieces, the longest first: one place of all pieces after the other."""
        alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")  # pieces of at least so many bytes
        room = np.zeros(len(flat), np.int64)  # bytes to the end of the piece
        index = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        room[index] = np.repeat(starts + sizes, sizes) - index
        lengths = [n for n in self.table.lengths if n <= sizes[0]]
        tokens = {}
        for n, keys in window_keys(flat, lengths):
            inside = np.flatnonzero(room[: len(keys)] >= n)
            tokens[n] = np.full(len(flat), -1, np.int32)
            tokens[n][inside] = self.table.find(keys[inside], n)
        last = np.full(len(flat), -1, np.int32)
        for size in range(1, int(sizes[0]) + 1):
            ends = starts[: alive[size - 1]] + size - 1
            for n in reversed(lengths):
                if n > size:
                    continue
                at = ends - (n - 1)
                t = tokens[n][at]
                own = np.flatnonzero(t >= 0)
                if not len(own):
                    continue
                if n < size:
                    own = own[self._borders_hold(last[at[own] - 1], t[own])]
                if len(own):
                    last[ends[own]] = t[own]
                    rest = np.ones(len(ends), bool)
                    rest[own] = False
                    ends = ends[rest]
                    if not len(ends):
                        break
            if len(ends):
                raise ValueError(f"the vocabulary has no token for byte {flat[ends[0]]}")
        # back from each piece's end, all pieces together
        place, left, ids, owners = starts + sizes - 1, np.arange(len(sizes)), [], []
        while len(left):
            t = last[place]
            ids.append(t)
            owners.append(left)
            place = place - self.lengths[t]
            more = place >= starts[left]
            place, left = place[more], left[more]
        owner = np.concatenate(owners)
        token = np.concatenate(ids)[np.lexsort((-np.arange(len(owner)), owner))]
        counts = np.bincount(owner, minlength=len(sizes))
        if b"".join(map(self.v.tokens.__getitem__, token.tolist())) != flat[index].tobytes():  # two strings of one key: not seen yet
            each = [PrefixEncoder(self.v).append(flat[a : a + n].tobytes()).ids() for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
            token, counts = np.array([i for x in each for i in x]), np.array(list(map(len, each)))
        return token, counts

    def _run(self, text: str) -> bytes:
        return b"".join([self._piece(m.encode("utf-8", "surrogatepass")) for m in self.find(text)])

    def _piece(self, data: bytes) -> bytes:
        """A piece that is itself a token is that token, whether or not merges lead to it."""
        whole = self.v.rank.get(data)
        return pack([whole]) if whole is not None else self.pieces([data])[0]

    def _store(self, keys: list[str], ids: list[bytes]) -> None:
        self.seen.update(zip(keys, ids, strict=True))
        self.held += sum(map(len, keys)) + sum(map(len, ids))

    def _learn(self, keys: list[str]) -> None:
        """Encodes words that stand alone and stores them. A key is a word that a blank leads, or a blank and one that none leads.

        Words of letters are one piece, those that a full stop or comma ends are two; the pattern cuts up others.
        """
        rank, seen, other = self.v.rank, self.seen, []
        stopped = [k for k in keys if k[-1] in ",." and k[:-1].isalpha()]
        plain = [k for k in keys if k.isalpha()] + [k for k in {k[:-1] for k in stopped}.difference(seen)]
        plain = list(dict.fromkeys(plain))
        if plain:
            data = (" " + " ".join(plain)).encode()
            starts = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
            ids = self._packed(data, starts, np.diff(starts, append=len(data)))
            self._store(plain, ids)
            for token in self.unreached:  # a piece that is a token is that token
                if token[:1] == b" " and (k := token[1:].decode("utf-8", "replace")) in seen:
                    seen[k] = pack([rank[token]])
        self._store(stopped, [seen[k[:-1]] + self.stops[k[-1]] for k in stopped])
        other = [k for k in keys if not k.isalpha() and not (k[-1] in ",." and k[:-1].isalpha())]
        parts = [[m.encode("utf-8", "surrogatepass") for m in self.find(k[1:] if k[0] == " " else " " + k)] for k in other]
        new = list({p for found in parts for p in found if p not in rank})
        ids_of = dict(zip(new, self.pieces(new), strict=True))
        self._store(other, [b"".join([ids_of[p] if p in ids_of else pack([rank[p]]) for p in found]) for found in parts])

    def packed(self, text: str) -> bytes:
        return self.packed_all([text])[0]

    def packed_all(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian 32-bit integers.

        The pattern never crosses from a non-space to a single blank, so blank-led words that neither start nor end
        in white space stand alone and are looked up; other stretches go through the pattern together.
        """
        was = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and walking the store again and again is a fifth of the work
        try:
            return self._packed_all(texts)
        finally:
            if was:
                gc.enable()

    def _packed_all(self, texts: list[str]) -> list[bytes]:
        split, words_of_all = [], set()
        for text in texts:
            words = text.split(" ")
            words[0] = " " + words[0]
            split.append(words)
            words_of_all.update(words)
        if len(self.seen) > self.words // 2 or self.held > self.store_bytes // 2:
            self.seen, self.older, self.held = {}, self.seen, 0
        seen, older, unknown = self.seen, self.older, []
        for w in words_of_all.difference(seen):
            if (ids := older.get(w)) is not None:
                seen[w] = ids
                self.held += len(ids) + len(w)
            elif len(w) <= 200 and (w.isalpha() or w not in ("", " ") and not w[-1].isspace() and not w[w[0] == " " :][0].isspace()):
                unknown.append(w)
        self._learn(unknown)
        out = []
        for words in split:
            got = list(map(seen.get, words))
            out.append(b"".join(self._mixed(words, got) if None in got else got))
        return out

    def _mixed(self, words: list[str], got: list[bytes | None]) -> Iterator[bytes]:
        """A word that isn't stored (a blank one, white space at a border, very long) goes with its neighbours."""
        run = ""
        for k, (word, ids) in enumerate(zip(words, got, strict=True)):
            plain = word[1:] if not k else " " + word
            if ids is None:
                run += plain
            elif run:
                yield self._run(run + plain)
                run = ""
            else:
                yield ids
        if run:
            yield self._run(run)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.tokens.__getitem__, ids))


class EditableEncoding:
    """A text and its ids under edits: only the pattern matches from the edit until the old ones fit again are redone.

    Long matches keep their prefix tables; a match that begins as an old one did goes on from the prefix they share.
    """

    LONG = 32  # bytes

    def __init__(self, encoder: Encoder, text: str):
        self.e, self.text = encoder, text
        self.pattern = regex.compile(encoder.v.pattern)
        self.starts: list[int] = []
        self.pieces: list[list[int]] = []
        self.tables: list[PrefixEncoder | None] = []
        self.bytes_done = 0  # of long matches, by all edits together
        for m in self.pattern.finditer(text):
            self.starts.append(m.start())
            self._encode(m.group(), None, self.pieces, self.tables)

    def _encode(self, match: str, old: PrefixEncoder | None, pieces: list[list[int]], tables: list[PrefixEncoder | None]) -> None:
        data = match.encode("utf-8", "surrogatepass")
        if len(data) < self.LONG:
            pieces.append(self.e.piece(data))
            tables.append(None)
            return
        table = old or PrefixEncoder(self.e.v)
        same = _common(table.data, data)
        pieces.append(table.truncate(same).append(data[same:]).ids())
        tables.append(table)
        self.bytes_done += len(data) - same
        if data in self.e.v.rank:  # a piece that is a token is that token
            pieces[-1] = [self.e.v.rank[data]]

    def replace(self, begin: int, end: int, new: str) -> int:
        """Replaces text[begin:end]; returns the number of pieces encoded anew."""
        shift, text = len(new) - (end - begin), self.text[:begin] + new + self.text[end:]
        low = max(0, int(np.searchsorted(self.starts, begin, "left")) - 2)  # a match looks one character past its end
        at = self.starts[low] if self.starts else 0
        old = {s + shift: k for k, s in enumerate(self.starts) if s > end}
        starts, pieces, tables, high = [], [], [], len(self.starts)
        before = {s: k for k, s in enumerate(self.starts[low:], low) if s <= begin}
        for m in self.pattern.finditer(text, at):
            if m.start() in old:
                high = old[m.start()]
                break
            starts.append(m.start())
            self._encode(m.group(), self.tables[before[m.start()]] if m.start() in before else None, pieces, tables)
        self.starts = self.starts[:low] + starts + [s + shift for s in self.starts[high:]]
        self.pieces = self.pieces[:low] + pieces + self.pieces[high:]
        self.tables = self.tables[:low] + tables + self.tables[high:]
        self.text = text
        return len(pieces)

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p]


def _common(a: bytes | bytearray, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(bytes(a[:n]), np.uint8) != np.frombuffer(b[:n], np.uint8))
    return int(differ[0]) if len(differ) else n


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of docs: id, n_tokens, ids_sha256, decoded_sha256 and, on request, ids.

    Null text counts as empty (no tokens, digests of nothing); ids pass through, null and repeated ones too; other
    columns are ignored. The vocabulary (bounded by its file) goes to the executors once, as a broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.tokens, vocabulary.pattern, vocabulary.split, vocabulary.merged))
    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * with_ids

    def make():
        encoder = _encoder(shared)

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, packed in zip(part.column(0).to_pylist(), encoder.packed_all(texts), strict=True):
                    ids = np.frombuffer(packed, dtype="<u4")
                    decoded = encoder.decode(ids.tolist())
                    yield (doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest(), *([ids.astype(np.int32)] if with_ids else []))

        return rows

    ddl = f"{id_column} long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    schema = pa.schema([(id_column if n == "id" else n, t) for n, t in fields])
    return map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")), make, schema, ddl)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per Python worker and vocabulary: later tasks find its words."""
    value = shared.value
    key = hash((len(value[0]), value[1], value[0][-1]))
    if key not in _ENCODERS:
        v = Vocabulary.__new__(Vocabulary)
        v.tokens, v.pattern, v.split, v.merged = value
        v.rank = {t: i for i, t in enumerate(v.tokens) if t}
        v.longest = max(map(len, v.rank), default=1)
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(v)
    return _ENCODERS[key]


def multi_vocabulary() -> Vocabulary:
    import public_tokenizers as tokenizers

    return Vocabulary(read_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken")), tokenizers.PATTERN)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), multi_vocabulary())
