"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

Encoding.  Every prefix of a piece has one encoding, and its last token is fixed by two tests: the token ends the prefix,
and it may follow the last token of the encoding of what stands before it.  The transducer reads one byte a step.  A state
holds the tokens already fixed (only the last matters) and, for each earlier place from which a token could still reach
the present one, a node of the token trie and the tokens pending up to that place.  Tokens that all live places share are
emitted, which happens after a bounded lookahead, as no place lives longer than the longest token.

Determinisation is lazy: a transition is made when it is first asked for, and kept.  The number of transitions is
bounded: when a generation of states is full it becomes the old one and a new one begins, which takes over from the old
what is still met; what is not goes with it.  A pair of tokens is tested once, by undoing the merges beside their boundary.

Decoding.  An incremental UTF-8 automaton reads the ids' bytes one at a time and keeps the value and the bounds of an
unfinished character between ids and chunks.  Ids whose bytes take it from its start to its start are known beforehand, by
the same automaton, and give their characters at once.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import struct
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import filled, kept_in_worker, lean, slices, table

#: Bounds of one worker's memory: pieces, transitions and pairs remembered in a generation; two generations are kept.
MAX_PIECES = 300_000
MAX_TRANSITIONS = 150_000
MAX_PAIRS = 500_000
#: Pieces and transitions where other operators ran before in the same executor and left it less memory.
TIGHT = (75_000, 50_000)
#: Of so many tasks of a worker, one is followed by a search of all its objects for circles.
SEARCHED = 8


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class State:
    """name: the last token fixed, then of each live place a node and the tokens pending up to it, side by side; next:
    transitions made from here; twin: the state of this name in the old generation."""

    __slots__ = ("name", "next", "twin", "__weakref__")

    def __init__(self, name: tuple, twin: State | None):
        self.name, self.twin = name, twin
        self.next: dict[int, tuple[State, tuple[int, ...]]] = {}


class Transducer:
    """Encodes one piece of bytes at a time by `ranks`."""

    def __init__(self, ranks: dict[bytes, int], most: int = MAX_TRANSITIONS):
        self.ranks, self.most, self.most_pairs = ranks, most, min(MAX_PAIRS, 4 * most)
        self.bytes_of = {v: k for k, v in ranks.items()}
        # a pair's key is first * width + second: with the second alone in its low bits, a table's slots would be those of the second
        self.width = max(ranks.values(), default=0) + 1 | 1
        # the token trie: a node's edges, byte -> (the next node, or 0 where no longer token goes on; the token that ends
        # there, or -1)
        child: list[dict] = [{}]
        token = [-1]
        for k, v in ranks.items():
            node = 0
            for b in k:
                to = child[node].get(b)
                if to is None:
                    to = child[node][b] = len(child)
                    child.append({})
                    token.append(-1)
                node = to
            token[node] = v
        self.edges = [{b: (to if child[to] else 0, token[to]) for b, to in own.items()} for own in child]
        self.proper: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.old: dict[tuple, State] = {}
        self.young: dict[tuple, State] = {}
        self.turn()

    def turn(self) -> None:
        """Begin a generation of states; the one before the old one goes, and its circles are cut, so that counting frees it."""
        for state in self.old.values():
            state.next.clear()
        for state in self.young.values():
            state.twin = None
        self.old, self.young, self.made = self.young, {}, 0
        name = (-1, 0, ())
        self.start = self.young[name] = State(name, self.old.get(name))

    def merge(self, piece: bytes, until: int = 1) -> list[int]:
        """The definition: merge the adjacent pair of the lowest rank, leftmost first, until none or `until` parts are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens that the token's last merge joins."""
        got = self.split.get(token)
        if got is None:
            left, right = self.merge(self.bytes_of[token], 2)
            got = self.split[token] = (left, right)
        return got

    def _follows(self, x: int, y: int) -> bool:
        """Whether x stays x and y stays y when their bytes stand side by side.

        Beside the boundary stand, at each time, a token of x's right spine and one of y's left spine.  Undoing the later
        merge first visits all pairs that ever stand there; a pair whose own merge comes before either side is used up
        (the leftmost first among equal ranks) joins across the boundary.
        """
        used_x = used_y = len(self.bytes_of) + 1_000_000
        bytes_of, ranks, split = self.bytes_of, self.ranks, self.split
        left, right = bytes_of[x], bytes_of[y]
        while True:
            r = ranks.get(left + right)
            if r is not None and r < used_x and r <= used_y:
                return False
            if len(left) > 1 and (len(right) == 1 or x > y):
                used_x, x = x, (split.get(x) or self._halves(x))[1]
                left = bytes_of[x]
            elif len(right) > 1:
                used_y, y = y, (split.get(y) or self._halves(y))[0]
                right = bytes_of[y]
            else:
                return True

    def _allowed(self, before: int, token: int) -> bool:
        if token not in self.proper:
            self.proper[token] = self.merge(self.bytes_of[token]) == [token]
        if not self.proper[token]:
            return False
        if before < 0:
            return True
        key = before * self.width + token
        if key not in self.pairs:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            self.pairs[key] = self._follows(before, token)
        return self.pairs[key]

    def _step(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        """A transition: taken over from the old generation, or made."""
        if self.made >= self.most:
            self.turn()
        self.made += 1
        if state.twin is not None:
            got = state.twin.next.get(byte)
            if got is not None:
                twin, out = got
                to = self.young.get(twin.name)
                if to is None:
                    to = self.young[twin.name] = State(twin.name, twin)
                got = state.next[byte] = (to, out)
                return got
        edges, pairs, width, name = self.edges, self.pairs, self.width, state.name
        places = iter(name)
        anchor = next(places)
        alive, chain = [anchor], None
        for node, pending in zip(places, places):
            to = edges[node].get(byte)
            if to is not None:
                node, t = to
                if node:
                    alive += node, pending
                if t >= 0 and chain is None:
                    last = pending[-1] if pending else anchor
                    ok = pairs.get(last * width + t)
                    if self._allowed(last, t) if ok is None else ok:
                        chain = (*pending, t)
        if chain is None:
            raise ValueError("the vocabulary lacks a byte")
        alive += 0, chain
        out = alive[2]  # the tokens that all live places share are fixed
        if out:
            for pending in alive[4::2]:
                while pending[: len(out)] != out:
                    out = out[:-1]
            if out:
                n = len(out)
                alive[0] = out[-1]
                alive[2::2] = [pending[n:] for pending in alive[2::2]]
        name = tuple(alive)
        to = self.young.get(name)
        if to is None:
            to = self.young[name] = State(name, self.old.get(name))
        got = state.next[byte] = (to, out)
        return got

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, step = self.start, self._step
        for b in piece:
            got = state.next.get(b)
            state, fixed = step(state, b) if got is None else got
            if fixed:
                out += fixed
        out += state.name[-1]  # the place at the end, where all before it is encoded
        return out


class Pieces(dict):
    """Remembered pieces: packed ids.  A full generation becomes the old one, from which pieces that are met
    again come back, so the memory follows a change of language."""

    def __init__(self, fst: Transducer, most: int):
        super().__init__()
        self.fst, self.most = fst, most
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        got = self.old.get(piece)
        if got is None:
            ids = self.fst.encode(piece.encode())
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = got
        return got


def ascii_form(pattern: str) -> str | None:
    """The pattern for texts of ASCII only, where the classes are short; None if it holds anything else of its kind."""
    out = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\t-\r A-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]").replace(r"(?!\S)", r"(?![^\t-\r ])").replace(r"\s", r"[\t-\r ]")
    return None if "\\p" in out or "\\s" in out or "\\S" in out else out


class TextEncoder:
    """Pieces by a pattern, each encoded by the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = MAX_PIECES, transitions: int = MAX_TRANSITIONS):
        self.fst, self.find = Transducer(ranks, transitions), regex.compile(pattern).findall
        short = ascii_form(pattern)
        self.find_ascii = re.compile(short).findall if short else self.find
        self.known = Pieces(self.fst, most)
        self.tasks = 0
        self.decimal = list(map(str, range(max(ranks.values(), default=-1) + 1)))

    def encode(self, text: str) -> tuple[int, str, np.ndarray]:
        """(number of ids, decimal ids joined by spaces, ids)."""
        got = list(map(self.known.__getitem__, (self.find_ascii if text.isascii() else self.find)(text)))
        ids = np.frombuffer(b"".join(got), "<u4")
        return len(ids), " ".join(map(self.decimal.__getitem__, ids.tolist())), ids


class Utf8Stream:
    """Incremental UTF-8 automaton: feed() gives the characters that a chunk of bytes finishes, close() checks the end.

    State: continuation bytes still to come, the bounds of the next one (which exclude overlong forms, surrogates and values
    beyond U+10FFFF), and the value so far.
    """

    __slots__ = ("need", "low", "high", "value")

    def __init__(self) -> None:
        self.need, self.low, self.high, self.value = 0, 0x80, 0xBF, 0

    def feed(self, chunk: bytes) -> str:
        if not self.need and chunk.isascii():
            return str(chunk, "ascii")
        need, low, high, value, out = self.need, self.low, self.high, self.value, []
        for b in chunk:
            if need:
                if not low <= b <= high:
                    raise ValueError("a character is broken")
                value, need, low, high = value << 6 | b & 0x3F, need - 1, 0x80, 0xBF
                if not need:
                    out.append(value)
            elif b < 0x80:
                out.append(b)
            elif 0xC2 <= b < 0xE0:
                need, value = 1, b & 0x1F
            elif 0xE0 <= b < 0xF0:
                need, value, low, high = 2, b & 0x0F, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
            elif 0xF0 <= b < 0xF5:
                need, value, low, high = 3, b & 0x07, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
            else:
                raise ValueError("no character begins so")
        self.need, self.low, self.high, self.value = need, low, high, value
        return "".join(map(chr, out))

    def close(self) -> None:
        if self.need:
            raise ValueError("the text ends within a character")


class Vocabulary:
    """Bytes of each id, and the characters of those ids that leave the automaton where they found it, at its start."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.data, self.whole = [b""] * size, [None] * size
        self.broken = np.ones(size, bool)  # not whole
        for data, i in ranks.items():
            self.data[i] = data
            stream = Utf8Stream()
            try:
                text = stream.feed(data)
            except ValueError:
                continue
            if not stream.need:
                self.whole[i], self.broken[i] = text, False


def decode(ids, vocabulary: Vocabulary, chunk: int = 8192):
    """The decoded text in parts, as ids stream in."""
    stream = Utf8Stream()
    whole, data, feed = vocabulary.whole, vocabulary.data, stream.feed
    for i in range(0, len(ids), chunk):
        part = ids[i : i + chunk]
        if not stream.need:
            try:
                text = "".join(map(whole.__getitem__, part))
            except TypeError:  # an id that begins or ends within a character
                text = None
        if stream.need or text is None:
            text = "".join([whole[t] if not stream.need and whole[t] is not None else feed(data[t]) for t in part])
        yield text
    stream.close()


def decode_bytes(ids: np.ndarray, vocabulary: Vocabulary, chunk: int = 8192):
    """The bytes of the decoded characters in parts: the same automaton, for those who need no text."""
    stream, data = Utf8Stream(), vocabulary.data
    for i in range(0, len(ids), chunk):
        part = ids[i : i + chunk]
        known = part.tolist()
        if stream.need or vocabulary.broken[part].any():
            yield "".join([vocabulary.whole[t] if not stream.need and vocabulary.whole[t] is not None else stream.feed(data[t]) for t in known]).encode()
        else:
            yield b"".join(map(data.__getitem__, known))
    stream.close()


@contextmanager
def unsearched(encoder: TextEncoder):
    """While it encodes and after it, the collector leaves alone what the encoder keeps.

    Its tables are a million objects, and their circles are cut by hand when a generation goes, but a search for circles at
    each task's end walks through all of them.  So they are frozen; at every eighth task all are searched once, so that
    circles that something else left in the worker go too.
    """
    gc.disable()
    try:
        yield
    finally:
        encoder.tasks += 1
        if encoder.tasks % SEARCHED:
            gc.freeze()
        else:
            gc.unfreeze()
        gc.enable()


def build(path: str, pattern: str, tight: bool = False) -> tuple[TextEncoder, Vocabulary]:
    ranks = load_ranks(path)
    return TextEncoder(ranks, pattern, *(TIGHT if tight else ())), Vocabulary(ranks)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False, tight: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids array<int>) of every whole text.

    tight: remember less, which takes more time and gives the same ids.

    Cases: a null text counts as empty; an empty text has no ids, and both digests are those of no bytes; repeated rows
    are encoded alike; a very long text is encoded in one pass with state bounded by the vocabulary; an empty table gives
    an empty table; other columns are not touched.
    """
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches):
        enc, vocabulary = kept_in_worker(("bpe", path, pattern, tight), lambda: build(path, pattern, tight))
        with unsearched(enc):
            yield from encoded(batches, enc, vocabulary)

    def encoded(batches, enc, vocabulary):
        for batch in batches:
            texts = filled(batch, "text")
            for lo, hi in slices(texts, 2 << 20):
                n, dig, dec, got = [], [], [], []
                for text in texts.slice(lo, hi - lo):
                    count, joined, packed = enc.encode(text.as_py())
                    back = hashlib.sha256()
                    for part in decode_bytes(packed, vocabulary):
                        back.update(part)
                    n.append(count)
                    dig.append(hashlib.sha256(joined.encode()).hexdigest())
                    dec.append(back.hexdigest())
                    if ids:
                        got.append(packed)
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(dig, pa.string()), pa.array(dec, pa.string())]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate(got).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(cols)])

    return narrow.mapInArrow(lean(run, keeps=True), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.PATTERN)
