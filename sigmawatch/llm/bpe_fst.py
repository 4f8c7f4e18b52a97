"""Byte-level BPE as a lazily determinised finite-state transducer.

The transducer reads the bytes of one pre-token (a match of the splitting pattern) from left to
right. Its state is the last token emitted and the bytes read since: everything later output can
depend on. For such a state every prefix of the pending bytes has one correct encoding, found by
the pair rule: a token may follow another exactly if merging their joined bytes gives back these
two tokens. Positions where a token that outlives the pending bytes may begin are the live ones;
as soon as the encodings up to all live positions begin with the same token, that token is
emitted. Tokens have a greatest length, so the lookahead is bounded. States and their transitions
are made when first met and kept up to a bound (beyond it they are made again when needed).
Pre-tokens are kept in two generations: those met again move to the young one, and when that is full
the old one is dropped. A worker keeps all this from task to task and drops it once it is idle.

Decoding streams: ids become bytes, and an incremental UTF-8 decoder holds back the bytes of a
character that is not complete yet.
"""

from __future__ import annotations

import base64
import codecs
import contextlib
import ctypes
import gc
import hashlib
import sys
import threading
import types
from array import array
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, strings

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Transducer states, pair decisions and pre-tokens of a generation that a worker keeps.
MAX_STATES = 200_000
MAX_PAIRS = 200_000
MAX_PIECES = 100_000
#: Seconds without a task after which a worker drops its encoders.
IDLE_SECONDS = 2.0
_NO_TOKEN = -1


def load_ranks(path: str) -> dict[bytes, int]:
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


class _State:
    """Last token, pending bytes, live positions with the encoding before each, known moves."""

    __slots__ = ("last", "pending", "live", "moves", "kept")

    def __init__(self, last: int, pending: bytes, live: list[tuple[int, tuple[int, ...]]]) -> None:
        self.last, self.pending, self.live = last, pending, live
        self.moves: dict[int, tuple[_State, tuple[int, ...]]] = {}
        self.kept = False


class Transducer:
    """Encoder of single pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES) -> None:
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.max_states = max_states
        # Bytes with which some longer token begins: only there a token can still grow.
        self.open = {t[:n] for t in ranks for n in range(1, len(t))}
        self._pairs: dict[int, bool] = {}
        self._parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._edges: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}
        self.states: dict[tuple[int, bytes], _State] = {}
        self.start = self._state(_NO_TOKEN, b"", [(0, ())])

    def _state(self, last: int, pending: bytes, live: list[tuple[int, tuple[int, ...]]]) -> _State:
        key = (last, pending)
        state = self.states.get(key)
        if state is None:
            state = _State(last, pending, live)
            if len(self.states) < self.max_states:
                self.states[key] = state
                state.kept = True
        return state

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge makes ``token`` out of its own bytes; None for a single byte
        and for a token that its own bytes never merge to."""
        if token in self._parts:
            return self._parts[token]
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1),
                       key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        got = self._parts[token] = tuple(parts) if len(parts) == 2 else None
        return got

    def _reachable(self, token: bytes) -> bool:
        return len(token) == 1 or self._halves(token) is not None

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one edge of ``token`` while it is merged, from the byte up, each
        with the rank of the merge that ends it (the token itself stays)."""
        key = (token, side)
        got = self._edges.get(key)
        if got is None:
            got, until, part = [], 1 << 40, token
            while True:
                got.append((part, until))
                halves = self._halves(part)
                if halves is None:
                    break
                until, part = self.ranks[part], halves[side]
            got.reverse()
            self._edges[key] = got
        return got

    def _follows(self, left: int, right: int) -> bool:
        """Whether the bytes of the two tokens merge to these two tokens: no merge may cross the
        border at any time. Of merges of one rank the leftmost comes first."""
        if left == _NO_TOKEN:
            return True
        pair = left << 32 | right
        got = self._pairs.get(pair)
        if got is None:
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs = {}
            before, after = self._edge(self.token[left], 1), self._edge(self.token[right], 0)
            i = j = 0
            while True:
                (a, a_until), (b, b_until) = before[i], after[j]
                across = self.ranks.get(a + b)
                if across is not None and across < a_until and across <= b_until:
                    got = False
                    break
                if a_until <= b_until:
                    i += 1
                else:
                    j += 1
                if i == len(before) or j == len(after):
                    got = True
                    break
            self._pairs[pair] = got
        return got

    def _step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        last, pending = state.last, state.pending + bytes((byte,))
        whole = None
        live = []
        for at in state.live:
            begin, path = at
            part = pending[begin:]
            if whole is None:
                token = self.ranks.get(part)
                if (token is not None and self._reachable(part)
                        and self._follows(path[-1] if path else last, token)):
                    whole = (*path, token)
            if part in self.open:
                live.append(at)
        if whole is None:
            raise ValueError("the vocabulary lacks a token for a single byte")
        live.append((len(pending), whole))
        out = live[0][1]
        if out:  # emit what all live encodings begin with
            for _, path in live:
                n = 0
                while n < len(out) and n < len(path) and out[n] == path[n]:
                    n += 1
                out = out[:n]
            cut = sum(len(self.token[t]) for t in out)
            if cut:
                last, pending = out[-1], pending[cut:]
                live = [(b - cut, p[len(out):]) for b, p in live]
        move = self._state(last, pending, live), out
        if state.kept and move[0].kept:
            state.moves[byte] = move
        return move

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token; a pre-token that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out = self.start, []
        for byte in piece:
            state, tokens = state.moves.get(byte) or self._step(state, byte)
            if tokens:
                out.extend(tokens)
        out.extend(state.live[-1][1])  # the end of the pending bytes is always live
        return out


class Encoder:
    """Encoder of whole texts: splits, runs the transducer, keeps recent pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN) -> None:
        self.transducer = Transducer(ranks)
        self.split = regex.compile(pattern)
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        """Ids of a pre-token that the young generation lacks."""
        ids = self.older.get(piece) or array("I", self.transducer.encode(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self.kept) >= MAX_PIECES:
                self.older = dict(self.kept)
                self.kept.clear()  # the same table: a running loop holds its `get`
            self.kept[piece] = ids
        return ids

    def chunks(self, text: str, size: int = 1 << 16) -> Iterator[bytes]:
        """The ids as little-endian unsigned 32-bit integers, chunk by chunk."""
        get, make, out = self.kept.get, self._piece, []
        for m in self.split.finditer(text) if len(text) > size else (None,):
            if m is None:
                yield b"".join([get(p) or make(p) for p in self.split.findall(text)])
                return
            p = m.group()
            out.append(get(p) or make(p))
            if len(out) >= size:
                yield b"".join(out)
                out = []
        yield b"".join(out)


class Decoder:
    """Streaming decoder: feed ids, get the bytes and the text that is complete so far."""

    def __init__(self, token: dict[int, bytes]) -> None:
        self.token = token
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> tuple[bytes, str]:
        data = b"".join(map(self.token.__getitem__, memoryview(ids).cast("I")))
        return data, self.machine.decode(data)

    def close(self) -> str:
        return self.machine.decode(b"", True)


@contextlib.contextmanager
def worker_encoder(path: str) -> Iterator[Encoder]:
    """The encoder of a vocabulary, kept by the Python worker from task to task: later tasks start
    with the states and pre-tokens that earlier ones met. A worker that has had no task for
    :data:`IDLE_SECONDS` drops it, so that other stages get its memory."""
    held = sys.modules.setdefault("_sigmawatch_worker", types.ModuleType("_sigmawatch_worker")).__dict__
    timer = held.pop("timer", None)
    if timer is not None:
        timer.cancel()
    kept = held.setdefault("encoders", {})
    encoder = kept.get(path) or kept.setdefault(path, Encoder(load_ranks(path)))
    try:
        yield encoder
    finally:
        del encoder
        held["timer"] = timer = threading.Timer(IDLE_SECONDS, drop_encoders, (kept,))
        timer.daemon = True
        timer.start()


def drop_encoders(kept: dict[str, Encoder]) -> None:
    """Drop the encoders (one that a task still holds ends with it) and give the memory back."""
    kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def ranks_table(vocabulary: str = VOCABULARY) -> str:
    """Path of a vocabulary file; the installed package holds it on every machine."""
    return public_tokenizers.path(vocabulary)


_ENCODED = "n_tokens long, ids binary"


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) added.

    Whole texts are encoded, null as empty (no tokens). Each row is answered by itself, repeated
    rows too; an empty table gives no rows. Columns of these names are replaced.
    """
    path = ranks_table(vocabulary)

    def make(encoder, texts):
        ids = [b"".join(encoder.chunks(t)) for t in texts]
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]

    return _with(docs, ("n_tokens", "ids"), _ENCODED, path, make)


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (lowercase hex) and
    ``round_trip`` (whether the decoded text equals the text) added; see :func:`encode`. The ids
    stream from the encoder into the decoder, so a very long text needs no list of its ids."""
    path = ranks_table(vocabulary)

    def make(encoder, texts):
        counts, ids_hex, out_hex, same = [], [], [], []
        token = encoder.transducer.token
        for t in texts:
            decoder, n, at, equal = Decoder(token), 0, 0, True
            of_ids, of_bytes = hashlib.sha256(), hashlib.sha256()
            for chunk in encoder.chunks(t):
                of_ids.update(chunk)
                n += len(chunk) // 4
                data, back = decoder.feed(chunk)
                of_bytes.update(data)
                equal = equal and t.startswith(back, at)
                at += len(back)
            rest = decoder.close()
            counts.append(n)
            ids_hex.append(of_ids.hexdigest())
            out_hex.append(of_bytes.hexdigest())
            same.append(equal and not rest and at == len(t))
        return [pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()),
                pa.array(out_hex, pa.string()), pa.array(same, pa.bool_())]

    return _with(docs, ("n_tokens", "ids_sha256", "decoded_sha256", "round_trip"),
                 "n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean",
                 path, make)


def _with(docs: DataFrame, names: tuple[str, ...], schema: str, path: str, make) -> DataFrame:
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with worker_encoder(path) as encoder:
            for column in columns:
                parts = [make(encoder, strings(s.column(0)))
                         for s in slices([pa.RecordBatch.from_arrays([column], ["t"])], 2_000, "t")]
                parts = parts or [make(encoder, [])]
                arrays = [pa.concat_arrays([p[i] for p in parts]) for i in range(len(names))]
                yield pa.StructArray.from_arrays(arrays, list(names))

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    kept = [c for c in docs.columns if c not in names]
    made = docs.select(*kept, F.arrow_udf(run, schema)(F.col("text").cast("string")).alias("_bpe"))
    return made.select(*kept, *[F.col(f"_bpe.{n}").alias(n) for n in names])
