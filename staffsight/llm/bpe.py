"""Operator 6, byte-level BPE encoding and decoding by a finite-state transducer.

Encoding. The merges are compiled into a transducer over bytes that is determinised lazily. A
state stands for what the rest of a piece depends on: for each start from which the bytes
read so far are still a prefix of some token, the place in the token trie and the token that
ends at that start. A byte moves each start along the trie; where a token ends, it may follow
the token before its start if merging the bytes of the two gives just the two. At each byte
exactly one such token ends (the last token of the prefix read so far); it is the output of
the transition and, with the byte's position, a new start. States and transitions are made
when first needed and kept.

A token is emitted as soon as the chains of all starts agree on it: at once when only one
start is left (transitions into such states are marked), and else in regular intervals, so that
what is pending is bounded by the interval and the longest token.

Whether a token may follow another is read off the two tokens' own merges: at their border lie
the parts that the left one ends and the right one begins with, growing by merges of rising
rank, and the tokens stay apart if no merge across the border has its turn in between.

Pieces are the matches of the splitting pattern; a piece that is itself a token is that
token. Piece results are kept in a table of bounded size, so that a common word costs one
look-up: when the newer half is full the older one goes, and what is asked for again moves over.

Decoding. Token bytes are fed in blocks to an incremental UTF-8 state machine, which carries an
incomplete character over to the next block; bytes that are not UTF-8 become U+FFFD in the
text, while ``decoded`` keeps the bytes themselves.

Defined results: null texts are empty and have no ids; an empty table gives no rows; repeated
rows are encoded each; null or unknown ids are an error; only the named columns are read.
The work is local to a row, without a shuffle. The ranks (a file of fixed size) are read
by the driver and broadcast.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import struct
import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

ship(__name__)

#: Pieces in each half of the table, transitions that are kept, and the longest piece kept.
KEPT_PIECES, KEPT_MOVES, KEPT_BYTES = 250_000, 450_000, 64
#: A long piece emits what is settled every so many bytes.
INTERVAL = 4096
#: Rank of a pair that no merge joins.
NEVER = 1 << 60
#: Rank files beyond this many bytes are refused, as they are broadcast.
MAX_RANK_BYTES = 64 << 20


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, from lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Transducer:
    """Lazily determinised transducer from the bytes of a piece to token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.length = {r: len(t) for t, r in ranks.items()}
        # the trie: (node, byte) -> node; node -> token that ends there
        self.child: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        nodes = 1
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                node = self.child[key]
            self.ends[node] = rank
        self.borders: dict[tuple[int, bool], list[int]] = {}
        #: (token before) + 1 << 24 | token -> may they stand side by side
        self.fits: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # a state: for each start, oldest first, trie node << 24 | token before it + 1 (0: the piece's start)
        # the number of a state is shifted by a byte
        self.numbers: dict[tuple, int] = {(0,): 0}
        self.states: list[tuple] = [(0,)]
        # state << 8 | byte -> next state << 8, token that ends there, is one start left
        self.moves: dict[int, tuple[int, int, bool]] = {}

    def merge(self, data: bytes, parts_left: int = 1) -> list[bytes]:
        """Merges adjacent pairs by rank until none is left or ``parts_left`` are; used to compile, on short strings."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > parts_left:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def border(self, token: int, last: bool) -> list[int]:
        """The parts that lie at the token's end (or start) while it is merged, from its byte to itself."""
        found = self.borders.get((token, last))
        if found is None:
            parts = self.merge(self.tokens[token], 2) if self.length[token] > 1 else []
            inner = self.border(self.ranks[parts[-1 if last else 0]], last) if len(parts) == 2 else []
            found = self.borders[token, last] = [*inner, token]
        return found

    def beside(self, before: int, token: int) -> bool:
        """May the token follow token ``before - 1`` (or start a piece, for 0)?"""
        left, right = self.border(before - 1, True) if before else (), self.border(token, False)
        if len(right) == 1 and self.length[token] > 1:
            return False  # merging its bytes gives something else
        i = j = 0
        while before:
            across = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]], NEVER)
            next_left = left[i + 1] if i + 1 < len(left) else NEVER
            next_right = right[j + 1] if j + 1 < len(right) else NEVER
            # of equal ranks the leftmost pair is merged first
            if across < next_left and across <= next_right and across < NEVER:
                return False
            if next_left == next_right:
                if next_left == NEVER:
                    break
            if next_left <= next_right:
                i += 1
            else:
                j += 1
        return True

    def _step(self, key: int) -> tuple[int, int, bool]:
        """The move for a state and byte, worked out and kept."""
        byte, alive, ended = key & 255, [], -1
        child, ends, fits = self.child, self.ends, self.fits
        for start in self.states[key >> 8]:
            node = child.get(start >> 24 << 8 | byte)
            if node is not None:
                before = start & 0xFFFFFF
                alive.append(node << 24 | before)
                if ended < 0 and node in ends:
                    token = ends[node]
                    fit = fits.get(before << 24 | token)
                    if fit is None:
                        if len(fits) > KEPT_MOVES:
                            fits.clear()
                        fit = fits[before << 24 | token] = self.beside(before, token)
                    if fit:
                        ended = token
        alive.append(ended + 1)
        state = tuple(alive)
        to = self.numbers.get(state)
        if to is None:
            to = self.numbers[state] = len(self.states) << 8
            self.states.append(state)
        move = self.moves[key] = to, ended, len(alive) == 1
        return move

    def _ways(self, ended: list[int], at: int) -> list[int]:
        """Positions of the token ends on the way back from ``at`` to the first pending byte."""
        out = []
        while at > 0:
            out.append(at)
            at -= self.length[ended[at - 1]]
        return out

    def _settled(self, ended: list[int], state: int) -> int:
        """The last position that the chains of all starts go through."""
        n, starts = len(ended), self.states[state]
        # a start's age is the depth of its trie node; the newest start is the end itself
        common = None
        for start in starts:
            at = n - self.depth(start >> 24)
            ways = set(self._ways(ended, at))
            common = ways if common is None else common & ways
        return max(common, default=0)

    def depth(self, node: int) -> int:
        if not hasattr(self, "depths"):
            self.depths = {0: 0}
            for key, to in self.child.items():  # a node's parent was entered before it
                self.depths[to] = self.depths[key >> 8] + 1
        return self.depths[node]

    def run(self, piece: bytes) -> list[int]:
        """Token ids of one piece, emitted as the bytes go by."""
        if len(self.moves) > KEPT_MOVES:
            self._reset()
        out: list[int] = []
        ended: list[int] = []
        at, moves = 0, self.moves
        for byte in piece:
            try:
                at, token, one = moves[at | byte]
            except KeyError:
                at, token, one = self._step(at | byte)
            ended.append(token)
            if one:
                out += self._chain(ended, len(ended))
                ended.clear()
            elif len(ended) >= INTERVAL and (settled := self._settled(ended, at >> 8)):
                out += self._chain(ended, settled)
                del ended[:settled]
        return out + self._chain(ended, len(ended))

    def _chain(self, ended: list[int], at: int) -> list[int]:
        """The tokens that lead from the first pending byte to ``at``."""
        out = []
        while at > 0:
            out.append(ended[at - 1])
            at -= self.length[out[-1]]
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        token = self.ranks.get(piece)
        return [token] if token is not None else self.run(piece)


class Pieces(dict):
    """Ids (little-endian unsigned 32-bit integers) by piece, worked out when first asked for; bounded."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer, self.older = transducer, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            found = self.transducer.encode_piece(piece.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= KEPT_BYTES:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes whole texts; kept by a Python worker between tasks."""

    def __init__(self, data: bytes, pattern: str):
        self.ranks = read_ranks(data)
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.pattern, self.pieces = regex.compile(pattern), None

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.pieces is None:  # a worker that only decodes needs no transducer
            self.pieces = Pieces(Transducer(self.ranks))
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.pattern.findall(text))), "<u4")

    def decode(self, ids: np.ndarray, block: int = 4096) -> tuple[bytes, str]:
        """The bytes of the ids and their text, block by block."""
        token = self.tokens.__getitem__
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        data, text = [], []
        for at in range(0, len(ids), block):
            data.append(b"".join(map(token, ids[at:at + block].tolist())))
            text.append(machine.decode(data[-1]))
        text.append(machine.decode(b"", final=True))
        return b"".join(data), "".join(text)


def load_codec(spark: SparkSession, path: str, pattern: str):
    """Broadcast of the rank file at ``path`` (local to the driver) and the pattern."""
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"{path} has more than {MAX_RANK_BYTES} bytes")
    return spark.sparkContext.broadcast((data, pattern))


def _codec(data: bytes, pattern: str) -> Codec:
    """The worker's codec. A Python worker holds one, with the states and pieces known so far,
    for all tasks and queries that use the same ranks and pattern."""
    slot = sys.modules.setdefault("bpe_worker_slot", ModuleType("bpe_worker_slot"))
    key = hashlib.sha256(data).digest(), pattern
    if getattr(slot, "key", None) != key:
        slot.key, slot.codec = key, Codec(data, pattern)
    return slot.codec


def encode(documents: DataFrame, codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids (binary: little-endian unsigned 32-bit integers) for every row."""
    rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        own = _codec(*codec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [own.encode(t) if t else np.zeros(0, "<u4") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=[id_col, "n_tokens", "ids"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, codec) -> DataFrame:
    """``encoded`` with ``decoded`` (the bytes) and ``text`` (those bytes as text)."""
    fields = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType()), T.StructField("text", T.StringType())])

    def run(batches):
        own = _codec(*codec.value)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                both = [own.decode(np.frombuffer(x, "<u4")) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([b for b, _ in both], pa.binary()), pa.array([t for _, t in both], pa.string())],
                    names=[*part.schema.names, "decoded", "text"])

    return encoded.mapInArrow(run, fields)


def roundtrip(documents: DataFrame, codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256, intact: every text encoded, and its ids decoded, in one pass.

    ``intact`` tells whether the incremental UTF-8 machine gives the text back.
    """
    rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        own = _codec(*codec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for text in part.column(1).to_pylist():
                    ids = own.encode(text or "")
                    data, back = own.decode(ids)
                    out.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(data).hexdigest(), back == (text or "")))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "intact"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, intact boolean")


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """The columns of the query."""
    return roundtrip(documents, load_codec(documents.sparkSession, path, pattern))
