"""Byte-level BPE as a lazily determinised transducer, and streaming decoding through an incremental UTF-8 state machine."""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import begin_task, fields, plain, remembered

#: Parts of texts, pairs and states a worker remembers (results do not depend on it). When half the parts are there, those not met since
#: the last time are forgotten; pairs and states start anew when full. A test holds the bytes of a part and of a move with its state to 250 each on average.
MAX_PARTS, MAX_PAIRS, MAX_STATES = 2**18, 2**17, 2**18
#: Bytes of a part that are remembered, and bytes of a piece after which tokens are given out that no further byte can change.
LONGEST, SETTLE = 48, 1 << 12
#: A pattern that begins a match at the last white space of every run of it that a visible character follows, so that a text may be cut
#: there (fixed value), and where it is cut.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BORDER = regex.compile(r"(?=[ \n][!-~\p{L}\p{N}])", regex.V1)
#: Bytes of results handed over at a time, and ids decoded at a time.
OUT_BYTES, CHUNK_IDS = 4 << 20, 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


#: A rank that no pair has.
NEVER = 1 << 60


class Transducer:
    """Merges as a transducer over bytes.

    Two facts carry it: a sequence of tokens is what the merges make of its bytes exactly if every two neighbours are (``fits``), and every
    prefix of the input has one such sequence. A hypothesis is an unfinished token (a node of the trie of tokens) with the token before it;
    a state is the hypotheses alive after a prefix, the longest first. A move reads a byte and puts out the one token that can end there;
    what is put out at the end, and before the token found there, and so on, is the sequence. Where the sequences before all hypotheses meet,
    nothing before can change, so tokens can be given out while a long piece is read. As a state knows nothing of the tokens before its
    hypotheses, pieces share states. States and moves are made when first needed, and kept as packed numbers: a hypothesis is its node and, in
    the low bits, the token before plus one; what a move leads to is the state's number, 8 bits for the next byte, and its token plus one.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.token, self.depth = ranks, array("i", [-1]), array("i", [0])
        self.bits = (max(ranks.values(), default=0) + 1).bit_length()
        self.mask = (1 << self.bits) - 1
        #: node * 256 + byte -> node, and the nodes that have children
        self.child: dict[int, int] = {}
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.length = {r: len(t) for t, r in ranks.items()}
        for token, rank in ranks.items():
            node = 0
            for depth, byte in enumerate(token, start=1):
                node = self.child.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.depth.append(depth)
            self.token[node] = rank
        self.inner = {key >> 8 for key in self.child}
        self.pairs: dict[int, bool] = {}
        self.spines: dict[int, list[int] | None] = {}
        self.forgot = self.made = 0
        self.forget()

    def forget(self) -> None:
        """Start with no states but the first: no token unfinished, none before."""
        first = array("q", [0]).tobytes()
        self.number, self.states, self.moves = {first: 0}, [first], {}

    def merge(self, data: bytes, parts_left: int = 1) -> list[bytes]:
        """The plain definition: join the neighbours of lowest rank until none can be joined or ``parts_left`` remain."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > parts_left:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spine(self, token: int, end: int) -> list[int] | None:
        """The tokens which stand at the left (0) or right (-1) end of a token's bytes while it is made, from the byte up; None if the
        merges never make it of its bytes."""
        key = token << 1 | (end & 1)
        if key not in self.spines:
            data = self.bytes_of[token]
            if len(data) == 1:
                self.spines[key] = [token]
            else:
                halves = self.merge(data, 2)
                below = self.spine(self.ranks[halves[end]], end) if len(halves) == 2 and halves[0] in self.ranks and halves[1] in self.ranks else None
                self.spines[key] = below and [*below, token]
        return self.spines[key]

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens as they are, side by side (``left`` -1: the start).

        Both grow from their bytes at the border; at each step the end of the one and the begin of the other could be joined instead of
        growing on, if that has the lower rank (of equal ranks, the one further left comes first).
        """
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        ups = self.spine(right, 0)
        if left < 0 or not ups:
            return bool(ups)
        downs, i, j = self.spine(left, -1), 0, 0
        while True:
            own, other = downs[i + 1] if i + 1 < len(downs) else NEVER, ups[j + 1] if j + 1 < len(ups) else NEVER
            rank = self.ranks.get(self.bytes_of[downs[i]] + self.bytes_of[ups[j]], NEVER)
            if rank < NEVER and rank < own and rank <= other:
                return False
            if own == other == NEVER:
                return True
            if own <= other:
                i += 1
            else:
                j += 1

    def move(self, state: int, byte: int) -> int:
        """The state after a byte and the token that ends with it, packed; ``state`` is a number with 8 bits for the byte."""
        alive, token_here, bits, mask = array("q"), -1, self.bits, self.mask
        for hypothesis in memoryview(self.states[state >> 8]).cast("q"):
            child = self.child.get((hypothesis >> bits) << 8 | byte)
            if child is not None:
                last = hypothesis & mask
                if child in self.inner:
                    alive.append(child << bits | last)
                token = self.token[child]
                if token_here < 0 <= token and self.fits(last - 1, token):
                    token_here = token
        alive.append(token_here + 1)
        after = alive.tobytes()
        number = self.number.get(after)
        if number is None:
            number = self.number[after] = len(self.states)
            self.states.append(after)
        self.made += 1
        found = self.moves[state | byte] = number << 8 + bits | token_here + 1
        return found

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(self.states) > MAX_STATES:
            self.forgot += 1
            self.forget()
        state, ends, out, known, bits, full = 0, [], [], self.moves.get, self.bits, SETTLE
        for at in range(0, len(piece), SETTLE):
            for byte in piece[at : at + SETTLE]:
                found = known(state | byte) or self.move(state, byte)
                state = found >> bits
                ends.append(found)
            if len(ends) >= full:
                settled = self._settled(state >> 8, ends)
                out += self._back(ends[:settled])
                del ends[:settled]
                full = max(SETTLE, 2 * len(ends))
        return out + self._back(ends)

    def _settled(self, state: int, ends: list[int]) -> int:
        """The last place at which the sequences before all hypotheses of a state have a border."""
        common = None
        for hypothesis in memoryview(self.states[state]).cast("q"):
            at = len(ends) - self.depth[hypothesis >> self.bits]
            borders = {at}
            while at:
                at -= self.length[(ends[at - 1] & self.mask) - 1]
                borders.add(at)
            common = borders if common is None else common & borders
        return max(common)

    def _back(self, ends: list[int]) -> list[int]:
        """The tokens of bytes each of which has the move that would end with it, from the last one back."""
        out, at, mask = [], len(ends), self.mask
        while at:
            out.append((ends[at - 1] & mask) - 1)
            at -= self.length[out[-1]]
        return out[::-1]


class Parts(dict):
    """Packed ids (little-endian, 32 bits) of parts of texts that matches do not reach over; a part is kept without the space before it."""

    def __init__(self, transducer: Transducer, pattern: str):
        self.transducer, self.find, self.cut = transducer, regex.compile(pattern).findall, pattern == BYTE_LEVEL
        #: those of the time before; one that is met again comes back
        self.before: dict[str, bytes | None] = {}

    def pieces(self, text: str) -> bytes:
        ids = [i for piece in self.find(text) for i in self.transducer.encode(piece.encode())]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, part: str) -> bytes | None:
        """None for a part that may not be cut off before it."""
        if part in self.before:
            packed = self.before[part]
        else:
            text = part if part[:1] == "\n" else " " + part
            packed = self.pieces(text) if BORDER.match(text) else None
        if len(part) < LONGEST:
            if len(self) >= MAX_PARTS // 2:
                self.before = dict(self)
                self.clear()
            self[part] = packed
        return packed

    def of_text(self, text: str) -> bytes:
        if not self.cut:
            return self.pieces(text)
        head, *rest = text.replace("\n", " \n").split(" ")
        found = list(map(self.__getitem__, rest))
        if None in found:
            head, *rest = BORDER.split(text)
            found = [self[p.removeprefix(" ")] for p in rest]
        return self.pieces(head) + b"".join(found)


class Utf8Stream:
    """Bytes in, text out: a character is given out when its last byte has come; broken bytes become U+FFFD."""

    #: Bytes a character has, by its first byte (fixed values of UTF-8).
    LENGTH = [1] * 0xC2 + [2] * 30 + [3] * 16 + [4] * 5 + [1] * 11

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        end = len(data)
        for back in range(1, min(3, end) + 1):
            byte = data[end - back]
            if byte & 0xC0 != 0x80:
                if self.LENGTH[byte] > back:
                    end -= back
                break
        self.held = data[end:]
        return data[:end].decode("utf-8", "replace")

    def close(self) -> str:
        text, self.held = self.held.decode("utf-8", "replace"), b""
        return text


@remembered
def encoder(path: str, pattern: str):
    return Parts(Transducer(read_ranks(path)), pattern).of_text


class Vocabulary:
    """All tokens' bytes end to end, so that ids become bytes by gathering."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.bytes = np.frombuffer(b"".join(ranks), np.uint8)
        lengths = np.array([len(t) for t in ranks], np.int64)
        ids = np.array(list(ranks.values()), np.int64)
        self.begin, self.length = np.full(ids.max() + 1, -1, np.int64), np.zeros(ids.max() + 1, np.int64)
        self.begin[ids], self.length[ids] = np.cumsum(lengths) - lengths, lengths

    def join(self, ids: np.ndarray) -> bytes:
        length = self.length[np.minimum(ids, len(self.length) - 1)]
        if (length == 0).any() or (ids >= len(self.length)).any():
            raise ValueError("an id that is not in the vocabulary")
        ends = np.cumsum(length)
        return self.bytes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[ids] - ends + length, length)].tobytes()


@remembered
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def decode(ids: bytes, vocabulary: Vocabulary) -> Iterator[str]:
    """The text of packed ids, in parts."""
    stream, size = Utf8Stream(), 4 * CHUNK_IDS
    for at in range(0, len(ids), size):
        yield stream.feed(vocabulary.join(np.frombuffer(ids[at : at + size], "<u4")))
    yield stream.close()


def _emit(batches: Iterable[pa.RecordBatch], column: str, fn, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Replace ``column`` by the columns ``fn`` makes of its values; hand over about OUT_BYTES at a time, and give back what Arrow held of them."""
    names = [n for n in schema.names]
    for batch in batches:
        keep = [n for n in names if n in batch.schema.names]
        made: list[tuple] = []
        begun = size = 0
        for i, value in enumerate(batch.column(column)):
            made.append(fn(value.as_py()))
            size += sum(len(v) for v in made[-1] if isinstance(v, (bytes, str)))
            if size >= OUT_BYTES or i == batch.num_rows - 1:
                new = iter(zip(*made))
                yield pa.record_batch([batch.column(n).slice(begun, i + 1 - begun) if n in keep else pa.array(next(new), schema.field(n).type) for n in names], schema=schema)
                made, begun, size, new = [], i + 1, 0, None
                pa.default_memory_pool().release_unused()


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32 bits) of documents (doc_id, text).

    Every match of ``pattern`` is encoded by itself with the ranks of ``path``, a file that every worker can open. Missing and empty texts
    have no ids; a row comes back for every row; long texts cost time and memory in proportion to their length.
    """
    rows = fields(docs, "doc_id", "text").select("doc_id", plain("text").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary"
    arrow = pa.schema([("doc_id", _arrow_type(rows)), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        begin_task(__name__)
        encode = encoder(path, pattern)
        return _emit(batches, "text", lambda text: ((len(ids := encode(text)) // 4), ids), arrow)

    return rows.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``text`` to (doc_id, n_tokens, ids). No ids: empty. An id that is not in the ranks is an error."""
    rows = fields(encoded, "doc_id", "n_tokens", "ids")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, text string"
    arrow = pa.schema([("doc_id", _arrow_type(rows)), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches):
        begin_task(__name__)
        vocabulary = _vocabulary(path)
        return _emit(batches, "ids", lambda ids: ("".join(decode(ids or b"", vocabulary)),), arrow)

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode_documents`` of ``encode_documents`` in one pass, so that ids do not leave and enter the workers again."""
    rows = fields(docs, "doc_id", "text").select("doc_id", plain("text").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, decoded string"
    arrow = pa.schema([("doc_id", _arrow_type(rows)), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches):
        begin_task(__name__)
        encode, vocabulary = encoder(path, pattern), _vocabulary(path)
        return _emit(batches, "text", lambda text: (len(ids := encode(text)) // 4, ids, "".join(decode(ids, vocabulary))), arrow)

    return rows.mapInArrow(run, schema).withColumnRenamed("decoded", "text")


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["doc_id"].dataType)
