"""Problem 6: the corpus encoded with a public byte-level BPE vocabulary.

The encoder is a left-to-right transducer.  After each byte it knows the last
token of the encoding of what it has read; a token may end here if it and the
token before it stay apart when they are encoded together.  It holds a window
as long as the vocabulary's *sufficient lookahead*, computed from the merge
list; once that is full, the tokens on which all continuations agree leave it,
so the state is bounded for runs of any length.  Texts go through in pieces.
Results of short pre-tokens and pieces are remembered per worker.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import spread

VOCABULARY = "byte_bpe_50k"
#: Results of strings of up to so many characters are remembered; a worker forgets them at so many entries.
MEMO_LENGTH, MEMO_ENTRIES = 64, 400_000
#: Characters of a text that are taken in at once.
PIECE = 1 << 16


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where a public vocabulary lies; the folder is a parameter of the installed ``public_tokenizers``."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(1)
def splitter() -> regex.Pattern:
    """Pre-token pattern: contractions, letters, numbers, other signs, white space (the last one left to the next word)."""
    return regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Transducer:
    """Streaming byte-level BPE over a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], window: int | None = None):
        """``window``: the sufficient lookahead if it is known already."""
        self.ranks, self._window = ranks, window
        self.text = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._apart: dict[tuple[int, int], bool] = {}
        self._parts: dict[bytes, tuple[bytes, bytes] | None] = {}

    def merge(self, word: bytes) -> list[bytes]:
        """Plain merging by rank, for short words."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 30))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def parts(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge gave ``token``."""
        if token not in self._parts:
            got, rank = None, self.ranks[token]
            if len(token) > 1:
                own = [token[i : i + 1] for i in range(len(token))]
                while len(own) > 2:
                    best = min(range(len(own) - 1), key=lambda i: r if (r := self.ranks.get(own[i] + own[i + 1], 1 << 30)) < rank else 1 << 30)
                    if self.ranks.get(own[best] + own[best + 1], 1 << 30) >= rank:
                        break
                    own[best : best + 2] = [own[best] + own[best + 1]]
                got = (own[0], own[1]) if len(own) == 2 else None
            self._parts[token] = got
        return self._parts[token]

    def apart(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay as they are side by side."""
        if (k := (a, b)) not in self._apart:
            if len(self._apart) > MEMO_ENTRIES:
                self._apart.clear()
            self._apart[k] = self.merge(self.text[a] + self.text[b]) == [self.text[a], self.text[b]]
        return self._apart[k]

    def lookahead(self) -> int:
        """Bytes after a token that can still change it.

        A merge ``u+v`` is undone only if an earlier merge takes a right part of
        ``v`` together with what follows, and that one in turn only by a still
        earlier one: the longest such chain of ever earlier merges bounds it.
        """
        if self._window is not None:
            return self._window
        best: dict[bytes, int] = {}
        most = 0
        for token, _ in sorted(self.ranks.items(), key=lambda x: x[1]):
            if not (p := self.parts(token)):
                continue
            u, v = p
            chain, w = 0, v
            while w:
                chain = max(chain, best.get(w, 0))
                q = self.parts(w)
                w = q[1] if q else b""
            n = len(v) + chain
            best[u] = max(best.get(u, 0), n)
            most = max(most, n)
        self._window = most + self.longest
        return self._window

    def run(self) -> Run:
        """The state for one pre-token."""
        return Run(self)

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """Ids of one pre-token that arrives in chunks."""
        r = self.run()
        for c in chunks:
            yield from r.feed(c)
        yield from r.end()


class Run:
    """One pre-token on its way through the transducer; holds only what isn't stable yet."""

    def __init__(self, machine: Transducer):
        self.machine, self.window = machine, machine.lookahead()
        self.data = bytearray()  # bytes since the last emitted token
        self.last = [-1]  # last token of the encoding of data[:i]
        self.prior = -1  # the token emitted last

    def feed(self, chunk: bytes) -> list[int]:
        """Ids that have become stable."""
        m, data, last, out = self.machine, self.data, self.last, []
        ranks, longest = m.ranks, m.longest
        for byte in chunk:
            data.append(byte)
            i = len(data)
            for n in range(min(longest, i), 0, -1):
                t = ranks.get(bytes(data[i - n :]))
                if t is None or i - n and last[i - n] < 0:
                    continue
                before = last[i - n] if i - n else self.prior
                if before < 0 or m.apart(before, t):
                    last.append(t)
                    break
            else:
                last.append(-1)
            if i >= self.window:
                stable = self._agreed(i)
                if stable:
                    out += stable
                    used = sum(len(m.text[t]) for t in stable)
                    del data[:used]
                    last[: used + 1] = [-1]
                    self.prior = stable[-1]
        return out

    def end(self) -> list[int]:
        return self._path(len(self.data))

    def _path(self, i: int) -> list[int]:
        out = []
        while i > 0:
            out.append(self.last[i])
            i -= len(self.machine.text[self.last[i]])
        return out[::-1]

    def _agreed(self, i: int) -> list[int]:
        """First tokens shared by the paths to all positions where the next token may begin."""
        common: list[int] | None = None
        for j in range(i, max(0, i - self.machine.longest), -1):
            if self.last[j] < 0:
                continue
            p = self._path(j)
            if common is None:
                common = p
            else:
                k = 0
                while k < min(len(common), len(p)) and common[k] == p[k]:
                    k += 1
                common = common[:k]
            if not common:
                return []
        return common or []


class _Memo(dict):
    """Strings to the bytes of their ids, computed on first use; emptied at ``MEMO_ENTRIES``."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make

    def __missing__(self, word: str) -> bytes:
        got = self.make(word)
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = got
        return got


#: A white-space run with a space and more in it; a piece between such runs; the last place where pieces may be parted.
_WIDE, _PIECE, _CUT = regex.compile(r" \s|\s "), regex.compile(r" ?\S+|\s+(?!\S)|\s+"), regex.compile(r"(?r)(?<=\S) (?=\S)")
#: What goes on in a pre-token, by its last character.
_CLASSES = [regex.compile(p) for p in (r"\s+", r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")]


def _bytes(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, np.int32).tobytes()


class Encoder:
    """Texts to ids, with memos of pre-tokens and of blank-separated pieces.

    No pre-token crosses from a non-space into white space, so a text may be
    cut before each single space and its pieces encoded on their own.
    """

    def __init__(self, ranks: dict[bytes, int], window: int | None = None):
        self.machine = Transducer(ranks, window)
        self.pretoken = _Memo(lambda w: _bytes(self.machine.stream([w.encode("utf-8", "replace")])))
        self.piece = _Memo(lambda w: b"".join(map(self.pretoken.__getitem__, splitter().findall(w))))
        self.after_space = _Memo(lambda w: self.piece[" " + w])

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids as the bytes of 32-bit integers; null and empty texts give none."""
        if not text:
            return b""
        if len(text) <= PIECE:
            return self._at_once(text)
        return b"".join(self.stream(text[i : i + PIECE] for i in range(0, len(text), PIECE)))

    def _at_once(self, text: str) -> bytes:
        if _WIDE.search(text) or text[0] == " " or text[-1] == " ":
            return b"".join(map(self.piece.__getitem__, _PIECE.findall(text)))
        first, *rest = text.split(" ")
        return self.piece[first] + b"".join(map(self.after_space.__getitem__, rest))

    def stream(self, chunks: Iterable[str], most: int = PIECE) -> Iterator[bytes]:
        """Ids of a text that arrives in chunks; beside a chunk and the state of one pre-token no more than ``most`` characters are held."""
        held, run, going_on = "", None, None
        for chunk in chunks:
            held += chunk
            if run is not None:
                end = m.end() if (m := going_on.match(held)) else 0
                # the last of several white-space characters may belong to what follows
                fed = max(end - 1, 0) if going_on is _CLASSES[0] else end
                yield _bytes(run.feed(held[:fed].encode("utf-8", "replace")))
                held = held[fed:]
                if end == fed + len(held):
                    continue
                yield _bytes(run.end())
                run = None
            if m := _CUT.search(held):
                yield self._at_once(held[: m.start()])
                held = held[m.start() :]
            if len(held) > most:
                *whole, last = splitter().finditer(held)
                yield b"".join(self.pretoken[t[0]] for t in whole)
                held = held[last.start() :]
                if len(held) > most:
                    going_on = next(c for c in _CLASSES if c.match(held[-1]))
                    fed = len(held) - (going_on is _CLASSES[0])
                    run = self.machine.run()
                    yield _bytes(run.feed(held[:fed].encode("utf-8", "replace")))
                    held = held[fed:]
        if run is not None:
            yield _bytes(run.feed(held.encode("utf-8", "replace")))
            yield _bytes(run.end())
        elif held:
            yield self._at_once(held)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()


class Decoder:
    """Ids to text piece by piece: bytes of an unfinished character wait for the next token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.text = {i: b for b, i in ranks.items()}
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: int) -> str:
        return self.state.decode(self.text[token])

    def end(self) -> str:
        return self.state.decode(b"", final=True)

    def decode(self, ids: Iterable[int]) -> str:
        self.state.reset()
        return "".join(map(self.feed, ids)) + self.end()


_encoders: dict[str, Encoder] = {}


def _encoder(name: str, ranks: dict[bytes, int], window: int) -> Encoder:
    """One encoder for a worker's life (Python workers are reused between tasks), kept under the hash of its vocabulary."""
    if name not in _encoders:
        _encoders[name] = Encoder(ranks, window)
    return _encoders[name]


@lru_cache(4)
def load(path: str) -> tuple[str, dict[bytes, int], int]:
    """Hash, ranks and sufficient lookahead of a vocabulary file."""
    ranks = read_ranks(path)
    own = hashlib.sha256(b"".join(b"%d:%d:%b" % (i, len(b), b) for b, i in sorted(ranks.items())))
    return own.hexdigest(), ranks, Transducer(ranks).lookahead()


def encode_table(df: DataFrame, key: str, text: str, path: str | None = None, ids: str = "ids") -> DataFrame:
    """``key`` and the token ids of ``text`` for each row.

    One row out for each row in, repeated rows included; null and empty texts
    have an empty list; a null key stays; strings that look like special
    tokens are ordinary text.  The vocabulary (under 1 MB, of fixed size) is
    broadcast, so executors need no file.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(load(path or vocabulary_path()))
    src = spread(df.select(key, text))
    kind = src.schema[key].dataType.simpleString()

    def run(batches):
        enc = _encoder(*vocabulary.value)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                raw = [enc.encode_bytes(t) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(r) // 4 for r in raw)], dtype=np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(raw))])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], names=[key, ids])

    return src.mapInArrow(run, f"`{key}` {kind}, `{ids}` array<int>")
