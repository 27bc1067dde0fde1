"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

Encoding. A text is cut into pre-tokens by the vocabulary's pattern, window by window; windows end where no
pre-token can continue. The bytes of each pre-token go through the transducer in chunks of bounded size, whatever its
length. It uses two facts of BPE:
a token sequence is the encoding of its bytes exactly if each two neighbours stay apart when encoded
together, and so the last token of a prefix's encoding is the longest one that ends there and is compatible
with the last token of what precedes it. The transducer keeps the last token of each prefix since the last
stable point. `lookahead`, computed from the merge list (`sufficient_lookahead`, with the proof), is how many bytes
after a place settle whether there is a token boundary, whatever follows. So the tokens that end at least `lookahead`
bytes before the end of what was read are stable and are emitted at once, and the state is bounded by the lookahead, a token and a chunk.

Decoding. Token bytes are fed, a bounded number at a time, to an incremental state machine from bytes
to text that holds back at most an unfinished character and replaces ill-formed bytes.

Cases: null text is the empty text, with no tokens; special tokens' strings in a text become their
ids, as the tokenizers library does by default; texts and pre-tokens of any length take memory for
themselves and the constant state; repeated rows are encoded alike; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import pickle
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from crestline.llm.common import give_back

#: Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNITS_KEPT, _FITS_KEPT, _DECODED, _NEVER = 400_000, 600_000, 8192, 2**31
#: Characters of a window of text, and bytes of a chunk fed to the transducer.
WINDOW, CHUNK = 65_536, 1024
#: Documents whose results leave a worker together.
ROWS = 500
_PLAIN = re.compile(r" (?=\S)")
_RUNS = re.compile(r" (?:\s|\Z)")
_START = re.compile(r"(?<!\s) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in out.values()):
        out[chr(256 + i)] = b
    return out


class Vocabulary:
    """Merges and tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, source: str | bytes):
        """`source` is a file's path, or what it holds."""
        spec = json.loads(Path(source).read_bytes() if isinstance(source, str) else source)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        ids = spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: raw(s) for s, i in ids.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        parts = [tuple(p) for p in pairs]
        for rank, (a, b) in enumerate(parts):
            ranks.setdefault((ids[a], ids[b]), rank)
            self.made.append(ids[a + b])
        self.ranks = ranks
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.added.items():
            self.bytes_of[i] = text.encode()
        self.lookahead = sufficient_lookahead([(ids[a], ids[b], ids[a + b]) for a, b in parts], {i: len(b) for i, b in self.bytes_of.items()})


def sufficient_lookahead(merges: list[tuple[int, int, int]], length: dict[int, int]) -> int:
    """How many bytes after a place settle, whatever comes later, whether the encoding has a boundary there.

    `merges` has (left, right, whole) in the order of rank. Let D(r) be how many bytes after its end decide whether merge
    r = (u, v) is applied at a place. By induction over ranks it depends on nothing else than: whether u and v are made there
    (ranks smaller than r), and whether a merge of a smaller rank takes one of them before: (v, x) or (u, x), which end len(x)
    after v or u, or (w, v) or (w, u), which end with v or u. Distances from the end of u shrink by len(v). A
    boundary goes only by a merge (s, x) with s before and x after it, so the greatest len(x) + D(s, x) is sufficient.
    """
    from bisect import bisect_left

    makes: dict[int, int] = {}  # greatest D of the merges that make a token
    rights: dict[int, tuple[list[int], list[int]]] = {}  # of merges (s, x) by s: ranks, and the running greatest len(x) + D
    lefts: dict[int, tuple[list[int], list[int]]] = {}  # of merges (w, s) by s: ranks, and the running greatest D
    enough = 0

    def most(table: dict[int, tuple[list[int], list[int]]], s: int, rank: int) -> int:
        ranks, top = table.get(s, ((), ()))
        at = bisect_left(ranks, rank)
        return top[at - 1] if at else 0

    def note(table: dict[int, tuple[list[int], list[int]]], s: int, rank: int, value: int) -> None:
        ranks, top = table.setdefault(s, ([], []))
        ranks.append(rank)
        top.append(max(value, top[-1]) if top else value)

    for r, (u, v, whole) in enumerate(merges):
        of_v = max(makes.get(v, 0), most(rights, v, r), most(lefts, v, r))
        of_u = max(makes.get(u, 0), most(rights, u, r), most(lefts, u, r))
        far = max(of_v, of_u - length[v])
        makes[whole] = max(makes.get(whole, 0), far)
        note(rights, u, r, length[v] + far)
        note(lefts, v, r, far)
        enough = max(enough, length[v] + far)
    return enough


def _packed(kind: str, ids: list[int]) -> array:
    out = array(kind, ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out


class Transducer:
    """Encodes one pre-token after another."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.first = [vocabulary.id_of[bytes([c])] for c in range(256)]
        self.fits: dict[int, bool] = {}
        #: Tokens that the merges can make.
        self.real = {b: i for b, i in vocabulary.id_of.items() if self.merged(b) == [i]}
        self.longest = max(map(len, self.real), default=1)
        self._automaton()
        #: The most prefixes that were held at once.
        self.held_most = 0

    def _automaton(self) -> None:
        """The suffix automaton of the tokens: from the bytes so far to the longest token that ends here, and on to shorter ones."""
        child: dict[int, int] = {}
        token, depth_first = [-1], [0]
        for text, i in self.real.items():
            node = 0
            for c in text:
                node = child.setdefault(node << 8 | c, len(token))
                if node == len(token):
                    token.append(-1)
            token[node] = i
        children: list[list[tuple[int, int]]] = [[] for _ in token]
        for key, node in child.items():
            children[key >> 8].append((key & 255, node))
        fail, out, link = [0] * len(token), token[:], [-1] * (1 + max(self.v.bytes_of))
        for node in depth_first:  # grows while it is read: nearest nodes first
            for c, down in children[node]:
                at = fail[node]
                while at and (at << 8 | c) not in child:
                    at = fail[at]
                fail[down] = child.get(at << 8 | c, 0) if node else 0
                if token[down] >= 0:
                    link[token[down]] = out[fail[down]]
                else:
                    out[down] = out[fail[down]]
                depth_first.append(down)
        self.child, self.fail, self.out, self.link = child, fail, out, link
        self.go: dict[int, int] = {}
        self.length = [0] * len(link)
        for text, i in self.real.items():
            self.length[i] = len(text)

    def step(self, state: int, byte: int) -> int:
        """The automaton's state after a byte."""
        if len(self.go) > _FITS_KEPT:
            self.go.clear()
        at = state
        while at and (at << 8 | byte) not in self.child:
            at = self.fail[at]
        self.go[state << 8 | byte] = found = self.child.get(at << 8 | byte, 0)
        return found

    def merged(self, piece: bytes) -> list[int]:
        """The encoding of the bytes of one or two tokens by the merge list itself: the best-ranked, leftmost pair first."""
        rank_of, made = self.v.ranks.get, self.v.made
        ids = [self.first[c] for c in piece]
        ranks = [rank_of(pair, _NEVER) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != _NEVER:
            at = ranks.index(best)
            ids[at : at + 2] = [made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), _NEVER)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), _NEVER)
        return ids

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay apart when their bytes are encoded together."""
        key = a << 20 | b
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > _FITS_KEPT:
                self.fits.clear()
            found = self.fits[key] = self.merged(self.v.bytes_of[a] + self.v.bytes_of[b]) == [a, b]
        return found

    def _read(self, chunk: bytes, last: list[int], before: int, state: int) -> int:
        """Appends the last token of the encoding up to each byte of a chunk to `last`; `before` is the token before last[1:]. Returns the new state."""
        go, out, link, length, fits = self.go, self.out, self.link, self.length, self.fits
        n = len(last) - 1
        for byte in chunk:
            found = go.get(state << 8 | byte)
            state = self.step(state, byte) if found is None else found
            n += 1
            token = out[state]
            while True:
                at = n - length[token]
                if at >= 0:
                    left = last[at] if at else before
                    if left < 0:
                        break
                    fit = fits.get(left << 20 | token)
                    if fit or fit is None and self.compatible(left, token):
                        break
                token = link[token]
            last.append(token)
        return state

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """Token ids of one pre-token that comes in chunks of bytes, each id as soon as a chunk makes it stable."""
        # last[i]: the last token of the encoding up to the i-th byte after the stable point.
        last, before, state = [-1], -1, 0
        for chunk in chunks:
            state = self._read(chunk, last, before, state)
            n = len(last) - 1
            self.held_most = max(self.held_most, n)
            # Boundaries of this prefix's encoding that are `lookahead` bytes old stay, whatever comes.
            stable = n
            while stable > max(0, n - self.v.lookahead):
                stable -= self.length[last[stable]]
            if stable > 0:
                yield from self._chain(last, stable)
                before, last = last[stable], last[stable:]
        yield from self._chain(last, len(last) - 1)

    def _chain(self, last: list[int], at: int) -> list[int]:
        out = []
        while at > 0:
            out.append(last[at])
            at -= self.length[last[at]]
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of a whole pre-token: of one chunk, with nothing to emit before its end, or of several."""
        if len(piece) > CHUNK:
            return list(self.stream(piece[i : i + CHUNK] for i in range(0, len(piece), CHUNK)))
        last = [-1]
        self._read(piece, last, -1, 0)
        return self._chain(last, len(piece))


class Encoder:
    """Texts to packed little-endian 32-bit ids, with frequent units remembered in bounded memory."""

    def __init__(self, machine: Vocabulary | Transducer):
        self.transducer = machine if isinstance(machine, Transducer) else Transducer(machine)
        self.pattern = regex.compile(PATTERN)
        self.added = self.transducer.v.added
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.units: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    def unit(self, text: str) -> bytes:
        """Ids of a text that starts and ends where pre-tokens do."""
        out, tokens, encode = [], self.tokens, self.transducer.encode
        for m in self.pattern.finditer(text):
            piece = m[0]
            if len(piece) == len(text):
                # The one piece of a unit is remembered as that.
                return _packed("I", encode(piece.encode("utf-8", "surrogatepass"))).tobytes()
            found = tokens.get(piece)
            if found is None:
                found = _packed("I", encode(piece.encode("utf-8", "surrogatepass"))).tobytes()
                if len(piece) <= 64:
                    if len(tokens) > _UNITS_KEPT:
                        tokens.clear()
                    tokens[piece] = found
            out.append(found)
        return b"".join(out)

    def windows(self, text: str, at: int, end: int) -> Iterator[str]:
        """The parts of text[at:end], of WINDOW characters and what follows up to a place where a pre-token starts."""
        while end - at > WINDOW:
            start = _START.search(text, at + WINDOW, end)
            if start is None:
                break
            yield text[at : start.start()]
            at = start.start()
        yield text[at:end]

    def plain(self, text: str) -> bytes:
        """Ids of a window of text without special tokens. A space before a character that is none starts a unit."""
        units = self.units
        if _RUNS.search(text):
            parts = _PLAIN.split(text)
        else:
            parts = text.split(" ")
        out = []
        get = units.get
        for i, part in enumerate(parts):
            if i:
                part = " " + part
            found = get(part)
            if found is None:
                found = self.unit(part)
                if len(part) <= 64:
                    if len(units) > _UNITS_KEPT:
                        units.clear()
                    units[part] = found
            out.append(found)
        return b"".join(out)

    def pieces(self, text: str | None) -> Iterator[bytes]:
        """Ids of a text, part by part."""
        text, at = text or "", 0
        for m in self.cut.finditer(text) if self.cut else ():
            if m.start() > at:
                yield from map(self.plain, self.windows(text, at, m.start()))
            yield _packed("I", [self.added[m[0]]]).tobytes()
            at = m.end()
        if at < len(text):
            yield from map(self.plain, self.windows(text, at, len(text)))

    def __call__(self, text: str | None) -> bytes:
        return b"".join(self.pieces(text))


class Decoder:
    """Packed ids to text, piece by piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.table = [vocabulary.bytes_of.get(i, b"") for i in range(max(vocabulary.bytes_of) + 1)]

    def pieces(self, parts: Iterable[bytes]) -> Iterator[str]:
        """The text of ids that come in parts, each a whole number of ids."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        get = self.table.__getitem__
        for part in parts:
            numbers = np.frombuffer(part, "<u4")
            for i in range(0, len(numbers), _DECODED):
                yield machine.decode(b"".join(map(get, numbers[i : i + _DECODED].tolist())))
        yield machine.decode(b"", final=True)


def _mapped(docs: DataFrame, path: str, columns: list[str], schema: str, make) -> DataFrame:
    # The tables are broadcast as bytes; what a task makes of them is freed with it, where a worker would keep it for good.
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(Transducer(Vocabulary(path)), protocol=5))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch = None
        machine = pickle.loads(shared.value)
        encoder, decoder = Encoder(machine), Decoder(machine.v)
        for batch in batches:
            # Results leave in parts, so that ids of a whole batch are never held at once.
            for i in range(0, len(batch), ROWS):
                yield make(batch.iloc[i : i + ROWS], encoder, decoder)
        del machine, encoder, decoder, batch
        give_back()

    return docs.select(*columns, "text").mapInPandas(run, schema)


def _through(text: str | None, encoder: Encoder, decoder: Decoder, take) -> tuple[int, str]:
    """The number of ids of a text and the sha256 of their decoding; each part of the ids goes to `take` and on to the decoder."""
    n, h = 0, hashlib.sha256()

    def parts() -> Iterator[bytes]:
        nonlocal n
        for part in encoder.pieces(text):
            n += len(part) // 4
            take(part)
            yield part

    for piece in decoder.pieces(parts()):
        h.update(piece.encode("utf-8", "surrogatepass"))
    return n, h.hexdigest()


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""

    def make(batch: pd.DataFrame, encoder: Encoder, decoder: Decoder) -> pd.DataFrame:
        n, ids, texts = [], [], []
        for text in batch["text"]:
            h = hashlib.sha256()
            count, decoded = _through(text, encoder, decoder, h.update)
            n.append(count)
            ids.append(h.hexdigest())
            texts.append(decoded)
        return pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": texts})

    return _mapped(docs, path, ["doc_id"], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers) and decoded_sha256 of every row."""

    def make(batch: pd.DataFrame, encoder: Encoder, decoder: Decoder) -> pd.DataFrame:
        n, ids, texts = [], [], []
        for text in batch["text"]:
            parts: list[bytes] = []
            count, decoded = _through(text, encoder, decoder, parts.append)
            n.append(count)
            ids.append(b"".join(parts))
            texts.append(decoded)
        return pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": n, "ids": ids, "decoded_sha256": texts})

    return _mapped(docs, path, ["doc_id"], "doc_id long, n_tokens long, ids binary, decoded_sha256 string", make)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of `encoded`."""
    shared = rows.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(Vocabulary(shared.value))
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": ["".join(decoder.pieces((x or b"",))) for x in batch["ids"]]})

    return rows.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")
