"""Texts to ids of a public byte-level BPE vocabulary.

Pieces are found without regular expressions: code points become classes, classes become transition
functions of a small automaton, and the functions are composed over blocks of a whole batch, so that every
position knows its state. The slices are merged once per distinct piece and kept in a cache.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import dealt

#: Folder of the vocabulary files; a parameter of every function that reads one.
VOCABULARIES = "/opt/tokenizers"
DEFAULT = "byte_bpe_50k"
#: Code points that are worked through at once, and positions of a block of the scan.
CHUNK, BLOCK = 1 << 20, 256
#: Distinct pieces kept by a Python worker.
CACHE_PIECES = 1 << 20

# Symbols: letter, number, other, a space that goes with what follows, other white space before text, white
# space within a run or at the end, an apostrophe that opens a contraction of one or two letters, a border.
LETTER, NUMBER, OTHER, LEAD, LAST, SPACE, ONE, TWO, BORDER = range(9)
# States: nothing open, in letters, in numbers, in others, after a leading space, in white space, one or two letters of a contraction left.
FREE, IN_LETTER, IN_NUMBER, IN_OTHER, LED, IN_SPACE, LEFT1, LEFT2 = range(8)
#: Code points of white space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACE of each code point."""
    first = "".join(unicodedata.category(chr(c))[0] for c in range(0x110000))
    out = np.full(0x110000, OTHER, np.uint8)
    letters = np.frombuffer(first.encode("ascii"), np.uint8)
    out[letters == ord("L")] = LETTER
    out[letters == ord("N")] = NUMBER
    out[WHITE] = SPACE
    return out


@lru_cache(maxsize=1)
def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece starts, by symbol and state."""
    after, starts = np.zeros((9, 8), np.uint8), np.zeros((9, 8), bool)
    for state in range(8):
        for symbol, own, goes_on in ((LETTER, IN_LETTER, (IN_LETTER, LED)), (NUMBER, IN_NUMBER, (IN_NUMBER, LED)), (OTHER, IN_OTHER, (IN_OTHER, LED))):
            after[symbol, state], starts[symbol, state] = own, state not in goes_on
        for symbol, left in ((ONE, LEFT1), (TWO, LEFT2)):
            within = state in (IN_OTHER, LED)
            after[symbol, state], starts[symbol, state] = IN_OTHER if within else left, not within
        after[LEAD, state], starts[LEAD, state] = LED, True
        after[LAST, state], starts[LAST, state] = FREE, True
        after[SPACE, state], starts[SPACE, state] = IN_SPACE, state != IN_SPACE
        after[BORDER, state], starts[BORDER, state] = FREE, False
    after[LETTER, LEFT2], starts[LETTER, LEFT2] = LEFT1, False
    after[LETTER, LEFT1], starts[LETTER, LEFT1] = FREE, False
    return after, starts


def _symbols(codes: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Symbol of each position; border marks the positions between texts."""
    out = _classes()[codes]
    out[border] = BORDER
    n = len(out)
    nxt = np.empty(n, np.uint8)
    nxt[:-1], nxt[-1] = out[1:], BORDER
    white = out == SPACE
    before_text = white & (nxt != SPACE) & (nxt != BORDER)
    out[before_text] = LAST
    out[before_text & (codes == 32)] = LEAD
    at = np.flatnonzero(codes == 39)
    at = at[~border[at]]
    if len(at):
        code = lambda k: np.where(at + k < n, codes[np.minimum(at + k, n - 1)], 0)
        a, b = code(1), code(2)
        out[at[np.isin(a, [ord(c) for c in "sdmt"])]] = ONE
        pairs = a.astype(np.int64) << 32 | b
        out[at[np.isin(pairs, [ord(x) << 32 | ord(y) for x, y in ("ll", "ve", "re")])]] = TWO
    return out


def _states_before(symbols: np.ndarray) -> np.ndarray:
    """State before each position: the transition functions of each block are composed, all blocks beside one
    another, then applied from block to block, then within the blocks."""
    after = _automaton()[0].ravel()
    n = len(symbols)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, BORDER, np.int16)
    padded[:n] = symbols
    grid = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T) * np.int16(8)
    if blocks > 1:
        whole = np.repeat(np.arange(8, dtype=np.uint8)[:, None], blocks, axis=1)
        for row in grid:
            whole = after[row[None, :] + whole]
        entry = np.empty(blocks, np.uint8)
        state = FREE
        for k in range(blocks):
            entry[k] = state
            state = whole[state, k]
    else:
        entry = np.full(1, FREE, np.uint8)
    before = np.empty((BLOCK, blocks), np.uint8)
    now = entry
    for k, row in enumerate(grid):
        before[k] = now
        now = after[row + now]
    return before.T.ravel()[:n]


def piece_starts(texts: list[str]) -> list[np.ndarray]:
    """For each text, the positions in code points where its pieces start."""
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(joined):
        return [np.zeros(0, np.int64) for _ in texts]
    border = np.zeros(len(joined), bool)
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)])
    border[firsts[1:-1] - 1] = True
    symbols = _symbols(joined, border)
    at = np.flatnonzero(_automaton()[1].ravel()[symbols.astype(np.int16) * 8 + _states_before(symbols)])
    cuts = np.searchsorted(at, firsts)
    return [at[a:b] - f for a, b, f in zip(cuts[:-1], cuts[1:], firsts[:-1], strict=True)]


def read_ranks(name: str = DEFAULT, folder: str = VOCABULARIES) -> dict[bytes, int]:
    """Ranks of a vocabulary file in tiktoken's form."""
    lines = Path(folder, f"{name}.tiktoken").read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}


class Encoder:
    """Ids of texts by a byte-level BPE. Only merging within one piece is left to tiktoken."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self._merge = tiktoken.Encoding("own", pat_str=r"[\s\S]", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self._bytes = {v: k for k, v in ranks.items()}
        self._cache: dict[str, list[int]] = {}

    def _piece(self, piece: str) -> list[int]:
        ids = self._merge(piece.encode("utf-8", "replace"))
        if len(self._cache) >= CACHE_PIECES:
            self._cache.clear()
        self._cache[piece] = ids
        return ids

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty give an empty list."""
        return [ids for ids, _ in self.encode_with_offsets(texts)]

    def encode_with_offsets(self, texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Ids of each text and where its pieces start, in code points."""
        k = 0
        while k < len(texts):
            part, size = [], 0
            while k < len(texts) and (not part or size < CHUNK):
                part.append(texts[k] or "")
                size += len(part[-1]) + 1
                k += 1
            for text, starts in zip(part, piece_starts(part), strict=True):
                ids: list[int] = []
                known, new = self._cache.get, self._piece
                at = starts.tolist()
                for a, b in zip(at, [*at[1:], len(text)] if at else []):
                    piece = text[a:b]
                    ids += known(piece) or new(piece)
                yield ids, starts

    def decode(self, ids: list[int]) -> str:
        return b"".join(self._bytes[i] for i in ids).decode("utf-8", "replace")


#: Bytes of a vocabulary file up to which the driver sends it to the executors; 50,000 pieces are about 0.8 MB.
MOST_BYTES = 32 << 20
#: Encoders that a Python worker keeps, by the hash of their vocabulary.
KEPT_ENCODERS = 4
_ENCODERS: dict[str, Encoder] = {}


def _sent(spark, name: str, folder: str):
    """Broadcast of a vocabulary and the hash of its file, whose size is checked first."""
    path = Path(folder, f"{name}.tiktoken")
    size = path.stat().st_size
    if size > MOST_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than {MOST_BYTES} to send to each executor")
    return spark.sparkContext.broadcast((hashlib.sha256(path.read_bytes()).hexdigest(), read_ranks(name, folder)))


def _encoder(shared) -> Encoder:
    """The worker's encoder of a vocabulary that the driver sent. The file's hash tells vocabularies apart, whatever
    their names and folders are."""
    digest, ranks = shared.value
    if digest not in _ENCODERS:
        while len(_ENCODERS) >= KEPT_ENCODERS:
            _ENCODERS.pop(next(iter(_ENCODERS)))
        _ENCODERS[digest] = Encoder(ranks)
    return _ENCODERS[digest]


def encode_texts(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = DEFAULT, folder: str = VOCABULARIES, counts_only: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ids) of each row, or (id, n_tokens) with ``counts_only``, and the columns ``keep``.

    Null and empty texts have an empty list (0 tokens). Repeated rows give repeated results, a null id stays
    null; other columns are ignored. Texts are encoded whole, row by row, without a shuffle. The driver
    sends the vocabulary, a file of at most ``MOST_BYTES``, to the executors; its folder is a parameter.
    """
    spark = rows.sparkSession
    shared = _sent(spark, name, folder)
    kept = [(c, t) for c, t in rows.dtypes if c in keep]
    out = "n_tokens" if counts_only else "ids"
    schema = ", ".join([f"`{id_col}` {dict(rows.dtypes)[id_col]}", *(f"`{c}` {t}" for c, t in kept), f"{out} {'int' if counts_only else 'array<int>'}"])

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder = _encoder(shared)
        for b in batches:
            texts = b.column("_text").to_pylist()
            if counts_only:
                found = pa.array([len(x) for x, _ in coder.encode_with_offsets(texts)], pa.int32())
            else:
                sizes, flat = [0], []
                for ids, _ in coder.encode_with_offsets(texts):
                    flat.append(np.array(ids, np.int32))
                    sizes.append(sizes[-1] + len(ids))
                found = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)))
            names = [id_col, *(c for c, _ in kept)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), found], [*names, out])

    return dealt(rows.select(id_col, *(c for c, _ in kept), F.col(text_col).alias("_text"))).mapInArrow(encode, schema)
