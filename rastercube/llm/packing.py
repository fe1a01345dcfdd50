"""Sum-of-squares online packing of tokenised documents into fixed windows."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.common import record_batches

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
       "offset long")
CACHE_WORDS, CACHE_LENGTH = 400_000, 48
# Words of one encoder call, and bytes of the texts that are looked up together.
CALL_WORDS, LOOK_BYTES = 512, 1 << 22
# Letters whose lower case and normal form are the same everywhere, and the signs behind them.
LETTERS, SIGNS = "[A-Za-zÀ-ÖØ-öø-ÿªºµ]+", r"[!-/:-@\[-`{-~]"


def gather(values: np.ndarray, lengths: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs numbered ``index`` of ``values``, which holds runs of ``lengths`` one after another."""
    first, n = (np.cumsum(lengths) - lengths)[index], lengths[index]
    return values[np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)]


class WordIds(dict):
    """Pieces of text between blanks -> their ids as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words in order; words recur, so each is encoded once.  It
    lowers case and splits letters from other characters; for Latin-1 letters
    that is simple enough to be done here, so a word, its capitalised form and
    its forms before signs share an entry.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.old: dict = {}
        pieces = self.encoder.get_vocab()
        self.ends = np.zeros(max(pieces.values(), default=0) + 1, bool)
        self.ends[[i for piece, i in pieces.items() if piece.endswith("</w>")]] = True

    def keep(self, piece: str, ids: bytes) -> None:
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:  # pieces in use come back from the old half
                self.old = dict(self)
                self.clear()
            self[piece] = ids

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def pieces(self, pieces: pa.Array) -> list[bytes]:
        """The ids of distinct pieces.

        Those of letters only that the cache lacks are encoded many in one
        call, whose ids are parted where a piece ends.
        """
        names = pieces.to_pylist()
        got = list(map(self.get, names))
        lack = []
        for i in [i for i, ids in enumerate(got) if ids is None]:
            got[i] = self.old.get(names[i])
            if got[i] is None:
                lack.append(i)
            else:
                self.keep(names[i], got[i])
        whole = pc.match_substring_regex(pieces, f"^{LETTERS}$").to_numpy(zero_copy_only=False)
        letters = [i for i in lack if whole[i]]
        for at in range(0, len(letters), CALL_WORDS):
            some = letters[at: at + CALL_WORDS]
            ids = self.encode(" ".join([names[i] for i in some]))
            stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stops) == len(some) and stops[-1] == 4 * len(ids):
                raw = ids.tobytes()
                for i, lo, hi in zip(some, [0, *stops], stops):
                    got[i] = raw[lo:hi]
        for i in lack:
            if got[i] is None:
                got[i] = self.encode(names[i]).tobytes()
            self.keep(names[i], got[i])
        return got

    def ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (null: none)."""
        split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        tokens = split.flatten().dictionary_encode()
        words, index = tokens.dictionary, tokens.indices.to_numpy()
        if not len(words):
            return [b""] * len(texts)
        plain = pc.match_substring_regex(words, f"^{LETTERS}{SIGNS}*$")
        stem = pc.if_else(plain, pc.utf8_lower(pc.replace_substring_regex(words, f"{SIGNS}+$", "")), words)
        tail = pc.if_else(plain, pc.replace_substring_regex(words, f"^{LETTERS}", ""), "")
        both = pa.concat_arrays([stem, tail]).dictionary_encode()
        got = self.pieces(both.dictionary)
        length = np.fromiter(map(len, got), np.int64, len(got)) // 4
        part = both.indices.to_numpy().reshape(2, -1)
        ids = gather(np.frombuffer(b"".join(got), "<u4"), length, part.T.ravel())
        length = length[part].sum(axis=0)
        raw = gather(ids, length, index).tobytes()
        at = 4 * np.concatenate(([0], np.cumsum(length[index])))
        at = at[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]


_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """The worker's encoder for ``path``, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


class Levels:
    """Open windows by fill level; ``count[h]`` is N(h), the windows filled to exactly h."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]
        self.n_open = 0

    def choose(self, size: int) -> int:
        """The level whose use for ``size`` leaves the least sum of N(h) squared; of ties the fullest.

        Moving a window from h to h + size changes the sum by
        ``2 N(h + size) + 1 - (2 N(h) - 1)``; a fresh window gives up nothing,
        and a full one is closed and counts no more.
        """
        top = self.window - size
        cost = 2 * self.count[size:] + 1
        cost[top] = 0
        gain = 2 * self.count[: top + 1] - 1
        gain[0] = 0
        cost = np.where(gain < 0, np.iinfo(np.int64).max, cost - gain)
        return top - int(np.argmin(cost[::-1]))

    def place(self, size: int, piece: tuple) -> list | None:
        """Put ``piece`` into the chosen window; the window's pieces if that filled it."""
        h = self.choose(size)
        if h:
            held = self.open[h].pop()
            self.count[h] -= 1
            self.n_open -= 1
        else:
            held = []
        held.append(piece)
        if h + size == self.window:
            return held
        self.open[h + size].append(held)
        self.count[h + size] += 1
        self.n_open += 1
        return None

    def drain(self) -> Iterator[list]:
        """Close all open windows, each filled but the last.

        The windows stay as the rule made them, the fullest first; their gaps
        are filled from the emptiest ones, which are taken apart for it, their
        pieces cut where a gap ends.
        """
        held = deque(h for level in self.open for h in level)
        self.__init__(self.window)
        spare: list[tuple] = []
        while held or spare:
            row = held.pop() if held else []
            room = self.window - sum(len(p[2]) // 4 for p in row)
            while room and (spare or held):
                spare = spare or held.popleft()
                doc_id, start, ids, total = spare.pop()
                row.append((doc_id, start, ids[: 4 * room], total))
                if len(ids) > 4 * room:
                    spare.append((doc_id, start + room, ids[4 * room:], total))
                room -= len(row[-1][2]) // 4
            yield row


def packed(docs: Iterator[tuple], window: int, first: int, max_open: int) -> Iterator[tuple]:
    """Rows of :func:`pack` for ``(doc_id, ids as bytes)``; ``first`` is the first sequence's number."""
    levels, sequence = Levels(window), first

    def emit(pieces: list) -> Iterator[tuple]:
        nonlocal sequence
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset
            offset += len(ids) // 4
        sequence += 1

    for doc_id, ids in docs:
        total, whole = len(ids) // 4, len(ids) // 4 // window * window
        for start in range(0, whole, window):
            yield from emit([(doc_id, start, ids[4 * start: 4 * (start + window)], total)])
        if total > whole:
            full = levels.place(total - whole, (doc_id, whole, ids[4 * whole:], total))
            if full:
                yield from emit(full)
            elif levels.n_open > max_open:
                for pieces in levels.drain():
                    yield from emit(pieces)
    for pieces in levels.drain():
        yield from emit(pieces)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, max_open: int = 8192,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack whole documents into windows of ``window`` ids by the sum-of-squares rule.

    A document is its ids by the tokenizer file ``tokenizer`` followed by
    ``end_id``; a null or empty text is ``end_id`` alone, a null id stays
    null, repeated rows are packed once each, an empty table gives no rows,
    and other columns are left out.  Full windows of a document longer than a
    window stand alone; the rest is one item, which goes online into the fill
    level chosen by :class:`Levels` (ties: the fullest).  Each input partition
    packs its own documents, so nothing is shuffled and a lost task repeats
    its result.  At its end, or when ``max_open`` windows are open (16 KB each
    at most), the gaps of the fullest open windows are filled from the emptiest
    (:meth:`Levels.drain`): at most one window a partition (and drain) is padded.

    Returns a row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id (partition number times 2^40 plus a running number), offset.
    """
    if not 0 < window or max_open < 1:
        raise ValueError("window and max_open must be positive")
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, first = encoder(tokenizer), TaskContext.get().partitionId() << 40

        def documents() -> Iterator[tuple]:
            for batch in batches:
                doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
                size = np.cumsum(pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False)) // LOOK_BYTES
                cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(texts)]
                for lo, hi in zip(cuts, cuts[1:]):
                    for doc_id, ids in zip(doc_ids[lo:hi], words.ids(texts.slice(lo, hi - lo))):
                        yield doc_id, ids + end

        yield from record_batches(packed(documents(), window, first, max_open), SCHEMA)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, DDL)
