"""2. SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled into one transducer: the normaliser (a space becomes the mark U+2581, one mark goes before
the text), the pieces (a prefix tree from the start state back to it, whose last arc puts out the piece id) and byte
fallback (one arc per character, with the ids of its UTF-8 bytes, where no path of pieces leads). Its arcs are sorted
arrays of (state, character). It is composed with many inputs at a time, start position by start position, and the
tropical semiring's shortest path is kept for every position.

Weights of a unigram model are minus the scores. In a BPE model, scores are merge ranks, not costs, and the weight is on
neighbours instead: zero if the merges leave the two pieces side by side, infinite if they would join or cut them. A
sequence of pieces is the BPE result just when all neighbours are of weight zero, so the one path of finite weight is
the library's result. Weights of neighbours are worked out when first met and kept in a bounded memo.

No path crosses a place between two characters that stand side by side in no piece, so a text is cut there without
changing its shortest path, and the results of short pieces of text are kept in a bounded memo.

Defined results: null and empty texts have no ids; control pieces are never put out; the mark itself in a text is read
as a space, as the library reads it; equal weights prefer the longer last piece; whole texts count; rows that share an
id, or have none, are encoded each; an empty table gives no rows; other columns are not read, whatever their names.
Models with a character map in the normaliser are refused.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from phraseloom.llm.scratch import process_cache

MARK = "▁"
ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MEMO_CELLS = 120_000
LOT_CHARS = 1 << 20
LOT_ROWS = 1000
# Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
MEMO_PAIRS = 1_000_000


def wire_fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, raw[at : at + size]
        at += size


class PieceModel:
    """Pieces, scores and normaliser switches of a model file."""

    def __init__(self, path: str):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.dummy_prefix = self.remove_extra = True
        self.kind = UNIGRAM
        with open(path, "rb") as file:
            raw = file.read()
        for field, value in wire_fields(raw):
            if field == 1:
                own = dict(wire_fields(value))
                self.pieces.append(own.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
            elif field == 2:
                self.kind = dict(wire_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                own = dict(wire_fields(value))
                if own.get(2):
                    raise ValueError("the normaliser of this model has a character map")
                self.dummy_prefix, self.remove_extra = bool(own.get(3, 1)), bool(own.get(4, 1))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        # What each id decodes to.
        self.bytes = [
            b"" if k in (CONTROL, UNUSED) else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode()
            for p, k in zip(self.pieces, self.kinds)
        ]


class Transducer:
    """The compiled model: `keys` are state << 21 | character, sorted; `target` the state reached by each.

    `leaf[state]` is the piece id put out on returning to the start state, or -1; `weight[state]` its weight.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        arcs: dict[tuple[int, str], int] = {}
        leaf, weight, follows = [-1], [0.0], set()
        usable = [(p, i) for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in (NORMAL, USER) and p]
        for piece, i in usable:
            state = 0
            for c in piece:
                if (state, c) not in arcs:
                    arcs[(state, c)] = len(leaf)
                    leaf.append(-1)
                    weight.append(0.0)
                state = arcs[(state, c)]
            leaf[state], weight[state] = i, -model.scores[i]
            follows.update(zip(piece, piece[1:]))
        self.rank = {p: model.scores[i] for p, i in usable}
        self.single = np.array(sorted(ord(p) for p, _ in usable if len(p) == 1))
        self.apart: dict[int, bool] = {}
        ordered = sorted((s << 21 | ord(c), t) for (s, c), t in arcs.items())
        self.keys = np.array([k for k, _ in ordered], np.int64)
        self.target = np.array([t for _, t in ordered], np.int64)
        self.leaf, self.weight = np.array(leaf), np.array(weight)
        self.follows = follows
        # Characters without a piece cost more than any path of pieces over one character could.
        self.fallback = max((abs(s) for s, k in zip(model.scores, model.kinds) if k == NORMAL), default=0.0) + 10.0
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)

    def step(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The states reached, or -1."""
        wanted = states << 21 | chars
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.target[at], -1)

    def merged(self, text: str) -> list[str]:
        """The parts that merges leave of a short text: the best-ranked neighbours join first, the left of equals."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            found = [(-rank[p], k) for k, p in enumerate(map("".join, zip(parts, parts[1:]))) if p in rank]
            if not found:
                break
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def side_by_side(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merges leave the two pieces side by side; -1 on the left is a text's start or a fallback character."""
        keys, back = np.unique((left + 1) << 32 | right, return_inverse=True)
        if len(self.apart) > MEMO_PAIRS:
            self.apart = {}
        apart, pieces = self.apart, self.model.pieces
        answers = []
        for key in keys.tolist():
            answer = apart.get(key)
            if answer is None:
                a, b = (key >> 32) - 1, pieces[key & 0xFFFFFFFF]
                answer = apart[key] = self.merged(b) == [b] if a < 0 else self.merged(pieces[a] + b) == [pieces[a], b]
            answers.append(answer)
        return np.array(answers, bool)[back]

    def shortest(self, cells: list[str]) -> list[bytes]:
        """Ids on the shortest path over each (normalised) cell, as little-endian 32-bit integers."""
        out = [b""] * len(cells)
        sizes = np.array([len(c) for c in cells])
        widths = np.maximum(8, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        for width in np.unique(widths):
            own = np.flatnonzero(widths == width)
            for lot in np.array_split(own, max(1, len(own) * int(width) // (1 << 20))):
                self._shortest(cells, sizes, lot, out)
        return out

    def _shortest(self, cells: list[str], sizes: np.ndarray, lot: np.ndarray, out: list[bytes]) -> None:
        size = sizes[lot]
        chars = np.zeros((len(lot), int(size.max(initial=0))), np.int64)
        flat = np.frombuffer("".join([cells[i] for i in lot]).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars[np.arange(chars.shape[1]) < size[:, None]] = flat
        best = np.full((len(lot), chars.shape[1] + 1), np.inf)
        best[:, 0] = 0
        from_, piece = np.zeros(best.shape, np.int64), np.full(best.shape, -1)
        bpe = self.model.kind == BPE
        for i in range(chars.shape[1]):
            live = np.flatnonzero(size > i)
            # Byte fallback: one character, at its own weight.
            cost = best[live, i] + self.fallback
            take = cost < best[live, i + 1]
            if bpe:
                take &= ~np.isin(chars[live, i], self.single)
            own = live[take]
            best[own, i + 1], from_[own, i + 1], piece[own, i + 1] = cost[take], i, -1
            states, end = np.zeros(len(live), np.int64), i
            while len(live):
                states = self.step(states, chars[live, end])
                alive = states >= 0
                live, states = live[alive], states[alive]
                end += 1
                ends = self.leaf[states] >= 0
                own, at = live[ends], states[ends]
                if bpe:
                    take = self.side_by_side(piece[own, i], self.leaf[at])
                    cost = best[own, i]
                else:
                    cost = best[own, i] + self.weight[at]
                    take = cost < best[own, end]
                own, at = own[take], at[take]
                best[own, end], from_[own, end], piece[own, end] = cost[take], i, self.leaf[at]
                more = size[live] > end
                live, states = live[more], states[more]
        # Walk back from the end of every cell at once; -2 stands where a cell has no more pieces.
        rows, at, steps = np.arange(len(lot)), size.copy(), []
        while at.any():
            steps.append(np.where(at > 0, piece[rows, at], -2))
            at = np.where(at > 0, from_[rows, at], 0)
        path = np.stack(steps[::-1], 1) if steps else np.zeros((len(lot), 0), np.int64)
        taken = path >= 0
        raw = path[taken].astype("<i4").tobytes()
        ends = (4 * np.cumsum(taken.sum(1))).tolist()
        start = 0
        for i, end, plain in zip(lot.tolist(), ends, (path != -1).all(1).tolist()):
            out[i] = raw[start:end] if plain else b""
            start = end
        for row in np.flatnonzero((path == -1).any(1)).tolist():
            out[lot[row]] = self._with_fallback(cells[lot[row]], from_[row].tolist(), piece[row].tolist())

    def _with_fallback(self, cell: str, back: list[int], pieces: list[int]) -> bytes:
        path, at = [], len(cell)
        while at:
            if pieces[at] >= 0:
                path.append(pieces[at])
            else:
                raw = cell[at - 1].encode("utf-8", "surrogatepass")
                path += [self.byte_id.get(b, self.unknown) for b in reversed(raw)] if self.byte_id else [self.unknown]
            at = back[at]
        return np.array(path[::-1], "<i4").tobytes()


class PieceEncoder:
    """Encodes and decodes texts with a transducer and a bounded memo of cells."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.fst = Transducer(self.model)
        inner = any(a != MARK and b == MARK for a, b in self.fst.follows)
        newline = any("\n" in p for p, k in zip(self.model.pieces, self.model.kinds) if k in (NORMAL, USER))
        self.by_word, self.by_line = not inner, not newline
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def normalise(self, text: str) -> str:
        if self.model.remove_extra:
            text = " ".join(text.split(" ")).strip(" ") if "  " not in text else " ".join(p for p in text.split(" ") if p)
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def cells(self, text: str) -> list[str]:
        """The normalised text in cells that no piece crosses; a newline is a cell where no piece holds one."""
        text = self.normalise(text)
        if not text:
            return []
        out = []
        for k, line in enumerate(text.split("\n") if self.by_line else [text]):
            if k:
                out.append("\n")
            if not line:
                continue
            if not self.by_word:
                out.append(line)
                continue
            parts = line.split(MARK)
            if "" in parts[1:]:
                run = ""
                for j, part in enumerate(parts):
                    run += MARK if j else ""
                    if part:
                        out.append(run + part)
                        run = ""
                if run:
                    out.append(run)
            else:
                if parts[0]:
                    out.append(parts[0])
                out += [MARK + p for p in parts[1:]]
        return out

    def split(self, cell: str) -> list[str]:
        """A cell in parts, cut between characters that are side by side in no piece; words of letters stay whole."""
        follows, parts, start = self.fst.follows, [], 0
        if cell[1:].isalpha():
            return [cell]
        core = cell.rstrip(ASCII_MARKS)
        if core != cell and core[1:].isalpha() and (core[-1], cell[len(core)]) not in follows:
            return [core, cell[len(core) :]]
        for k, pair in enumerate(zip(cell, cell[1:]), 1):
            if pair not in follows:
                parts.append(cell[start:k])
                start = k
        parts.append(cell[start:])
        return parts

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers."""
        if len(self.memo) > MEMO_CELLS:
            self.memo, self.old = {}, self.memo
        lists = [self.cells(t) for t in texts]
        new = []
        for cell in set().union(*lists).difference(self.memo):
            if (ids := self.old.get(cell)) is None:
                new.append((cell, self.split(cell)))
            else:
                self.memo[cell] = ids
        memo = self.memo
        atoms = [a for a in {part for _, parts in new for part in parts} if a not in memo]
        memo.update(zip(atoms, self.fst.shortest(atoms)))
        for cell, parts in new:
            if len(parts) > 1:
                memo[cell] = b"".join([memo[p] for p in parts])
        get = memo.__getitem__
        return [b"".join(map(get, cells)) for cells in lists]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.model.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return raw[1:] if self.model.dummy_prefix and raw[:1] == " " else raw


def piece_encoder(path: str) -> PieceEncoder:
    cache = process_cache()
    if ("pieces", path) not in cache:
        cache[("pieces", path)] = PieceEncoder(path)
    return cache[("pieces", path)]


def lots(texts: list[str]) -> Iterator[list[str]]:
    lot, size = [], 0
    for text in texts:
        lot.append(text)
        size += len(text)
        if size >= LOT_CHARS:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, n_pieces and round_trip (whether the ids decode to the normalised text) of every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model)
        for batch in (whole.slice(k, LOT_ROWS) for whole in batches for k in range(0, len(whole), LOT_ROWS)):
            at = 0
            for lot in lots([t or "" for t in batch.column("text").to_pylist()]):
                raw = encoder.encode_many(lot)
                sizes = np.array([len(r) // 4 for r in raw], np.int64)
                values = np.frombuffer(b"".join(raw), np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = values.tolist()
                ends = offsets.tolist()
                plain = [encoder.normalise(t).replace(MARK, " ") for t in lot]
                skip = int(encoder.model.dummy_prefix)
                same = [encoder.decode(ids[a:b]) == p[skip:] for a, b, p in zip(ends, ends[1:], plain)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(lot)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(sizes), pa.array(same)],
                    ["doc_id", "ids", "n_pieces", "round_trip"],
                )
                at += len(lot)

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, ids array<int>, n_pieces bigint, round_trip boolean")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model)
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")
