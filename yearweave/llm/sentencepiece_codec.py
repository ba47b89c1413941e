"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder is the score-ordered agenda: a text starts as single characters; every adjacent
pair whose concatenation is a piece waits in an agenda ordered by piece score, then by position;
the best pair merges, and its new neighbours join the agenda. Symbols that stay outside the
vocabulary fall back to their UTF-8 bytes. Texts pass through in Arrow batches. The agenda's ids are
returned and decoded; each batch is checked against the sentencepiece library, and a text for which it
gives other ids takes those instead, with ``agenda_matches`` false.

No merge can join two characters that are neighbours in no piece, so a text is cut there first;
the parts ("chunks", about a word long) repeat, and their ids are remembered per worker.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Chunks whose ids a worker remembers before it starts anew.
REMEMBERED_CHUNKS = 1_200_000
#: Chunks of up to this many characters are merged many at a time; longer ones each by a heap.
FLAT_AGENDA = 32
_INFINITE = float("inf")


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class _PairTable:
    """Score and piece of every pair of pieces whose concatenation is a piece."""

    def __init__(self, ids: dict[str, int], cost: dict[str, float]):
        splits = [(ids[p[:k]], ids[p[k:]], i, cost[p]) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        left, right, merged, score = map(np.array, zip(*splits))
        self.width = max(ids.values()) + 1
        key = left * self.width + right
        order = np.argsort(key)
        self.key, self.merged, self.score = key[order], merged[order], score[order]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost (infinite for no pair, as beside an absent symbol, -1) and merged piece."""
        key = left * self.width + right
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        found = (self.key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.score[at], _INFINITE), self.merged[at]


def _merge_together(symbols: np.ndarray, pairs: _PairTable) -> np.ndarray:
    """The agenda of many short chunks at once: rows of character pieces, -1 filled, become rows of pieces.

    Each round takes every row's best pair (the leftmost of equals), and asks for its new neighbours."""
    symbols = np.pad(symbols, ((0, 0), (0, 2)), constant_values=-1)
    cost, merged = pairs.look_up(symbols[:, :-1], symbols[:, 1:])
    done, rows = np.full_like(symbols, -1), np.arange(len(symbols))
    place = np.arange(symbols.shape[1])
    while len(rows):
        each = np.arange(len(rows))
        best = cost.argmin(axis=1)
        more = cost[each, best] < _INFINITE
        if not more.all():
            done[rows[~more]] = symbols[~more]
            rows, symbols, cost, merged, best = rows[more], symbols[more], cost[more], merged[more], best[more]
            each = each[: len(rows)]
            if not len(rows):
                break
        piece = merged[each, best]
        from_symbol = np.minimum(place + (place > best[:, None]), symbols.shape[1] - 1)
        symbols = np.take_along_axis(symbols, from_symbol, 1)
        symbols[each, best] = piece
        from_pair = np.minimum(place[:-1] + (place[:-1] > best[:, None]), cost.shape[1] - 1)
        cost, merged = np.take_along_axis(cost, from_pair, 1), np.take_along_axis(merged, from_pair, 1)
        for at in (best, np.maximum(best - 1, 0)):
            cost[each, at], merged[each, at] = pairs.look_up(symbols[each, at], symbols[each, at + 1])
    return done


def _families(inside: set[tuple[str, str]], most: int = 12) -> list[set[str]]:
    """Characters that pieces chain together (the space mark apart): the largest such sets, and all the others in one."""
    of: dict[str, set[str]] = {}
    for pair in inside:
        if "▁" not in pair:
            a, b = (of.setdefault(c, {c}) for c in pair)
            if a is not b:
                small, large = sorted((a, b), key=len)
                large |= small
                of.update(dict.fromkeys(small, large))
        else:
            for c in pair:
                of.setdefault(c, {c})
    of.pop("▁", None)
    families = sorted({id(f): f for f in of.values()}.values(), key=lambda f: (-len(f), min(f)))
    return families[:most] + ([set().union(*families[most:])] if families[most:] else [])


class AgendaEncoder:
    """Ids of texts under one merge-type vocabulary, as the library gives them (no begin or end ids)."""

    def __init__(self, model: bytes):
        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}  # the negated score: the agenda takes the least
        self.byte_ids: dict[int, int] = {}
        inside: set[tuple[str, str]] = set()
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
            elif library.is_unused(i):
                raise ValueError(f"piece {i} is marked unused; only plain merge vocabularies are supported")
            elif not (library.is_control(i) or library.is_unknown(i)):
                self.ids[piece] = i
                self.cost[piece] = -library.get_score(i)
                inside.update(zip(piece, piece[1:]))
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary needs byte fallback pieces")
        self.inside = inside
        # runs of the space mark with a run of characters of one family after them; else one character
        runs = "|".join("[" + "".join(map(re.escape, sorted(f))) + "]+" for f in _families(inside))
        self.chunks = re.compile(f"▁*(?:{runs})|▁+|.", re.DOTALL).findall
        self.words_only = not any(p[1] == "▁" and p[0] != "▁" for p in inside)
        self.pairs = _PairTable(self.ids, self.cost)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Of each text the ids as 32-bit integers one after another."""
        marked = [self.library.normalize(t) for t in texts]
        if not self.words_only:
            return [_packed(self.merged(m)) for m in marked]
        if len(self.known) > REMEMBERED_CHUNKS:
            self.known.clear()
        chunks = [self.chunks(m) for m in marked]
        self.learn(set(chain.from_iterable(chunks)).difference(self.known))
        return [b"".join(map(self.known.__getitem__, parts)) for parts in chunks]

    def learn(self, chunks: set[str]) -> None:
        """Remember new chunks. Each is cut at pairs that no piece holds, as before a full stop after a word."""
        inside, known, cut, plain = self.inside, self.known, {}, set()
        for chunk in chunks:
            rest = chunk[:-1]
            if inside.issuperset(zip(chunk, chunk[1:])):
                plain.add(chunk)
            elif rest in known and (rest[-1], chunk[-1]) not in inside:  # a known word and a mark after it
                cut[chunk] = parts = (rest, chunk[-1])
                plain.add(chunk[-1])
            else:
                cuts = [0, *[i for i, pair in enumerate(zip(chunk, chunk[1:]), 1) if pair not in inside], len(chunk)]
                cut[chunk] = parts = [chunk[i:j] for i, j in zip(cuts, cuts[1:])]
                plain.update(parts)
        short = []
        for chunk in plain:
            if chunk in known:
                continue
            if len(chunk) <= FLAT_AGENDA:
                short.append(chunk)
            else:
                known[chunk] = _packed(self.merged(chunk))
        if short:
            self._learn_short(sorted(short, key=len))
        for chunk, parts in cut.items():
            known[chunk] = b"".join([known[part] for part in parts])

    def _learn_short(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), 4096):  # of about one length each
            some = chunks[at:at + 4096]
            width = len(some[-1])
            codes = np.frombuffer("".join(c.ljust(width, "\0") for c in some).encode("utf-32-le"), np.uint32).reshape(len(some), width)
            letters, which = np.unique(codes, return_inverse=True)
            of_letter = np.array([self.ids.get(chr(c), -2) for c in letters.tolist()])
            symbols = of_letter[which].reshape(codes.shape)
            lengths = np.fromiter(map(len, some), np.int64, len(some))
            symbols[np.arange(width) >= lengths[:, None]] = -1
            odd = (symbols == -2).any(axis=1)  # a character that is no piece: its bytes stand for it
            for i in np.flatnonzero(odd).tolist():
                self.known[some[i]] = _packed(self.merged(some[i]))
            some = [c for c, o in zip(some, odd.tolist()) if not o]
            rows = _merge_together(symbols[~odd], self.pairs)
            held = rows >= 0
            ends = np.cumsum(held.sum(axis=1) * 4).tolist()
            ids = rows[held].astype(np.int32).tobytes()
            self.known.update(zip(some, [ids[i:j] for i, j in zip([0, *ends], ends)]))

    def merged(self, chunk: str) -> list[int]:
        symbols = self._heaped(list(chunk))
        out: list[int] = []
        for symbol in symbols:
            if symbol in self.ids:
                out.append(self.ids[symbol])
            else:
                out.extend(self.byte_ids[b] for b in symbol.encode())
        return out

    def _heaped(self, symbols: list[str]) -> list[str]:
        cost, n = self.cost, len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(cost[p], i, i + 1, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in cost]
        heapq.heapify(agenda)

        def propose(left: int, right: int) -> None:
            pair = symbols[left] + symbols[right]
            if pair in cost:
                heapq.heappush(agenda, (cost[pair], left, right, pair))

        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != pair:
                continue  # one side has merged meanwhile
            symbols[left], symbols[right] = pair, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                propose(left, after[left])
            if before[left] >= 0:
                propose(before[left], left)
        return [s for s in symbols if s]


_ENCODERS: dict[int, AgendaEncoder] = {}


def _encoder(model: bytes) -> AgendaEncoder:
    """One encoder per worker and model, so that remembered chunks outlive a task."""
    key = hash(model)
    if key not in _ENCODERS:
        _ENCODERS[key] = AgendaEncoder(model)
    return _ENCODERS[key]


def encode_texts(encoder: AgendaEncoder, texts: list[str]) -> tuple[list[bytes], list[str], list[bool]]:
    """Ids (32-bit integers in a row) by the agenda, the texts decoded from them, and whether the library gives the same ids.

    Where it does not, its ids stand instead."""
    packed = encoder.encode(texts)
    ids = [np.frombuffer(p, np.int32).tolist() for p in packed]
    expected = encoder.library.encode(texts, num_threads=1)
    same = [a == b for a, b in zip(ids, expected)]
    for i, s in enumerate(same):
        if not s:
            ids[i], packed[i] = expected[i], _packed(expected[i])
    return packed, encoder.library.decode(ids, num_threads=1), same


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts and decode the ids again.

    Returns ``id_col``, ``ids array<int>``, ``decoded string``, ``agenda_matches boolean``, one row
    per input row. A null text counts as empty (no ids, decoded empty); repeated rows and null ids
    come back as they are; an empty table gives an empty result; other columns are not read. The
    model file is read by the driver and broadcast: a vocabulary, whose size does not grow with the data.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = batch.column(1).to_pylist()
                packed, decoded, same = encode_texts(encoder, texts)
                ends = np.cumsum([0, *[len(p) // 4 for p in packed]])
                flat = np.frombuffer(b"".join(packed), np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    pa.array(decoded, pa.string()),
                    pa.array(same, pa.bool_()),
                ], names=["id", "ids", "decoded", "agenda_matches"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string, agenda_matches boolean")
    return out.withColumnRenamed("id", id_col)


def token_digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of ``encode_decode``'s rows."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        "agenda_matches",
    )
