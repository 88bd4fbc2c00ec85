"""Encoding with a public SentencePiece vocabulary: the N best segmentations of each text, and exact decoding."""

from __future__ import annotations

import heapq
import sys
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, groupby
from operator import add, itemgetter
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import kept_by_worker, query, table

SPACE = "▁"
#: Segmentations that are ranked for each text.
N_BEST = 3
#: Entries of a worker's tables of words and of runs; a table that is full starts anew. 100,000 of each take about 60 MB.
CACHE_SEGMENTS = 600_000
#: Longer ones are not kept.
KEEP_CHARS = 64
#: Rows that are passed on at once, and characters after which a batch of texts is closed.
ROWS, CHARS = 512, 1 << 20
#: Words or ids whose values are gathered at once.
GATHERED = 1 << 18


class Segmented(NamedTuple):
    """The best way to segment a run: its score, its ids, packed, and what the next best way loses (infinite if there is none)."""

    score: float
    ids: bytes
    loss: float
    run: str
    literal: bool


class Encoded(NamedTuple):
    """The best segmentations of a batch: ids of all texts, where each text's begin, scores, and of
    each text the N best as (loss, [(begin, end, packed ids that stand there instead)])."""

    ids: np.ndarray
    starts: np.ndarray
    scores: np.ndarray
    ways: list[list[tuple[float, list[tuple[int, int, bytes]]]]]


_SCORE, _IDS, _LOSS = itemgetter(0), itemgetter(1), itemgetter(2)


def _gather(pool: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """`counts` values of `pool` from each of `starts`, one after the other, made in blocks."""
    out = []
    for a in range(0, len(starts), GATHERED):
        begin, count = starts[a:a + GATHERED], counts[a:a + GATHERED]
        ends = np.cumsum(count)
        out.append(pool[np.repeat(begin - ends + count, count) + np.arange(ends[-1])])
    return np.concatenate(out) if out else pool[:0]


def spliced(packed: memoryview, width: int, begin: int, end: int, others: list[tuple[int, int, bytes]]) -> Iterator:
    """The bytes of ids `begin` to `end`, of `width` bytes each, with `others` in their places."""
    for a, b, other in others:
        yield packed[begin * width:a * width]
        yield other
        begin = b
    yield packed[begin * width:end * width]


class Words(dict):
    """Numbers of the words met; a new one is segmented. Score, least loss, and ids of all lie side by side in growing tables."""

    def __init__(self, lattice: Lattice):
        super().__init__()
        self.lattice = lattice
        self.entries: list[str] = []
        self.scores, self.losses, self.starts, self.counts = array("d"), array("d"), array("q"), array("q")
        self.ids = array(lattice.dtype.char)
        #: Segments of long words, which the batch would make twice.
        self.parts: dict[int, tuple[Segmented, ...]] = {}

    def __missing__(self, word: str) -> int:
        parts = self.lattice._parts(word)
        number = self[word] = len(self.entries)
        ids = b"".join(map(_IDS, parts))
        self.entries.append(word)
        self.scores.append(sum(map(_SCORE, parts)))
        self.losses.append(min(map(_LOSS, parts)))
        self.starts.append(len(self.ids))
        self.counts.append(len(ids) // self.lattice.dtype.itemsize)
        self.ids.frombytes(ids)
        if len(word) > KEEP_CHARS:
            self.parts[number] = parts
        return number

    def is_full(self) -> bool:
        """Whether the next batch begins with new tables: too many words, too many ids, or segments of long words."""
        cache = self.lattice.cache
        return len(self) >= cache or len(self.ids) >= 8 * cache or sum(map(len, self.parts.values())) >= cache


class Lattice:
    """Segmentations of a text into pieces, ranked by the sum of the pieces' scores.

    A space counts as `SPACE` and one stands before the text. A character that
    no piece stands for is written as its UTF-8 bytes, as is `SPACE` where it is
    part of the text, so decoding gives the text back. Between two
    characters that no piece holds side by side every segmentation has a cut; there
    the lattice falls apart into segments, which repeat and are kept. The best
    segmentations of a whole are picked from those of its segments.
    """

    def __init__(self, model: str, n_best: int = N_BEST, cache: int = CACHE_SEGMENTS):
        read = sentencepiece.SentencePieceProcessor(model_file=model)
        size = range(read.get_piece_size())
        self.n_best, self.cache = n_best, cache
        self.bytes = {int(read.id_to_piece(i)[1:-1], 16): i for i in size if read.is_byte(i)}
        #: Id, score and (as an arc has them) ids of each piece.
        self.pieces = {read.id_to_piece(i): (i, read.get_score(i), (i,)) for i in size if not (read.is_byte(i) or read.is_control(i) or read.is_unknown(i))}
        text_of = [b""] * len(size)
        for byte, i in self.bytes.items():
            text_of[i] = bytes([byte])
        for piece, (i, *_) in self.pieces.items():
            text_of[i] = piece.replace(SPACE, " ").encode()
        self.text_pool = np.frombuffer(b"".join(text_of), np.uint8)
        self.text_bytes = np.array([len(x) for x in text_of])
        self.text_starts = np.cumsum(self.text_bytes) - self.text_bytes
        self.dtype = np.dtype("<u2" if len(size) <= 1 << 16 else "<u4")
        #: Pieces by their characters: score and ids (None where no piece ends) and what may follow.
        self.trie = self._trie("", sorted(self.pieces))
        self.longest = max(map(len, self.pieces))
        self.pairs = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        #: Ten below the worst piece of a single character, for each byte of one that has no piece.
        self.byte_score = min(s for p, (_, s, _) in self.pieces.items() if len(p) == 1) - 10.0
        self.runs: dict[str, Segmented] = {}
        self.others: dict[tuple[str, bool], list[tuple[float, bytes]]] = {}
        self.words = Words(self)

    def _trie(self, prefix: str, pieces: list[str]) -> dict[str, tuple]:
        """What may follow `prefix` in the given pieces, which are sorted and begin with it."""
        depth, nodes = len(prefix), {}
        for char, group in groupby((p for p in pieces if len(p) > depth), lambda p: p[depth]):
            longer = list(group)
            _, score, ids = self.pieces.get(prefix + char, (None, 0.0, None))
            nodes[char] = score, ids, self._trie(prefix + char, longer)
        return nodes

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self.dtype.char, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _spell(self, char: str) -> tuple[tuple[int, ...], float]:
        data = char.encode()
        return tuple(self.bytes[b] for b in data), self.byte_score * len(data)

    def _arcs(self, run: str, literal: bool) -> tuple[list[float], list[list[tuple]]]:
        """Score of the best way to each place, and the arcs (start, score, ids) that end there."""
        n, longest, single = len(run), self.longest, self.pieces
        root = {} if literal else self.trie
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        arcs: list[list[tuple]] = [[] for _ in range(n + 1)]
        for i in range(n):
            here, node, j = best[i], root, i
            for char in run[i:i + longest]:
                if (found := node.get(char)) is None:
                    break
                own, ids, node = found
                j += 1
                if ids is not None:
                    arcs[j].append((i, own, ids))
                    best[j] = max(best[j], here + own)
            if literal or run[i] not in single:
                ids, own = self._spell(run[i])
                arcs[i + 1].append((i, own, ids))
                best[i + 1] = max(best[i + 1], here + own)
        return best, arcs

    def segment(self, run: str, literal: bool = False) -> Segmented:
        """The best way by forward scores, and the loss of the next best: every place keeps the scores of its two best ways."""
        n, longest, single = len(run), self.longest, self.pieces
        root = {} if literal else self.trie
        best, second = [float("-inf")] * (n + 1), [float("-inf")] * (n + 1)
        best[0] = 0.0
        chosen: list[tuple] = [()] * (n + 1)
        for i in range(n):
            here, below, node, j = best[i], second[i], root, i
            for char in run[i:i + longest]:
                if (found := node.get(char)) is None:
                    break
                own, ids, node = found
                j += 1
                if ids is None:
                    continue
                score = here + own
                if score > best[j]:
                    second[j] = max(best[j], below + own)
                    best[j], chosen[j] = score, (i, ids)
                elif score > second[j]:
                    second[j] = score
            if literal or run[i] not in single:
                ids, own = self._spell(run[i])
                score, j = here + own, i + 1
                if score > best[j]:
                    second[j] = max(best[j], below + own)
                    best[j], chosen[j] = score, (i, ids)
                elif score > second[j]:
                    second[j] = score
        path, taken = n, []
        while path:
            path, ids = chosen[path]
            taken.append(ids)
        return Segmented(best[n], self._pack(list(chain.from_iterable(reversed(taken)))), best[n] - second[n], run, literal)

    def ways(self, run: str, count: int, literal: bool = False) -> list[tuple[float, bytes]]:
        """The best `count` ways to segment a run, as (score, packed ids), by A* from its end, led by the exact scores of the best way from its start."""
        best, arcs = self._arcs(run, literal)
        ways: list[tuple[float, bytes]] = []
        # Entries: minus the score of the best whole that goes on from here, a number that puts the
        # latest first among equals, place, score of what follows, and what follows as nested pairs.
        pops, pushed = [0] * (len(run) + 1), 0
        queue: list[tuple] = [(-best[-1], 0, len(run), 0.0, None)]
        while queue and len(ways) < count:
            total, _, at, behind, tail = heapq.heappop(queue)
            if not at:
                ids: list[int] = []
                while tail:
                    ids += tail[0]
                    tail = tail[1]
                ways.append((-total, self._pack(ids)))
                continue
            if pops[at] == count:
                continue  # the best through a place leave it by its best ends, as many as are asked for
            pops[at] += 1
            for i, score, own in arcs[at]:
                pushed -= 1
                heapq.heappush(queue, (-(best[i] + score + behind), pushed, i, score + behind, (own, tail)))
        return ways

    def _others(self, part: Segmented) -> list[tuple[float, bytes]]:
        """What the next best ways of a segment lose, and their ids."""
        key = part.run, part.literal
        if (known := self.others.get(key)) is None:
            known = [(part.score - score, ids) for score, ids in self.ways(part.run, self.n_best, part.literal) if ids != part.ids][:self.n_best - 1]
            if len(part.run) <= KEEP_CHARS:
                if len(self.others) >= self.cache // 8:
                    self.others.clear()
                self.others[key] = known
        return known

    def _ranked(self, parts: list[Segmented]) -> list[tuple[float, dict[int, bytes]]]:
        """The N best wholes as (loss, other ids by the place of their part).

        Only the N - 1 parts whose second way loses least can differ from their best; the ways of those are made anew.
        """
        ranked: list[tuple[float, dict[int, bytes]]] = [(0.0, {})]
        for k in self._least(np.fromiter(map(_LOSS, parts), np.float64, len(parts))):
            wider = list(ranked)
            for lost, ids in self._others(parts[k]):
                wider += [(loss + lost, taken | {k: ids}) for loss, taken in ranked]
            ranked = sorted(wider, key=_SCORE)[:self.n_best]
        return ranked

    def _least(self, losses: np.ndarray) -> list[int]:
        """Places of the N - 1 smallest finite losses, the smallest first, earlier ones first among equals."""
        want = self.n_best - 1
        if want < 1 or not len(losses):
            return []
        bound = np.partition(losses, want - 1)[want - 1] if len(losses) > want else np.inf
        places = np.flatnonzero((losses <= bound) & (losses < np.inf))
        return places[np.argsort(losses[places], kind="stable")][:want].tolist()

    def _run(self, run: str) -> Segmented:
        if len(run) > KEEP_CHARS:
            return self.segment(run)
        if (known := self.runs.get(run)) is None:
            if len(self.runs) >= self.cache:
                self.runs.clear()
            known = self.runs[run] = self.segment(run)
        return known

    def _word(self, spaces: int, word: str) -> tuple[Segmented, ...]:
        """The segments of a word and the spaces before it."""
        parts, pairs = [], self.pairs
        for k, piece in enumerate(word.split(SPACE)):
            if k:
                parts.append(self.segment(SPACE, literal=True))
            text = piece if k else SPACE * spaces + piece
            start = 0
            for i, pair in enumerate(map(add, text, text[1:]), 1):
                if pair not in pairs:
                    parts.append(self._run(text[start:i]))
                    start = i
            if text:
                parts.append(self._run(text[start:]))
        return tuple(parts)

    def _parts(self, word: str) -> tuple[Segmented, ...]:
        """The segments of an entry of `_split`."""
        bare = word.lstrip(" ")
        return self._word(len(word) - len(bare) + 1, bare) if bare else (self._run(SPACE * len(word)),)

    @staticmethod
    def _split(text: str) -> list[str]:
        """The words of a text, each with the spaces before it but for one, and the spaces that end the text."""
        words = text.split(" ")
        if "" not in words:
            return words
        out, spaces = [], 0
        for word in words if text else ():
            if word:
                out.append(" " * spaces + word)
                spaces = 0
            else:
                spaces += 1
        return [*out, " " * spaces] if spaces else out

    def encode_batch(self, texts: list[str]) -> Encoded:
        """The best segmentations of many texts; tables of words and numpy do the work of all texts at once."""
        words = self.words
        number, seen, bounds = words.__getitem__, array("q"), [0]
        for text in texts:
            seen.extend(map(number, self._split(text)))
            bounds.append(len(seen))
        at = np.frombuffer(seen, np.int64)
        counts = np.frombuffer(words.counts, np.int64)[at]
        ids = _gather(np.frombuffer(words.ids, self.dtype), np.frombuffer(words.starts, np.int64)[at], counts)
        begins = np.r_[0, np.cumsum(counts)]
        starts = np.array(bounds)
        scores = np.zeros(len(texts))
        filled = np.flatnonzero(np.diff(starts))
        if len(filled):
            scores[filled] = np.add.reduceat(np.frombuffer(words.scores, np.float64)[at], starts[filled])
        losses = np.frombuffer(words.losses, np.float64)[at]
        ways = []
        for a, b in zip(bounds, bounds[1:]):
            parts, places = [], []
            # A part among the N - 1 that lose least lies in one of the N - 1 words that lose least.
            for k in sorted(self._least(losses[a:b])):
                begin = int(begins[a + k])
                for part in words.parts.get(seen[a + k]) or self._parts(words.entries[seen[a + k]]):
                    parts.append(part)
                    places.append((begin, begin := begin + len(part.ids) // self.dtype.itemsize))
            ways.append([(loss, sorted((*places[k], other) for k, other in taken.items())) for loss, taken in self._ranked(parts)])
        if words.is_full():
            self.words = Words(self)
        return Encoded(ids, begins[starts], scores, ways)

    def encode(self, text: str) -> tuple[bytes, float, list[tuple[float, bytes]]]:
        """Packed ids and score of the best segmentation, and (score, packed ids) of the N best, the best first."""
        done = self.encode_batch([text])
        score, packed = float(done.scores[0]), done.ids.tobytes()
        ranked = [(score - loss, b"".join(spliced(memoryview(packed), self.dtype.itemsize, 0, len(done.ids), others))) for loss, others in done.ways[0]]
        return packed, score, ranked

    def decode(self, ids) -> bytes:
        """UTF-8 of a text from its ids: the piece that opens it gives up the space that stands before the text."""
        return self.decode_batch(np.asarray(ids, np.int64))[0][1:]

    def decode_batch(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, spaces before texts included, and where each id's begin and the last's end."""
        counts = self.text_bytes[ids]
        return _gather(self.text_pool, self.text_starts[ids], counts).tobytes(), np.r_[0, np.cumsum(counts)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def worker_lattice(model: str, n_best: int, cache: int = CACHE_SEGMENTS) -> Lattice:
    """The lattice of this Python worker, kept between its tasks for the sake of its tables."""
    return kept_by_worker(f"lattice {model} {n_best} {cache}", lambda: Lattice(model, n_best, cache))


_MADE = ("ids", "n_tokens", "score", "nbest", "round_trip")
_RANKED = pa.list_(pa.struct([("score", pa.float64()), ("n_tokens", pa.int32()), ("ids_crc32", pa.int64())]))


def _batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    """First and last place of runs of texts that are closed once they hold `CHARS` characters."""
    begin, chars = 0, 0
    for i, text in enumerate(texts, 1):
        chars += len(text)
        if chars >= CHARS or i == len(texts):
            yield begin, i
            begin, chars = i, 0


def _columns(lattice: Lattice, texts: list[str]) -> list[pa.Array]:
    """The columns `_MADE` of some texts."""
    done = lattice.encode_batch(texts)
    wide = memoryview(done.ids.astype("<u4")).cast("B")
    read, ends = lattice.decode_batch(done.ids)
    starts = done.starts.tolist()
    # Without the space that stands before a text.
    whole = [read[a + 1:b] == text.encode() for a, b, text in zip(ends[done.starts[:-1]].tolist(), ends[done.starts[1:]].tolist(), texts)]
    losses, counts, sums, ranks = [], [], [], [0]
    for a, b, ways in zip(starts, starts[1:], done.ways):
        for loss, others in ways:
            crc, size = 0, 0
            for part in spliced(wide, 4, a, b, [(i, j, np.frombuffer(x, lattice.dtype).astype("<u4").tobytes()) for i, j, x in others]):
                crc, size = zlib.crc32(part, crc), size + len(part)
            losses.append(loss)
            counts.append(size // 4)
            sums.append(crc)
        ranks.append(len(losses))
    ranked = np.repeat(done.scores, np.diff(ranks)) - np.array(losses)
    best = pa.StructArray.from_arrays([pa.array(ranked, pa.float64()), pa.array(counts, pa.int32()), pa.array(sums, pa.int64())], fields=list(_RANKED.value_type))
    return [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(done.ids.astype(np.int32))), pa.array(np.diff(done.starts).astype(np.int32)),
            pa.array(done.scores, pa.float64()), pa.ListArray.from_arrays(pa.array(ranks, pa.int32()), best), pa.array(whole, pa.bool_())]


def encode_texts(df: DataFrame, text: str, model: str, n_best: int = N_BEST, cache: int = CACHE_SEGMENTS) -> DataFrame:
    """`df` with ids (array<int>), n_tokens, score, nbest (score, n_tokens, CRC-32 of the ids as little-endian
    unsigned 32-bit numbers) and round_trip: whether decoding the ids gives the text back.

    nbest is ranked from the best down and holds fewer than `n_best` entries
    where there are no more ways; ties keep the earlier choice. Texts are encoded whole and row by row;
    a null or empty text has no ids, score 0 and one (empty) way. Columns of
    these names are replaced. `cache` bounds what a Python worker keeps of words it has met; it changes no result.
    """
    kept = [c for c in df.columns if c not in _MADE]
    place = kept.index(text)
    plain = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    schema = ", ".join(f"c{i} {plain.schema[i].dataType.simpleString()}" for i in range(len(kept)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = worker_lattice(model, n_best, cache)
        for batch in _slices(batches):
            texts = [value or "" for value in batch.column(place).to_pylist()]
            for a, b in _batches(texts):
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *_columns(lattice, texts[a:b])], [*[f"c{i}" for i in range(len(kept))], *_MADE])

    out = plain.mapInArrow(encode, f"{schema}, ids array<int>, n_tokens int, score double, nbest array<struct<score:double,n_tokens:int,ids_crc32:bigint>>, round_trip boolean")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *_MADE)


def decode_ids(df: DataFrame, ids: str, model: str, out: str = "decoded") -> DataFrame:
    """`df` with the text of each row's ids; null ids give null, no ids the empty text."""
    kept = [c for c in df.columns if c != out]
    place = kept.index(ids)
    plain = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    schema = ", ".join(f"c{i} {plain.schema[i].dataType.simpleString()}" for i in range(len(kept)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = worker_lattice(model, 1)
        for batch in _slices(batches):
            lists = batch.column(place)
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_pylist()
            texts = [lattice.decode(flat[a:b]).decode(errors="replace") if ok else None for a, b, ok in zip(offsets, offsets[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*[f"c{i}" for i in range(len(kept))], "t"])

    done = plain.mapInArrow(decode, f"{schema}, t string")
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.col("t").alias(out))


@query("op4_sentencepiece")
def op4_sentencepiece(spark, sf):
    """Every document's best segmentation, the scores of the next best, and the round trip."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return encode_texts(docs, "text", public_tokenizers.path("piece_bpe_32k.model")).drop("text")
