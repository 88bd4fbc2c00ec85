"""Alignment of two tokenizers over the same texts, and how often their tokens end together in the whole corpus."""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexmill.llm.common import kept_by_worker, query, table
from lexmill.llm.tokenfiles import _byte_letters
from lexmill.session import stage

#: Characters of text whose windows share one numbering, at most.
BLOCK_BYTES = 16 << 20
#: Bytes of text that are tokenised at once.
CALL_BYTES = 1 << 20
#: Windows that a Python worker remembers; where there are more, its block ends and it forgets them all. 100,000 take about 35 MB.
MEMO_WINDOWS = 200_000
_STOP = 0xFFFF


class Vocabulary(NamedTuple):
    """encode (texts to arrays of ids), bytes of each id, their lengths, and whether they begin with a space."""

    encode: Callable[[list[str]], list[np.ndarray]]
    tokens: list[bytes]
    lengths: np.ndarray
    spaced: np.ndarray

    @classmethod
    def of(cls, encode: Callable[[list[str]], list[np.ndarray]], tokens: list[bytes]) -> Vocabulary:
        if len(tokens) > _STOP:
            raise ValueError("ids need two bytes")
        return cls(encode, tokens, np.array([len(t) for t in tokens], np.int64), np.array([t[:1] == b" " for t in tokens]))


#: Beyond these characters, and in longer texts, only the tokenizers library itself is asked.
_COMMON = re.compile("[\0-\u024f]*")
_COMMON_CHARS = 1 << 20


def byte_level(path: str, ranks: str | None = None) -> Vocabulary:
    """A byte-level BPE of the tokenizers library, over a space and the text; strings of special tokens are plain text.

    `ranks` names the same vocabulary as ranks for tiktoken, which gives the same ids in a third of the time; it is asked for texts
    of Latin letters, whose classes both split alike.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    byte_of = {letter: byte for byte, letter in _byte_letters().items()}
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    tokens = [bytes(byte_of[c] for c in n) if all(c in byte_of for c in n) else n.encode() for n in names]
    fast = None
    if ranks:
        with open(ranks, "rb") as file:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def encode(texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            if fast and len(text) <= _COMMON_CHARS and _COMMON.fullmatch(text):
                out.append(fast.encode_to_numpy(f" {text}", disallowed_special=()).astype(np.uint16))
            else:
                out.append(np.array(tokenizer.encode(f" {text}", add_special_tokens=False).ids, np.uint16))
        return out

    return Vocabulary.of(encode, tokens)


def pieces(path: str) -> Vocabulary:
    """A SentencePiece model with byte fallback, which puts a space before the text itself."""
    read = sentencepiece.SentencePieceProcessor(model_file=path)
    size = range(read.get_piece_size())
    tokens = [bytes([int(read.id_to_piece(i)[1:-1], 16)]) if read.is_byte(i) else read.id_to_piece(i).replace("▁", " ").encode() for i in size]
    return Vocabulary.of(lambda texts: [np.array(ids, np.uint16) for ids in read.encode(texts, num_threads=1)], tokens)


_DIGITS = np.array([list(str(i).ljust(5).encode()) for i in range(1 << 16)], np.uint8)
_N_DIGITS = (_DIGITS != ord(" ")).sum(axis=1)


def align_windows(a: Vocabulary, b: Vocabulary, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts two runs of ids over the same bytes wherever both have an end.

    Returns the groups as text (`a1,a2|b1;` and so on) in bytes; for each group, the place in that text behind it and the number
    of A ids up to its end; and the (A, B) ids that end together. Windows that follow each other can be aligned as one run.
    """
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    mark_a, mark_b = np.zeros((2, int(ends_a[-1]) + 1), bool)
    mark_a[ends_a] = mark_b[ends_b] = True
    last_a, last_b = mark_b[ends_a], mark_a[ends_b]
    until_a, until_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    order_a = np.arange(len(ids_a)) + np.r_[0, until_b][group_a]
    order_b = np.arange(len(ids_b)) + until_a[group_b]
    ids, marks = np.empty(len(ids_a) + len(ids_b), np.uint16), np.empty(len(ids_a) + len(ids_b), np.uint8)
    ids[order_a], ids[order_b] = ids_a, ids_b
    marks[order_a], marks[order_b] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
    sizes = _N_DIGITS[ids] + 1
    behind = np.cumsum(sizes)
    text = np.empty(int(behind[-1]), np.uint8)
    text[behind - 1] = marks
    for k in range(5):
        has = sizes > k + 1
        text[(behind - sizes)[has] + k] = _DIGITS[ids[has], k]
    return text, behind[until_a + until_b - 1], until_a, np.stack([ids_a[last_a], ids_b[last_b]], axis=1)


class _Memo(dict):
    """Number of each window by its ids (A, a stop, B, two bytes each), with the groups and the links of each number."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        self.groups: list[str] = []
        #: (A, B) ids that end together, two bytes each.
        self.links: list[bytes] = []

    def numbers(self, keys: list[bytes]) -> list[int]:
        """Numbers of some windows; new ones are aligned, all in one run."""
        new = [k for k in dict.fromkeys(keys) if k not in self]
        if new:
            ids = np.frombuffer(b"".join(new), np.uint16)
            ends = np.cumsum([len(k) // 2 for k in new])
            stops = np.flatnonzero(ids == _STOP)
            side = np.zeros(len(ids), np.int64)
            side[stops] = 1
            side[ends[:-1]] -= 1
            first = np.cumsum(side) == 0
            second = ~first
            second[stops] = False
            text, behind, until_a, links = align_windows(self.a, self.b, ids[first], ids[second])
            # The last A id of a window stands before the stop, and closes its last group.
            counts = np.searchsorted(until_a, stops - np.r_[0, (ends - stops)[:-1]].cumsum(), side="right")
            data, pairs = text.tobytes().decode(), links.tobytes()
            at, place = 0, 0
            for key, count, end in zip(new, counts.tolist(), behind[counts - 1].tolist()):
                self[key] = len(self.groups)
                self.groups.append(data[at:end])
                self.links.append(pairs[4 * place:4 * count])
                at, place = end, count
        return list(map(self.__getitem__, keys))

    def forget(self) -> None:
        self.clear()
        self.groups.clear()
        self.links.clear()


def _joined(tokens: list[bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def _windows(a: Vocabulary, b: Vocabulary, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """Keys of all windows of some texts in turn, and how many each text has.

    Both sides spell the same bytes. A window starts where a text does, and wherever a token
    that begins with a space starts on both sides, which is where both sides have just had an end.
    """
    flat_a, flat_b = np.concatenate(ids_a), np.concatenate(ids_b)
    ends_a, ends_b = np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b])
    starts_a, starts_b = ends_a - a.lengths[flat_a], ends_b - b.lengths[flat_b]
    firsts = np.r_[0, np.cumsum([len(ids) for ids in ids_a])]
    mark_a, mark = np.zeros((2, int(ends_a[-1]) + 1), bool)
    mark_a[starts_a[a.spaced[flat_a]]] = True
    spaced_b = starts_b[b.spaced[flat_b]]
    mark[spaced_b[mark_a[spaced_b]]] = True
    mark[starts_a[firsts[:-1]]] = True
    cut_a, cut_b = np.flatnonzero(mark[starts_a]), np.flatnonzero(mark[starts_b])
    many_a, many_b = np.diff(np.r_[cut_a, len(flat_a)]), np.diff(np.r_[cut_b, len(flat_b)])
    number = np.arange(len(cut_a))
    both = np.full(len(flat_a) + len(flat_b) + len(cut_a), _STOP, np.uint16)
    both[np.arange(len(flat_a)) + np.repeat(cut_b + number, many_a)] = flat_a
    both[np.arange(len(flat_b)) + np.repeat(cut_a + many_a + number + 1, many_b)] = flat_b
    starts = 2 * (cut_a + cut_b + number)
    data = both.tobytes()
    keys = [data[s:e] for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(data)])]
    return keys, np.diff(np.searchsorted(cut_a, firsts))


class _Block:
    """Texts met so far, their windows, and how the block is passed on."""

    def __init__(self, memo: _Memo):
        self.memo, self.rows, self.numbers, self.size = memo, [], [], 0

    def add(self, ids: list, texts: list[str | None], keep_groups: bool) -> None:
        a, b = self.memo.a, self.memo.b
        filled = [i for i, t in enumerate(texts) if t]
        own = [texts[i] for i in filled]
        tokens = list(zip(filled, own, a.encode(own), b.encode(own)))
        sound = []
        for i, text, one, two in tokens:
            whole = f" {text}".encode()
            if _joined(a.tokens, one) == whole and _joined(b.tokens, two) == whole:
                sound.append((i, one, two))
        made = dict.fromkeys(range(len(texts)), (0, 0, 0, "", None, np.zeros(0, np.int64)))
        if sound:
            keys, counts = _windows(a, b, [s[1] for s in sound], [s[2] for s in sound])
            numbers, at = self.memo.numbers(keys), 0
            for (i, one, two), n in zip(sound, counts.tolist()):
                mine = numbers[at:at + n]
                at += n
                groups = "".join(map(self.memo.groups.__getitem__, mine))[:-1]
                n_groups = groups.count(";") + 1
                made[i] = (len(one), len(two), n_groups, hashlib.sha256(groups.encode()).hexdigest(), groups if keep_groups else None, np.array(mine))
        for i, key in enumerate(ids):
            *row, numbers = made[i]
            self.rows.append((key, *row))
            self.numbers.append(numbers)
        self.size += sum(len(t) for t in own)

    def passed_on(self, block: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Rows of the documents, one of the windows and one for each pair of ids; then the block is empty again."""
        memo = self.memo
        flat = np.concatenate([*self.numbers, np.zeros(0, np.int64)]).astype(np.int64)
        times = np.bincount(flat, minlength=len(memo.groups))
        used = np.flatnonzero(times)
        place = np.zeros(len(memo.groups), np.int64)
        place[used] = np.arange(len(used))
        links = [memo.links[k] for k in used.tolist()]
        sizes = np.array([len(x) // 4 for x in links], np.int64)
        pairs, pair_numbers = np.unique(np.frombuffer(b"".join(links), np.uint32), return_inverse=True)
        n = np.bincount(pair_numbers, weights=np.repeat(times[used], sizes), minlength=len(pairs)).astype(np.int64)
        pairs = pairs.view(np.uint16).reshape(-1, 2).astype(np.int32)
        width = 2 if len(used) <= 1 << 16 else 4
        codes = [place[k].astype(f"<u{width}").tobytes() for k in self.numbers]
        nothing = {c: None for c in _NAMES[1:]}
        yield _rows([nothing | {"kind": 1, "block": block, "codes": pair_numbers.astype("<u4").tobytes(), "sizes": sizes.astype("<u4").tobytes()}], id_type)
        step = 4096
        for i in range(0, len(self.rows), step):
            part = self.rows[i:i + step]
            yield _rows([nothing | dict(zip(("doc", "n_a", "n_b", "n_groups", "groups_sha256", "groups"), r)) | {"kind": 2, "block": block, "width": width, "codes": c}
                         for r, c in zip(part, codes[i:i + step])], id_type)
        for i in range(0, len(pairs), 1 << 16):
            part = pairs[i:i + (1 << 16)]
            known = {"kind": np.zeros(len(part), np.int32), "block": np.full(len(part), block), "pair": np.arange(i, i + len(part)).astype(np.int32),
                     "a": part[:, 0], "b": part[:, 1], "n": n[i:i + (1 << 16)]}
            schema = _schema(id_type)
            yield pa.RecordBatch.from_arrays([pa.array(known[f.name], f.type) if f.name in known else pa.nulls(len(part), f.type) for f in schema], schema=schema)
        self.rows, self.numbers, self.size = [], [], 0
        if len(memo.groups) > MEMO_WINDOWS:
            memo.forget()


_FIELDS = [("kind", "int", pa.int32()), ("block", "long", pa.int64()), ("n_a", "long", pa.int64()), ("n_b", "long", pa.int64()), ("n_groups", "long", pa.int64()),
           ("groups_sha256", "string", pa.string()), ("groups", "string", pa.string()), ("width", "int", pa.int32()), ("codes", "binary", pa.binary()),
           ("sizes", "binary", pa.binary()), ("pair", "int", pa.int32()), ("a", "int", pa.int32()), ("b", "int", pa.int32()), ("n", "long", pa.int64())]
_NAMES = ["doc", *[f[0] for f in _FIELDS]]


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("doc", id_type), *[(name, kind) for name, _, kind in _FIELDS]])


def _rows(rows: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"doc": None} | r for r in rows], _schema(id_type))


class Alignment(NamedTuple):
    """parts (rows of kind 0: pairs of ids of a block, 1: its windows, 2: its documents) and pairs (a, b, count, best)."""

    parts: DataFrame
    pairs: DataFrame


def align_texts(df: DataFrame, id: str, text: str, a: Callable[[], Vocabulary], b: Callable[[], Vocabulary], keep_groups: bool = False,
                block_bytes: int = BLOCK_BYTES) -> Alignment:
    """Aligns both tokenizers over every whole text and counts which of their ids end together.

    Texts are tokenised whole, once. Where a space-marked token starts on both sides at the same byte, the text is cut;
    the windows between such anchors repeat, so each is aligned once per worker and found again by its ids.
    A text that is null or empty, or that either side does not spell back, has no tokens. Each task
    passes on blocks of about `block_bytes` of text: the windows of a block are numbered, and a pair of ids is counted
    within its block before it meets the same pair of other blocks, so no pair has more rows than there are blocks.
    Parts are written under the shared folder. `a` and `b` make the vocabularies in a worker. Rows are aligned each by itself.
    """
    slim = df.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    id_type = slim.schema["doc"].dataType.simpleString()
    schema = f"doc {id_type}, " + ", ".join(f"{name} {kind}" for name, kind, _ in _FIELDS)
    name = f"alignment {a} {b}"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = kept_by_worker(name, lambda: _Memo(a(), b()))
        block, number, arrow_id = _Block(memo), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            arrow_id = batch.schema.field(0).type
            ids, texts, size = [], [], 0
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py()
                ids.append(key)
                texts.append(value)
                size += len(value or "")
                if size >= CALL_BYTES:
                    block.add(ids, texts, keep_groups)
                    ids, texts, size = [], [], 0
                    if block.size >= block_bytes or len(memo.groups) > MEMO_WINDOWS:
                        yield from block.passed_on(number, arrow_id)
                        number += 1
            block.add(ids, texts, keep_groups)
        if block.rows:
            yield from block.passed_on(number, arrow_id)

    parts = stage(slim.mapInArrow(align, schema), "aligned")
    counted = parts.where("kind = 0").groupBy("a", "b").agg(F.sum("n").alias("count"))
    # A B id has at most as many partners as there are A ids.
    best = F.col("count") == F.max("count").over(Window.partitionBy("b"))
    return Alignment(parts, stage(counted.withColumn("best", best), "pairs"))


def link_totals(alignment: Alignment) -> DataFrame:
    """doc, n_a, n_b, n_groups, groups_sha256, groups, n_links, n_best, count_sum of every document.

    The counts of a block's pairs go to its block, one row for each pair, and meet its windows and documents there.
    """
    parts = alignment.parts
    doc = parts.schema["doc"].dataType.simpleString()
    counts = parts.where("kind = 0").select("block", "pair", "a", "b").join(alignment.pairs, ["a", "b"]).select(
        F.lit(0).alias("kind"), "block", "pair", "count", "best")
    rest = parts.where("kind > 0").drop("pair", "a", "b", "n")
    met = rest.unionByName(counts, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")
    kept = ["doc", "n_a", "n_b", "n_groups", "groups_sha256", "groups"]
    schema = f"doc {doc}, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, n_links long, n_best long, count_sum long"

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, found = None, []
        sums = bests = np.zeros(0, np.int64)
        for batch in batches:
            block, kind = (batch.column(c).to_numpy() for c in ("block", "kind"))
            edges = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])]) if len(block) else []
            for start, end in zip(edges, [*edges[1:], len(block)]):
                part = batch.slice(start, end - start)
                if at != block[start]:
                    at, found = block[start], []
                if kind[start] == 0:
                    found.append(tuple(part.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "count", "best")))
                elif kind[start] == 1:
                    pair, count, best = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
                    order = np.argsort(pair)
                    numbers = np.frombuffer(part.column("codes")[0].as_buffer(), "<u4")
                    sizes = np.frombuffer(part.column("sizes")[0].as_buffer(), "<u4").astype(np.int64)
                    window = np.repeat(np.arange(len(sizes)), sizes)
                    sums, bests = np.zeros((2, len(sizes)), np.int64)
                    np.add.at(sums, window, count.astype(np.int64)[order][numbers])
                    np.add.at(bests, window, best.astype(np.int64)[order][numbers])
                else:
                    codes = [np.frombuffer(c.as_buffer(), f"<u{w}") for c, w in zip(part.column("codes"), part.column("width").to_pylist())]
                    made = [part.column("n_groups"), pa.array([int(bests[c].sum()) for c in codes]), pa.array([int(sums[c].sum()) for c in codes])]
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *made], [*kept, "n_links", "n_best", "count_sum"])

    return met.mapInArrow(total, schema)


def _bytes_50k() -> Vocabulary:
    return byte_level(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _pieces_32k() -> Vocabulary:
    return pieces(public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_cross_tokenizer_alignment")
def op11_cross_tokenizer_alignment(spark, sf):
    """Groups and links of every document under a byte-level BPE and a SentencePiece model."""
    found = link_totals(align_texts(table(spark, sf, "documents"), "doc_id", "text", _bytes_50k, _pieces_32k))
    return found.select(F.col("doc").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
