"""Token ids in files of length-delimited binary records with masked checksums, and their offset index."""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

from lexmill.llm.common import kept_by_worker, query, table
from lexmill.llm.files import as_batches, packed, read_files, write_files
from lexmill.session import scratch_path

#: Pieces that a worker remembers in each of two tables; when the newer is full it takes the place of the older.
CACHE_PIECES = 250_000
#: Bytes of text whose words are numbered at once; a longer text goes alone.
CHUNK_BYTES = 8 << 20
#: Parts of words in one text for the library, and texts in one call.
CALL_PARTS, CALL_TEXTS = 64, 64


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 stands for itself, the rest follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(other)) for b in range(256)}


class _Known:
    """Packed ids of pieces of text, made by the list; those used of late are remembered."""

    def __init__(self, make: Callable[[list[str]], list[bytes]]):
        self.make = make
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Of different pieces; the empty one has none."""
        if len(self.newer) >= CACHE_PIECES:
            self.newer, self.older = {}, self.newer
        found = list(map(self.newer.get, pieces))
        missed = [i for i, ids in enumerate(found) if ids is None]
        kept = [self.older.get(pieces[i]) for i in missed]
        made = iter(self.make([p for i, ids in zip(missed, kept) if ids is None and (p := pieces[i])]))
        for i, ids in zip(missed, kept):
            self.newer[pieces[i]] = found[i] = ids if ids is not None else next(made) if pieces[i] else b""
        return found


def _joined(values: pa.LargeBinaryArray, offsets: pa.Array) -> pa.LargeBinaryArray:
    """The values between each two offsets as one; `values` must begin at the start of its buffer, as results of `take` do."""
    ends = np.append(0, np.cumsum(pc.binary_length(values).to_numpy(), dtype=np.int64))[offsets.to_numpy()]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), values.buffers()[2] or pa.py_buffer(b"")])


class WordEncoder:
    """Ids of whole texts under a byte-level BPE that lower-cases and drops white space.

    Such a tokenizer never joins what stands on two sides of a space, so a text's ids
    are those of its words in turn, and words repeat: Arrow numbers the different words of a chunk of texts and
    puts their ids where they stood. Words of ASCII and accented Latin-1 letters are cut by the tokenizer's own pattern (letters,
    single digits, other signs), and each different part goes once to the library with its BPE model; any other word goes
    to the tokenizer's `encode` as it is, as does a word that holds the string of an added token, which the library
    takes out wherever it stands. The ids equal `encode(text, add_special_tokens=False)`.
    """

    SIMPLE = "^[!-~À-ÖØ-öø-ÿ]*$"
    PART = "'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        #: The model alone, for parts that are already cut and written in byte-level letters.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = CharDelimiterSplit(" ")
        size, suffix = self.tokenizer.get_vocab_size(), self.tokenizer.model.end_of_word_suffix or ""
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.letters = np.array([ord(letter) for _, letter in sorted(_byte_letters().items())], "<u4")
        self.letters[ord(" ")] = ord(" ")
        self.added = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.parts = _Known(self._parts)
        self.others = _Known(self._others)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _spelled(self, parts: list[str]) -> str:
        """The parts in byte-level letters, with spaces between them."""
        return self.letters[np.frombuffer(" ".join(parts).encode(), np.uint8)].tobytes().decode("utf-32-le")

    def _parts(self, parts: list[str]) -> list[bytes]:
        out, step = [], CALL_PARTS * CALL_TEXTS
        for call in (parts[i:i + step] for i in range(0, len(parts), step)):
            texts = [self._spelled(call[i:i + CALL_PARTS]) for i in range(0, len(call), CALL_PARTS)]
            ids = np.array([i for e in self.model.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(call):  # the vocabulary marks the last id of a part, so one call serves many
                packed = ids.tobytes()
                out += [packed[a:b] for a, b in itertools.pairwise([0, *(ends * self.dtype.itemsize).tolist()])]
            else:
                out += [self._packed(self.model.encode(self._spelled([p]), add_special_tokens=False).ids) for p in call]
        return out

    def _others(self, words: list[str]) -> list[bytes]:
        return [self._packed(self.tokenizer.encode(w, add_special_tokens=False).ids) for w in words]

    def _words(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        simple = pc.match_substring_regex(words, self.SIMPLE)
        if self.added:
            simple = pc.and_not(simple, pc.match_substring_regex(words, self.added))
        lower = pc.utf8_lower(words.filter(simple)).cast(pa.large_string())  # spaces may take it over 2 GB
        spaced = pc.replace_substring_regex(lower, self.PART, r"\0 ")
        split = pc.ascii_split_whitespace(spaced)
        parts = split.values.dictionary_encode()
        ids = pa.array(self.parts.ids(_listed(parts.dictionary)), pa.large_binary()).take(parts.indices)
        others = pa.array(self.others.ids(_listed(words.filter(pc.invert(simple)))), pa.large_binary())
        place = np.argsort(np.argsort(~simple.to_numpy(zero_copy_only=False), kind="stable"))
        return pa.concat_arrays([_joined(ids, split.offsets), others]).take(pa.array(place))

    def encode_all(self, texts: pa.StringArray) -> pa.LargeBinaryArray:
        """Packed ids of each text; none may be null."""
        split = pc.ascii_split_whitespace(texts)
        words = split.values.dictionary_encode()
        return _joined(self._words(words.dictionary).take(words.indices), split.offsets)

    def encode(self, text: bytes) -> bytes:
        return self.encode_all(pa.array([text.decode()], pa.string()))[0].as_py()


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def chunks(texts: pa.Array) -> Iterator[pa.StringArray]:
    """Slices of as many texts as CHUNK_BYTES hold, one at least."""
    ends, at = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while at < len(texts):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_BYTES, side="right")))
        yield texts[at:until].cast(pa.string())
        at = until


def mask(data: bytes) -> int:
    """CRC-32, rotated right by 15 bits and shifted by a constant, so that a checksum of data holding checksums is sound."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """Length (8 bytes), its masked checksum (4), payload, its masked checksum (4); all little-endian."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", mask(length)), payload, struct.pack("<I", mask(payload))))


def frames(content: bytes) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each record; raises if a length or checksum does not fit."""
    view, at = memoryview(content), 0
    while at + 16 <= len(view):
        length = bytes(view[at:at + 8])
        (size,) = struct.unpack("<Q", length)
        payload = view[at + 12:at + 12 + size]
        if struct.unpack("<I", view[at + 8:at + 12])[0] != mask(length) or struct.unpack("<I", view[at + 12 + size:at + 16 + size])[0] != mask(payload):
            raise ValueError(f"damaged record at byte {at}")
        yield at, payload
        at += 16 + size


class Record(NamedTuple):
    id: int | None
    ids: np.ndarray


def pack_record(id: int | None, ids: bytes) -> bytes:
    return struct.pack("<?q", id is not None, id or 0) + ids


def unpack_record(payload: memoryview, dtype: str) -> Record:
    known, id = struct.unpack("<?q", payload[:9])
    return Record(id if known else None, np.frombuffer(payload[9:], dtype))


def _range_of(id: Column, bounds: list) -> Column:
    """Number of bounds that are not above `id`; null ids come first."""
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= id)), F.lit(0)) if bounds else F.lit(0)


def write_token_files(docs: DataFrame, id: str, text: str, path: str, tokenizer: str, end_id: int) -> None:
    """Writes `path`/data (records in ascending id order, cut into ranges and files) and `path`/index.

    A first look at the ids alone gives as many ranges of about equal row counts as there are shuffle partitions;
    texts then move once, to the task of their range, which sorts, encodes and
    writes. Each file opens with a JSON record (range, file, tokens of the range in earlier files,
    id type); a record holds the id and all token ids with the end id. Null
    texts are empty and have the end id alone. Rows with a null id come first,
    rows sharing an id stand side by side. An empty table gives no files. `id` must be a whole number.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / n for i in range(1, n)]
    cuts = docs.agg(F.percentile_approx(id, F.array(*map(F.lit, shares)), F.lit(20 * n)).alias("c")).first()["c"] if shares else []
    bounds = sorted(set(cuts or []))
    ranged = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).withColumn("range", _range_of(F.col("id"), bounds))
    ordered = ranged.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions(F.asc_nulls_first("id"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(f"words {tokenizer}", lambda: WordEncoder(tokenizer))
        state = {"range": None, "tokens": 0}
        end = np.array([end_id], encoder.dtype).tobytes()

        def records() -> Iterator[bytes]:
            for batch in batches:
                texts = batch.column(1).fill_null("")
                encoded = itertools.chain.from_iterable(map(encoder.encode_all, chunks(texts)))
                for key, value, at in zip(batch.column(0), encoded, batch.column(2)):
                    state["range"] = at.as_py()
                    ids = value.as_py() + end
                    yield frame(pack_record(key.as_py(), ids))
                    state["tokens"] += len(ids) // encoder.dtype.itemsize

        # A record has been made, but not counted, when the file that it opens asks for its head.
        head = lambda number: frame(json.dumps({"file": number, "dtype": encoder.dtype.str, **state}).encode())
        return as_batches(packed(records(), head))

    write_files(ordered.mapInArrow(encode, "content binary"), f"{path}/data")
    read_index(spark, path, "data").write.parquet(f"{path}/index")


def _scan(spark: SparkSession, path: str, row, schema: str) -> DataFrame:
    """A row for each record: `row(path, header, offset, tokens before it in its range, payload, record)`."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                found = frames(content.as_py())
                first = next(found, None)
                if first is None:  # Spark's writer leaves an empty file for an empty table
                    continue
                header = json.loads(bytes(first[1]))
                tokens, rows = header["tokens"], []
                for offset, payload in found:
                    record = unpack_record(payload, header["dtype"])
                    rows.append(row(name.as_py(), header, offset, tokens, payload, record))
                    tokens += len(record.ids)
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], pa.schema(
                    [(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}[c.split()[1]]) for c in schema.split(", ")]))

    return read_files(spark, path).mapInArrow(scan, schema)


def read_index(spark: SparkSession, path: str, part: str = "index") -> DataFrame:
    """path, offset, length (of the payload), id, range, at (tokens before it in its range), n_tokens of each record."""
    if part == "index":
        return spark.read.parquet(f"{path}/index")
    return _scan(spark, f"{path}/data", lambda name, head, offset, at, payload, r: (name, offset, len(payload), r.id, head["range"], at, len(r.ids)),
                 "path string, offset long, length long, id long, range int, at long, n_tokens long")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """id, range, at, n_tokens, ids_crc32 of every record, from the files themselves with all checksums tested."""
    crc = lambda ids: zlib.crc32(ids.astype("<u4").tobytes())
    return _scan(spark, f"{path}/data", lambda name, head, offset, at, payload, r: (r.id, head["range"], at, len(r.ids), crc(r.ids)),
                 "id long, range int, at long, n_tokens long, ids_crc32 long")


def read_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """id, ids for some index rows in any order: the shuffled read. Each file is fetched once and only the wanted offsets are decoded."""
    per_file = wanted.groupBy("path").agg(F.collect_list("offset").alias("offsets"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets in zip(batch.column(0), batch.column(1)):
                content = content.as_py()
                dtype = json.loads(bytes(next(frames(content))[1]))["dtype"]
                found = [unpack_record(next(frames(memoryview(content)[o:]))[1], dtype) for o in offsets.as_py()]
                yield pa.RecordBatch.from_arrays([pa.array([r.id for r in found], pa.int64()), pa.array([r.ids.tolist() for r in found], pa.list_(pa.int64()))], ["id", "ids"])

    return read_files(spark, f"{path}/data").join(per_file, "path").select("content", "offsets").mapInArrow(fetch, "id long, ids array<long>")


def with_starts(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """Adds start: tokens of all records before this one. One row per range is summed in one task, from the index."""
    totals = read_index(spark, path).groupBy("range").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    return records.join(F.broadcast(before), "range").withColumn("start", F.col("before") + F.col("at")).drop("before")


@query("op6_token_files")
def op6_token_files(spark, sf):
    """All documents as token files, and what is read back from them."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf, "documents"), "doc_id", "text", path, public_tokenizers.path("word_bpe_49k.json"), 2)
    read = with_starts(spark, path, read_tokens(spark, path))
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")
