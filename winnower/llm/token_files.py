"""Token-id output: documents as files of independently coded, checksummed blocks.

Documents are range-partitioned by id and sorted; each task tokenizes its texts
and writes files of bounded size to the shared folder. A file has

    magic, then the documents' table: how many, and zlib of their ids (a flag
    for null and a signed 64-bit integer) and token counts; zlib of which ids
    the file holds (a bit each) and how often; the CRC-32 of both;
    then blocks of at most ``BLOCK_IDS`` ids, each with its id count, its coded
    size and the CRC-32 of its coded bytes, followed by those bytes.

Any block can be decoded alone, with the counts of its file. The rows of the index name the files of tasks
that succeeded; files that a lost attempt left are never read.

Defined cases: a null text is empty and gives the end id alone; repeated rows
are written each, in the order of their text's hash; a null doc_id comes first;
an empty table gives no document.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Buffer, Iterable, Iterator
from functools import lru_cache
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnower.llm.files import file_system, new_file
from winnower.llm.id_coder import IDS, LANES, Shares, decode, encode
from winnower.storage import shared_folder, written

BLOCK_IDS = 2048
_MAGIC = b"WIDS2\n"
_TABLE = struct.Struct("<QIII")
_BLOCK = struct.Struct("<III")
_CACHED_WORDS = 600_000
_CACHED_LETTERS = 40
_LETTERS_AT_ONCE = 1 << 23
#: Words that no normal form changes, without the starts of contractions and special strings.
_PLAIN = "[!-&(-;=-~À-ÖØ-öø-ÿ]+"
_RUN = "([a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+)"
_is_plain = re.compile(_PLAIN).fullmatch
#: The letters that stand for the two bytes of a plain letter beyond ASCII.
_BYTE_LETTERS = {
    code: "Ã" + ("Ń" if code == ord("í") else chr(code - 0x40 + (0xA2 if code < 0xE1 else 0)))
    for code in range(0xC0, 0x100)
}
_FILE_BYTES = 64 << 20
_INDEX = "part int, roll int, name string, n_docs long, n_ids long"


def _gathered(
    ids: np.ndarray, n_ids: np.ndarray, which: pa.Array, lists: pa.Array
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of entries ``which`` in a row, and the bounds of each of the lists in them."""
    which, offsets = which.to_numpy(), lists.offsets.to_numpy()
    size = n_ids[which]
    end = np.cumsum(size)
    at = np.repeat(((np.cumsum(n_ids) - n_ids)[which] - (end - size)).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    return ids[at], np.append(0, end)[offsets - offsets[0]]


class WordIds(dict):
    """Ids of words as little-endian 32-bit bytes, by a tokenizer that drops white space.

    Words between ASCII white space never share a token, so each distinct word of
    some texts is encoded alone. A word of plain characters is cut into runs of
    letters, digits and runs of marks, which go to the tokenizer's model as its
    normalizer and splitter would hand them on; all others take its whole way. The
    ids of runs and other words are kept; the older half makes room when there are
    too many.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model

    def __missing__(self, part: str) -> bytes:
        if part.isascii() and part.isalpha():
            found = [token.id for token in self.model.tokenize(part)]
        elif _is_plain(part):
            found = [token.id for token in self.model.tokenize(part.translate(_BYTE_LETTERS))]
        else:
            found = self.tokenizer.encode(part, add_special_tokens=False).ids
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(part) <= _CACHED_LETTERS:
            self[part] = ids
        return ids

    @staticmethod
    def _parts(words: pa.Array) -> pa.Array:
        """The runs of each plain word, any other word whole; empty strings may follow."""
        plain, lower = pc.match_substring_regex(words, f"^{_PLAIN}$"), pc.utf8_lower(words)
        mixed = pc.and_not(plain, pc.utf8_is_alpha(words))
        runs = pc.replace_substring_regex(lower.filter(mixed), _RUN, r"\1 ")
        return pc.ascii_split_whitespace(pc.replace_with_mask(pc.if_else(plain, lower, words), mixed, runs))

    def _of_some(self, texts: pa.Array) -> Iterator[bytes]:
        if len(self) > _CACHED_WORDS:
            for part in list(islice(self, len(self) // 2)):
                del self[part]
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        cut = self._parts(words.dictionary)
        parts = cut.flatten().dictionary_encode()
        known = [self[part] for part in parts.dictionary.to_numpy(zero_copy_only=False).tolist()]
        n_ids = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids, ends = _gathered(np.frombuffer(b"".join(known), "<u4"), n_ids, parts.indices, cut)
        ids, ends = _gathered(ids, np.diff(ends), words.indices, split)
        coded = memoryview(ids).cast("B")
        return (bytes(coded[start:end]) for start, end in pairwise((4 * ends).tolist()))

    def of_texts(self, texts: pa.Array) -> Iterator[bytes]:
        letters = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(texts):
            before = letters[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(letters, before + _LETTERS_AT_ONCE)))
            yield from self._of_some(texts[start:stop])
            start = stop

    def of_text(self, text: str | None) -> bytes:
        (ids,) = self._of_some(pa.array([text], pa.string()))
        return ids


@lru_cache(maxsize=2)
def _ids_of(tokenizer_file: str) -> WordIds:
    """The cache of one worker process, which outlives its tasks."""
    return WordIds(tokenizer_file)


def _joined(pieces: Iterable[bytes]) -> Iterator[np.ndarray]:
    """The ids of a stream of id bytes, LANES blocks at a time."""
    held, size, full = [], 0, LANES * BLOCK_IDS * 4
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size >= full:
            data = b"".join(held)
            whole = len(data) // full * full
            for start in range(0, whole, full):
                yield np.frombuffer(data, "<u4", full // 4, start)
            held, size = [data[whole:]], len(data) - whole
    yield np.frombuffer(b"".join(held), "<u4")


def _counts(pieces: Iterable[bytes]) -> np.ndarray:
    """How often each id occurs."""
    counts = np.zeros(IDS, np.int64)
    for ids in _joined(pieces):
        if len(ids) and int(ids.max()) >= IDS:
            raise ValueError("the file format holds ids below 65536")
        counts += np.bincount(ids, minlength=IDS)
    return counts


def _coded_blocks(pieces: Iterable[bytes], shares: Shares) -> Iterator[tuple[int, bytes]]:
    """(ids, coded bytes) of blocks cut from a stream of id bytes."""
    for ids in _joined(pieces):
        blocks = [ids[i : i + BLOCK_IDS] for i in range(0, len(ids), BLOCK_IDS)]
        yield from zip(map(len, blocks), encode(blocks, shares), strict=True)


def _write_file(folder: str, part: int, doc_ids: list, pieces: list[bytes]) -> tuple[str, int]:
    """Name of the new file, and how many ids it holds."""
    counts = np.array([len(piece) // 4 for piece in pieces], "<i8")
    missing = np.array([doc is None for doc in doc_ids], np.uint8)
    known = np.array([doc or 0 for doc in doc_ids], "<i8")
    table = zlib.compress(missing.tobytes() + known.tobytes() + counts.tobytes(), 1)
    each = _counts(pieces)
    held = zlib.compress(np.packbits(each > 0).tobytes() + each[each > 0].astype("<i8").tobytes(), 1)
    sizes = len(doc_ids), len(table), len(held)
    with new_file(folder, f"ids-{part:06d}", ".wids") as (name, stream):
        stream.write(_MAGIC + _TABLE.pack(*sizes, zlib.crc32(table + held)) + table + held)
        for n_ids, coded in _coded_blocks(pieces, Shares(each)):
            stream.write(_BLOCK.pack(n_ids, len(coded), zlib.crc32(coded)) + coded)
    return name, int(counts.sum())


def _read_file(data: bytes) -> Iterator[tuple[int | None, Buffer]]:
    """(doc_id, id bytes) of the documents of a file, in order; checks every checksum."""
    if not data.startswith(_MAGIC):
        raise ValueError("not a file of token ids")
    at = len(_MAGIC)
    n_docs, size, held_size, checksum = _TABLE.unpack_from(data, at)
    at += _TABLE.size
    end = at + size + held_size
    if zlib.crc32(data[at:end]) != checksum:
        raise ValueError("the table of documents or of ids is damaged")
    table, held = zlib.decompress(data[at : at + size]), zlib.decompress(data[at + size : end])
    at = end
    each = np.unpackbits(np.frombuffer(held, np.uint8, IDS // 8)).astype(np.int64)
    each[each > 0] = np.frombuffer(held, "<i8", -1, IDS // 8)
    shares = Shares(each)
    missing = np.frombuffer(table, np.uint8, n_docs)
    known, counts = np.frombuffer(table, "<i8", 2 * n_docs, n_docs).reshape(2, n_docs)
    blocks = []
    while at < len(data):
        n_ids, size, checksum = _BLOCK.unpack_from(data, at)
        at += _BLOCK.size
        coded = data[at : at + size]
        if len(coded) != size or zlib.crc32(coded) != checksum:
            raise ValueError("a block is damaged")
        blocks.append((n_ids, coded))
        at += size
    groups = (blocks[start : start + LANES] for start in range(0, len(blocks), LANES))
    held, at = memoryview(b""), 0
    for doc in range(n_docs):
        pieces, need = [], int(counts[doc]) * 4
        while need:
            if at == len(held):
                group = next(groups)
                ids = decode([coded for _, coded in group], [n for n, _ in group], shares)
                held, at = memoryview(np.concatenate(ids).astype("<u4").tobytes()), 0
            pieces.append(held[at : at + need])
            at += len(pieces[-1])
            need -= len(pieces[-1])
        yield (None if missing[doc] else int(known[doc])), pieces[0] if len(pieces) == 1 else b"".join(pieces)


def write_token_files(
    docs: DataFrame,
    tokenizer_file: str,
    folder: str,
    end_id: int,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Index of the files written, one row each: part, roll, name, n_docs, n_ids."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("_hash"),
    )
    ordered = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash")
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, roll = _ids_of(tokenizer_file), TaskContext.get().partitionId(), 0
        doc_ids, pieces, size = [], [], 0

        def finished() -> pa.RecordBatch:
            name, n_ids = _write_file(folder, part, doc_ids, pieces)
            values = [[part], [roll], [name], [len(doc_ids)], [n_ids]]
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, kind) for v, kind in zip(values, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "roll", "name", "n_docs", "n_ids"])

        for batch in batches:
            texts = words.of_texts(batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), texts, strict=True):
                doc_ids.append(doc)
                pieces.append(ids + end)
                size += len(ids)
                if size >= _FILE_BYTES:
                    yield finished()
                    doc_ids, pieces, size, roll = [], [], 0, roll + 1
        if doc_ids:
            yield finished()

    index = ordered.select("doc_id", "text").mapInArrow(run, _INDEX)
    return written(docs.sparkSession, index, "ids-index")


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of an index.

    ``start`` counts the ids of all documents before. Files are numbered over
    one window of their index, a row for each file.
    """
    before = Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1)
    starts = index.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spark = index.sparkSession
    starts = written(spark, starts, "ids-starts")
    dealt = starts.repartition(max(1, starts.count()), "part", "roll")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{base}/{row['name']}", compression=None) as stream:
                    data = stream.read()
                doc_ids, counts, sums = [], [], []
                for doc, ids in _read_file(data):
                    doc_ids.append(doc)
                    counts.append(len(ids) // 4)
                    sums.append(zlib.crc32(ids))
                n_tokens = np.array(counts, np.int64)
                start = row["first"] + np.cumsum(n_tokens) - n_tokens
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(start),
                        pa.array(n_tokens),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return dealt.mapInArrow(run, schema)


def token_file_round_trip(
    docs: DataFrame, tokenizer_file: str, end_id: int = 2, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Writes the files to a new shared folder and returns what they hold."""
    folder = shared_folder(docs.sparkSession, "token-files")
    index = write_token_files(docs, tokenizer_file, folder, end_id, text, doc_id)
    return read_token_files(index, folder)
