"""Token ids of documents in files that a reader can open at one document.

A file is in zstandard's seekable format: one independent frame for each document, its ids as unsigned
32-bit little-endian integers, then a skippable frame with the seek table: for each frame its compressed
and decompressed size and a checksum (the low half of the content's XXH64). So any zstandard reader reads
a whole file, and ours decompresses only the frames asked for and checks them.

Files are written by the tasks of one range of document ids each, under a name of their own, and given
their final name when complete; a task that runs again writes the same bytes. An index table has each
document's file, frame, place among all ids and number of tokens.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.llm.split import Pieces, splitter
from lodestar.llm.store import bounded_batches, row_order
from lodestar.llm.worker import kept

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
_ENTRY, _FOOTER, _HEADER = struct.Struct("<III"), struct.Struct("<IBI"), struct.Struct("<II")

END_ID = 1
LEVEL = 3


class SeekableWriter:
    """Frames appended to a stream, the seek table at ``close``."""

    def __init__(self, stream, level: int = LEVEL) -> None:
        self.stream, self.entries = stream, []
        self.compressor = zstandard.ZstdCompressor(level=level)

    def frame(self, data: bytes) -> int:
        packed = self.compressor.compress(data)
        self.stream.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        return len(self.entries) - 1

    def close(self) -> None:
        body = b"".join(_ENTRY.pack(*e) for e in self.entries) + _FOOTER.pack(len(self.entries), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.stream.write(_HEADER.pack(SKIPPABLE_MAGIC, len(body)) + body)


class SeekableReader:
    """Frames of a seekable file by number; each is checked against its checksum."""

    def __init__(self, stream, size: int) -> None:
        self.stream = stream
        stream.seek(size - _FOOTER.size)
        frames, flags, magic = _FOOTER.unpack(stream.read(_FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the file's end")
        stream.seek(size - _FOOTER.size - frames * _ENTRY.size)
        table = np.frombuffer(stream.read(frames * _ENTRY.size), "<u4").reshape(frames, 3)
        self.packed, self.plain, self.sums = (table[:, k].astype(np.int64) for k in range(3))
        self.start = np.concatenate([[0], np.cumsum(self.packed)])
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        self.stream.seek(int(self.start[k]))
        data = self.decompressor.decompress(self.stream.read(int(self.packed[k])), max_output_size=int(self.plain[k]) or 1)
        if len(data) != self.plain[k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return data


class WordIds:
    """Ids of texts by a tokenizer of the ``tokenizers`` library.

    For a tokenizer that lower-cases, drops white space and never merges over it, as the given one, texts of
    Latin letters are split here and the library's model merges each new piece; the ids of frequent pieces
    are kept. Any other text, and any other tokenizer, goes through the library as a whole.
    """

    MAX_PIECES = 500_000
    #: Fixed values of the tokenizer file for which pieces can be taken one by one.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, config: str) -> None:
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(config)
        about = json.loads(config)
        steps = [s.get("type") for s in (about.get("normalizer") or {}).get("normalizers", [])]
        split = [s.get("pattern", {}).get("Regex") for s in (about.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        added = [t["content"] for t in about.get("added_tokens", [])]
        self.by_piece = steps == ["NFC", "Replace", "Lowercase"] and split == [self.SPLIT, None] and not about.get("post_processor")
        self.find = splitter(self.SPLIT)
        # all of Latin-1 and Latin Extended-A but the dotted capital I, which is two characters in lower case
        self.plain = regex.compile("[\\x00-\\u012f\\u0131-\\u017f]*").fullmatch
        self.added = regex.compile("|".join(map(regex.escape, added)) or r"(?!)").search
        self.letter = self._letters()
        model, letter = self.tokenizer.model, self.letter
        self.pieces = Pieces(lambda piece: np.array([t.id for t in model.tokenize("".join(map(letter.__getitem__, piece.encode())))], "<u4").tobytes(), self.MAX_PIECES)

    @staticmethod
    def _letters() -> list[str]:
        """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = (b for b in range(256) if b not in own)
        stand = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
        return [stand[b] for b in range(256)]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.stored(text), "<u4").tolist()

    def stored(self, text: str | None) -> bytes:
        """The ids as they are written: unsigned 32-bit little-endian integers."""
        if not text:
            return b""
        if not (self.by_piece and (text.isascii() or self.plain(text))) or self.added(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.pieces.of(self.find(text.lower()))


def _word_ids(config: str) -> WordIds:
    return kept(("word-ids", hash(config)), lambda: WordIds(config))


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else "file:" + path if path.startswith("/") else path)


def _uri(path: str) -> str:
    """``file:/x`` as Hadoop writes it is ``file:///x`` elsewhere."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, partitions: int | None = None) -> DataFrame:
    """Encode every text, write the ids under ``folder`` in ascending id order; returns the index written to
    ``folder/index``: ``doc_id, file, frame, start, n_tokens``.

    Each document's ids end with ``end_id``; a null or empty text is that id alone. Null ids come last, rows
    that tie on id are in order of a hash of the text; repeated rows are repeated. An empty table gives
    an empty index.
    """
    bounded_batches(docs)
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(row_order(id_col).alias("ord"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange(n, "ord", "text_key").sortWithinPartitions("ord", "text_key").select("doc_id", "text")
    target = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = _word_ids(shared.value).stored, np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        store, root = _store(target)
        name = f"part-{part:06d}.zst"
        own = f"{root}/_unfinished-{name}-{uuid.uuid4().hex}"
        stream = writer = None
        before = 0
        for batch in batches:
            done: list[tuple] = []
            for i in range(batch.num_rows):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    stream = store.open_output_stream(own)
                    writer = SeekableWriter(stream)
                data = ids_of(batch.column(1)[i].as_py()) + end
                done.append((batch.column(0)[i].as_py(), part, writer.frame(data), before, len(data) // 4))
                before += len(data) // 4
            if done:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kinds[k]) for k in range(5)], names=["doc_id", "file", "frame", "before", "n_tokens"])
        if writer is not None:
            writer.close()
            stream.close()
            if store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                store.move(own, f"{root}/{name}")
            else:  # an earlier run of this task got that far: the same bytes
                store.delete_file(own)

    placed = f"{folder}/placed"
    rows.mapInArrow(run, "doc_id long, file int, frame int, before long, n_tokens long").write.parquet(placed)
    placed = spark.read.parquet(placed)
    # files are in id order: a file starts after all ids of the files before it (one row for each file)
    sizes = sorted(placed.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    starts, total = [], 0
    for file, size in sizes:
        starts.append((file, total))
        total += size
    base = spark.createDataFrame(starts, "file int, base long")
    index = placed.join(F.broadcast(base), "file").select("doc_id", "file", "frame", (F.col("before") + F.col("base")).alias("start"), "n_tokens")
    index.write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def read_ids(wanted: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """Rows of the index (any of them) with ``ids_crc32`` (unsigned crc32 of the stored bytes) and, if wanted, ``ids``
    (array of long): only their frames are read and decompressed.

    Rows are dealt out by file, so a task opens few files; a damaged frame is an error.
    """
    bounded_batches(wanted)
    wanted = wanted.repartition(int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file").sortWithinPartitions("file", "frame")
    target = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(target)
        opened: tuple[int, SeekableReader] | None = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                row = batch.column(0).slice(lo, 512)
                data = []
                for file, frame in zip(row.field(files).to_pylist(), row.field(frames).to_pylist(), strict=True):
                    if opened is None or opened[0] != file:
                        path = f"{root}/part-{file:06d}.zst"
                        opened = file, SeekableReader(store.open_input_file(path), store.get_file_info(path).size)
                    data.append(opened[1].frame(frame))
                cols = [row, pa.array([zlib.crc32(d) for d in data], pa.int64())]
                if with_ids:
                    flat = np.frombuffer(b"".join(data), "<u4").astype(np.int64)
                    cut = np.concatenate([[0], np.cumsum([len(d) // 4 for d in data])]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(cut), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(cols, names=["row", "ids_crc32", "ids"][: len(cols)])

    files, frames = wanted.columns.index("file"), wanted.columns.index("frame")
    rows = wanted.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], *StructType.fromDDL("ids_crc32 long" + ", ids array<long>" * with_ids).fields]))
