"""Token files: independent zstandard frames, a trailing seek table and a checksum per frame.

A file is a row of zstandard frames followed by a skippable frame, the seek table of the public seekable format: per frame its
compressed and plain size and the low 32 bits of its XXH64, then the number of frames, a descriptor and a magic number. Plain
zstandard tools can read such a file. Data frames hold whole documents; the last frame is an index of the documents' ids, so a
reader takes the tail, the index and only the frames of the documents it wants.

A data frame's plain bytes: number of documents (u32), then per document a null mark (u8), the id (i64) and the number of token
ids (u32) as three arrays, then all token ids (u32). The index frame: number of data frames (u32), per frame the first and last
id (i64, i64), a mark whether it has null ids (u8) and its documents and token ids (u32, u64). All little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import small_batches
from shelfcast.llm.pieces import LATIN, Pieces
from shelfcast.sources.scratch import scratch_path

# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: Bytes of text for which there is one file: large enough that a file's words repeat, small enough to encode in seconds.
FILE_BYTES = 40_000_000
#: Token ids after which a frame is closed, and words whose ids a task remembers before it starts anew.
FRAME_TOKENS = 1 << 17
REMEMBERED = 400_000
#: Bytes of text that are worked on at a time.
TEXT_BYTES = 4_000_000


def file_system(uri: str):
    """The file system of a folder and the folder's path in it. A path without a scheme is a path of the machine."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def pack(ids: list[int | None], payloads: list[bytes]) -> bytes:
    """A data frame's plain bytes; a payload is a document's token ids as u32."""
    n = len(ids)
    nulls = np.array([x is None for x in ids], "u1")
    numbers = np.array([x or 0 for x in ids], "<i8")
    lengths = np.array([len(x) // 4 for x in payloads], "<u4")
    return b"".join([struct.pack("<I", n), nulls.tobytes(), numbers.tobytes(), lengths.tobytes(), *payloads])


def unpack(plain: bytes) -> Iterator[tuple[int | None, bytes]]:
    """Documents of a data frame: id and token ids as u32 bytes."""
    (n,) = struct.unpack_from("<I", plain)
    nulls = np.frombuffer(plain, "u1", n, 4)
    numbers = np.frombuffer(plain, "<i8", n, 4 + n)
    lengths = np.frombuffer(plain, "<u4", n, 4 + 9 * n)
    at = 4 + 13 * n
    for null, number, length in zip(nulls.tolist(), numbers.tolist(), lengths.tolist()):
        yield None if null else number, plain[at : at + 4 * length]
        at += 4 * length


class FrameWriter:
    """Writes documents, given in ascending order of their ids with nulls first, to an open file."""

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS):
        import zstandard

        self.out, self.frame_tokens, self.zip = out, frame_tokens, zstandard.ZstdCompressor(level=1)
        self.ids, self.payloads, self.held = [], [], 0
        self.seek: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int, int]] = []
        self.n_docs = self.n_tokens = 0

    def add(self, doc_id: int | None, payload: bytes) -> None:
        self.ids.append(doc_id)
        self.payloads.append(payload)
        self.held += len(payload) // 4
        if self.held >= self.frame_tokens:
            self._close_frame()

    def _put(self, plain: bytes) -> None:
        import xxhash

        packed = self.zip.compress(plain)
        self.out.write(packed)
        self.seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def _close_frame(self) -> None:
        if self.ids:
            self._put(pack(self.ids, self.payloads))
            numbers = [x for x in self.ids if x is not None]
            self.index.append((min(numbers, default=0), max(numbers, default=-1), len(numbers) < len(self.ids), len(self.ids), self.held))
            self.n_docs += len(self.ids)
            self.n_tokens += self.held
            self.ids, self.payloads, self.held = [], [], 0

    def close(self) -> None:
        self._close_frame()
        self._put(struct.pack("<I", len(self.index)) + b"".join(struct.pack("<qqBIQ", *x) for x in self.index))
        table = b"".join(struct.pack("<III", *x) for x in self.seek) + struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class FrameReader:
    """Reads a file by its seek table; frames are decompressed one at a time and checked."""

    def __init__(self, source):
        self.source, size = source, source.size()
        n, descriptor, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or not descriptor & CHECKSUM_FLAG:
            raise ValueError("not a token file: the seek table is missing")
        table = source.read_at(12 * n, size - 9 - 12 * n)
        self.seek = [struct.unpack_from("<III", table, 12 * i) for i in range(n)]
        self.places = [0]
        for packed, _, _ in self.seek:
            self.places.append(self.places[-1] + packed)
        plain = self.frame(n - 1)
        self.index = [struct.unpack_from("<qqBIQ", plain, 4 + 29 * i) for i in range(struct.unpack_from("<I", plain)[0])]

    def frame(self, i: int) -> bytes:
        import xxhash
        import zstandard

        packed, size, checksum = self.seek[i]
        plain = zstandard.ZstdDecompressor().decompress(self.source.read_at(packed, self.places[i]), max_output_size=size)
        if len(plain) != size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        return plain

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """All documents, or those with a wanted id, for which only frames whose range holds one are read."""
        ids = None if wanted is None else sorted(wanted)
        for i, (first, last, _, _, _) in enumerate(self.index):
            if ids is None or (k := int(np.searchsorted(ids, first))) < len(ids) and ids[k] <= last:
                yield from ((d, x) for d, x in unpack(self.frame(i)) if ids is None or d is not None and ids[min(int(np.searchsorted(ids, d)), len(ids) - 1)] == d)


def gather(flat: np.ndarray, edges: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs with the wanted numbers, one after another, and their lengths; run i lies between the edges i and i + 1 of `flat`."""
    starts = edges[wanted]
    n = edges[wanted + 1] - starts
    ends = np.cumsum(n)
    return flat[np.repeat(starts - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], n


def edges_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def appended(buffer: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """The buffer with more values after its used ones, at twice the size if they do not fit."""
    if used + len(more) > len(buffer):
        buffer = np.concatenate([buffer[:used], np.zeros(max(len(buffer), len(more)), buffer.dtype)])
    buffer[used : used + len(more)] = more
    return buffer


class Encoder:
    """Encodes texts to their token ids as u32 bytes, each with the end id.

    Texts are encoded by their space-separated words, which is exact for a vocabulary that drops white space. The distinct words
    of some texts are taken apart in columns: words of Latin letters and marks into these two pieces, others by the splitter. Pieces
    that are not known yet go to the vocabulary's merges, and ids are gathered by number.
    """

    def __init__(self, vocabulary: str, end_id: int | None):
        self.splitter = Pieces(vocabulary)
        self.end = np.array([] if end_id is None else [end_id], "<u4")
        self._forget()

    def _forget(self) -> None:
        self.number, self.flat, self.edges = {"": 0}, np.zeros(1024, "<u4"), np.zeros(1024, "i8")

    def _numbers(self, strings: list[str], letters: bool) -> np.ndarray:
        """The numbers of pieces or, if they are not of letters, of whole words."""
        number, new = self.number, [x for x in strings if x not in self.number]
        tokenize, ids, lengths = self.splitter.tokenizer.model.tokenize, [], []
        for x in new:
            before = len(ids)
            for piece in [self.splitter.letters(x)] if letters else self.splitter.split(x):
                ids += [piece] if type(piece) is int else [t.id for t in tokenize(piece)]
            lengths.append(len(ids) - before)
        known = len(number)
        used = int(self.edges[known])
        self.flat = appended(self.flat, used, np.array(ids, "<u4"))
        self.edges = appended(self.edges, known + 1, used + np.cumsum(lengths, dtype="i8"))
        number.update(zip(new, range(known, known + len(new))))
        return np.fromiter(map(number.__getitem__, strings), "i8", len(strings))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one word after another, and how many each has."""
        if len(self.number) > REMEMBERED:
            self._forget()
        plain = pc.match_substring_regex(words, f"^{LATIN}+[.,!]*$")
        both = np.zeros((len(words), 2), "i8")
        at = plain.to_numpy(zero_copy_only=False)
        latin = words.filter(plain)
        first = pc.utf8_lower(pc.utf8_rtrim(latin, ".,!")).dictionary_encode()
        second = pc.replace_substring_regex(latin, "^[^.,!]+", "").dictionary_encode()
        if len(latin):
            both[at, 0] = self._numbers(first.dictionary.to_pylist(), True)[first.indices.to_numpy()]
            both[at, 1] = self._numbers(second.dictionary.to_pylist(), False)[second.indices.to_numpy()]
        both[~at, 0] = self._numbers(words.filter(pc.invert(plain)).to_pylist(), False)
        ids, n = gather(self.flat, self.edges, both.reshape(-1))
        return ids, n.reshape(-1, 2).sum(axis=1)

    def __call__(self, batch: pa.Array) -> Iterator[bytes]:
        batch = pc.fill_null(batch, "")
        sizes = np.cumsum(pc.binary_length(batch).to_numpy()) // TEXT_BYTES
        for some in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(sizes)) + 1) if len(batch) else ():
            part = pc.replace_substring(batch.slice(some[0], len(some)), "\n", " ")
            split = pc.split_pattern(part, " ")
            coded = split.flatten().dictionary_encode()
            flat, lengths = self._words(coded.dictionary)
            ids, n = gather(flat, edges_of(lengths), coded.indices.to_numpy())
            edges = edges_of(n)[edges_of(pc.list_value_length(split).to_numpy())].tolist()
            for a, b in zip(edges, edges[1:]):
                yield ids[a:b].tobytes() + self.end.tobytes()


def write_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = 2) -> list[tuple[int, str, int, int]]:
    """Encode every text and write one file per range of ids below `folder`; returns (shard, path, documents, token ids) by shard.

    Documents are dealt by ranges of doc_id, which must be an integer, and sorted within, null ids first. Rows that share an id
    stand together, by their text; if they are many, they are dealt to several files by a hash of it. A null or empty text has the end id alone. A file gets its name when it is complete, so a repeated task replaces
    it by an equal one. Only one line per file comes to the driver.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        shipped = spark.sparkContext.broadcast(f.read())
    schema = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        store, base = file_system(folder)
        encode, shard = Encoder(shipped.value, end_id), TaskContext.get().partitionId()
        name, part = f"{base}/shard-{shard:06d}.tokens", f"{base}/_part-{uuid.uuid4().hex}"
        store.create_dir(base, recursive=True)
        with store.open_output_stream(part, compression=None) as out:
            writer = FrameWriter(out)
            for batch in _and_rest(first, batches):
                for doc_id, payload in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                    writer.add(doc_id, payload)
            writer.close()
        store.move(part, name)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [name], "n_docs": [writer.n_docs], "n_tokens": [writer.n_tokens]}, schema=schema)

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.asc_nulls_first("doc_id"), F.asc("hash")]
    ranges = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash")).repartitionByRange(int(size // FILE_BYTES) + 1, *order)
    dealt = ranges.sortWithinPartitions(order[0], "text").drop("hash")
    with small_batches(spark, 1000):
        written = dealt.mapInArrow(run, "shard long, path string, n_docs long, n_tokens long").collect()
    return sorted(tuple(r) for r in written)


def _and_rest(first, rest):
    yield first
    yield from rest


def read_files(spark: SparkSession, folder: str, files: list[tuple[int, str, int, int]], wanted: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of all documents of the files, or of those with a wanted id; one task per file.

    start counts the token ids of all documents before, over all files.
    """
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], kind)
    rows, before = [], 0
    for _, path, _, n_tokens in files:
        rows.append((path, before))
        before += n_tokens
    schema = pa.schema([(x, pa.int64()) for x in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches):
        store, _ = file_system(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                with store.open_input_file(path) as source:
                    reader, docs = FrameReader(source), []
                    for i, (first, last, has_null, _, n) in enumerate(reader.index):
                        if wanted is None or any(first <= x <= last for x in wanted):
                            at = start
                            for doc_id, payload in unpack(reader.frame(i)):
                                if wanted is None or doc_id in wanted:
                                    docs.append((doc_id, at, len(payload) // 4, zlib.crc32(payload)))
                                at += len(payload) // 4
                        start += n
                    if docs:
                        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*docs))), schema=schema)

    return spark.createDataFrame(rows, "path string, before long").repartition(len(rows)).mapInArrow(run, kind)


def token_files(docs: DataFrame, vocabulary: str, end_id: int | None = 2, folder: str | None = None) -> DataFrame:
    """Write the token files of a corpus and read them back: doc_id, start, n_tokens and ids_crc32 of every document.

    Empty tables give no file and no row; a null text counts as empty; null ids come first; repeated rows are written each.
    Columns other than doc_id and text are not read.
    """
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    return read_files(docs.sparkSession, folder, write_files(docs, folder, vocabulary, end_id))
