"""Token ids as length-delimited binary records, with an offset index beside them.

A data file is a run of frames and one final newline. A frame is the payload's length (8 bytes), the masked CRC-32C of these
8 bytes, the payload, and the payload's masked CRC-32C; numbers are little-endian. The first frame of a file holds
JSON: the part and chunk that order the files, and the bytes of an id. Every other frame is one sequence: a byte that is 1 if
there is an id, the document's id as 8 bytes, then the token ids in 2 bytes each, or 4 where the vocabulary needs them.

Documents are range-partitioned and sorted by id (ties by position, so equal ids cannot fill a task); each task
encodes its range and emits files of about ``FILE_BYTES``. Spark's text writer stores the bytes, so any file system that
Spark knows will do, and a repeated task replaces its files as with any Spark write. The index (file, number, offset,
length, id, tokens, tokens of all earlier sequences) is a Parquet table made from the files. Reading checks every
length and sum and fails on any difference.

Defined results: null and empty texts are sequences of the end id alone; null ids come first; repeated rows are sequences
of their own, in any order among equals; texts of any length are one frame each; other columns play no
part, whatever their names; an empty table gives an empty folder and index.
"""

import json
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.tokens import ID, encoder
from newsloom.session import shared_folder

END_ID = 2
FILE_BYTES = 8 << 20
PIECE = 256  # bytes of a message whose sum is made in one row
POLYNOMIAL = 0x82F63B78  # fixed values of CRC-32C and its mask
MASK_ADDED = 0xA282EAD8


def _tables() -> np.ndarray:
    """Eight tables: table k advances a byte by k further zero bytes."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(POLYNOMIAL), first >> 1)
    tables = [first]
    for _ in range(7):
        tables.append((tables[-1] >> 8) ^ first[tables[-1] & 255])
    return np.stack(tables)


TABLES = _tables()


def _piece_sums(pieces: np.ndarray) -> np.ndarray:
    """The sum of each row, from register zero, eight bytes at a time."""
    columns = np.ascontiguousarray(pieces.T)
    register = np.zeros(pieces.shape[0], np.uint32)
    for at in range(0, PIECE, 8):
        register = register ^ columns[at : at + 4].T.copy().view(np.uint32).ravel() if at else columns[:4].T.copy().view(np.uint32).ravel()
        total = TABLES[7][register & 255] ^ TABLES[6][register >> 8 & 255]
        total ^= TABLES[5][register >> 16 & 255]
        total ^= TABLES[4][register >> 24]
        for k in range(4):
            total ^= TABLES[3 - k][columns[at + 4 + k]]
        register = total
    return register


def _advance() -> np.ndarray:
    """Four tables that advance a register by ``PIECE`` zero bytes, byte by byte of the register."""
    rows = []
    for byte in range(4):
        register = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
        for _ in range(PIECE):
            register = (register >> 8) ^ TABLES[0][register & 255]
        rows.append(register)
    return np.stack(rows)


ADVANCE = _advance()


def crc32c(messages: list[bytes]) -> np.ndarray:
    """CRC-32C of messages of four bytes or more.

    Messages are cut into pieces, the first filled up with zeros in front, which leave a zero register as it is. The
    usual start value is the same as inverting a message's first four bytes.
    """
    if not messages:
        return np.zeros(0, np.uint32)
    lengths = np.fromiter(map(len, messages), np.int64, len(messages))
    counts = -(-lengths // PIECE)
    ends = np.cumsum(counts)
    flat = np.zeros(int(ends[-1]) * PIECE, np.uint8)
    begins = ends * PIECE - lengths
    for begin, message in zip(begins.tolist(), messages):
        flat[begin : begin + len(message)] = np.frombuffer(message, np.uint8)
    for k in range(4):
        flat[begins + k] ^= 255
    sums = _piece_sums(flat.reshape(-1, PIECE))
    first = ends - counts
    register = np.zeros(len(messages), np.uint32)
    longest = np.argsort(-counts, kind="stable")
    reaching = np.searchsorted(-counts[longest], -np.arange(int(counts.max())), side="left")
    for step, number in enumerate(reaching.tolist()):
        rows = longest[:number]
        r = register[rows]
        moved = ADVANCE[0][r & 255] ^ ADVANCE[1][r >> 8 & 255] ^ ADVANCE[2][r >> 16 & 255] ^ ADVANCE[3][r >> 24]
        register[rows] = moved ^ sums[first[rows] + step]
    return ~register


def masked(messages: list[bytes]) -> np.ndarray:
    sums = crc32c(messages)
    return ((sums >> 15) | (sums << 17)) + np.uint32(MASK_ADDED)


def framed(payloads: list[bytes]) -> bytes:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads, tails = masked(lengths).astype("<u4").tobytes(), masked(payloads).astype("<u4").tobytes()
    parts = []
    for i, (length, payload) in enumerate(zip(lengths, payloads)):
        parts += [length, heads[4 * i : 4 * i + 4], payload, tails[4 * i : 4 * i + 4]]
    return b"".join(parts)


def frames(content: bytes) -> list[tuple[int, int]]:
    """(offset, payload length) of each frame of a file; fails unless they end at the final newline."""
    found, at, end = [], 0, len(content) - 1
    while at < end:
        if at + 16 > end:
            raise ValueError("a frame is cut off")
        (length,) = struct.unpack_from("<Q", content, at)
        found.append((at, length))
        at += length + 16
    if at != end or content[end:] != b"\n":
        raise ValueError("a frame is cut off")
    return found


def payloads_of(content: bytes, places: list[tuple[int, int]]) -> list[bytes]:
    """The payloads at ``places``, all sums checked."""
    heads = [content[at : at + 8] for at, _ in places]
    found = [content[at + 12 : at + 12 + length] for at, length in places]
    said = np.array([struct.unpack_from("<I", content, at + 8)[0] for at, _ in places], np.uint32)
    tails = np.array([struct.unpack_from("<I", content, at + 12 + length)[0] for at, length in places], np.uint32)
    if not (np.array_equal(masked(heads), said) and np.array_equal(masked(found), tails)):
        raise ValueError("a checksum differs")
    return found


def _file(part: int, chunk: int, width: int, payloads: list[bytes]) -> bytes:
    return framed([json.dumps({"part": part, "chunk": chunk, "id_bytes": width}).encode(), *payloads])


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    text: str = "text",
    id_column: str = "doc_id",
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Data files in ``folder``/data and their index in ``folder``/index."""
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def encoded(batches):
        part, chunk, waiting, size = TaskContext.get().partitionId(), 0, [], 0
        coder = encoder(tokenizer)
        width = 2 if coder.library.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        kind = np.dtype(f"<u{width}")
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1))):
                body = np.append(ids, ID.type(end_id)).astype(kind).tobytes()
                waiting.append(struct.pack("<Bq", name is not None, name or 0) + body)
                size += len(body) + 25
                if size >= file_bytes:
                    yield pa.RecordBatch.from_pydict({"file": pa.array([_file(part, chunk, width, waiting)], pa.binary())})
                    chunk, waiting, size = chunk + 1, [], 0
        if waiting:
            yield pa.RecordBatch.from_pydict({"file": pa.array([_file(part, chunk, width, waiting)], pa.binary())})

    files = rows.mapInArrow(encoded, "file binary").select(F.col("file").cast("string").alias("value"))
    files.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(f"{folder}/data")
    _write_index(docs.sparkSession, folder)


def data_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, content)"""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{folder}/data")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _write_index(spark: SparkSession, folder: str) -> None:
    def listed(batches):
        encoder.cache_clear()  # a worker that encoded before needs its memory now
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = content.as_py()
                places = frames(content)
                head = json.loads(payloads_of(content, places[:1])[0])
                at, length = np.array(places[1:], np.int64).reshape(-1, 2).T
                names = [struct.unpack_from("<Bq", content, a + 12) for a in at.tolist()]
                n = len(at)
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([file] * n), "part": np.full(n, head["part"]), "chunk": np.full(n, head["chunk"]),
                    "number": np.arange(n), "offset": at, "length": length,
                    "doc_id": pa.array([i if known else None for known, i in names], pa.int64()),
                    "n_tokens": (length - 9) // head["id_bytes"],
                })

    schema = "file string, part long, chunk long, number long, offset long, length long, doc_id long, n_tokens long"
    found = data_files(spark, folder).mapInArrow(listed, schema)
    raw = f"{folder}/places"
    found.write.parquet(raw)
    found = spark.read.parquet(raw)
    # A part is one task's range: the driver adds up the parts, Spark the sequences of a part.
    parts = sorted(map(tuple, found.groupBy("part").agg(F.sum("n_tokens")).collect()))
    before = np.cumsum([0, *[n for _, n in parts]]).tolist()
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(parts, before)], "part long, before long")
    order = Window.partitionBy("part").orderBy("chunk", "number")
    start = F.col("before") + F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    index = found.join(F.broadcast(offsets), "part").withColumn("start", F.coalesce(start, F.col("before")))
    index.drop("before").write.parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(file, number, doc_id, ids) of every sequence, checked; ids as little-endian unsigned 32-bit numbers."""

    def read(batches):
        encoder.cache_clear()
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = content.as_py()
                head, *found = payloads_of(content, frames(content))
                kind = np.dtype(f"<u{json.loads(head)['id_bytes']}")
                names = [struct.unpack_from("<Bq", p) for p in found]
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([file] * len(found)), "number": np.arange(len(found)),
                    "doc_id": pa.array([i if known else None for known, i in names], pa.int64()),
                    "ids": pa.array([np.frombuffer(p, kind, offset=9).astype(ID).tobytes() for p in found], pa.binary()),
                })

    return data_files(spark, folder).mapInArrow(read, "file string, number long, doc_id long, ids binary")


def shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """The records in an order that ``seed`` decides, as a training run reads them: order, doc_id, ids."""
    order = F.xxhash64("file", "number", F.lit(seed)).alias("order")
    return read_records(spark, folder).select(order, "doc_id", "ids").orderBy("order")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
