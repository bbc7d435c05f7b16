"""Token ids in training order as files of fixed stride: every sequence has a global slot and a byte address.

Texts are tokenised once, each followed by an end token, and cut into sequences of a fixed length. A sequence is
known by the digest of its row's id and text and by its place in the document, never by where the row was read,
so the order does not depend on how the table is split. A keyed hash of that sends the sequence to one of ``R``
ranges of like size; in its range it is numbered by the hash, and a balanced Feistel network over the next
power of four, keyed by key and range and walked until it falls below the range's size, permutes the
numbers. The global slot is the range's first slot plus that. Tokens move once: each task holds one range
and writes it as one file in which record ``k`` starts at byte ``2 * length * k``.

Rows that repeat id and text more often than ``HOT`` times go as blocks of copies with numbers of their own,
so they spread over all ranges.
"""

from __future__ import annotations

import base64
import re
import urllib.parse
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsim.llm.words import mix, values
from docsim.session import new_path, written

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256  # free in the vocabulary above
LENGTH = 512
PER_FILE = 8192  # slots of a task and its file, about; a multiple of it beyond MOST_TASKS tasks
MOST_TASKS = 100_000
HOT = 1000  # rows that repeat id and text more often than this, and than the MOST_HOT-th part of all rows, are spread
MOST_HOT = 10_000
BLOCK = 256  # copies of a row that stay together when it is spread
KEY = 20240229
ROUNDS = 6
CHUNK = 1 << 20
BLANKS = 1 << 16
LONG_BLANK = re.compile(rf"\s{{{BLANKS + 1},}}")
# the pre-tokeniser of the vocabulary, a fixed value
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_tokenizer(path: str):
    """The public byte-level BPE at ``path`` (a file that every executor has)."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("shards", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _cuts(text: str) -> list[int]:
    """Ends of the pieces that a text is tokenised in.

    A run of blanks is cut after every ``BLANKS`` of them: the pre-tokeniser fails on very long ones. Any other
    piece of ``CHUNK`` characters ends where a letter or digit meets a blank, if there is such a place.
    """
    blanks = [m.start() + k for m in LONG_BLANK.finditer(text) for k in range(BLANKS, m.end() - m.start(), BLANKS)]
    out, at = [], 0
    for stop in [*blanks, len(text)]:
        while stop - at > CHUNK:
            end = at + CHUNK
            at = next((k for k in range(end, at, -1) if text[k] == " " and text[k - 1].isalnum()), end)
            out.append(at)
        out.append(stop)
        at = stop
    return out


def encode(tokenizer, text: str | None) -> np.ndarray:
    """Token ids of a whole text, of any length."""
    text = text or ""
    parts, at = [np.zeros(0, np.uint16)], 0
    for end in _cuts(text):
        parts.append(np.array(tokenizer.encode_ordinary(text[at:end]), np.uint16))
        at = end
    return np.concatenate(parts)


def permuted(numbers: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """Slots of sequence numbers below ``total``: a permutation of ``range(total)``."""
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << shift) | right

    out = once(np.asarray(numbers, np.uint64))
    while len(over := np.flatnonzero(out >= total)):
        out[over] = once(out[over])
    return out.astype(np.int64)


class Folder:
    """A folder that tasks write files to and readers seek in: a path or an address that Arrow knows."""

    def __init__(self, path: str):
        address = urllib.parse.urlparse(path)
        local = address.scheme in ("", "file")
        self.system, self.path = (pa.fs.LocalFileSystem(), address.path) if local else pa.fs.FileSystem.from_uri(path)

    def write(self, name: str, content: bytes | memoryview) -> None:
        """Write a file whole or not at all. Another attempt at the same file has the same content."""
        self.system.create_dir(self.path, recursive=True)
        target, attempt = f"{self.path}/{name}", f"{self.path}/.{name}.{uuid.uuid4().hex}"
        with self.system.open_output_stream(attempt) as out:
            out.write(content)
        try:
            self.system.move(attempt, target)
        except OSError:  # some stores do not move onto a file that another attempt wrote
            if self.system.get_file_info(target).size != len(content):
                raise
            self.system.delete_file(attempt)

    def read(self, name: str, offset: int, size: int) -> bytes:
        with self.system.open_input_file(f"{self.path}/{name}") as file:
            file.seek(offset)
            return file.read(size)


def file_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _sequences(path: str, end: int, length: int, ranges: int, key: int) -> Callable:
    """Tokens of every text in pieces, each with its range, compressed for the way there."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tokenizer = load_tokenizer(path)
        pack = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=True).compress
        for batch in stream:
            out, size = [], 0
            for doc, text, row, block, copies in values(*batch.columns):
                codes = np.append(encode(tokenizer, text), np.uint16(end))
                for k, at in enumerate(range(0, len(codes), length)):
                    piece = codes[at : at + length]
                    sign = xxhash.xxh3_64_intdigest(f"{row}:{block}:{k}", key)
                    out.append((sign * ranges >> 64, sign >> 1, doc, k, len(piece), copies, pack(piece.tobytes())))
                size += len(codes)
                if size > 1 << 21:
                    yield _batch(out, batch.schema.field(0).type)
                    out, size = [], 0
            yield _batch(out, batch.schema.field(0).type)

    return run


def _batch(rows: list[tuple], ident: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), ident, pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    names = ["shard", "sign", "doc_id", "piece", "n_tokens", "copies", "tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _files(path: str, length: int, key: int) -> Callable:
    """Write the ranges of a task, each as one file, and list their records.

    The rows come sorted by range and hash; a range has about ``PER_FILE`` records, so it is held at once.
    """

    def write(shard: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        rows = pa.Table.from_batches(held).combine_chunks()
        copies = rows.column("copies").to_numpy()
        total, owner = int(copies.sum()), np.repeat(np.arange(len(copies)), copies)
        places = permuted(np.arange(total), total, (key + shard * 0x9E3779B9) & 0xFFFFFFFFFFFF)
        source = np.empty(total, np.int64)
        source[places] = owner
        tokens = rows.column("tokens")
        records = [unpack(t.as_py()).ljust(2 * length, b"\0") for t in tokens]
        Folder(path).write(file_name(shard), b"".join([records[k] for k in source]))
        sums = np.array([xxhash.xxh64_intdigest(r, 42) for r in records], np.uint64).astype(np.int64)
        listed = rows.select(["shard", "doc_id", "piece", "n_tokens"]).take(pa.array(source))
        listed = listed.add_column(1, "place", pa.array(np.arange(total))).append_column("checksum", pa.array(sums[source]))
        yield from listed.combine_chunks().to_batches()

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in stream:
            kinds = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)]
            for start, stop in zip(cuts, cuts[1:]):
                if stop > start and kinds[start] != shard:
                    if held:
                        yield from write(shard, held)
                    shard, held = int(kinds[start]), []
                if stop > start:
                    held.append(batch.slice(start, stop - start))
        if held:
            yield from write(shard, held)

    return run


def write_shards(
    documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
    end: int = END, length: int = LENGTH, per_file: int = PER_FILE, key: int = KEY, hot: int = HOT,
) -> int:
    """Write ``path/data/shard-*.bin``, ``path/index`` (a row per sequence) and ``path/files`` (a row per file).

    Returns the number of sequences. Every row of ``documents`` is written: null and empty texts as one sequence
    that holds the end token alone, repeated rows as often as they come. A record is ``length`` little-endian 16-bit
    ids, of which ``n_tokens`` count. Other columns are ignored. An empty table writes no file of records.
    """
    spark = documents.sparkSession
    ident = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the length of the id as text tells where it ends and whether it is null
    name = F.col("doc_id").cast("string")
    rows = rows.withColumn("row", F.sha2(F.concat(F.coalesce(F.length(name), F.lit(-1)), F.lit(":"), F.coalesce(name, F.lit("")), "text"), 256))
    met = rows.groupBy("row").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).cast("long").alias("bytes"))
    met = written(met, "token-rows")
    size = met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("n") * F.col("bytes")), F.lit(0)).alias("bytes")).first()
    # not more than MOST_HOT rows of this table can repeat that often
    spread = met.where(F.col("n") > max(hot, size.n // MOST_HOT)).select("row", "n")
    once = rows.join(F.broadcast(spread), "row", "left_anti").select("doc_id", "text", "row", F.lit(0).alias("block"), F.lit(1).alias("copies"))
    often = rows.join(F.broadcast(spread), "row").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("n").alias("n"))
    often = often.select("doc_id", "text", "row", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / BLOCK).cast("int"))).alias("block"))
    often = often.select("doc_id", "text", "row", "block", F.least(F.lit(BLOCK), F.col("n") - F.col("block") * BLOCK).cast("int").alias("copies"))

    expected = size.n + size.bytes // (4 * length)
    ranges = max(1, -(-expected // (per_file * max(1, -(-expected // (per_file * MOST_TASKS))))))
    schema = f"shard int, sign bigint, doc_id {ident}, piece int, n_tokens int, copies int, tokens binary"
    pieces = once.unionByName(often).mapInArrow(_sequences(tokenizer, end, length, ranges, key), schema)
    # equal hashes of different sequences are told apart by the rest, so the order is that of the rows' content
    ordered = pieces.repartitionById(ranges, "shard").sortWithinPartitions("shard", "sign", "doc_id", "piece", "tokens")
    listed = f"shard int, place bigint, doc_id {ident}, piece int, n_tokens int, checksum bigint"
    ordered.mapInArrow(_files(f"{path}/data", length, key), listed).write.parquet(f"{path}/index")
    # one row per file that a task wrote, so the scheduler has held as many already
    sizes = spark.read.schema(listed).parquet(f"{path}/index").groupBy("shard").agg(F.count("*").alias("n")).orderBy("shard").collect()
    files, total = [], 0
    for row in sizes:
        files.append((row.shard, file_name(row.shard), total, row.n, 2 * length))
        total += row.n
    spark.createDataFrame(files, FILES).coalesce(1).write.parquet(f"{path}/files")
    return total


FILES = "shard int, file string, first_slot bigint, n bigint, stride int"


def read_index(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``slot``, ``shard``, ``offset`` (first byte of the record in its file), ``doc_id``, ``piece``, ``n_tokens``, ``checksum``."""
    files = spark.read.schema(FILES).parquet(f"{path}/files")
    rows = spark.read.schema(f"shard int, place bigint, doc_id {id_type}, piece int, n_tokens int, checksum bigint").parquet(f"{path}/index")
    return rows.join(F.broadcast(files), "shard").select(
        (F.col("first_slot") + F.col("place")).alias("slot"), "shard", (F.col("place") * F.col("stride")).alias("offset"),
        "doc_id", "piece", "n_tokens", "checksum",
    )


def records(spark: SparkSession, path: str, from_slot: int = 0, chunk: int = 1024) -> Iterator[tuple[int, bytes]]:
    """(slot, record) in training order from a slot on: files before it are not opened, the first is entered by seek."""
    folder = Folder(f"{path}/data")
    files = spark.read.schema(FILES).parquet(f"{path}/files").where(F.col("first_slot") + F.col("n") > from_slot)
    for row in files.orderBy("first_slot").toLocalIterator():
        for at in range(max(0, from_slot - row.first_slot), row.n, chunk):
            content = folder.read(row.file, at * row.stride, min(chunk, row.n - at) * row.stride)
            for k in range(0, len(content), row.stride):
                yield row.first_slot + at + k // row.stride, content[k : k + row.stride]


def token_ids(record: bytes, n_tokens: int) -> list[int]:
    """The ids of a record without its padding."""
    return np.frombuffer(record, "<u2")[:n_tokens].tolist()


def materialise(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the shards to the shared folder and list what they hold, one row per sequence (see ``read_index``).

    ``piece`` is the place of the sequence in its document, ``checksum`` the xxhash64 of the record.
    """
    spark = documents.sparkSession
    path = new_path(spark, "shards")
    write_shards(documents, path, id_col, text_col, **options)
    return read_index(spark, path, documents.schema[id_col].dataType.simpleString())
