"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Tokenising is one pass over the texts; the token ids stay where they are unless asked for, only piece lengths
are dealt out. Every task packs its pieces online with a fixed number of open bins: a bitset over free space
tells the tightest open bin that fits, and when one bin too many is open the fullest is closed. Pieces left
in bins that a task could not fill go to a next round with fewer tasks, so the number of tasks leaves no trace
in the number of sequences, and no task holds more than its open bins.

Defined cases: a null or empty text is the end token alone; a repeated row is packed as a document of its own; an
empty table packs into nothing; a very long text is cut into whole pieces, of which only the first may be
shorter; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import plain, table, written

CAPACITY = 2048
END_TOKEN = 0
OPEN_BINS = 4096
PIECES_PER_TASK = 250_000
#: Texts of a batch that a worker holds as Python strings at once.
TEXTS_AT_ONCE = 256

# Fixed value: the byte-level BPE's pre-tokenising pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of these characters only: all pattern libraries class them alike.
_SAME = re.compile(r"[\x09-\x0d\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")
#: White space in a row up to which the rank encoder is safe; its pattern library overflows near 1,000,000.
SAFE_BLANKS = 100_000
_BLANKS = re.compile(r"\s{2,}")
_tokenizers: dict[str, tuple] = {}
_added: dict[str, list[str]] = {}


def _tokenizer(path: str) -> tuple:
    """The tokenizer of a .json file and, if its vocabulary also lies beside it as ranks, the encoder over those."""
    if path not in _tokenizers:
        import base64

        from tokenizers import Tokenizer

        full, fast = Tokenizer.from_file(path), None
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import tiktoken

            with open(ranks, "rb") as f:
                pairs = [line.split() for line in f]
            fast = tiktoken.Encoding(os.path.basename(ranks), pat_str=PATTERN, special_tokens={},
                                     mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs})
        _tokenizers[path] = full, fast
        _added[path] = [t.content for t in full.get_added_tokens_decoder().values()]
    return _tokenizers[path]


def _long_blanks(text: str) -> bool:
    return len(text) > SAFE_BLANKS and any(m.end() - m.start() > SAFE_BLANKS for m in _BLANKS.finditer(text))


def encode(text: str, path: str) -> bytes:
    """The token ids of a whole text as little-endian unsigned 32-bit integers.

    The rank encoder gives the same ids about four times as fast; texts with characters that its pattern
    library could class differently, with more white space in a row than it can take, or with an added token,
    which has no rank, go through the tokenizer itself.
    """
    full, fast = _tokenizer(path)
    if fast and _SAME.fullmatch(text) and not _long_blanks(text) and not any(t in text for t in _added[path]):
        ids = fast.encode_ordinary(text)
    else:
        ids = full.encode_batch_fast([text], add_special_tokens=False)[0].ids
    return np.asarray(ids, dtype="<u4").tobytes()


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole ones, the first may be shorter."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def tokenised(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
              text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if asked for, ids (array of int)."""
    fields = [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.uint32()))] * with_ids
    schema = pa.schema(fields)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        end = np.asarray([END_TOKEN], dtype="<u4").tobytes()
        for batch in (b.slice(at, TEXTS_AT_ONCE) for b in batches for at in range(0, b.num_rows, TEXTS_AT_ONCE)):
            columns = [[] for _ in fields]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "", tokenizer_path) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start: 4 * (start + length)]
                    row = (i, k, start, length, zlib.crc32(own)) + ((np.frombuffer(own, "<u4"),) if with_ids else ())
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                                             schema=schema)

    ddl = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    if with_ids:
        schema = schema.set(5, pa.field("ids", pa.list_(pa.int64())))
    return plain(docs, id=id_col, text=text_col).mapInArrow(tokenise, ddl)


class OpenBins:
    """A fixed number of open bins; bit ``f`` of ``free`` is set while some open bin has ``f`` tokens free."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.open = capacity, most, 0
        self.free = 0
        self.by_free: list[list] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.free &= ~(1 << free)
        self.open -= 1
        return found

    def _put(self, free: int, content: list) -> None:
        self.by_free[free].append(content)
        self.free |= 1 << free
        self.open += 1

    def add(self, size: int, item) -> Iterator[list]:
        """Place an item in the tightest open bin that holds it; yields the bins that this closes."""
        fits = self.free >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            content = self._take(free)
        else:
            free, content = self.capacity, []
        content.append(item)
        if free == size:
            yield content
            return
        self._put(free - size, content)
        if self.open > self.most:                        # the fullest closes first
            yield self._take((self.free & -self.free).bit_length() - 1)

    def rest(self) -> Iterator[tuple[int, list]]:
        for free, bins in enumerate(self.by_free):
            for content in bins:
                yield free, content


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         pieces_per_task: int = PIECES_PER_TASK, name: str = "packed") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length`` (at most ``capacity``) and ``id``, ``piece``.

    ``pieces_per_task`` and ``open_bins`` bound a task's memory; they do not limit the input.
    """
    spark, columns = pieces.sparkSession, pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) \
        + ", sequence_id bigint, offset bigint"
    slack = capacity // 100

    def task(round_no: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins, number = OpenBins(capacity, open_bins), 0
            base = (round_no << 56) | (TaskContext.get().partitionId() << 32)
            rows: list[dict] = []

            def closed(content: list) -> None:
                nonlocal number
                at = 0
                for item in content:
                    rows.append(item | {"sequence_id": base + number, "offset": at})
                    at += item["length"]
                number += 1

            def flushed() -> pa.RecordBatch:
                out = pa.RecordBatch.from_pylist(rows, out_schema)
                rows.clear()
                return out

            out_schema = None
            for batch in batches:
                if out_schema is None:
                    out_schema = batch.schema.append(pa.field("sequence_id", pa.int64())).append(
                        pa.field("offset", pa.int64()))
                for item in batch.to_pylist():
                    for content in bins.add(item["length"], item):
                        closed(content)
                if rows:
                    yield flushed()
            for free, content in bins.rest():
                if last or free <= slack:
                    closed(content)
                else:                                    # to the next round
                    rows.extend(item | {"sequence_id": None, "offset": None} for item in content)
                if len(rows) > 10_000:
                    yield flushed()
            if rows:
                yield flushed()

        return run

    rest, done, round_no, tasks = pieces, None, 0, None
    while True:
        n = rest.count()
        wanted = max(1, -(-n // pieces_per_task))
        tasks = wanted if tasks is None else max(1, min(wanted, tasks // 2))
        # short pieces among long ones: the order is a hash of the piece, the same on every run
        dealt = rest.repartition(tasks, "id", "piece").sortWithinPartitions(F.xxhash64("id", "piece"), "id", "piece")
        out = written(dealt.select(*columns).mapInArrow(task(round_no, tasks == 1), schema), name)
        full = out.filter("sequence_id IS NOT NULL")
        done = full if done is None else done.unionByName(full)
        if tasks == 1:
            return done
        rest, round_no = out.filter("sequence_id IS NULL"), round_no + 1


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: a row per piece with its sequence and offset (and ids, if asked for)."""
    return pack(written(tokenised(docs, tokenizer_path, capacity, id_col, text_col, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The token ids of each sequence, from :func:`pack_documents` with ids; a group is one sequence."""
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(
        F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digest_columns(packed: DataFrame) -> DataFrame:
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return digest_columns(pack_documents(table(spark, sf_dir, "documents"), default_tokenizer()))
