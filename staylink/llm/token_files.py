"""Token ids in compact files: ids ranked by frequency, in byte-aligned
variable-length coding with separate control bytes.

:func:`encoded` tokenizes whole texts with the ``tokenizers`` library.  Where the
tokenizer's own description shows that no token spans ASCII white space, each
distinct word of a batch goes to the library once and a text's ids are gathered
from those of its words; any other tokenizer gets the whole texts.

:class:`RankedIds` is a Spark data source (``ranked_ids``).  Documents arrive in
ranges of ascending id; each task writes files of whole blocks, and only files
that the job commits enter the list ``files.json``, with the number of ids before
them, so lost or repeated tasks leave nothing that a reader sees.  A frequent id
has a small rank and takes one byte; two bits of a control byte give the length
of each of four ranks, so a decoder finds which bytes are there by one table
lookup per control byte, for a whole block at once.  Readers take one file per task, a
block at a time.

Defined results: a null or empty text has the end id only; a null doc_id sorts
first; rows that share a doc_id stand in the order of the hash of their ids, equal
rows one after the other; an empty table gives no rows.  Only doc_id and text are
read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import load, shared_dir, stored

END = 2
#: Bytes of text handled at once, words and ids remembered, ids of a block, bytes after which a new file starts.
SLICE, WORDS, IDS, BLOCK, FILE = 4_000_000, 400_000, 4_000_000, 1 << 19, 32 << 20
#: New words that go to the library as one text.
TOGETHER = 64
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"

# --- coding ------------------------------------------------------------------------

#: For each control byte, which bytes of four little-endian 32-bit ranks are there.
PRESENT = (np.arange(4) <= (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)[:, :, None]).reshape(256, 16)


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    padded = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    padded[:len(ranks)] = ranks
    code = (padded > 0xFF).view(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    there = PRESENT[control].reshape(-1)
    there[4 * len(ranks):] = False
    return control, padded.view(np.uint8)[there]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers of :func:`pack`."""
    if len(control) != -(-n // 4):
        raise ValueError("control bytes do not fit")
    there = PRESENT[control].reshape(-1)
    there[4 * n:] = False
    ranks = np.zeros(len(there), np.uint8)
    ranks[there] = data
    return ranks.view("<u4")[:n]


# --- files -------------------------------------------------------------------------

MAGIC = b"RIDS0001"


def folder(uri: str):
    """(file system, path) of a folder; any scheme that Arrow knows."""
    from pyarrow.fs import FileSystem, LocalFileSystem
    if not re.match(r"[a-z][a-z0-9+.-]*:", uri):
        return LocalFileSystem(), uri
    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def cells(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """(ends, bytes) of a binary column without nulls."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return offsets[1:] - offsets[0], memoryview(data or b"")[offsets[0]:offsets[-1]]


def column_of(ends: np.ndarray, data: bytes) -> pa.Array:
    """The binary column of cells that end at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def block_bytes(doc_ids: list, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    """Documents, ids, control and data bytes; then doc ids with their null
    marks, ids per document, control bytes, data bytes."""
    control, data = pack(ranks)
    head = np.array([len(doc_ids), len(ranks), len(control), len(data)], "<u8")
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([head.tobytes(), numbers.tobytes(), nulls.tobytes(), counts.astype("<u8").tobytes(),
                     control.tobytes(), data.tobytes()])


def blocks(f) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc ids, ids per document, ranks) of each block of an open file."""
    def take(n: int, dtype) -> np.ndarray:
        raw = f.read(n * np.dtype(dtype).itemsize)
        if len(raw) != n * np.dtype(dtype).itemsize:
            raise ValueError("the file ends inside a block")
        return np.frombuffer(raw, dtype)

    if f.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of ranked ids")
    while head := f.read(32):
        n_docs, n_ids, n_control, n_data = np.frombuffer(head, "<u8").astype(int)
        numbers, nulls = take(n_docs, "<i8"), take(n_docs, np.uint8)
        counts = take(n_docs, "<u8").astype(np.int64)
        yield ([None if z else int(d) for d, z in zip(numbers, nulls)], counts,
               unpack(take(n_control, np.uint8), take(n_data, np.uint8), n_ids))


@dataclass
class Written(WriterCommitMessage):
    partition: int
    files: list  # (name, documents, ids) in order


class RankedIdsWriter(DataSourceArrowWriter):
    """Rows (doc_id, ids) in order; ids are little-endian unsigned integers of
    ``width`` bytes; ``block`` ids make a block, ``file`` bytes a file."""

    def __init__(self, options):
        self.path, self.width = options["path"], int(options["width"])
        self.block, self.file = int(options.get("block", BLOCK)), int(options.get("file", FILE))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, base = folder(self.path)
        with fs.open_input_file(f"{base}/by_rank") as f:
            by_rank = np.frombuffer(f.read(), "<u4")
        rank_of = np.empty(len(by_rank), np.uint32)
        rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
        partition, stem, files = TaskContext.get().partitionId(), uuid.uuid4().hex, []
        out = None
        for batch in batches:
            doc_ids = batch["doc_id"].to_pylist()
            ends, data = cells(batch["ids"])
            ids, ends = np.frombuffer(data, f"<u{self.width}"), ends // self.width
            first = 0
            while first < len(doc_ids):  # whole documents, about ``block`` ids
                before = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + self.block, "right")))
                if out is None:
                    files.append([f"part-{partition:06d}-{stem}-{len(files):05d}.rids", 0, 0])
                    out = fs.open_output_stream(f"{base}/{files[-1][0]}")
                    out.write(MAGIC)
                counts = np.diff(ends[first:last], prepend=before)
                out.write(block_bytes(doc_ids[first:last], counts, rank_of[ids[before:ends[last - 1]]]))
                files[-1][1] += last - first
                files[-1][2] += int(counts.sum())
                first = last
                if out.tell() >= self.file:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(partition, files)

    def commit(self, messages) -> None:
        fs, base = folder(self.path)
        listed, before = [], 0
        for message in sorted(filter(None, messages), key=lambda m: m.partition):
            for name, docs, ids in message.files:
                listed.append({"file": name, "docs": docs, "ids": ids, "before": before})
                before += ids
        with fs.open_output_stream(f"{base}/files.json") as f:
            f.write(json.dumps(listed).encode())

    def abort(self, messages) -> None:
        fs, base = folder(self.path)
        for message in filter(None, messages):
            for name, _, _ in message.files:
                fs.delete_file(f"{base}/{name}")


@dataclass
class OneFile(InputPartition):
    name: str
    before: int


class RankedIdsReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self) -> list[OneFile]:
        fs, base = folder(self.path)
        with fs.open_input_file(f"{base}/files.json") as f:
            return [OneFile(x["file"], x["before"]) for x in json.loads(f.read())] or [OneFile("", 0)]

    def read(self, part: OneFile) -> Iterator[pa.RecordBatch]:
        if not part.name:
            return
        fs, base = folder(self.path)
        with fs.open_input_file(f"{base}/by_rank") as f:
            by_rank = np.frombuffer(f.read(), "<u4")
        start = part.before
        with fs.open_input_stream(f"{base}/{part.name}") as f:
            for doc_ids, counts, ranks in blocks(f):
                ends = np.cumsum(counts)
                yield pa.record_batch({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": start + ends - counts, "n_tokens": counts,
                    "ids": column_of(4 * ends, by_rank[ranks].tobytes())})
                start += int(ends[-1])


class RankedIds(DataSource):
    """``format("ranked_ids")``: reads (doc_id, start, n_tokens, ids), writes
    (doc_id, ids) in the order of the rows' partitions."""

    @classmethod
    def name(cls) -> str:
        return "ranked_ids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RankedIdsReader:
        return RankedIdsReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> RankedIdsWriter:
        return RankedIdsWriter(dict(self.options))


# --- tokenizing --------------------------------------------------------------------

# Fixed value: the pieces of a tokenizer description under which text can be cut
# at ASCII white space: the normalizers work character by character or replace
# white space, the split drops all that its pattern does not match.
SAFE_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def cuts_at_space(description: dict) -> bool:
    """Whether the tokenizer's ids of a text are those of its words (parts
    between ASCII white space) one after the other."""
    normalizer, cut = description.get("normalizer"), description.get("pre_tokenizer") or {}
    steps = [] if normalizer is None else normalizer.get("normalizers", [normalizer])
    parts = cut.get("pretokenizers", [cut])
    split = parts[0]
    whole = split.get("type") == "Split" and split.get("invert") and split.get("behavior") == "Removed" and "Regex" in split["pattern"]
    if not whole or any(s not in SAFE_NORMALIZERS for s in steps) or description.get("post_processor") or description.get("truncation"):
        return False
    # each alternative is letters after an apostrophe, or one class without white space, perhaps repeated
    alternatives = split["pattern"]["Regex"].split("|")
    simple = r"'[a-z]+|\[(?:\\p\{[LN]\})+\]\+?|\[\^\\s(?:\\p\{[LN]\})*\]\+?"
    level = [p for p in parts[1:] if p.get("type") != "ByteLevel" or p.get("add_prefix_space") or p.get("use_regex")]
    added = all(not set(t["content"]) & set(" \t\n\r\v\f") and not t["lstrip"] and not t["rstrip"] for t in description["added_tokens"])
    return all(re.fullmatch(simple, a) for a in alternatives) and not level and added


class Numbers(dict):
    """word -> number in order of first sight; ``new`` lists those just met."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Ids:
    """The ids of texts; words already met are remembered, in bounded memory."""

    def __init__(self, description: str, end: int):
        from tokenizers import Tokenizer
        self.tokenizer, self.end = Tokenizer.from_str(description), end
        parts = json.loads(description)
        self.by_word = cuts_at_space(parts)
        self.lower = self.by_word and '"Lowercase"' in json.dumps(parts["normalizer"])
        # no normalizer changes an ASCII word once its letters are lower-case
        self.ascii = Tokenizer.from_str(json.dumps({**parts, "normalizer": None})) if self.by_word else None
        self.index, self.known, self.n_flat = Numbers(), 0, 0
        self.flat, self.first, self.count, self.hits = np.empty(0, np.uint32), *np.zeros((3, 0), np.int64)
        assert self.index[None] == 0  # what ends a document
        self.index.new.clear()
        self.learn(np.zeros(1, int), np.array([end], np.uint32), np.array([1]))

    def forget(self) -> None:
        """Keep half of the memory at most: words met more than once, the most
        frequent first."""
        many = np.flatnonzero(self.hits[1:self.known] > 1) + 1
        kept = np.concatenate([[0], many[np.argsort(-self.hits[many], kind="stable")][:WORDS // 2]])
        counts = self.count[kept]
        if counts.sum() > IDS // 2:
            kept, counts = kept[:1], counts[:1]
        words, ids = list(self.index), self.gathered(kept)
        self.index = Numbers()
        self.index.update((words[k], n) for n, k in enumerate(kept.tolist()))
        self.known, self.n_flat, self.hits[:] = 0, 0, 0
        self.learn(np.arange(len(kept)), ids, counts)

    def gathered(self, at: np.ndarray) -> np.ndarray:
        """The ids of the words of these numbers, one after the other."""
        counts = self.count[at]
        ends = np.cumsum(counts)
        return self.flat[np.repeat(self.first[at] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]

    def learn(self, at: np.ndarray, new: np.ndarray, counts: np.ndarray) -> None:
        """The ids of the words of these numbers."""
        n, m, total = self.known, len(self.index), self.n_flat + len(new)
        if total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * total)
        if m > len(self.first):
            self.first, self.count, self.hits = (np.concatenate([x[:n], np.zeros(2 * m - n, np.int64)])
                                                 for x in (self.first, self.count, self.hits))
        self.flat[self.n_flat:total] = new
        self.first[at], self.count[at] = self.n_flat + np.cumsum(counts) - counts, counts
        self.known, self.n_flat = m, total

    def learn_words(self, words: list[str]) -> None:
        """The ids of the words met last, in order of their numbers."""
        first = len(self.index) - len(words)
        plain = np.fromiter(map(str.isascii, words), bool, len(words))
        for tokenizer, which in ((self.ascii, plain), (self.tokenizer, ~plain)):
            at = np.flatnonzero(which)
            if len(at):
                self.learn(first + at, *self.of_words(tokenizer, [words[k] for k in at.tolist()]))

    def of_words(self, tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word): each token of the joined words
        belongs to the word in which it begins."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        every = range(0, len(words), TOGETHER)
        parts = tokenizer.encode_batch([" ".join(words[k:k + TOGETHER]) for k in every], add_special_tokens=False)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ids = np.fromiter(chain.from_iterable(one.ids for one in parts), np.uint32, sizes.sum())
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(one.offsets for one in parts)), np.int64, 2 * sizes.sum())
        base = np.concatenate([[0], ends[TOGETHER - 1::TOGETHER]])[:len(parts)]
        begins = spans[::2] + np.repeat(base, sizes)
        return ids, np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(words))

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text), the end id after each text; no
        text is null."""
        if not self.by_word:
            ids = [[*one.ids, self.end] for one in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64)
        if len(self.index) > WORDS or self.n_flat > IDS:
            self.forget()
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if self.lower else texts)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        if self.index.new:
            self.learn_words(self.index.new)
            self.index.new.clear()
        # a zero, the number of the end, after the words of each text
        after = np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64) + 1) - 1
        at = np.zeros(len(words) + len(after), np.int64)
        there = np.ones(len(at), bool)
        there[after] = False
        at[there] = number[words.indices.to_numpy()]
        self.hits[:self.known] += np.bincount(at, minlength=self.known)
        return self.gathered(at), np.diff(np.cumsum(self.count[at])[after], prepend=0)


@lru_cache(maxsize=1)
def remembered(description: str, end: int) -> Ids:
    """One for all tasks of a worker."""
    return Ids(description, end)


def runs(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts, null ones empty, in runs of about ``SLICE`` bytes."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    run = np.cumsum(pc.binary_length(texts).to_numpy()) // SLICE
    cuts = np.flatnonzero(np.diff(run, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(texts)]):
        yield texts.slice(a, b - a)


def encoded(docs: DataFrame, path: str, end: int = END, text: str = "text") -> tuple[DataFrame, int, int]:
    """(rows (doc_id, ids, seen), size of the vocabulary, bytes of an id): the ids
    of each text and the end id, as little-endian unsigned integers; the last row
    of a batch carries the counts of all its ids (pairs of 64-bit integers), so
    that nobody has to read the ids again to count them."""
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        description = f.read()
    size = max(Tokenizer.from_str(description).get_vocab(with_added_tokens=True).values()) + 1
    size = max(size, end + 1)
    width = 2 if size <= 1 << 16 else 4

    @F.arrow_udf("struct<ids: binary, seen: binary>")
    def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are what runs side by side
        model = remembered(description, end)
        for texts in parts:
            raw, sizes, total = [], [np.zeros(0, np.int64)], np.zeros(size, np.int64)
            for run in runs(texts):
                all_ids, counts = model.of(run)
                total += np.bincount(all_ids, minlength=size)
                raw.append(all_ids.astype(f"<u{width}").tobytes())
                sizes.append(counts)
            met = np.flatnonzero(total)
            seen = [None] * (len(texts) - 1) + [np.stack([met, total[met]]).astype("<i8").tobytes()] * bool(len(texts))
            yield pa.StructArray.from_arrays([column_of(width * np.cumsum(np.concatenate(sizes)), b"".join(raw)),
                                              pa.array(seen, pa.binary())], names=["ids", "seen"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ids(F.col(text).cast("string")).alias("_e"))
    return rows.select("doc_id", "_e.ids", "_e.seen"), size, width


def by_frequency(rows: DataFrame, size: int) -> np.ndarray:
    """All ids, the most frequent first (ties: the smaller id).  Each task sends
    one count per id, and the vocabulary bounds what reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch["seen"].to_pylist():
                ids, n = np.frombuffer(raw, "<i8").reshape(2, -1)
                total[ids] += n
        seen = np.flatnonzero(total)
        yield pa.record_batch({"id": seen, "n": total[seen]})

    counts = np.zeros(size, np.int64)
    sums = rows.where("seen is not null").select("seen").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for r in sums.collect():
        counts[r["id"]] = r["n"]
    return np.lexsort((np.arange(size), -counts)).astype(np.uint32)


def write_ids(rows: DataFrame, path: str, by_rank: np.ndarray, width: int, **options) -> None:
    """(doc_id, ids, _hash, _turn) as files in ascending doc_id order."""
    spark = rows.sparkSession
    spark.dataSource.register(RankedIds)
    fs, base = folder(path)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/by_rank") as f:
        f.write(by_rank.astype("<u4").tobytes())
    # equal rows are told apart by their turn, so a group of them is no single range
    order = ["doc_id", "_hash", "_turn"]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
         .write.format("ranked_ids").options(width=width, **options).mode("append").save(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all
    documents before, ids are little-endian unsigned 32-bit integers."""
    spark.dataSource.register(RankedIds)
    return spark.read.format("ranked_ids").load(path)


def token_files(docs: DataFrame, path: str, tokenizer: str, end: int = END, **options) -> DataFrame:
    """Tokenizes ``docs``, writes the files to the folder ``path`` and reads
    them back; ``options`` go to the writer."""
    rows, size, width = encoded(docs, tokenizer, end)
    rows = stored(rows.withColumns({"_hash": F.xxhash64("ids"), "_turn": F.monotonically_increasing_id()}), "token-ids", compression="zstd")
    write_ids(rows, path, by_frequency(rows, size), width, **options)
    return read_ids(docs.sparkSession, path)


def op12_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = load(spark, sf_dir, "documents")
    files = token_files(docs, shared_dir(spark, "token-files"), public_tokenizers.path("word_bpe_49k.json"))
    return files.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
