"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by joined byte pieces."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.text import blocks, run_hashes, stored_by, utf8

#: Buckets of the rank map; a bucket holds about one entry, so a look-up reads one or two keys.
BUCKETS = 1 << 16
#: Words of the documents whose distinct words are listed together.
CHUNK_WORDS = 3 << 19
#: Words of the documents that are written out together; a longer document is alone.
GROUP_WORDS = 1 << 16
#: Rank of a pair that is no token.
NONE = (1 << 31) - 1
#: A slice length beyond any word's.
REST = 1 << 30


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64-token rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def rank_table(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """One row with ``ranks``, an array of small maps from token to rank; a token stands in the map that its CRC-32 names.

    Tokens are strings of one character a byte (ISO 8859-1), so that JSON can carry them and characters are bytes. As a
    row it can be broadcast: an executor holds it once, where a literal is in every plan, in every plan's text and in
    every task once for each place that names it.
    """
    maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        name = token.decode("latin-1")
        maps[zlib.crc32(name.encode("utf-8")) % BUCKETS][name] = rank
    rows = spark.createDataFrame(pa.table({"ranks": [json.dumps(maps, separators=(",", ":"))]}))
    return rows.select(F.from_json("ranks", "array<map<string,int>>").alias("ranks"))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: lambda variables are, expressions named twice are not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def encoded(words: str, table: str) -> Column:
    """Token ids of each word of an array column by the column of a ``rank_table``, a fold over the word's bytes.

    A word that is a token is its own id. Otherwise the state is the list of pieces, for every two neighbours the
    rank of both together, with ``NONE`` before the first piece and behind the last, and the place of the leftmost least
    rank, 0 if no pair is a token. Each step joins that pair and looks up the two new neighbours only; the fold has as
    many steps as there are bytes.
    """
    rank = lambda x: F.coalesce(F.element_at(F.get(F.col(table), (F.crc32(x) % BUCKETS).cast("int")), x), F.lit(NONE))

    def state(pieces: Column, found: Column) -> Column:
        at = lambda x: _bound(F.array_min(x.r), lambda low: F.when(low == NONE, 0).otherwise(F.array_position(x.r, low)).cast("int"))
        return _bound(F.struct(pieces.alias("p"), found.alias("r")), lambda x: F.struct(x.p.alias("p"), x.r.alias("r"), at(x).alias("at")))

    def merge(s: Column) -> Column:
        def joined(x: Column) -> Column:  # beside the ends of the word there is a null, which has no rank
            near = F.array(rank(F.concat(F.get(s.p, s.at - 3), x)), rank(F.concat(x, F.get(s.p, s.at))))
            return state(
                F.concat(F.slice(s.p, F.lit(1), s.at - 2), F.array(x), F.slice(s.p, s.at + 1, F.lit(REST))),
                F.concat(F.slice(s.r, F.lit(1), s.at - 2), near, F.slice(s.r, s.at + 2, F.lit(REST))),
            )

        return _bound(F.concat(F.get(s.p, s.at - 2), F.get(s.p, s.at - 1)), joined)

    def fold(word: Column) -> Column:
        def started(letters: Column) -> Column:
            pairs = F.zip_with(F.slice(letters, F.lit(1), F.size(letters) - 1), F.slice(letters, F.lit(2), F.lit(REST)), lambda a, b: rank(F.concat(a, b)))
            return state(letters, F.concat(F.array(F.lit(NONE)), pairs, F.array(F.lit(NONE))))

        step = lambda s, i: F.when(s.at == 0, s).otherwise(merge(s))
        return F.aggregate(F.sequence(F.lit(1), F.length(word)), _bound(F.split(word, ""), started), step, lambda s: F.transform(s.p, rank))

    one = lambda word: _bound(rank(word), lambda own: F.when(own != NONE, F.array(own)).otherwise(fold(word)))
    return F.transform(F.transform(words, lambda w: F.decode(F.encode(w, "UTF-8"), "ISO-8859-1")), one)


_CHUNK = "chunk long, doc_ids array<bigint>, sizes array<int>, places binary, lengths binary, letters binary"
_PIECE = "bucket long, chunk long, size int, lengths binary, letters binary"
_BUCKET = "bucket long, chunks array<bigint>, sizes array<int>, places binary, words array<string>"
_ENCODED = "bucket long, chunk long, size int, counts binary, ids binary"
_RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Buckets of words for each chunk of documents; a bucket then holds about a quarter of the words of a chunk.
SPREAD = 4


def _column(values, kind: pa.DataType) -> pa.Array:
    return pa.array(values, kind)


def _shrunk(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(data, asbytes=True) if data else b""


def _grown(data: bytes, count: int) -> bytes:
    """The ``count`` bytes that ``_shrunk`` was given."""
    return pa.Codec("zstd").decompress(data, count, asbytes=True) if count else b""


def _squeezed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 32 bits, compressed byte place by byte place."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _shrunk(planes.tobytes())


def _restored(data: bytes, count: int) -> np.ndarray:
    """The ``count`` numbers that ``_squeezed`` was given."""
    planes = np.frombuffer(_grown(data, 4 * count), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


def _words(lengths: bytes, letters: bytes) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(np.frombuffer(lengths, np.int32)))).astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(letters))


def _bucket_order(lengths: bytes, letters: bytes, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word by its hash, and the words ordered by bucket."""
    ends = np.cumsum(np.frombuffer(lengths, np.int32).astype(np.int64))
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    data = np.frombuffer(letters, np.uint8)
    bucket = np.zeros(len(ends), np.int64)
    for i, j in blocks(np.concatenate(([0], ends))):
        low = starts[i]
        bucket[i:j] = (run_hashes(data[low : ends[j - 1]], starts[i:j] - low, ends[i:j] - low) % np.uint64(count)).astype(np.int64)
    return bucket, np.argsort(bucket, kind="stable")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a chunk of documents: the distinct words, and for each document the places of its words among them.

    A chunk has ``CHUNK_WORDS`` words at most, or one document.
    """
    wrap = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False))))
        for i, j in blocks(ends, CHUNK_WORDS):
            part = batch.slice(i, j - i)
            coded = part.column(1).flatten().dictionary_encode()
            places = coded.indices.to_numpy(zero_copy_only=False)
            often = np.argsort(-np.bincount(places, minlength=len(coded.dictionary)), kind="stable")  # low places are the frequent ones
            place = np.empty(len(often), np.int32)
            place[often] = np.arange(len(often), dtype=np.int32)
            places = place[places]
            data, offsets = utf8(coded.dictionary.take(pa.array(often)))
            columns = [
                _column([chunk], pa.int64()),
                wrap(part.column(0)),
                wrap(_column(np.diff(ends[i : j + 1]), pa.int32())),
                _column([_squeezed(places)], pa.binary()),
                _column([np.diff(offsets).astype(np.int32).tobytes()], pa.binary()),
                _column([data.tobytes()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "doc_ids", "sizes", "places", "lengths", "letters"])
            chunk += 1
            del part, coded, places, data, columns
            pa.default_memory_pool().release_unused()  # a worker is kept for later tasks


def _pieces(count: int):
    """From the words of chunks to one row a chunk and bucket that has some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                chunk, lengths, letters = (batch.column(c)[r].as_py() for c in range(3))
                bucket, order = _bucket_order(lengths, letters, count)
                words = _words(lengths, letters).take(pa.array(order))
                data, offsets = utf8(words)
                sizes, data = np.diff(offsets).astype(np.int32), data.tobytes()
                named, first = np.unique(bucket[order], return_index=True)
                edges = np.append(first, len(order))
                cut = lambda k: (_squeezed(sizes[edges[k] : edges[k + 1]]), _shrunk(data[offsets[edges[k]] : offsets[edges[k + 1]]]))
                parts = [cut(k) for k in range(len(named))]
                packed = [_column([x[c] for x in parts], pa.binary()) for c in (0, 1)]
                columns = [_column(named, pa.int64()), _column([chunk] * len(named), pa.int64()), _column(np.diff(edges), pa.int32()), *packed]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "chunk", "size", "lengths", "letters"])
                pa.default_memory_pool().release_unused()

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces ordered by bucket to one row a bucket: its distinct words, and the places of each chunk's words."""
    wrap = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), _column(values, kind))

    def row(bucket: int, pieces: list[tuple[int, pa.Array]]) -> pa.RecordBatch:
        coded = pa.concat_arrays([x for _, x in pieces]).dictionary_encode()
        columns = [
            _column([bucket], pa.int64()),
            wrap([c for c, _ in pieces], pa.int64()),
            wrap([len(x) for _, x in pieces], pa.int32()),
            _column([coded.indices.to_numpy(zero_copy_only=False).astype(np.int32).tobytes()], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "chunks", "sizes", "places", "words"])

    held, own = [], None
    for batch in batches:
        for bucket, chunk, size, lengths, letters in zip(*(c.to_pylist() for c in batch.columns)):
            if held and bucket != own:
                yield row(own, held)
                held = []
                pa.default_memory_pool().release_unused()
            own = bucket
            sizes = _restored(lengths, size)
            held.append((chunk, _words(sizes.tobytes(), _grown(letters, int(sizes.sum())))))
    if held:
        yield row(own, held)


def _dealt_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From buckets whose words are encoded to the ids of each chunk's words, in the order of the chunk's piece."""
    for batch in batches:
        for r in range(batch.num_rows):
            chunks, sizes = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in (1, 2))
            places = np.frombuffer(batch.column(3)[r].as_py(), np.int32)
            by_word = batch.column(4)[r].values
            counts = pc.list_value_length(by_word).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = by_word.flatten().to_numpy(zero_copy_only=False)
            starts, edges = np.cumsum(counts) - counts, np.concatenate(([0], np.cumsum(sizes)))
            found = []
            for a, b in zip(edges[:-1], edges[1:]):
                n = counts[places[a:b]]
                found.append((_squeezed(n), _squeezed(flat[_runs(starts[places[a:b]], n)])))
            columns = [
                _column([batch.column(0)[r].as_py()] * len(chunks), pa.int64()),
                _column(chunks, pa.int64()),
                _column(sizes, pa.int32()),
                _column([x[0] for x in found], pa.binary()),
                _column([x[1] for x in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "chunk", "size", "counts", "ids"])
            pa.default_memory_pool().release_unused()


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...``, ``count`` of them for each start, one run after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _written(vocabulary: list[bytes], count: int):
    """From chunks with the ids of their distinct words, listed by bucket, to rows of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(vocabulary, pa.large_binary())
        for batch in batches:
            for r in range(batch.num_rows):
                doc_ids, sizes = batch.column(0)[r].values, batch.column(1)[r].values.to_numpy(zero_copy_only=False)
                lengths, letters = batch.column(3)[r].as_py(), batch.column(4)[r].as_py()
                _, order = _bucket_order(lengths, letters, count)
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order))
                places = place[_restored(batch.column(2)[r].as_py(), int(sizes.sum()))]
                listed = batch.column(5)[r].as_py() or []
                counts = [_restored(x["counts"], x["size"]) for x in listed]
                flat = np.concatenate([np.zeros(0, np.int32), *[_restored(x["ids"], int(n.sum())) for x, n in zip(listed, counts)]])
                counts = np.concatenate([np.zeros(0, np.int32), *counts])
                starts = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
                names = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat).cast(pa.string())), " ")
                edges = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
                out = []
                for i, j in blocks(edges, GROUP_WORDS):
                    own = places[edges[i] : edges[j]]
                    by_word = counts[own]
                    ids = flat[_runs(starts[own], by_word)]
                    cuts = edges[i : j + 1] - edges[i]
                    text, ends = utf8(pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts), names.take(pa.array(own))), " "))
                    data, begins = utf8(pieces.take(pa.array(ids)))
                    of = np.concatenate(([0], np.cumsum(by_word)))[cuts]
                    for k, (a, b) in enumerate(zip(of[:-1], of[1:])):
                        out.append((b - a, sha256(text[ends[k] : ends[k + 1]]).hexdigest(), sha256(data[begins[a] : begins[b]]).hexdigest()))
                columns = [doc_ids, pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                pa.default_memory_pool().release_unused()

    return run


def encoded_documents(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row; a null text counts as empty, without tokens.

    Documents are read once, into a table of chunks that holds each chunk's distinct words and the places of the
    documents' words among them. Only the distinct words move: equal ones of all chunks meet in a bucket by their
    hash, the fold encodes each once, and the ids go back to the chunks, whose table is bucketed so that it stays
    where it is. A bucket holds a word at most once a chunk, and there are ``SPREAD`` times as many buckets as
    chunks. ``pattern`` splits texts before the merges; its ``\\s`` means Unicode white space.
    """
    ranks = read_ranks(ranks_path)
    vocabulary = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        vocabulary[rank] = token
    words = documents.select(F.col("doc_id").cast("long"), F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(f"(?U){pattern}"), F.lit(0)).alias("words"))
    chunks = stored_by(words.mapInArrow(_chunks, _CHUNK), "chunks", "chunk")
    count = max(1, SPREAD * chunks.count())
    pieces = chunks.select("chunk", "lengths", "letters").mapInArrow(_pieces(count), _PIECE)
    buckets = pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_buckets, _BUCKET)
    ranked = buckets.crossJoin(F.broadcast(rank_table(documents.sparkSession, ranks)))
    ids = ranked.withColumn("words", encoded("words", "ranks")).drop("ranks").mapInArrow(_dealt_back, _ENCODED)
    ids = ids.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "size", "counts", "ids"))).alias("listed"))
    return chunks.join(ids, "chunk", "left").select("doc_ids", "sizes", "places", "lengths", "letters", "listed").mapInArrow(_written(vocabulary, count), _RESULT)


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encoded_documents(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
