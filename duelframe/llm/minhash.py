"""Near-duplicate documents by HyperMinHash sketches: compressed registers, banding, corrected estimates, exact check."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.components import components
from duelframe.llm.linking import linked, shared_buckets
from duelframe.llm.text import blocks, mixed, released, run_hashes, spaces, stored, utf8, word_runs

BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
#: Bands of four registers each: documents at the threshold meet in one of them but for one case in 10 million.
BANDS = 32
#: How far below the threshold an estimate may be before its pair is left out: four standard errors at 0.8.
MARGIN = 0.1
#: Bits of a set's parity sketch, in numbers of 64.
PARITY_BITS = 1024

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed ``k``-word shingles of every row, sorted in each row, and where each row's begin.

    A-Z count as a-z. A row of fewer words has its whole sequence as one shingle; a row without words has none.
    """
    rows = len(offsets) - 1
    size = np.diff(offsets)
    # a line feed around each text keeps words apart
    block = np.full(int(offsets[-1] - offsets[0]) + rows + 1, 10, np.uint8)
    block[np.arange(offsets[-1] - offsets[0]) + np.repeat(np.arange(1, rows + 1), size)] = _LOWER[data]
    starts, ends = word_runs(spaces(block))
    words = run_hashes(block, starts, ends)
    first_word = np.searchsorted(starts, offsets - offsets[0] + np.arange(rows + 1))
    found, edges = [], np.zeros(rows + 1, np.int64)
    m = len(words) - k + 1
    whole = words[: max(m, 0)]
    for t in range(1, k):
        whole = mixed(whole * np.uint64(3) + words[t : t + max(m, 0)])
    for i in range(rows):
        a, b = int(first_word[i]), int(first_word[i + 1])
        if b - a >= k:
            own = np.unique(whole[a : b - k + 1])
        elif b > a:
            own = np.array([(b - a) * 0x9E3779B97F4A7C15 % (1 << 64)], np.uint64)
            for w in words[a:b]:
                own = mixed(own * np.uint64(3) + w)
        else:
            own = words[:0]
        found.append(own)
        edges[i + 1] = edges[i] + len(own)
    return (np.concatenate(found) if found else words[:0]), edges


def registers(shingles: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One row of registers a document: of each bucket's least hash the count of leading zeros and ten more bits.

    0 stands for an empty bucket.
    """
    out = np.zeros((len(edges) - 1, BUCKETS), np.uint16)
    if len(shingles):
        own = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        place = own * BUCKETS + (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        rest = (shingles[first] << np.uint64(BUCKET_BITS)) >> np.uint64(11)
        zeros = np.uint64(53) - np.frexp(rest.astype(np.float64))[1].astype(np.uint64)
        tail = (rest << (zeros + np.uint64(1))) & np.uint64((1 << 53) - 1)
        out.reshape(-1)[place[first]] = (zeros << np.uint64(MANTISSA_BITS)) + (tail >> np.uint64(53 - MANTISSA_BITS)) + np.uint64(1)
    return out


@lru_cache(1)
def _borrowing() -> np.ndarray:
    """For each register of a band a fixed random order of all registers that begins with itself."""
    rng = np.random.default_rng(11)
    return np.stack([np.concatenate(([j], rng.permutation(np.delete(np.arange(BUCKETS), j)))) for j in range(4 * BANDS)])


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of registers, with the band's number in it.

    An empty register of a band borrows from the first filled one in its own order, so small sets meet like large
    ones do.
    """
    used = regs[:, : 4 * BANDS].copy()
    order = _borrowing()
    lacking = np.flatnonzero((used == 0).any(1) & (regs > 0).any(1))
    for i in range(0, len(lacking), 64):
        part = regs[lacking[i : i + 64]]
        pick = (part > 0)[:, order].argmax(2)
        used[lacking[i : i + 64]] = np.take_along_axis(part, order[np.arange(4 * BANDS), pick], 1)
    return mixed(used.view(np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates from register rows: equal ones among those filled on either side.

    Of the registers filled on both sides the share that agrees by chance is taken off: two independent least hashes
    of such sets have as many leading zeros with a known probability, and then the same further bits once in 1024.
    """
    equal = ((a == b) & (a > 0)).sum(1)
    both = ((a > 0) & (b > 0)).sum(1)
    either = ((a > 0) | (b > 0)).sum(1)
    level = 0.5 ** np.arange(54)

    def share(n: np.ndarray) -> np.ndarray:
        mean = np.maximum(n[:, None] / BUCKETS, 1)
        return np.clip(1 - level / 2, 1e-300, 1) ** mean - np.clip(1 - level, 1e-300, 1) ** mean

    chance = (share(size_a.astype(float)) * share(size_b.astype(float))).sum(1) / (1 << MANTISSA_BITS)
    return (equal - chance * both) / (1 - chance) / np.maximum(either, 1)


def sketches(documents: DataFrame, k: int) -> DataFrame:
    """``(doc_id, n_shingles, set_a, set_b, registers, mark)``: 128 bits name the exact set, 640 bytes sketch it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in blocks(offsets):
                found, edges = distinct_shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1], k)
                names = []
                for salt in (1, 2):
                    sums = np.zeros(len(found) + 1, np.uint64)
                    np.cumsum(mixed(found ^ np.uint64(salt * 0x51B54A32D192ED03 % (1 << 64))), out=sums[1:])
                    names.append((sums[edges[1:]] - sums[edges[:-1]]).view(np.int64))
                regs = registers(found, edges)
                odd = parities(found, edges)
                mark = pa.StructArray.from_arrays([pa.array(np.diff(edges)), *map(pa.array, odd.T.copy())], ["n", *(f"x{k}" for k in range(odd.shape[1]))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(edges)), *map(pa.array, names), pa.array([r.tobytes() for r in regs], pa.binary()), mark],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "registers", "mark"],
                )

    mark = ", ".join(["n: bigint", *(f"x{k}: bigint" for k in range(PARITY_BITS // 64))])
    schema = f"doc_id long, n_shingles long, set_a long, set_b long, registers binary, mark struct<{mark}>"
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _bands(reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS)
            keys = band_keys(regs)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(ids)], names=["key", "id"])

    return reps.select("rep", "registers").mapInArrow(run, "key long, id long")


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose set sizes and estimated similarity allow the threshold, with the estimate."""
    least = percent / 100 - MARGIN
    side = lambda c: reps.select(F.col("rep").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    joined = joined.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in (3, 5))
            found = estimate(ra, rb, batch.column(2).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(zero_copy_only=False))
            keep = pa.array(found >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["a", "b", "similarity"]).filter(keep)

    return joined.select("a", "b", "n_a", "r_a", "n_b", "r_b").mapInArrow(run, "a long, b long, similarity double")


def parities(shingles: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For every set whether an odd number of its shingles falls on each of ``PARITY_BITS`` places."""
    rows = len(edges) - 1
    place = np.repeat(np.arange(rows), np.diff(edges)) * PARITY_BITS + (shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=rows * PARITY_BITS) & 1).astype(np.uint8).reshape(rows, PARITY_BITS)
    return np.packbits(odd, axis=1).view(np.int64)


def _close(a: Column, b: Column, percent: int) -> Column:
    """Whether sizes and parity sketches allow the threshold.

    Sets that reach it differ in at most ``d = (100 - percent) / (100 + percent)`` of their summed sizes. Their
    sketches differ in no more places than that, and in large sets, where shingles fall on one place, in no more than
    expected for ``d`` and four standard deviations above.
    """
    apart = F.lit(0)
    for k in range(PARITY_BITS // 64):
        apart = apart + F.bit_count(a[f"x{k}"].bitwiseXOR(b[f"x{k}"]))
    d = (a["n"] + b["n"]) * ((100 - percent) / (100 + percent))
    mean = (F.lit(1.0) - F.exp(d * (-2.0 / PARITY_BITS))) * (PARITY_BITS / 2)
    sizes = F.least(a["n"], b["n"]) * 100 >= F.greatest(a["n"], b["n"]) * percent
    return sizes & (apart <= F.least(d, mean + F.sqrt(mean) * 4.0))


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full shingle sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            (data_a, at_a), (data_b, at_b) = utf8(batch.column(2)), utf8(batch.column(3))
            for i, j in blocks(at_a + at_b):
                (sa, ea), (sb, eb) = (distinct_shingles(d[o[i] : o[j]], o[i : j + 1], k) for d, o in ((data_a, at_a), (data_b, at_b)))
                for r in range(j - i):
                    one, two = sa[ea[r] : ea[r + 1]], sb[eb[r] : eb[r + 1]]
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    keep[i + r] = both and 100 * both >= percent * (len(one) + len(two) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"t_{c}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``documents``.

    Documents are linked where ``100 * intersection >= percent * union`` of their distinct ``k``-word shingles;
    a component's id is the smallest ``doc_id`` in it and its document is the one kept. Equal sets meet through a
    128-bit name and go on as one. Documents that share a band are compared as ``linking.linked`` says; a pair is
    read in full only if its corrected estimate is near the threshold. Rows that share a ``doc_id`` are one node.
    Null or empty texts have no shingles and are linked with nothing; a row without ``doc_id`` is linked with
    nothing, its component is null and it is kept. Columns other than ``doc_id`` and ``text`` are not read.
    """
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = stored(sketches(documents, k), "sketches")
    named = ["set_a", "set_b", "n_shingles"]
    sets = known.where("n_shingles > 0 and doc_id is not null")
    reps = stored(sets.groupBy(*named).agg(F.min("doc_id").alias("rep"), F.first("registers").alias("registers"), F.first("mark").alias("mark"), F.count("*").alias("rows")), "sets")
    copies = sets.join(reps.where("rows > 1").select(*named, "rep"), named).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    members = shared_buckets(_bands(reps))
    # texts of documents that any candidate of the bands may need
    texts = documents.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    marks = reps.select(F.col("rep").alias("id"), "mark")
    found = linked(members, lambda pairs: _estimated(pairs, reps, percent), lambda pairs: _confirmed(pairs, texts, k, percent), marks, lambda a, b: _close(a, b, percent))
    links = stored(found.unionByName(copies), "links")
    released(members, found, reps)

    final = components(links, "links").withColumnRenamed("node", "doc_id")
    out = known.select("doc_id", "n_shingles").join(final, "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` without those that are near copies of a smaller ``doc_id``; every column stays."""
    dropped = near_duplicates(documents, k, percent).where("not kept").select("doc_id").distinct()
    return documents.join(dropped, "doc_id", "left_anti").select(documents.columns)


def op6_minhash_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=2)
