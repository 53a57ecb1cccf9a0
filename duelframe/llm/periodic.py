"""Periodic runs of words by online dyadic square catching, and texts with their repetitions collapsed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.text import BLOCK_BYTES, blocks, mixed, utf8

#: A run holds its period this many times at least; the catchers need three.
EXPONENT = 4
#: Words of a run at least.
LEAST = 6
#: Contract of the registered query: one document in this many is made periodic from some word on.
PLANTED = 10

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_TURN = np.uint64(0x9E3779B97F4A7C15)


class Catchers:
    """Squares of a growing row of words, caught as words are appended.

    At level k every completed block of ``2**k`` words, counted from its document's first word, has a catcher. It
    lives while the words come that close a window at a distance of ``2**k`` to ``2**(k+1) - 1`` words behind the
    block, so that each appended word closes one window a level, and that window has exactly one living catcher to
    be compared with. Equality means that all words of the block repeat at that distance: a square is caught, or one
    that is known grows. A level begins when a document has room for ``exponent`` of its blocks. Windows are compared
    by 64-bit names, made of the names of their halves: equal windows have equal names, and two others share one with
    a chance of 2**-64. Words may come one by one or in any portions; all of a portion are compared in array
    operations, and what is caught does not depend on the portions. Memory is eight bytes a word and level.
    """

    def __init__(self, exponent: int = EXPONENT):
        if exponent < 3:
            raise ValueError("a run shorter than three periods need not hold a whole block and its repeat")
        self.exponent = exponent
        self.first = np.zeros(0, np.int64)
        self.names: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.caught: list[list[np.ndarray]] = [[]]
        self.longest = 0

    def append(self, words: np.ndarray, first: np.ndarray) -> int:
        """Append word numbers, each with the place of its document's first word; the number of windows that repeated."""
        self.first = np.concatenate((self.first, first))
        self.names[0] = np.concatenate((self.names[0], mixed(words.astype(np.uint64) + _TURN)))
        n, hits = len(self.first), 0
        self.longest = max(self.longest, int((np.arange(n - len(first), n) - first).max(initial=-1)) + 1)
        seen = n - len(first)
        level = 0
        while level == 0 or self.exponent << level <= self.longest:
            size = 1 << level
            if level == len(self.names):
                self.names.append(np.zeros(0, np.uint64))
                self.caught.append([])
            if level:
                seen, half, lower = len(self.names[level]), size >> 1, self.names[level - 1]
                left, right = lower[seen : n - size + 1], lower[seen + half : n - size + 1 + half]
                self.names[level] = np.concatenate((self.names[level], mixed(left * _TURN + (right ^ right >> np.uint64(29)))))
            windows = np.arange(seen, n - size + 1)
            begin = self.first[windows]
            place = windows - begin
            alive = (place >= size) & (self.first[windows + size - 1] == begin)
            windows, begin, place = windows[alive], begin[alive], place[alive]
            block = begin + (place >> level << level) - size
            same = self.names[level][block] == self.names[level][windows]
            self.caught[level].append(np.stack((windows[same] - block[same], block[same])))
            hits += int(same.sum())
            level += 1
        return hits

    def runs(self, least: int = LEAST) -> np.ndarray:
        """Rows ``(start, length, period)`` of all maximal runs so far, in order of start, then period.

        Catches of neighbouring blocks at one distance are one square that grew. Its ends lie less than a block
        further, and are found by comparing windows of half the size, a quarter, and so on. The same stretch found at
        several distances has the smallest as its period, because the others are its multiples.
        """
        found, ends = [], np.append(np.flatnonzero(np.diff(self.first)) + 1, len(self.first))
        for level, caught in enumerate(self.caught):
            period, block = np.concatenate(caught, axis=1) if caught else np.zeros((2, 0), np.int64)
            if not len(block):
                continue
            order = np.lexsort((block, period))
            period, block = period[order], block[order]
            fresh = np.append(True, (np.diff(period) != 0) | (np.diff(block) != 1 << level))
            left, right = block[fresh], block[np.append(fresh[1:], True)] + (1 << level)
            period = period[fresh]
            begin, end = self.first[left], ends[np.searchsorted(ends, left, "right")]
            for k in range(level - 1, -1, -1):
                names, step = self.names[k], 1 << k
                ok = left - step >= begin
                at = np.where(ok, left - step, left)
                left = np.where(ok & (names[at] == names[at + period]), at, left)
                ok = right + period + step <= end
                at = np.where(ok, right, left)
                right = right + step * (ok & (names[at] == names[at + period]))
            length = right - left + period
            keep = length >= np.maximum(least, self.exponent * period)
            found.append(np.stack((left[keep], length[keep], period[keep]), axis=1))
        rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        if len(rows):
            rows = rows[np.append(True, (np.diff(rows[:, :2], axis=0) != 0).any(axis=1))]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _of_batches(exponent: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            _, offsets = utf8(texts)
            for i, j in blocks(offsets, BLOCK_BYTES):
                words = [(t or b"").split() for t in texts.slice(i, j - i).to_pylist()]
                sizes = np.array([len(w) for w in words], np.int64)
                starts = np.cumsum(sizes) - sizes
                flat = pa.array([w for row in words for w in row], pa.binary()).dictionary_encode().indices
                catchers = Catchers(exponent)
                catchers.append(flat.to_numpy(), np.repeat(starts, sizes))
                rows = catchers.runs(least)
                drop = np.zeros(len(flat) + 1, np.int64)
                np.add.at(drop, rows[:, 0] + rows[:, 2], 1)
                np.add.at(drop, rows[:, 0] + rows[:, 1], -1)
                keep = np.cumsum(drop)[:-1] == 0
                bounds = np.searchsorted(rows[:, 0], np.append(starts, len(flat)))
                runs, left = [], []
                for k, row in enumerate(words):
                    own = rows[bounds[k] : bounds[k + 1]] if sizes[k] else rows[:0]
                    runs.append([{"start": s - starts[k], "length": n, "period": p} for s, n, p in own])
                    if len(own):
                        row = [row[x] for x in np.flatnonzero(keep[starts[k] : starts[k] + sizes[k]])]
                    left.append(b" ".join(row).decode())
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                columns = [batch.column("_id").slice(i, j - i), pa.array(sizes), pa.array(runs, kind), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, text: str = "text", id_column: str = "doc_id", exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` per row: all runs of words, and the text with each run cut to one period.

    Words are the stretches without ASCII white space. A run is a stretch with smallest period q and at least
    ``max(least, exponent * q)`` words that no neighbouring word extends; ``runs`` lists ``start``, ``length`` and
    ``period`` by start, then period. ``collapsed`` is the words, joined by one space, that no run holds behind its
    first q words. Rows stay in their partitions and are read whole; nothing is shuffled, and one task holds a megabyte
    of text, or one longer text, at a time.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Rows with a null or repeated id are rows
    of their own. Other columns are not read, whatever their names. An empty table gives an empty table.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("binary").alias("_text"))
    found = plain.mapInArrow(_of_batches(exponent, least), f"_id {kind}, n_words bigint, runs {_RUNS}, collapsed string")
    return found.withColumnRenamed("_id", id_column)


def planted(doc_id: Column, text: Column) -> Column:
    """The text whose words repeat from some word on, in the tenth of the documents that their checksum picks.

    With h the checksum of the id in decimal, g its tenth and n words, word ``a = g % n`` and those behind it become
    repetitions of the ``1 + (n - a) // (3 + g % 8)`` words from a on. Rows with a null id or without words stay.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / PLANTED)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(words, F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int"))), " ")

    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # The word list stands in an array of one, so that it is split once and not for each word.
    changed = F.get(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, repeated(ws)).otherwise("")), F.lit(0))
    return F.when(h % PLANTED == 0, changed).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the longest one, and digests of all runs and of the collapsed text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    runs = F.col("runs")
    longest = F.aggregate(
        runs,
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best),
    )
    lines = F.concat_ws("", F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    out = found.withColumn("_best", longest)
    best = F.col("_best")
    return out.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(F.try_divide(1000 * best["length"], best["period"])).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
