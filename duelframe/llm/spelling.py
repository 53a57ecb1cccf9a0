"""Spelling variants: one-edit neighbours of a vocabulary, found by walking a trie whose edges are a table."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.text import mixed, prefix_hashes_of, released, stored

#: Code points and occurrences of a word at least.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is so many times as frequent as its variant.
MORE_FREQUENT = 10
#: Contract of the registered query: one (document, run) in this many loses a code point.
PLANTED = 31
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 200_000

_LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def _counts(planted: int | None, least_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
                # Bytes are lower-cased in ASCII only.
                found = Counter(_LETTERS.findall((text or "").encode().lower().decode()))
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in found.items():
                    if planted:
                        h = zlib.crc32(word.encode(), seed)
                        if h % planted == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield flush()
        yield flush()

    return run


def vocabulary(docs: DataFrame, text: str = "text", id_column: str = "doc_id", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, planted: int | None = None) -> DataFrame:
    """``(word, n)``: runs of Latin letters, lower-cased in A-Z, of so many code points and occurrences at least.

    Tasks count before the shuffle, so a frequent word is one row a task. ``planted`` changes one (document, run) in
    that many: with h the checksum of ``id:run``, code point ``h % length`` goes. Null and empty texts have no words,
    a null id is an empty one, repeated rows count as often as they stand, other columns are not read.
    """
    plain = docs.select(F.col(id_column).cast("string").alias("_id"), F.col(text).alias("_text"))
    parts = plain.mapInArrow(_counts(planted, least_length), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row ``(word, depth, node, symbol)`` for each node of a word from its middle on; symbol 0 ends the word."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        symbols = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        sums, inverse = prefix_hashes_of(mixed(symbols.astype(np.uint64)))
        low = sizes // 2
        count = sizes - low + 1
        own = np.repeat(np.arange(len(words)), count)
        depth = low[own] + np.arange(len(own)) - (np.cumsum(count) - count)[own]
        at = starts[own] + depth
        # The direction is in the word column: reversed words start with a mark that is no letter.
        node = mixed((sums[at] - sums[starts[own]]) * inverse[starts[own]] + depth.astype(np.uint64)).view(np.int64)
        symbol = np.where(depth < sizes[own], np.append(symbols, 0)[np.minimum(at, len(symbols))], 0).astype(np.int32)
        columns = [batch.column("word").take(pa.array(own)), batch.column("n").take(pa.array(own)), pa.array(depth.astype(np.int32)), pa.array(node), pa.array(symbol)]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "depth", "node", "symbol"])


def _tail(s: str | Column, start: str | Column) -> Column:
    """``s`` without its first ``start`` code points."""
    s, start = (F.col(c) if isinstance(c, str) else c for c in (s, start))
    return F.substring(s, start + 1, F.length(s))


def _trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edge table and first states of ``words(word, n)``, whose ``word`` begins with a mark of its direction.

    A node is the hash of a prefix, from the middle of each word on; only nodes where words part are kept, and an
    edge's ``label`` is all that stands between two of them, or the rest of its ``target`` word behind the last. A
    state ``(word, n, rest, node, edits)`` has read ``word`` up to ``rest``.
    """
    paths = stored(words.mapInArrow(_paths, "word string, n bigint, depth int, node bigint, symbol int"), "paths")
    parting = paths.groupBy("node").agg(F.min("symbol").alias("low"), F.max("symbol").alias("high")).where("low < high").select("node")
    kept = paths.join(parting, "node").groupBy("word", "n").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("path"))
    kept = stored(kept, "parting")
    released(paths)
    steps = kept.select("word", "n", "path", F.posexplode("path").alias("k", "at"))
    following = F.get("path", F.col("k") + 1)
    depth, after = F.col("at.depth"), following["depth"]
    label = F.when(after.isNull(), _tail("word", depth)).otherwise(F.substring("word", depth + 1, after - depth))
    # The last edge of a word has it as its target; the others are shared by all words that pass.
    last = after.isNull()
    edges = steps.select(
        F.col("at.node").alias("node"),
        label.alias("label"),
        following["node"].alias("child"),
        F.when(last, F.col("word")).alias("target"),
        F.when(last, F.col("n")).alias("target_n"),
    ).distinct()
    edges = stored(edges, "edges")
    states = steps.where(depth < F.length("word")).select("word", "n", _tail("word", depth).alias("rest"), F.col("at.node").alias("node"), F.lit(0).alias("edits"))
    return edges, stored(states, "states")


def _reached(joined: DataFrame, read: Column) -> DataFrame:
    """States after an edge, with ``read`` code points of their rest taken; a target wants nothing left of it."""
    out = joined.select("word", "n", _tail("rest", read).alias("rest"), F.col("child").alias("node"), F.lit(1).alias("edits"), "target", "target_n")
    return out.where("target is null or rest = ''")


def _stepped(states: DataFrame, edges: DataFrame, first: bool) -> DataFrame:
    """One level: states joined with the edges of their nodes.

    An edge is matched, or, by the first step, with its first symbol replaced by a larger one or with the state's
    next symbol skipped. Smaller symbols and insertions are the same pairs seen from the other word, and of a row of
    equal symbols the last one is skipped, since skipping any gives the same word.
    """
    size = F.length("label")
    if not first:
        on = states.withColumn("symbol", F.substring("rest", 1, 1)).join(edges.withColumn("symbol", F.substring("label", 1, 1)), ["node", "symbol"])
        return _reached(on.where(F.startswith("rest", "label")), size)
    head, more = F.substring("rest", 1, 1), _tail("rest", F.lit(1))
    replaced = (size > 0) & (F.substring("label", 1, 1) > head) & F.startswith(more, _tail("label", F.lit(1)))
    skipped = (F.substring("rest", 2, 1) != head) & F.startswith(more, F.col("label"))
    joined = states.join(edges, "node").where(replaced | skipped)
    # Both can hold for one edge: "abb" becomes "bbb" by another first letter and "bb" by skipping it.
    read = F.filter(F.array(F.when(replaced, size), F.when(skipped, size + 1)), lambda x: x.isNotNull())
    return _reached(joined.withColumn("read", F.explode(read)), F.col("read"))


def neighbours(words: DataFrame) -> DataFrame:
    """Pairs ``(a, b, n_a, n_b)`` of words of ``words(word, n)`` that differ by one inserted, deleted or replaced
    code point, each once, a < b.

    Two tries stand in one table, of the words and of the words reversed, each from the middle of its words on: an
    edit lies in the second half of a word or of its reverse, so no state starts near the root, where everything
    parts. Frontier and edges are joined by node, level by level, until no state is left; a level crosses all that
    stands between two nodes where words part. Node hashes may only add pairs, and edit distance has the last word.
    Words of fewer than two code points, null words and repeated rows of a word are left out or count once.
    """
    words = words.where(F.length("word") >= 2).groupBy("word").agg(F.max("n").alias("n"))
    both = words.select(F.explode(F.array(F.concat(F.lit(">"), "word"), F.concat(F.lit("<"), F.reverse("word")))).alias("word"), "n")
    edges, frontier = _trie(both)
    level = stored(_stepped(frontier, edges, first=True), "frontier")
    released(frontier)
    found = level
    while not (alive := level.where("target is null").drop("target", "target_n")).isEmpty():
        level = stored(_stepped(alive, edges, first=False), "frontier")
        found = found.unionByName(level)
    released(edges)

    def plain(c: str) -> Column:
        w = _tail(c, F.lit(1))
        return F.when(F.startswith(F.col(c), F.lit("<")), F.reverse(w)).otherwise(w)

    pairs = found.where("target is not null").select(F.struct(plain("word").alias("w"), "n").alias("x"), F.struct(plain("target").alias("w"), F.col("target_n").alias("n")).alias("y"))
    pairs = pairs.where((F.col("x.w") != F.col("y.w")) & (F.levenshtein("x.w", "y.w", 1) == 1))
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return pairs.select(F.col("x.w").alias("a"), F.col("y.w").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")).distinct()


def variants(words: DataFrame, more_frequent: int = MORE_FREQUENT) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``words(word, n)``.

    ``n_near`` counts the near words, ``form`` is the most frequent of them (ties: the first in code-point order) if it
    is ``more_frequent`` times as frequent, ``root`` is where forms of forms end. Frequencies grow along forms, so
    there are no circles and few steps; each round of joins doubles the steps taken. Words come once each.
    """
    pairs = neighbours(words)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n")),
    )
    # The largest count and, of its words, the smallest: the least of (-n, word).
    best = pairs.select(F.explode(sides).alias("x")).groupBy("x.word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("x.n")).alias("m"), F.col("x.near").alias("near"))).alias("best"))
    joined = words.join(best, "word", "left")
    taken = -F.col("best.m") >= more_frequent * F.col("n")
    table = joined.select(
        "word",
        F.when(taken, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, -F.col("best.m")).alias("form_n"),
    )
    table = stored(table, "variants")
    up = stored(table.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = up.join(further, "root", "left")
        after = stored(after.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        done = after.where("moved").isEmpty()
        released(up)
        up = after
        if done:
            break
    return table.join(up.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of the words of all documents, one (document, run) in 31 misspelt."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variants(stored(vocabulary(docs, planted=PLANTED), "vocabulary"))
