"""Benchmark decontamination by short seeds: hashes under fixed masks, and overlaps checked around their hits."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 1 reads a token, 0 passes over it. Among 13 same tokens at a share of 4 in 5 there are four in a row, and in items
#: of 7 to 15 tokens four in a row or two runs of three with one token between.
MASKS = ("1111", "111011")
#: Tokens an overlap needs, or their share of the whole item if it is shorter; and what share of them must agree.
LEAST_TOKENS = 13
AGREEING = 0.8
#: Items of fewer tokens are looked for as they stand, one mask of ones for each length.
SPAN = 5
#: Masks that items of 5 and 6 tokens need besides, for one token replaced inside.
INSIDE = {5: ("10111", "11011", "11101"), 6: ("110111",)}
#: Bytes of the benchmark's seed rows, each with its whole item, up to which they are broadcast; beyond, the same join is
#: left to the planner.
BROADCAST_BYTES = 64 << 20

_SHARE = Fraction(str(AGREEING))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _seeds(masks: list[str]) -> Column:
    """Hashes of the tokens that each mask reads at ``p``, null where the mask reaches past the end.

    A mask's number is hashed with its tokens, so only hashes of one mask can meet.
    """
    rows = []
    for number, mask in enumerate(masks):
        read = ", ".join(f"get(words, p + {i})" for i, c in enumerate(mask) if c == "1")
        rows.append(f"if(p + {len(mask)} <= size(words), xxhash64({number}, {read}), null)")
    return F.expr(f"explode(array({', '.join(rows)}))")


def _seeded(words: DataFrame, masks: list[str], *kept: str) -> DataFrame:
    places = words.select(*kept, "words", F.explode(F.expr("if(size(words) > 0, sequence(0, size(words) - 1), cast(array() as array<int>))")).alias("p"))
    return places.select(*kept, "words", "p", _seeds(masks).alias("seed")).where("seed is not null")


def _stretch(same: str) -> Column:
    """The stretch of an alignment with most agreements among those that agree at ``AGREEING`` or more.

    The k-th agreement, at token x, has the value ``v = den k - num x``; a stretch from one agreement to another is
    good if its end has at least the value of its start less ``den - num``. The widest such pair comes from one walk
    along the least values so far and the greatest still to come; the first of equals is taken.
    """
    num, den = _SHARE.numerator, _SHARE.denominator
    return F.expr(f"""transform(array(filter(sequence(0, size({same}) - 1), x -> {same}[x])), at ->
      transform(array(transform(at, (x, k) -> {den} * k - {num} * x)), v ->
      transform(array(struct(transform(v, (x, k) -> array_min(slice(v, 1, k + 1))) as low, transform(v, (x, k) -> array_max(slice(v, k + 1, size(v)))) as high)), m ->
      aggregate(sequence(1, 2 * size(v)), named_struct('i', 0, 'j', 0, 'first', 0, 'last', -1), (s, n) ->
        if(s.j >= size(v), s, if(m.low[s.i] <= m.high[s.j] + {den - num},
          named_struct('i', s.i, 'j', s.j + 1, 'first', if(s.j - s.i > s.last - s.first, s.i, s.first), 'last', if(s.j - s.i > s.last - s.first, s.j, s.last)),
          named_struct('i', s.i + 1, 'j', s.j, 'first', s.first, 'last', s.last))),
        s -> named_struct('found', s.last - s.first + 1, 'first', at[s.first], 'last', at[s.last])))[0])[0])[0]""")


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, n_tokens, n_agreeing, doc_start)``: the best overlap of each document with each item.

    Where a seed of a document meets one of an item, both are laid side by side at that offset. An overlap is any
    stretch of which at least ``AGREEING`` of the tokens are the same; it is reported if the same ones number
    ``LEAST_TOKENS``, or ``AGREEING`` of all that the item has if that is less. The seeds miss none of these. ``doc_start`` counts the document's tokens from 0. Null and empty texts have no tokens; an
    item without tokens is never found; an item that stands twice is reported under each id. Rows that share a
    ``doc_id`` are looked at one by one and the best overlap among them is reported. The benchmark is small beside the
    documents: its seeds are broadcast up to ``BROADCAST_BYTES``, which a bound from the items' lengths is held against.
    """
    items = benchmark.select(F.col("item_id"), tokens(F.col("text").cast("string")).alias("words")).where("size(words) > 0")
    lengths = [r[0] for r in items.where(F.size("words") <= LEAST_TOKENS / AGREEING).select(F.size("words").alias("n")).distinct().orderBy("n").collect()]  # at most 16
    masks = [MASKS[0], *(MASKS[1:] if any(n > SPAN for n in lengths) else ()), *(m for n in lengths for m in INSIDE.get(n, ())), *("1" * n for n in lengths if n < len(MASKS[0]))]
    seeds = _seeded(items, masks, "item_id").select("item_id", "seed", F.col("p").alias("q"), F.col("words").alias("item"))
    row = F.expr("aggregate(words, 64L, (bytes, x) -> bytes + octet_length(x) + 16)")
    if (items.agg(F.sum(row * F.size("words")).alias("n")).first()["n"] or 0) * len(masks) <= BROADCAST_BYTES:
        seeds = F.broadcast(seeds)
    words = documents.select(F.col("doc_id"), tokens(F.col("text").cast("string")).alias("words"))
    hits = _seeded(words, masks, "doc_id").join(seeds, "seed").where("p = 0 or q = 0 or not (words[p - 1] <=> item[q - 1])")  # once for a run
    # side by side from the first token that both have at this offset
    hits = hits.withColumn("doc_start", F.greatest(F.col("p") - F.col("q"), F.lit(0))).withColumn("item_start", F.greatest(F.col("q") - F.col("p"), F.lit(0)))
    hits = hits.select("doc_id", F.xxhash64("words").alias("version"), "item_id", "doc_start", "item_start", F.size("item").alias("n_item"), F.expr("zip_with(slice(words, doc_start + 1, size(item) - item_start), slice(item, item_start + 1, size(item)), (x, y) -> x <=> y)").alias("same"))
    # A passage is hit at each of its tokens: one row for an offset goes on. Being an aggregate, ``same`` keeps the fold
    # below out of the join's condition, where it would end the code generation that spares copies of ``words``.
    hits = hits.groupBy("doc_id", "version", "item_id", "doc_start", "item_start", "n_item").agg(F.max("same").alias("same"))
    need = F.least(F.lit(LEAST_TOKENS), F.expr(f"cast(ceil({_SHARE.numerator} * n_item / {_SHARE.denominator}) as int)"))
    hits = hits.where(F.size(F.filter("same", lambda x: x)) >= need)
    found = hits.select("doc_id", "item_id", "doc_start", "n_item", _stretch("same").alias("s"))
    found = found.where(F.col("s.found") >= need)
    found = found.select("doc_id", "item_id", F.struct(F.col("s.found").alias("agreeing"), (-F.col("doc_start") - F.col("s.first")).alias("at"), (F.col("s.last") - F.col("s.first") + 1).alias("n")).alias("x"))
    return found.groupBy("doc_id", "item_id").agg(F.max("x").alias("x")).select("doc_id", "item_id", F.col("x.n").cast("long").alias("n_tokens"), F.col("x.agreeing").cast("long").alias("n_agreeing"), (-F.col("x.at")).cast("long").alias("doc_start"))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` that overlap with no item; rows without ``doc_id`` stay."""
    found = leaks(documents.where("doc_id is not null"), benchmark).select("doc_id").distinct()
    return documents.join(found, "doc_id", "left_anti").select(documents.columns)


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
