"""Secrets by fixed patterns and by character Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, their order, and the characters each one needs.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

#: Runs of key characters from this length on are scored.
LEAST_RUN = 16
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"
#: An ordinary identifier of the training sample: letters only, all of one case but for the first.
ORDINARY = r"^([A-Za-z][a-z]+|[A-Z]+)$"
#: Log-likelihood ratio from which a run counts as random: one run in a thousand is expected to be a secret.
THRESHOLD = math.log(1000)
#: Share of an identifier's steps that are taken to be even over the key characters.
UNSEEN = 0.02
#: What stands behind the identifiers of a small sample, as so many steps from each character: nine in ten of them to
#: a small letter.
PRIOR_STEPS, PRIOR_SMALL = 5.0, 0.9
#: ASCII codes are the states of both chains.
STATES = 128


@dataclass(frozen=True)
class Chains:
    """``ratio[a * STATES + b]``: log of how much likelier ``b`` follows ``a`` in a random string; 0 is a string's edge."""

    ratio: list[float]


_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
KINDS = ("assign", "access", "hex", "random")


def _running(found: Column, gaps: Column, kind: int, values: Column) -> Column:
    """Spans of matches from the gaps before them: one fold, linear in the number of matches."""
    rows = F.zip_with(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))), values, lambda x, v: F.struct(x.gap.alias("gap"), x.size.alias("size"), v.alias("value")))
    rows = F.filter(rows, lambda x: x.size.isNotNull())
    zero = F.expr("struct(0 as at, cast(array() as array<struct<start:int,kind:int,end:int,value:string>>) as spans)")
    step = lambda s, x: F.struct(
        (s.at + x.gap + x.size).alias("at"),
        F.concat(s.spans, F.array(F.struct((s.at + x.gap).alias("start"), F.lit(kind).alias("kind"), (s.at + x.gap + x.size).alias("end"), x.value.alias("value")))).alias("spans"),
    )
    return F.aggregate(rows, zero, step, lambda s: s.spans)


def _spans(text: str, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """All spans of one kind; a text that does not hold the pattern is read once."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    every = _running(found, F.split(text, pattern, -1), kind, values)
    kept = F.filter(every, lambda x: F.length(x.value) >= least) if least else every
    return F.when(F.col(text).rlike(pattern), kept).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def base_spans(documents: DataFrame) -> DataFrame:
    """``(doc_id, text, base)``: the spans that the fixed patterns give, and the text, null as empty."""
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = F.concat(_spans("text", ASSIGN, 0, 2, LEAST_VALUE), _spans("text", ACCESS, 1), _spans("text", HEX, 2))
    return rows.select("doc_id", "text", base.alias("base"))


def _candidates(rows: DataFrame) -> DataFrame:
    """``(doc_id, text, base, runs)``: long runs of key characters that touch no base span."""
    runs = _spans("text", CANDIDATE, 3)
    free = F.filter(runs, lambda r: ~F.exists("base", lambda b: (b.start < r.end) & (r.start < b.end)))
    return rows.select("doc_id", "text", "base", F.when(F.size("base") == 0, runs).otherwise(free).alias("runs"))


def train(documents: DataFrame) -> Chains:
    """Both chains from all documents: values of base spans are random strings, plain long words are identifiers.

    Only counts of character pairs by label leave the executors, at most two for each pair of states. Half of the
    random chain is even over the key characters, so a kind of secret that the sample lacks stays possible; pairs
    that neither chain has seen count a little in both. Without documents identifiers are those of the prior.
    """
    rows = _candidates(base_spans(documents))
    secret = F.transform("base", lambda x: F.struct(F.regexp_extract(x.value, r"([A-Za-z0-9+/_=-]*)$", 1).alias("word"), F.lit(1).alias("random")))
    plain = F.transform(F.filter("runs", lambda r: r.value.rlike(ORDINARY)), lambda r: F.struct(r.value.alias("word"), F.lit(0).alias("random")))
    words = rows.select(F.explode(F.concat(secret, plain)).alias("x")).select("x.*").groupBy("word", "random").count()
    pairs = words.where("word <> ''").select("random", "count", F.explode(F.sequence(F.lit(1), F.length("word") + 1)).alias("i"), "word")
    pairs = pairs.select("random", "count", F.expr("if(i = 1, 0, ascii(substr(word, i - 1, 1)))").alias("a"), F.expr("if(i > length(word), 0, ascii(substr(word, i, 1)))").alias("b"))
    counts = pairs.groupBy("random", "a", "b").agg(F.sum("count").alias("n")).collect()  # at most 2 * 66 * 66 rows
    seen = [[0.0] * (STATES * STATES) for _ in range(2)]
    for r in counts:
        seen[r["random"]][r["a"] * STATES + r["b"]] += r["n"]
    keys = [ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]
    even = 1 / (len(keys) + 1)
    ratio = [0.0] * (STATES * STATES)
    for a in (0, *keys):
        row = slice(a * STATES, (a + 1) * STATES)
        total = [sum(s[row]) for s in seen]
        for b in (0, *keys):
            k = a * STATES + b
            random = 0.5 * even + 0.5 * (seen[1][k] + even) / (total[1] + 1)
            # a pair that no identifier has shown is rare in one, not impossible: separators in paths and names
            small = PRIOR_SMALL / 26 if 97 <= b <= 122 else (1 - PRIOR_SMALL) / (len(keys) - 25)
            plain = (seen[0][k] + PRIOR_STEPS * small) / (total[0] + PRIOR_STEPS)
            ratio[k] = math.log(random) - math.log(UNSEEN * even + (1 - UNSEEN) * plain)
    return Chains(ratio)


def _score(word: Column, chains: Chains) -> Column:
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in chains.ratio)), ",").cast("array<double>")  # folded to one literal
    code = lambda i: F.ascii(F.substr(word, i, F.lit(1)))
    step = lambda s, i: F.struct((s.sum + F.get(table, s.last * STATES + code(i))).alias("sum"), code(i).alias("last"))
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last"))
    return F.aggregate(F.sequence(F.lit(1), F.length(word)), zero, step, lambda s: s.sum + F.get(table, s.last * STATES))


def _listed(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x.kind), x.start, x.end)), ",")


def scan(documents: DataFrame, chains: Chains) -> DataFrame:
    """``(doc_id, base, added)``: base spans and the runs that the chains hold for random, both by start, then kind.
    A run without any letter is a number or a rule, not a key.

    A span has ``start``, ``end`` (code points, end exclusive), ``kind`` (the place in ``KINDS``) and ``value``.
    Every row of ``documents`` gives a row, with empty lists for a null or empty text.
    """
    rows = _candidates(base_spans(documents))
    added = F.filter("runs", lambda r: r.value.rlike("[A-Za-z]") & (_score(r.value, chains) >= THRESHOLD))
    return rows.select("doc_id", F.sort_array("base").alias("base"), F.when(F.size("runs") > 0, F.sort_array(added)).otherwise(F.col("runs")).alias("added"))


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(documents, train(documents))
    number = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("long")
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )
