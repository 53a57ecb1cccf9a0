import random
from hashlib import sha256
from itertools import combinations

import numpy as np
import plain
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from duelframe.llm import bpe, decontam, lines, minhash, quality, secret_scan, suffix
from duelframe.llm.components import components

SYLLABLES = "the of and in ta re mo li ven dor kas pil une que".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(rng, text, share):
    return " ".join(prose(rng, 1) if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, self-repetition, a hot line, nulls, empty and white-space texts, one long text."""
    rng = random.Random(4)
    bases = [prose(rng, rng.randint(20, 160)) for _ in range(25)]
    rows = [*bases, *(edited(rng, rng.choice(bases), rng.choice([0, 0.02, 0.05, 0.1, 0.3])) for _ in range(60))]
    hot = "A line that a third of all documents carry, word for word, or very nearly so, at their end no. 17."
    rows = [r + ("\n" + hot.replace("17", str(i)) if i % 3 == 0 else "") for i, r in enumerate(rows)]
    rows += ["ab" * 300, "x" * 250, "x" * 250, "", None, " \n\t ", "One", "one", "é" * 180, bases[0].upper(), prose(rng, 20_000)]
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").withColumns({"score": F.lit("clash"), "n_removed": F.lit(7), "p": F.lit(1)}).repartition(3)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(5, 5)]
    want = plain.groups(sorted({x for a, b in links if a != b for x in (a, b)}), [x for x in links if x[0] != x[1]])
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


def test_bpe_equals_the_library(spark, corpus, documents):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    odd = ["don't we'll I'M  two  spaces\n\n\nend ", "tab\t  wide", "日本語 текст ١٢٣ 42", "a" * 700, "<|endoftext|>", "🙂🙂 ퟿", "\r\n \r\n"]
    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(odd)), (0, "repeated id")]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = []
    for d, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((d, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1)).repartition(2)
    assert sorted(tuple(r) for r in bpe.encoded_documents(df, path, public_tokenizers.PATTERN).collect()) == sorted(want)
    assert bpe.encoded_documents(empty(spark), path, public_tokenizers.PATTERN).count() == 0


def test_bpe_ranks_are_in_no_plan(spark, documents):
    """A literal of them fills a driver, for every plan is kept as text, and is unpacked by every task."""
    found = bpe.encoded_documents(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert len(found._jdf.queryExecution().toString()) < 100_000


def test_repeated_strings(spark, corpus, documents):
    got = {r.doc_id: tuple(r)[1:] for r in suffix.without_repeats(documents).collect()}
    assert got == plain.without_repeats(corpus)
    assert suffix.without_repeats(empty(spark)).count() == 0


def test_repeated_strings_of_a_large_anchor_are_dealt_again(spark, corpus, documents, monkeypatch):
    kept = [r for r in corpus if len(r[1] or "") < 2000]
    monkeypatch.setattr(suffix, "LARGE", 1)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.without_repeats(documents.where("coalesce(length(text), 0) < 2000")).collect()}
    assert got == plain.without_repeats(kept)


def test_repeats_with_one_id_and_without(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef") for _ in range(150))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text[:120])], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in suffix.without_repeats(df).collect())
    assert got == [(-1, 0), (1, 150), (1, 150), (2, 120)]
    got = sorted((r.doc_id, r.n_removed) for r in suffix.without_repeats(df.where("doc_id is not null")).collect())
    assert got == [(1, 0), (1, 0), (2, 120)]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, corpus, documents, k):
    got = minhash.near_duplicates(documents, k).collect()
    want = plain.near_duplicates(corpus, k, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_edge_rows(spark, documents):
    assert minhash.near_duplicates(empty(spark)).count() == 0
    df = spark.createDataFrame([(None, "one two three"), (1, "one two three"), (4, "one two three"), (4, "one two three")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in minhash.near_duplicates(df, 2).collect()) == [(-1, None, True), (1, 1, True), (4, 1, False), (4, 1, False)]
    kept = minhash.one_of_each(df.withColumn("extra", F.lit("x")), 2)
    assert kept.columns == ["doc_id", "text", "extra"] and kept.count() == 2


def _lines_plain(docs):
    """First occurrences by brute force: all pairs of forms under the same definition of a link."""
    import regex

    def norm(line):
        return regex.sub(r"[^\p{L}\p{N}]+", " ", regex.sub(r"\p{N}", "0", line.lower())).strip(" ")

    import pyarrow as pa

    places = [(d, n, norm(x)) for d, t in sorted(docs, key=lambda r: r[0]) for n, x in enumerate(t.split("\n") if t is not None else [])]
    forms = {}
    for d, n, f in places:
        if f:
            forms.setdefault(f, (d, n))
    names = list(forms)
    hashes = lines.minhashes(pa.array(names, pa.string()), lines.KEYED + lines.FURTHER)
    first, more = hashes[:, : lines.KEYED], hashes[:, lines.KEYED :]
    links = []
    for i, a in enumerate(names):
        for j in range(i):
            b = names[j]
            if (first[i] == first[j]).sum() < 2 or not (more[i] == more[j]).any():
                continue
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and plain.edit_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                links.append((forms[a], forms[b]))
    top = plain.groups(list(forms.values()), links)
    gone = {}
    for d, n, f in places:
        if f and top[forms[f]] != (d, n):
            gone.setdefault(d, set()).add(n)
    return {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(d, ())) if t is not None else None for d, t in docs}


def test_fuzzy_lines(spark, corpus, documents):
    rng = random.Random(8)
    short = [(d, t) for d, t in corpus if len(t or "") < 2000]
    more = [(5000 + i, "\n".join([rng.choice(["Same line here.", "same LINE, here", ""]), edited(rng, short[3][1], 0.03), "a", "b"])) for i in range(12)]
    df = spark.createDataFrame([*short, *more], "doc_id long, text string").withColumn("n_lines", F.lit("old"))
    got = lines.deduplicated(df)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    rows = got.collect()
    want = _lines_plain([*short, *more])
    assert {r.doc_id: r.text for r in rows} == want
    assert sum(r.n_removed for r in rows) > 20
    assert lines.deduplicated(empty(spark)).count() == 0


def _retyped(rng, line, share):
    """``line`` with one word replaced, or words until ``share`` of its letters may have changed."""
    words, left = line.split(), share * len(line)
    for n, i in enumerate(rng.sample(range(len(words)), len(words))):
        left -= len(words[i]) + 1
        if n and left < 0:
            break
        words[i] = prose(rng, 1)
    return " ".join(words)


@pytest.mark.parametrize("low, high, one, some", [(40, 60, 0.85, 0.8), (60, 120, 0.93, 0.8), (120, 400, 0.97, 0.85)])
def test_lines_alike_by_edit_similarity_alone(spark, low, high, one, some):
    """Of the line pairs that edit similarity alone joins, the shares that are found after one word or a tenth has changed."""
    rng = random.Random(low)
    bases = []
    while len(bases) < 150:
        line = prose(rng, high // 5)[: rng.randint(low, high)].strip()
        if len(line) >= low:
            bases.append(line)
    for share, least in ((0, one), (0.1, some)):
        pairs = [(a, b) for a in bases for b in [_retyped(rng, a, share)] if a != b and plain.edit_distance(a, b) <= 0.2 * max(len(a), len(b))]
        assert len(pairs) > 80
        df = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)], "doc_id long, text string")
        assert sum(r.n_removed for r in lines.deduplicated(df).collect()) >= least * len(pairs)


def test_edit_distance_of_many_pairs():
    """Two bits a character never drop a pair that is near enough."""
    import numpy as np
    import pyarrow as pa

    from duelframe.llm import edit_bits

    rng = random.Random(4)
    some = lambda n: "".join(rng.choice("abc eé中😀") for _ in range(n))
    pairs = [("", ""), ("", "a"), ("é", "é")]
    for n in [1, 5, 63, 64, 65, 130, 200] * 8:
        text = some(n)
        changed = list(text)
        for _ in range(rng.randint(0, n // 3 + 1)):
            i = rng.randint(0, len(changed))
            changed[i : i + rng.randint(0, 1)] = some(rng.randint(0, 1))
        pairs += [(text, "".join(changed)), (text, some(n))]
    left, right = (pa.array(x) for x in zip(*pairs))
    most = np.array([int(max(len(a), len(b)) * 0.2 + 1e-9) for a, b in pairs])
    want = np.array([plain.edit_distance(a, b) for a, b in pairs]) <= most
    assert 20 < want.sum() < len(pairs) - 20
    held, planes = edit_bits.two_bits(pa.concat_arrays([left, right]), 180)
    words = [edit_bits.as_words(edit_bits.utf8(x)[0], (np.where(held <= 180, held, 0) + 7) // 8) for x in planes]
    at = np.arange(len(pairs))
    inside = np.maximum(held[: len(pairs)], held[len(pairs) :]) <= 180
    may = edit_bits.may_reach([w for w, _ in words], words[0][1], held, at[inside], at[inside] + len(pairs), most[inside])
    assert not (want[inside] & ~may).any() and not may.all()


def test_unlike_lines_with_frequent_pieces_leave_their_buckets(spark):
    """Lines that share MinHashes because of frequent pieces alone reach no join, and near copies still do."""
    rng = random.Random(6)
    words = ["".join(rng.choice("bcdfghlmnorstu") for _ in range(12)) for _ in range(400)]
    unlike = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(300)]
    near = [unlike[0] + f" {x}" for x in "abcdefgh"]
    forms = spark.createDataFrame(list(enumerate(unlike + near)), "id long, norm string")
    found = {r.id for r in lines._members(forms).collect()}
    sketches = lines._sketched(forms).select([F.expr(f"shiftright({c}, 32)").alias(f"{c}_{k}") if k else F.expr(f"{c} & 4294967295").alias(f"{c}_{k}") for c in lines.SKETCH for k in range(2)]).collect()
    assert sum(sum(x == y for x, y in zip(sketches[i], sketches[j])) >= 2 for i in range(300) for j in range(i)) > 100
    assert found >= {0, *range(300, 308)} and len(found) < 40


def test_normalised_lines_with_every_kind_of_character(spark):
    rng = random.Random(7)
    letters = [chr(c) for c in range(1, 0x260)] + list("\n\n\n\n   abcé١²½ªßŸẞΣς中😀")
    docs = [(i, "".join(rng.choice(letters if i % 2 else letters[8:0x12F]) for _ in range(rng.randint(0, 120)))) for i in range(300)]
    docs += [(900, ""), (901, "\n"), (902, None), (None, "a b"), (903, "\n\na\n"), (904, " ")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = df.where("doc_id is not null and text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "norm"))
    want = want.select("doc_id", "line", lines.normalised(F.col("norm")).alias("norm")).where("norm <> ''")
    assert sorted(map(tuple, lines._lines(df).select("doc_id", "line", "norm").collect())) == sorted(map(tuple, want.collect()))


def test_lines_of_the_pipeline_stage(spark):
    df = spark.createDataFrame([(1, "Alpha beta gamma.\nDelta", 23, "s"), (2, "alpha, BETA gamma", 17, "s"), (3, "", 0, "s"), (4, "Delta\nnew", 9, None), (None, "Delta", 5, "s")], "doc_id long, text string, n_chars long, source string")
    got = sorted((r.doc_id or -1, r.text, r.n_chars) for r in lines.with_lines_left(df).collect())
    assert got == [(-1, "Delta", 5), (1, "Alpha beta gamma.\nDelta", 23), (3, "", 0), (4, "new", 3)]


def test_leaks(spark, corpus, documents):
    rng = random.Random(9)
    items = [(i, prose(rng, n)) for i, n in enumerate([40, 30, 15, 9, 4])] + [(5, ""), (6, None)]
    planted = [(700, "before " + items[0][1] + " after"), (701, edited(rng, items[0][1], 0.08)), (702, " ".join(items[1][1].split()[:16])), (703, items[2][1].upper()), (704, "x " + items[4][1] + " y"), (705, items[3][1])]
    short = [(d, t) for d, t in corpus if len(t or "") < 1500][:50]
    df = spark.createDataFrame([*short, *planted, (None, items[0][1]), (700, items[0][1])], "doc_id long, text string").withColumn("seed", F.lit(0))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("clash"))
    found = decontam.leaks(df, bench)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    want = plain.leaks([*short, *planted], items, decontam.MASKS, decontam.LEAST_TOKENS, decontam.SPAN)
    assert {(700, 0), (703, 2), (704, 4), (705, 3)} <= want
    assert got - {(None, 0)} == want and (None, 0) in got
    assert found.count() == len(got)
    left = decontam.clean(df, bench)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == {d for d, _ in short} - {d for d, _ in want} | {None} | {d for d, _ in planted} - {d for d, _ in want}
    assert decontam.leaks(empty(spark), bench).count() == 0 and decontam.leaks(df, bench.limit(0)).count() == 0


def _overlaps_plain(docs, items):
    """(doc, item): agreeing tokens of the best stretch, by every offset and every stretch of it."""
    out = {}
    for d, text in docs:
        own = text.split()
        for i, item in items:
            other = item.split()
            need = min(13, -(-4 * len(other) // 5))
            for shift in range(1 - len(other), len(own)):
                same = [own[k + shift] == w for k, w in enumerate(other) if 0 <= k + shift < len(own)]
                total = np.concatenate(([0], np.cumsum(same)))
                for a in range(len(same)):
                    for b in range(a + need, len(same) + 1):
                        n = int(total[b] - total[a])
                        if n >= need and 5 * n >= 4 * (b - a):
                            out[d, i] = max(n, out.get((d, i), 0))
    return out


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_leaks_of_rows_with_one_id(spark, monkeypatch, limit):
    """Texts under one id are laid beside an item one by one; the best overlap counts, broadcast or not."""
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)
    words = [f"w{k}" for k in range(40)]
    texts = [(1, " ".join([*words[:29], *(f"y{k}" for k in range(11))])), (1, " ".join([*(f"z{k}" for k in range(27)), *words[27:]])), (2, None), (2, " ".join(words[:12])), (2, " ".join(["a", *words[5:30]]))]
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    found = decontam.leaks(spark.createDataFrame(texts, "doc_id long, text string"), bench)
    assert sorted((r.doc_id, r.item_id, r.n_tokens, r.n_agreeing, r.doc_start) for r in found.collect()) == [(1, 7, 29, 29, 0), (2, 7, 25, 25, 1)]


def test_leaks_against_all_stretches(spark):
    rng = random.Random(12)
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in [*range(1, 19), 20, 24, 27]]
    items += [(100 + n, " ".join(rng.choice("abc") for _ in range(n))) for n in (6, 11, 15, 18, 40)]
    texts = []
    for n, item in items[:21]:
        for gone in range(5):
            tried = list(combinations(range(n), gone))
            texts += [" ".join("new" if k in at else w for k, w in enumerate(item.split())) for at in rng.sample(tried, min(len(tried), 40))]
    words = items[20][1].split()
    texts.append(" ".join([*words[:12], "x", "y", "z", *words[15:]]))
    words = items[15][1].split()
    texts.append(" ".join(["before", *words[:4], "x", *words[5:8], "y", *words[9:], "after"]))
    texts += [" ".join(rng.choice("abcd") for _ in range(60)) for _ in range(20)]
    docs = list(enumerate(texts))
    want = _overlaps_plain(docs, items)
    assert {(len(docs) - 22, 27), (len(docs) - 21, 16)} <= set(want)
    found = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.n_agreeing for r in found} == want
    for r in found:
        own, item = texts[r.doc_id].split(), dict(items)[r.item_id].split()
        stretch = own[r.doc_start : r.doc_start + r.n_tokens]
        same = [sum(x == y for x, y in zip(stretch, item[k:])) for k in range(len(item) - len(stretch) + 1)]
        assert 5 * r.n_agreeing >= 4 * r.n_tokens and r.n_agreeing in same


def test_secrets(spark, corpus):
    rng = random.Random(3)
    key = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    mixed, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef"
    texts = [t for _, t in corpus[:60]]
    texts += [f"é {prose(rng, 5)} Token = \"{key(40, low)}\" {prose(rng, 3)}" for _ in range(20)]
    texts += [f"{prose(rng, 5)} {key(32, mixed)} ende {key(24, low)} und AKIA{key(16, mixed).upper()}" for _ in range(20)]
    texts += ["password: token: abcdefgh", "API_KEY='short' apikey=long_enough", "token=secret=abcdef", "", None, "AKIAAKIA", "f" * 30, "supercalifragilisticexpialidocious " * 3, "1234567890123456"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("base", F.lit(1))
    rows = {r.doc_id: r for r in secret_scan.scan(df, secret_scan.train(df)).collect()}
    for d, text in enumerate(texts):
        assert [f"{secret_scan.KINDS[s.kind]}:{s.start}:{s.end}" for s in rows[d].base] == plain.base_spans(text), text
        for s in rows[d].added:
            assert text[s.start : s.end] == s.value and len(s.value) >= secret_scan.LEAST_RUN
    assert all(any(len(s.value) == 32 for s in rows[d].added) for d in range(80, 100))
    assert not any(rows[d].added for d in (*range(60), len(texts) - 1, len(texts) - 2))
    none = secret_scan.scan(df, secret_scan.train(empty(spark))).collect()
    assert len(none) == len(texts) and secret_scan.scan(empty(spark), secret_scan.train(df)).count() == 0


def test_quality(spark):
    rng = random.Random(5)
    good = [prose(rng, rng.randint(20, 200)) for _ in range(150)]
    junk = [" ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in prose(rng, 60).split()) for _ in range(40)] + [" ".join([prose(rng, 1)] * 60) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate([*good, *junk, "", None])]
    df = spark.createDataFrame([*rows, (None, "no id")], "doc_id long, text string").withColumn("odds", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(230)] + [(3, None), (None, 1), (999, 0)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    got = {r.doc_id: r for r in quality.score(df, model).withColumn("held_out", quality.held_out()).collect()}
    held = [i for i in range(230) if got[i].held_out]
    assert 50 < len(held) < 110 and all(0 <= r.score <= 1 for r in got.values()) and len(got) == 233
    assert sum((got[i].score >= 0.5) == (i < 150) for i in held) >= 0.97 * len(held)
    assert quality.accepted(df, labels).columns == df.columns
    even = quality.score(df, quality.fit(df, labels.limit(0))).select("score").distinct().collect()
    assert [r.score for r in even] == [0.5]
    assert quality.score(empty(spark), model).count() == 0


def test_scores_do_not_depend_on_blocks(monkeypatch):
    import pyarrow as pa

    rng = random.Random(6)
    texts = [prose(rng, n) for n in (3, 500, 40)]
    settings = quality.Settings(sample_rows=10)
    model = quality.QualityModel(np.random.default_rng(0).normal(size=1 << settings.bits), 0.1, settings)
    whole = quality.scores(pa.array(texts), model)
    alone = np.concatenate([quality.scores(pa.array([x]), model) for x in texts])
    assert whole == pytest.approx(alone, abs=1e-12)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 700)  # the long text is cut now, and loses a word pair at each cut
    assert quality.scores(pa.array(texts), model) == pytest.approx(whole, abs=2e-3)
