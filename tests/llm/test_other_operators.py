import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.llm import ann, dom, html_text, warc


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_chi_square_and_reach():
    assert ann.chi_square(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    settings = ann.Settings(certainty=0.95)
    assert ann.reach(settings) == pytest.approx(15.507, abs=1e-2)


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16))
    x = centres[rng.integers(8, size=900)] + 0.4 * rng.normal(size=(900, 16))
    x *= rng.uniform(0.5, 2, (900, 1))  # inner products, not angles
    x[300:600] = x[7]  # a third of the rows are one vector
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    bad = [(900, None), (920, [0.0] * 16), (940, [1.0, None] + [0.0] * 14), (960, [float("nan")] + [0.0] * 15), (980, [float("inf")] + [0.0] * 15), (1000, [1.0]), (1001, [])]
    settings = ann.Settings(neighbours=20, cell_rows=128, sample_rows=256)
    got = ann.nearest(_vectors(spark, rows + bad).withColumn("cell", F.lit("clash")), F.col("vec_id") % 20 == 0, settings).collect()
    full = np.array([v for _, v in rows], np.float64)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == set(range(0, 900, 20))
    hit = 0
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and all(f[1] != q for f in found)
        assert all(f[2] == pytest.approx(full[f[1]] @ full[q], rel=1e-12) for f in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        scores = full @ full[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(900), -scores))[:20]
        # ties beyond the last place are as good
        hit += sum(scores[i] >= scores[best[-1]] - 1e-9 for _, i, _ in found)
    assert hit / (20 * len(by)) >= 0.95


def test_few_vectors_and_none(spark):
    few = _vectors(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0]), (20, [1.0, 0.0])])
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(few, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 20), (0, 2, 1), (0, 3, 2), (20, 1, 0), (20, 2, 1), (20, 3, 2)]
    assert ann.nearest(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ('<div><svg width="9"/></div><article><h1>Head</h1><p>All of it.</p></article>', "Head All of it."),
        ('<svg/><article><p>Between.</p></article><svg><path d="M0"/></svg><p>After.</p>', "Between. After."),
        ('<svg viewBox="0"><path d="M0"><article><p>Kept.</p></article><p>Too.</p>', "Kept. Too."),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><p>So.</p>", "Let x=1 be. So."),
        ("<math/><p>One.</p><object/><p>Two.</p>", "One. Two."),
        ("<p>See <object data='a'>the fallback</object> here.</p>", "See the fallback here."),
        ("<object data='a'><p>Open.</p><article><p>Body.</p></article>", "Open. Body."),
        ("<select><option>A<option>B<article><p>Body.</p></article>", "A B Body."),
        ("<script>var a = '<p>no</p>'</script><p>Yes.</p><style>p{}", "Yes."),
    ],
)
def test_no_element_swallows_the_page(page, want):
    nodes = dom.read(page)
    assert dom.blocks(nodes, [True] * len(nodes)) == want


def test_place_among_any_number_of_siblings():
    """Each of 100,000 siblings has its own place, and the share of its tag among them."""
    many = 100_000
    page = "<div><h1>Head</h1>" + "<p>Words.</p>" * (many - 1) + "</div>"
    nodes = dom.read(page)
    rows = np.array(dom.features(nodes, len(page)))
    at = {name: k for k, name in enumerate(dom.NAMES)}
    assert len(rows) == many + 2
    assert np.array_equal(rows[2:, at["before"]], np.arange(many) / many)
    assert (rows[2:, at["siblings"]] == many).all()
    assert rows[2, at["alike"]] == 1 / many and (rows[3:, at["alike"]] == (many - 1) / many).all()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News &amp; more</a></li></ul></nav>
<div class="ad">Buy now. Cheap things for all.</div>
<article><h1>A   heading</h1><p>First &lt;b&gt; paragraph,<br>with a break and <b>bold</b>ness. It goes on for a while, as paragraphs do.
<p>Second&nbsp;paragraph, not closed. It has some more sentences. They are plain, and they end.<!-- not this --></article>
<footer>&copy; someone</footer></body>"""


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").collect()]
    return html_text.train(pages, html_text.Settings(variants=10))


def test_page(model):
    want = "A heading First <b> paragraph, with a break and boldness. It goes on for a while, as paragraphs do. Second paragraph, not closed. It has some more sentences. They are plain, and they end."
    assert html_text.extract([PAGE, "", "no markup", "<p", "<!-- open", "</p></p>", "&am"], model)[:2] == [want, ""]


def test_decoding_is_consistent():
    rng = np.random.default_rng(1)
    nodes = dom.read(PAGE)
    for _ in range(50):
        odds = rng.normal(0, 3, len(nodes))
        kept = html_text.decode(nodes, odds)
        best = {}
        step = {("main", "main"): html_text.KEPT, ("main", "rest"): html_text.BROKEN, ("rest", "rest"): 0.0}
        turn = lambda above, own: -step.get((above, own), html_text.OPEN)

        def score(i, state):
            if (i, state) not in best:
                own = {"main": -np.logaddexp(0, -odds[i]), "rest": -np.logaddexp(0, odds[i]), "mixed": np.log(0.5)}[state]
                below = {"main": ("main", "rest"), "rest": ("rest",), "mixed": ("main", "rest", "mixed")}[state]
                best[i, state] = own + sum(max(score(c, s) - turn(state, s) for s in below) for c in nodes[i].children)
            return best[i, state]

        top = max(score(0, s) for s in ("main", "rest", "mixed"))
        found = 0.0
        state = []
        for i, x in enumerate(nodes):
            above = state[x.parent] if i else "mixed"
            options = {"main": ("main", "rest"), "rest": ("rest",), "mixed": ("main", "rest", "mixed")}[above]
            state.append("main" if kept[i] else max((s for s in options if s != "main"), key=lambda s: score(i, s)))
            assert state[i] in options
            found += {"main": -np.logaddexp(0, -odds[i]), "rest": -np.logaddexp(0, odds[i]), "mixed": np.log(0.5)}[state[i]] - (turn(above, state[i]) if i else 0)
        assert found == pytest.approx(top)


def test_other_layouts_by_held_out_variants(model):
    rng = np.random.default_rng(77)
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore".split()
    exact = lost = 0
    for _ in range(60):
        sentence = lambda: " ".join(rng.choice(words, int(rng.integers(3, 9)))) + ", " + " ".join(rng.choice(words, int(rng.integers(2, 9)))) + "."
        texts = [" ".join(sentence() for _ in range(int(rng.integers(1, 6)))) for _ in range(int(rng.integers(3, 9)))]
        page = html_text._variant(texts, rng).replace(html_text.MARK, "")
        got = html_text.extract([page], model)[0]
        exact += got == " ".join(texts)
        lost += not got
    assert exact >= 50 and lost <= 2


def test_pages_table(spark, model):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "x", ""), (3, "y", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_text.main_text(df, model).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 2] == [""]
    assert html_text.main_text(df.limit(0), model).count() == 0
    assert html_text.fit(df.limit(0)).odds(np.zeros((2, len(dom.NAMES)))).shape == (2,)


def _pages(spark, n=300, hot=100):
    rows = [(i, f"http://h{i % 7}/{i}", f"<p>{'x' * (i % 50)} é {i}</p>") for i in range(n)]
    rows += [(5, "http://hot/", "same")] * hot + [(None, None, None), (7, "", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("place", F.lit("clash"))


def test_audit_finds_what_differs(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 32)
    monkeypatch.setattr(warc, "FANOUT", 4)
    pages = _pages(spark)
    left = warc.archived(pages)
    assert warc.audit(left, warc.archived(pages)).count() == 0
    hurt = pages.withColumn("html", F.when(F.col("page_id").isin(3, 250), F.concat(F.lit("#"), F.substring("html", 2, 9999))).otherwise(F.col("html")))
    got = warc.audit(left, warc.archived(hurt)).collect()
    assert sorted((r.a.page_id, r.state) for r in got) == [(3, "changed"), (250, "changed")]
    assert all(r.a.offset == r.b.offset and r.a.digest != r.b.digest for r in got)
    short = left.where("place < 398")
    assert sorted((r.place, r.state) for r in warc.audit(left, short).collect()) == [(p, "missing") for p in range(398, 402)]
    assert [r.state for r in warc.audit(short, left).limit(1).collect()] == ["extra"]
    assert warc.audit(left.limit(0), left.limit(0)).count() == 0
    assert warc.audit(left, left.limit(0)).count() == 402


def test_offsets_follow_each_other(spark):
    rows = warc.archived(_pages(spark)).orderBy("place").collect()
    at = 0
    for r in rows:
        assert r.offset == at
        at += r.length
    first = next(r for r in rows if r.page_id == 0)
    text = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://h0/0\r\nContent-Type: text/html\r\nContent-Length: 12\r\n\r\n<p> é 0</p>\r\n\r\n"
    from hashlib import sha256

    assert first.length == len(text.encode()) and first.digest == sha256(text.encode()).hexdigest()
