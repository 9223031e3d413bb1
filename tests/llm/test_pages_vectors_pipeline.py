"""HTML extraction, embedding near-dedup against all pairs, and the pipeline's stages in order."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.helpers import LABELS, ODD, classes, crc, docs, shingles
from tests.llm.test_rules_and_lines import brute_lines
from tillflow.llm import embed, html, packing, queries

SF = "/root/testdata/sf0.001"


# --- html --------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a = "<p>no</p>";</script></head>
<body><nav><ul><li><a href="/a">Home</a></li><li>About us</li></ul></nav><div class="ad">Buy now buy now</div>
<article><h1>Title &eacute;&nbsp;here</h1><!-- <p>gone</p> --><p>First  <b>bold</b>
line &lt;x&gt; &amp;amp;<br>after break<p>Second para<div class="adBox sidebar">More adverts</div><p>Third one is a bit longer</p></article>
<div class="comments"><p>Reader says no</p></div><form><p>Mail</p><button>Go</button></form><footer>&copy; all rights</footer></body></html>"""
TEXT = "Title é here\nFirst bold line <x> &amp;\nafter break\nSecond para\nThird one is a bit longer"


def fit(pages):
    total = {}
    for p in pages:
        for (f, inside), n in html.counts(p).items():
            total.setdefault(f, [0, 0])[0 if inside else 1] += n
    return html.weigh(total)


def test_article_without_the_rest():
    weights = fit([PAGE] * 3)
    assert html.extract(weights, PAGE) == TEXT
    bare = PAGE.replace("<article>", "<article >").replace("</footer></body></html>", "")
    assert html.extract(weights, bare) == TEXT
    assert html.extract(weights, "") == "" and html.extract(weights, "<p") == ""
    assert html.extract(weights, "<nav>" + "menu " * 50 + "</nav>") == ""


RICH = """<body><nav><ul><li>Home and more</li><li>About us</li></ul><table><tr><td>Menu cell</td></tr></table><blockquote><p>Menu words</p></blockquote></nav>
<article><h1>Head</h1><p>Before it</p><ul><li>%s</li><li>two</li></ul><table><tr><td>cell one</td><td>cell two</td></tr></table>
<aside>%s</aside><blockquote><p>Quoted here</p></blockquote><p>After it</p></article><footer><ul><li>Imprint</li></ul></footer></body>"""


def test_lists_tables_and_quotations_of_the_article():
    """Places that menus share lose nothing, on pages that mark their article and on others."""
    items = " ".join(["item"] * 30)
    page = RICH % (items, "advert " * 200)
    want = f"Head\nBefore it\n{items}\ntwo\ncell one\ncell two\nQuoted here\nAfter it"
    menus = "<nav><ul>" + "<li>menu words</li>" * 50 + "</ul></nav>"
    for weights in (fit([PAGE] * 9 + [page]), fit([menus + PAGE] * 9)):
        assert html.extract(weights, page) == want
    weights = fit([menus + PAGE] * 9 + [page] * 3)
    assert weights["flow|ul>li"] > 0 > weights["nav|ul>li"]
    assert html.extract(weights, page.replace("<body>", "<body><article>A teaser</article>")).endswith(want)
    bare = re.sub("<aside>.*?</aside>", "", page).replace("<article>", "<div class=post>").replace("</article>", "</div>")
    assert items in html.extract(weights, bare) and "cell two" in html.extract(weights, bare)


def test_marks_within_the_article_count_as_whole_classes():
    page = """<body><div class="site-header"><p>Site name</p></div><article><div class="entry-header"><h1>Head</h1></div>
<section id="related-work"><p>Earlier work</p></section><div class="header"><p>Lead</p></div><div class="Share sharedaddy"><p>Share it</p></div>
<div role="navigation"><p>Next page</p></div><p class=noticeBoard>Board</p></article><div id="related-posts"><p>More</p></div></body>"""
    assert html.extract({}, page) == "Head\nEarlier work\nLead\nBoard"
    assert [b.element.never for b in html.Page(page).blocks if not b.element.within] == [True, True]


def test_scan_finds_the_best_stretch():
    """The linear scan against all contiguous stretches, ties to the earlier and shorter one."""
    rng = np.random.default_rng(3)
    for _ in range(2000):
        n = int(rng.integers(0, 9))
        scores = (rng.integers(0, 5, n) / 2).tolist()
        before = (-rng.integers(0, 6, n) / 2).tolist()
        sums = {(i, j): sum(scores[i:j]) + sum(before[i + 1:j]) for i in range(n) for j in range(i + 1, n + 1)}
        best = max(sums.values(), default=0)
        got = html.best_stretch(before, scores)
        if best <= 0:
            assert got == (0, 0)
        else:
            assert sums[got] == best and got[1] == min(j for (_, j), v in sums.items() if v == best)
            assert got[0] == max(i for (i, j), v in sums.items() if v == best and j == got[1])


def test_weights_have_contrast():
    """Words and tags carry weights learned from labelled pages: places of menus fall below, tags cost by where they stand."""
    menus = "<nav><ul>" + "<li><a href=x>menu words</a></li>" * 20 + "</ul></nav>"
    weights = fit([menus + PAGE] * 9)
    assert weights["nav|ul>li"] < 0 and weights["div.ad|"] < 0 and weights["footer|"] < 0 and weights["flow|p"] > 0 < weights["flow|h1"]
    tags = {f: w for f, w in weights.items() if f.startswith("<")}
    assert all(-html.TAG_CLIP <= w <= -html.TAG_LEAST for w in tags.values())
    assert tags["<li"] == tags["<a"] == tags["<nav"] == -html.TAG_CLIP < tags["<p"]


def test_pages_without_the_mark_give_the_same_text(spark):
    """The article's mark has no part in the scan: renamed or removed, every page's text stays."""
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    weights = fit(pages)
    for page in pages:
        want = html.extract(weights, page)
        assert want
        for tag in ("section", "div"):
            assert html.extract(weights, page.replace("<article>", f"<{tag}>").replace("</article>", f"</{tag}>")) == want
        assert html.extract(weights, page.replace("<article>", "").replace("</article>", "")) == want


def test_no_labelled_page_leaves_the_lists():
    page = PAGE.replace("<article>", "<section>").replace("</article>", "</section>")
    assert fit([page]) == {} and html.extract({}, page) == TEXT


def test_open_elements_and_stray_tags_take_linear_time():
    import time

    def took(n):
        page = "<foo>" * n + "</bar>" * n + "<p>x</p><li>y" * n
        start = time.perf_counter()
        html.extract({}, page)
        return time.perf_counter() - start
    took(500)
    assert min(took(16_000) for _ in range(2)) < 24 * max(min(took(2_000) for _ in range(3)), 0.02)


def test_pages_query_reads_whole_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in html.main_text(pages).collect()}
    assert len(got) == pages.count()
    import html as lib
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(lib.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner)]
        want = "\n".join(x for x in parts if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_odd_pages(spark):
    rows = [(i, None, t) for i, t in enumerate([None, "", "plain text", "<", "<p>" * 4000 + "x", "<a " + "b" * 9999, PAGE, PAGE])]
    df = spark.createDataFrame([*rows, (None, "u", PAGE)], "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = html.main_text(df).collect()
    assert len(got) == 9 and sum(r["text"] == TEXT for r in got) == 3
    assert html.main_text(df.limit(0)).count() == 0


# --- embeddings --------------------------------------------------------------

def brute_vectors(rows, least=embed.COSINE):
    good = {}
    for i, v, label in rows:
        if label is None or v is None or i is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float64)
        good[i] = (x / np.linalg.norm(x), label)
    links = {i: {j for j, (y, m) in good.items() if j != i and m == label and len(x) == len(y) and x @ y >= least}
             for i, (x, label) in good.items()}
    names = {i for i, _, _ in rows if i is not None}
    cls = classes([(i, j) for i, s in links.items() for j in s], names)
    return {i: (len(links.get(i, ())), cls[i]) for i in names}


def test_links_match_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(14):
        base = rng.standard_normal(24)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.integers(1, 30))):
            v = base + rng.standard_normal(24) * rng.choice([0, 0.05, 0.1, 0.2]) * np.linalg.norm(base) / 5
            rows.append((len(rows), v.astype(np.float32).tolist(), label))
    same = rng.standard_normal(24).astype(np.float32).tolist()
    rows += [(len(rows) + k, same, 1) for k in range(40)]
    rows += [(len(rows) + k, v, label) for k, (v, label) in enumerate([
        (None, 1), ([0.0] * 24, 1), ([], 1), (same, None), ([None] + same[1:], 1), ([float("nan")] + same[1:], 1),
        ([float("inf")] + same[1:], 1), (same[:12], 1), (same[:12], 1), ([2 * x for x in same], 1)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = {r["vec_id"]: r for r in embed.near_duplicates(df, size=16).collect()}
    want = brute_vectors(rows)
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_distant_blocks_are_skipped(spark):
    """Groups far apart on the grid: the descent must leave fewer block pairs than there are."""
    rng = np.random.default_rng(6)
    rows = []
    for g in range(8):
        base = np.zeros(16)
        base[g % 8] = 10 if g < 4 else -10
        rows += [(len(rows) + k, (base + rng.standard_normal(16) * 0.2).tolist(), 0) for k in range(48)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    reps = df.select(F.col("vec_id").alias("rep"), F.lit(1).cast("long").alias("many"), "label", "embedding")
    eps = float(np.sqrt(2 - 2 * embed.COSINE))
    blocks = embed._block_table(reps, embed.principal_axes(reps, 16), eps, 16).checkpoint()
    bits = blocks.agg(F.max("number")).first()[0].bit_length()
    nodes = blocks.withColumn("node", F.shiftleft("task", bits) + F.col("number"))
    top = -(-(bits + blocks.agg(F.max("task")).first()[0].bit_length()) // embed.FAN_BITS)
    pairs, n = embed.near_pairs(nodes, top, eps).count(), blocks.count()
    assert n <= pairs < 0.5 * n * (n + 1) / 2
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed.near_duplicates(df, size=16).collect()}
    assert got == brute_vectors(rows)


def test_axes_of_wide_vectors(spark):
    """Beyond SKETCH components the axes come from a sketch: orthonormal, nearly as good, results as before."""
    rng = np.random.default_rng(6)
    dim = embed.SKETCH + 40
    way = np.linalg.qr(rng.standard_normal((dim, embed.DIMS)))[0]
    centre = (rng.standard_normal((60, embed.DIMS)) * 4) @ way.T
    vectors = np.concatenate([centre[i % 60] + 0.05 * rng.standard_normal((1, dim)) for i in range(240)])
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    axes = embed.principal_axes(df, dim)
    assert axes.shape == (dim, embed.DIMS) and np.allclose(axes.T @ axes, np.eye(embed.DIMS), atol=1e-9)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cov = np.cov(unit.T, bias=True)
    best = np.linalg.eigvalsh(cov)[::-1][: embed.DIMS].sum()
    assert np.trace(axes.T @ cov @ axes) > 0.95 * best
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed.near_duplicates(df, size=16).collect()}
    assert got == {i: tuple(x) for i, x in brute_vectors(rows).items()}


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed.near_duplicates(df).count() == 0
    bad = spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, embed.near_duplicates(bad).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


# --- pipeline ----------------------------------------------------------------

def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "line dedup", "minhash near-dedup", "packing"]
    names = set(entry.queries())
    assert {*queries.QUERIES, "pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_equals_its_parts(spark, tmp_path):
    """Every stage on what the one before kept, against brute force where there is one."""
    docs_ = spark.read.parquet(f"{SF}/documents.parquet")
    held = {}
    frames = [docs_]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], SF)
        out.write.parquet(str(tmp_path / str(k)))
        frames.append(spark.read.parquet(str(tmp_path / str(k))))
        held[name] = frames[-1]
        if name != "packing":
            assert frames[-1].columns == docs_.columns
    rules = {r["doc_id"]: r["kept"] for r in queries.op2_quality(spark, SF).collect()}
    assert {r["doc_id"] for r in held["quality rules"].collect()} == {d for d, k in rules.items() if k}
    before = [(r["doc_id"], r["text"]) for r in held["toxicity"].collect()]
    after = {r["doc_id"]: r["text"] for r in held["line dedup"].collect()}
    import hashlib
    want = {d: h for d, _, _, h in brute_lines(before)}
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in after.items()} == want
    sets = [(d, shingles(t)) for d, t in after.items()]
    cls = classes([(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if s and t and len(s & t) >= 0.8 * len(s | t)], list(after))
    kept = {r["doc_id"] for r in held["minhash near-dedup"].collect()}
    assert kept == {d for d, c in cls.items() if d == c}
    pieces = held["packing"].collect()
    assert {r["doc_id"] for r in pieces} == kept
    one = sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect()))
    assert one == sorted({(r["doc_id"], r["doc_tokens"]) for r in pieces})


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, tmp_path, name):
    spark.createDataFrame([(i, 1, int(crc(i) % 2)) for i in range(len(ODD))], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    df = docs(spark, ODD, extra=True)
    out = stage(spark, df, str(tmp_path))
    assert out.count() >= 0 and (name == "packing" or out.columns == df.columns)
    if name != "packing":  # other columns keep their own values
        assert out.filter("n_lines != 'own n_lines' or score != 'own score' or kept != 'own kept'").count() == 0
    empty = stage(spark, df.limit(0), str(tmp_path))
    assert empty.count() == 0 and packing.SIZE == 1024
