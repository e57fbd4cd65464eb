"""Source audit, importance resampling and HTML extraction against plain versions and hand-made cases."""
import html
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkpack.llm import divergence, dom, extraction, resampling, terms
from sparkpack.llm.common import runs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def odd_texts():
    rng = random.Random(3)
    out = [None, "", " ", "A b É日本 x1 Y", "q" * 200 + " " + "Z" * 65 + " " + "w" * 64, "x" * 5000, "one"]
    return out + ["".join(rng.choice("abAB é1 ,\n") for _ in range(rng.randrange(300))) for _ in range(120)]


@pytest.mark.parametrize("limit", [40, 1000, 1 << 20])
def test_terms_are_counted_exactly_however_texts_are_sliced(limit):
    texts = odd_texts()
    for inside, pattern in ((terms.TERM, TERM), (terms.WORD, WORD)):
        found = Counter()
        for lo, data, offsets, _ in terms.text_slices(pa.array(texts), inside, limit):
            doc, term, names = terms.distinct_runs(data, offsets, inside)
            names = names.to_pylist()
            for a, b in zip(doc.tolist(), term.tolist()):
                found[lo + a, names[b]] += 1
            starts, ends, _ = runs(data, offsets, inside)
            assert terms.run_crcs(data, starts, ends).tolist() == [zlib.crc32(names[b].encode()) for b in term]
        assert found == Counter((i, w) for i, t in enumerate(texts) for w in pattern.findall(low(t)))


def test_joint_traversal_equals_dense_sums():
    rng = np.random.default_rng(1)
    for columns, rows in ((divergence.COLS, 64), (700, 5), (1, 64), (65, 1)):
        trees, dense = [], []
        for _ in range(2):
            p = np.where(rng.random((rows, columns)) < rng.choice([0.0, 0.001, 0.05], (rows, 1)), rng.integers(50, 10**9, (rows, columns)), 0)
            p[:, columns // 3: columns // 2] = 0                     # a band every row leaves empty
            zero = rng.integers(1, 1000, rows)
            r, c = np.nonzero(p)
            trees.append(divergence.Quadtree(r, c, p[r, c], zero))
            dense.append(np.where(p > 0, p, zero[:, None]))
        expected = np.array([np.abs(dense[1] - row).sum(axis=1) for row in dense[0]])
        assert np.array_equal(divergence.joint_sums(*trees, columns), expected)


def plain_audit(rows, least_docs, best):
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    out = []
    for lang in {a for _, a, _ in rows}:
        docs = [(low(t), s) for t, a, s in rows if a == lang]
        df = Counter(w for t, _ in docs for w in set(TERM.findall(t)))
        kept = sorted(w for w in df if df[w] >= least_docs)
        count = defaultdict(Counter)
        for t, s in docs:
            count[s].update(w for w in TERM.findall(t) if df[w] >= least_docs)
        everything = sum(count.values(), Counter())

        def chances(c):
            return {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        q, sources = chances(everything), sorted({s for _, s in docs})
        p = {s: chances(count[s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in sources if o != s]
            some = [(p[s][w] - q[w], w) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, items in (("pair", pairs), ("term", some)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, w, v, i) for i, (v, w) in enumerate(items, 1) if part == "pair" or i <= best]
    return sorted(out)


@pytest.mark.parametrize("least_docs, best", [(3, 50), (2, 4), (10**6, 50)])
def test_audit_equals_plain_version(spark, least_docs, best):
    rng = random.Random(2)
    vocab = [f"{a}{b}" for a in "abcdeéß" for b in "xyzö"]
    rows = [(" ".join(rng.choice(vocab[: rng.randrange(2, 28)]) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None]),
             rng.choice(["hot", "hot", "a", "b", "c", None])) for _ in range(150)]
    rows += [(None, "fr", "only"), ("", "it", "x"), ("!!", "it", "y"), ("word " * 3000, "en", "long"), rows[0], rows[0]]
    rows += [(" ".join(vocab[:6]), "many", f"s{i:03}") for i in range(70)]      # more groups than one band of the tree holds
    docs = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], SCHEMA).withColumn("term", F.lit("own")).withColumn("n", F.lit(1)).repartition(3)
    found = divergence.audit_sources(docs, least_docs, best).collect()
    assert sorted(map(tuple, found)) == plain_audit(rows, least_docs, best)


def test_audit_of_no_documents(spark):
    assert divergence.audit_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_resample(rows, target, percent, least_words, buckets):
    feats = [[zlib.crc32(w.encode()) % buckets for w in WORD.findall(low(t))] for _, t in rows]
    s, t = Counter(b for f in feats for b in f), Counter(zlib.crc32(w.encode()) % buckets for x in target for w in WORD.findall(low(x)))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for (key, _), f in zip(rows, feats):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return sorted(map(repr, map(tuple, out)))


def test_resampling_equals_plain_version(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["Über", "日本"]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(60)))) for i in range(200)]
    rows += [(i, t) for i, t in enumerate(odd_texts(), 500)] + [rows[7]] * 30 + [(None, "w1 " * 30), (None, "w1 " * 30), (None, None), (-5, "w2 " * 25)]
    target = ["w1 w2 w3", None, "", "日本 w1"]
    docs = spark.createDataFrame([(k, t, None, None, 0) for k, t in rows], SCHEMA).withColumn("row", F.lit("own")).withColumn("score", F.lit("x")).repartition(3)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (0, 10, 37, 100):
        found = resampling.resample(docs, aim, percent=percent, buckets=500).collect()
        expected = plain_resample(rows, target, percent, 20, 500)
        assert sorted(map(repr, map(tuple, found))) == expected
    none = spark.createDataFrame([], "text string")
    assert sorted(map(repr, map(tuple, resampling.resample(docs, none).collect()))) == plain_resample(rows, [], 10, 20, 10_000)
    assert resampling.resample(spark.createDataFrame([], SCHEMA), aim).collect() == []


def test_bisection_finds_the_cut_in_any_range(spark):
    values = [-(2**62), -7, -7, -7, 0, 1, 5, 5, 2**62]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for wanted in range(1, len(values) + 1):
        at, below = resampling.least_reaching(rows, F.col("v"), wanted)
        assert at == values[wanted - 1] and below == sum(v < at for v in values)


ARTICLES = [f"Title {i}|First {w} paragraph, number {i}.|Second &amp; last {w}; it has {i * 7} words &lt;b&gt;." for i, w in
            enumerate("red green blue grey black white brown pink".split())]


def semantic(i, parts):
    """A page that marks its parts; menus, adverts, comments and the footer vary by page."""
    return f"""<!DOCTYPE html><html><head><title>{parts[0]} | site</title><style>p {{}}</style></head><body class="has-sidebar">
      <header><h1>The Site</h1></header><nav><ul><li><a href="/{i}">menu {i}</a><li><a href=x>more {i}</a></ul></nav>
      <div class="cookie-notice">We use cookies {i}</div><main><article class="post-{i}"><header><h1>{parts[0]}</h1></header>
      <p>{parts[1]}<p>{parts[2]}</p><p class="share-bar">Share {i}</p><aside>Related {i}</aside><script>var x = "</p>{i}";</script>
      <p>Subscribe to our letter!</p></article><section id="comments"><article class=comment><p>Nice {i}</article></section></main>
      <form><label>Mail</label><input value=x><button>Send {i}</button></form><footer>&copy; {i}</footer>"""


def plain_divs(i, parts):
    """No element says what is what: only names and what varies."""
    return f"""<html><body><div>The Site of Things</div><div class="navbar"><a href=a>A{i}</a></div><table><tr><td>Fixed words</td></tr></table>
      <div class=text><b>{parts[0]}</b><br><p>{parts[1]}<p>{parts[2]}</div><div class="links"><a href=1>next {i}</a> <a href=2>last {i}</a></div>
      <div class="adBox">Buy {i}</div><div>All rights are ours</div></body></html>"""


def expected_blocks(parts):
    return "\n\n".join(html.unescape(p) for p in parts)


def test_pages_of_two_kinds_of_template(spark):
    rows, expected = [], {}
    for kind, build in enumerate((semantic, plain_divs)):
        for i, a in enumerate(ARTICLES):
            key = 100 * kind + i
            rows.append((key, f"https://host{kind}.example.org/{i}", build(i, a.split("|"))))
            expected[key] = expected_blocks(a.split("|"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("own")).withColumn("text", F.lit(1))
    for parts in (1, 7):
        found = {r["page_id"]: r for r in extraction.extract_pages(pages.repartition(parts)).collect()}
        assert {k: r["text"] for k, r in found.items()} == expected
        assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, None, None), (2, "no url", ""), (3, "http://a.b/", "just   words\n here"), (4, "http://a.b:80/x", "<p>a<p>b &nbsp; c</p></p></div><i>d"),
            (5, "http://u@A.b", "<script>never closed <p>x"), (6, "http://a.b", "<!-- never closed <p>x"), (7, "http://a.b", deep), (8, "http://a.b", "<p>" + "word " * 200_000),
            (None, "http://a.b", "<ul><li>one<li>two</ul>"), (9, "http://a.b", "<article></article><p>body text only</p>"), (10, "http://a.b", "<<p>>x</ p><b"), (10, "http://a.b", "<<p>>x</ p><b")]
    found = extraction.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    assert text[1] == text[2] == text[5] == "" and text[3] == "just words here" and text[4] == "a\n\nb c\n\nd"
    assert text[7] == "deep" and text[8] == ("word " * 200_000).strip() and text[None] == "one\n\ntwo" and text[9] == "body text only"
    assert extraction.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_equal_pages_are_not_taken_for_template(spark):
    page = semantic(1, ARTICLES[1].split("|"))
    rows = [(i, "http://copies.example.org", page) for i in range(9)]
    found = extraction.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    wanted = expected_blocks(ARTICLES[1].split("|")) + "\n\nSubscribe to our letter!"       # nothing shows that this repeats
    assert {r["text"] for r in found} == {wanted}


def test_tree_matching_pairs_the_most_nodes():
    def tree(text):
        return extraction.page_template(dom.compact(dom.parse(text)))

    def count(t):
        return 1 + sum(map(count, t[-1]))
    a, b = tree("<div class=a><p>x</div><div class=b><h1>t</h1><p>y</div>"), tree("<div class=b><p>y</div><table></table><div class=a><p>x</div>")
    assert extraction.tree_match(a, b, {}) == 3                     # order lets only one of the two divs match
    assert extraction.tree_match(a, a, {}) == count(a)
    both = extraction.merge(json.loads(json.dumps(a)), json.loads(json.dumps(b)))
    assert both[1] == 2 and count(both) == count(a) + count(b) - 3


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extraction.extract_pages(pages).collect():
        inner = re.search(r"<article>(.*)</article>", source[r["page_id"]], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


def test_cut_texts_have_the_tokenizers_ids(monkeypatch):
    """All texts of sf0.01 and short forms in odd places, with small and large slices."""
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    from sparkpack.llm import packing
    from sparkpack.llm.queries import tokenizer_path

    rng = random.Random(1)
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()]
    texts += ["don't we'll they've i'm he'd you're it's 'tis ''s \"'s x's's 's", "'", "l'", "a'l b'r c'v 're've", "12a3'4", "''", "foo's\n'bar", "<|x|> y", "日本 a"]
    texts += ["".join(rng.choice("ab'strevlmd 1,._é\n\t") for _ in range(rng.randrange(80))) for _ in range(500)]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for size in (3000, 1 << 20):
        monkeypatch.setattr(packing, "CHARS", size)
        assert packing.WordTokens(tokenizer_path()).encode(texts) == expected
