"""Each operator against a brute-force version, and on awkward and empty tables."""

import hashlib
import html as entities
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import awkward, documents, sorted_rows
from tests.oracle import compare, connect
from tidemark.llm import bpe, decontaminate, html_text, pii, quality_classifier, quality_rules, queries, quotations, sharding, simhash, toxicity
from tidemark.llm.shared import read

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(llm_spark, name):
    assert compare(queries.QUERIES[name](llm_spark, SF), connect(SF), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_one_row_each(llm_spark, name):
    table = {"op3_html_text": "pages", "op10_quotations": "conversations", "op13_centroids": "embeddings"}.get(name, "documents")
    df = queries.QUERIES[name](llm_spark, SF)
    if name == "op12_packing":  # one row a piece
        df = df.where("start = 0")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert df.count() == read(llm_spark, SF, table).count()


# ---- decontamination

def naive_hits(text, items, window=13):
    words = decontaminate.ascii_words(text)
    covered, found = set(), set()
    for item, t in items:
        w = decontaminate.ascii_words(t)
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if k else ():
            for p in range(len(words) - k + 1):
                if words[p:p + k] == w[i:i + k]:
                    covered |= set(range(p, p + k))
                    found |= {item} - {None}
    return len(words), len(covered), sorted(found)


@pytest.mark.parametrize("block_bytes", [64 << 20, 400])
def test_decontaminate_brute_force(llm_spark, block_bytes):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "c", "Dé", "e1"])
    items = [(str(i), " ".join(word() for _ in range(rng.choice([1, 2, 5, 13, 14, 20])))) for i in range(12)] + [("9", None), ("8", " ,. "), (None, "c c c c")]
    docs = [(i, ", ".join(word() for _ in range(rng.randrange(60)))) for i in range(40)] + [(90, None), (91, "x " * 20 + items[5][1] + " y")]
    df = llm_spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = llm_spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.find_items(df, bench, block_bytes=block_bytes).withColumn("h", decontaminate.n_hit("hits")).collect()
    assert {r["doc_id"]: (r["n_words"], r["h"], r["items"]) for r in got} == {i: naive_hits(t, items) for i, t in docs}


def test_decontaminate_drops_and_keeps(llm_spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = documents(llm_spark, [(1, item), (2, "clean text " * 20), (3, item + " other" * 5000), (4, None), (5, "")])
    left = decontaminate.decontaminate(docs, llm_spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {2, 3, 4, 5}


def test_decontaminate_awkward(llm_spark):
    docs = awkward(llm_spark)
    empty = llm_spark.createDataFrame([], "item_id bigint, text string")
    assert sorted_rows(decontaminate.decontaminate(docs, empty)) == sorted_rows(docs)
    assert decontaminate.find_items(docs.limit(0).drop("n_words"), empty).count() == 0


# ---- tokens

@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return bpe.Bpe(bpe.load(bpe.default_path())), tokenizers.Tokenizer.from_file(bpe.default_path())


def test_bpe_equals_library(tokenizer, llm_spark):
    own, library = tokenizer
    rng = random.Random(1)
    texts = [r["text"] for r in read(llm_spark, SF, "documents").select("text").collect()]
    parts = ["abc", "The", "ing", "'s", "'LL", "é", "ß", "ΑΣ", "İ", " ", "\n\t", "&&&", "#", "..", "019", "日本", "\U0001f600", "<|endoftext|>", "\x85", "é"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(2000)] + ["", " ", "a" * 3000, "!?" * 2000, "ab" * 999]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        ids, decoded = own.encode_and_decode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want
        assert decoded == own.decode(ids) == library.decode(want, skip_special_tokens=False)
        assert own.encode(t) == ids


def test_every_token_encodes_to_itself(tokenizer):
    own, library = tokenizer
    for s, i in library.get_vocab().items():
        if i in own.parts and s.endswith("</w>"):
            word = bytes(own.letters.index(c) for c in s[:-4])
            try:
                assert own.piece_ids(word.decode()) == [i]
            except UnicodeDecodeError:
                pass  # part of a character


def test_bpe_awkward(llm_spark):
    docs = awkward(llm_spark)
    got = bpe.tokenized(docs, bpe.default_path(), names=("ids", "decoded"))
    assert got.count() == docs.count() and got.columns == [*docs.columns, "ids", "decoded"]
    assert {(bytes(r["ids"]), r["decoded"]) for r in got.where("text is null or trim(text) = ''").collect()} == {(b"", "")}


# ---- pages

def test_html_plain_articles(llm_spark):
    pages = read(llm_spark, SF, "pages")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h\d)>", article)]
        want[r["page_id"]] = "\n".join(p for p in parts if p)
    got = html_text.extracted(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_html_boilerplate_and_templates(llm_spark):
    page = lambda i, box="": (i, f"http://www.host.org/{i}", f"""<html><head><title>T{i}</title></head><body><header>Site name</header>
      <div class="cookie-notice">We use cookies</div><div><p>Every page says this.</p></div>{box}<h1>Title &amp; {i}</h1><p>First&nbsp;line<br>goes on {i}
      <p>Second <b>bold</b>er {i}<script>var a = "<p>no</p>";</script><form>Search</form><aside>Side</aside><ul id="comments"><li>nice one {i}</ul>
      <footer>Bye</footer></body>""")  # noqa: E731
    rows = [page(i) for i in range(10)] + [(50, None, None), (51, "", ""), (52, "nonsense", "just text & more"), (53, "http://host.org/x", "<p>open <b>text<!-- never closed")]
    got = {r["page_id"]: r["text"] for r in html_text.extracted(llm_spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "Title & 3\nFirst line goes on 3\nSecond bolder 3"
    assert (got[50], got[51], got[52], got[53]) == ("", "", "just text & more", "open text")


def test_html_copied_articles_stay(llm_spark):
    text = "<html><body><div class=menu>M</div><article><h1>Same</h1><p>Copied words.</p><div class='share'>Share</div></article></body></html>"
    rows = [(i, "https://copy.example/a", text) for i in range(30)] + [(i, "https://copy.example/b", text.replace("words", f"words {i % 7}")) for i in range(30, 90)]
    got = {r["page_id"]: r["text"] for r in html_text.extracted(llm_spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == "Same\nCopied words." and got[31] == "Same\nCopied words 3."
    assert html_text.extracted(read(llm_spark, SF, "pages").limit(0)).count() == 0


def kept(page):
    return [t for t, kind in html_text.parse(page)[0] if kind]


@pytest.mark.parametrize("tag", ["<video-player src=a></video-player>", "<title-bar>", "<select-menu>", "<object-x>", "<svg width=1/>", '<svg aria-label="a > b" width="1" />', "<svg/>",
                                 "<math/>", "<iframe src=a>", "<video src=a>", "<noscript>"])
def test_html_text_goes_on_after(tag):
    assert kept(f"<p>One.</p>{tag}<p>Two.</p><p>Three.</p>") == ["One.", "Two.", "Three."]


@pytest.mark.parametrize("wrapper", ['div class="layout has-sidebar"', 'div id="page" class="site with-nav"', 'div class="page-header-fixed"', 'form id="aspnetForm"'])
@pytest.mark.parametrize("inner", ["article", "main"])
def test_html_wrapped_article_stays(wrapper, inner):
    tag = wrapper.split()[0]
    page = f"<body><a>Skip</a><{wrapper}><div class=sidebar>Side</div><{inner}><h1>One.</h1><p class=share>Share</p><p>Two words.</p></{inner}><p>Foot</p></{tag}></body>"
    blocks = html_text.parse(page)[0]
    assert [t for t, kind in blocks if kind == html_text.best_kind(blocks)] == ["One.", "Two words."]


@pytest.mark.parametrize("box", ["div class=comments", "div class=related", "nav", "div hidden", "div class='sidebar related'"])
def test_html_articles_of_boxes_go(box):
    tag = box.split()[0]
    assert kept(f"<body><p>Text.</p><{box}><article>Another one that is longer.</article></{tag}></body>") == ["Text."]
    assert kept(f"<body><article>Text.</article><div class=has-nav><{box}><article>Another one.</article></{tag}></div></body>") == ["Text."]


def test_html_teaser_in_main(llm_spark):
    page = "<main><h1>Title</h1><p>A long text stands in the main element.</p><article><p>Teaser</p></article></main>"
    rows = [(1, "http://a.org/1", page), (2, "http://a.org/2", "<main><h1>Title</h1><article><p>The article itself.</p></article></main>")]
    got = {r["page_id"]: r["text"] for r in html_text.extracted(llm_spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {1: "Title\nA long text stands in the main element.", 2: "The article itself."}


def test_html_raw_elements_go():
    assert kept("<p>One.</p><svg><text>no</text></svg ><p>Two.</p><SCRIPT>if (a<b) '<p>no</p>'</script><p>Three.</p><style>no") == ["One.", "Two.", "Three."]
    assert len(kept("<svg><p>a</p>" * 100_000)) == 100_000  # linear


def test_html_titles_of_articles_stay():
    for name in ("related-work", "social_policy", "promotion-and-relegation", "informed-consent", "modal-logic", "hidden-markov-models", "navigation", "comments"):
        assert kept(f"<article><h2 id='{name}'>Title</h2><p>Text.</p></article>") == ["Title", "Text."]
        assert kept(f"<article><section id='{name}'><h2>Title</h2><p>Text.</p></section></article>") == ["Title", "Text."]
        assert kept(f"<main><div class='section' id='{name}'><h2>Title</h2><p id='{name}'>Text.</p></div></main>") == ["Title", "Text."]
    assert kept("<article><h2 class=social>Title</h2><p>As <math><semantics><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></semantics></math> holds.</p><math/><p>So.</p></article>") \
        == ["Title", "As x=1 holds.", "So."]
    assert kept("<article><p>Text.</p><div class='share-buttons'>no</div><div id=comments>no</div><section class='newsletter'>no</section><div role=navigation>no</div></article>") == ["Text."]


def test_html_weak_words_go_where_they_recur(llm_spark):
    page = lambda i: f"<article><h2 class=social>Follow us</h2><p>Text of page {i}.</p><h2 id=related>Related {i}</h2></article>"
    rows = [(i, f"https://weak.example/{i}", page(i)) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in html_text.extracted(llm_spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"Text of page {i}.\nRelated {i}" for i in range(12)}


def test_html_template_of_one_section_of_a_large_host(llm_spark):
    notice = "<div><span>Spring sale until Sunday.</span></div>"
    page = lambda i: f"<html><body>{notice if i % 10 == 0 else ''}<p>Text of page {i}.</p></body></html>"
    for n in (40, 400):  # on a tenth of the pages: a few of a small host, many of a large one
        rows = [(i, f"https://large.example/{i}", page(i)) for i in range(n)]
        got = {r["page_id"]: r["text"] for r in html_text.extracted(llm_spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
        assert got == {i: ("Spring sale until Sunday.\n" if n == 40 and i % 10 == 0 else "") + f"Text of page {i}." for i in range(n)}


def test_new_columns_replace_clashing_ones(llm_spark):
    docs = llm_spark.createDataFrame([(1, "Mail a.b@c.org now.", 7, "x", 2)], "doc_id bigint, text string, Ids int, decoded string, spans int")
    alone = bpe.tokenized(docs.select("doc_id", "text"), bpe.default_path()).first()
    got = bpe.tokenized(docs, bpe.default_path())
    assert got.columns == ["doc_id", "text", "spans", "ids", "decoded"] and got.first()["ids"] == alone["ids"] and got.first()["decoded"] == alone["decoded"]
    got = bpe.tokenized(docs.withColumnRenamed("text", "t").drop("decoded").withColumnRenamed("t", "decoded"), bpe.default_path(), text="decoded")
    assert got.columns == ["doc_id", "spans", "ids", "decoded"] and got.first()["ids"] == alone["ids"] and got.first()["decoded"] == alone["decoded"]
    got = pii.with_spans(docs)
    assert got.columns == ["doc_id", "text", "Ids", "decoded", "spans"] and [s["kind"] for s in got.first()["spans"]] == ["email"]


# ---- toxicity

def test_block_max_equals_brute_force():
    rng = random.Random(2)
    words = [f"t{i}" for i in range(40)]
    terms = [w.encode() for w in words]
    vectors = toxicity.Vectors(terms, np.array([1 + rng.random() * 3 for _ in terms]), 0.7)
    texts = [" ".join(rng.choices([*words, "other"], [*range(1, 41), 5], k=rng.randrange(6))) for _ in range(4000)]
    examples = [(str(i), rng.randrange(2), *vectors(toxicity.terms_of(t))) for i, t in enumerate(texts)]
    index = toxicity.Index(vectors, examples, (1.0, 1.0), 0.1)
    dicts = [(k, dict(zip(at.tolist(), w.tolist()))) for k, _, at, w in examples]
    queries_run = 0
    for _ in range(150):
        q = vectors(toxicity.terms_of(" ".join(rng.choices([*words, "new"], k=rng.randrange(5)))))
        every = [(-round(sum(w * v.get(t, 0) for t, w in zip(*map(np.ndarray.tolist, q))), 9), k) for k, v in dicts]
        want = [(k, -s) for s, k in sorted(x for x in every if x[0] < 0)[:toxicity.NEIGHBOURS]]
        got = [(index.keys[i], s) for i, s in index.nearest(*q)]
        assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=2e-9)
        assert [k for k, _ in got] == [k for k, _ in want]
        queries_run += bool(len(q[0]))
    assert index.scored_blocks < queries_run * index.blocks  # some blocks were skipped


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_each_example_finds_itself(llm_spark, sf):
    """At every size: a labelled example's nearest neighbour is itself or an equal text, and toxic examples score toxic."""
    docs, labels = read(llm_spark, f"/root/testdata/sf{sf}", "documents"), read(llm_spark, f"/root/testdata/sf{sf}", "labels")
    texts = {str(r["doc_id"]): toxicity.terms_of(r["text"]) for r in docs.collect()}
    got = toxicity.scored(docs, labels).join(labels, "doc_id").where("not held_out").collect()
    for r in got:
        mine = texts[str(r["doc_id"])]
        assert not mine or texts[r["neighbours"][0]] == mine
    toxic = [r["predicted"] for r in got if r["toxic"] == 1]
    assert sum(toxic) / len(toxic) > 0.85


def test_toxicity_few_labels(llm_spark):
    """Three equal toxic texts among forty others are enough; a copy that is not labelled scores toxic, too."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(30))) for i in range(40)] + [(i, "you utter blockhead go away and never speak again") for i in (101, 103, 104, 105)]
    learnt = [i for i in (101, 103, 104, 105) if zlib.crc32(str(i).encode()) % 5][:3]
    labels = [(i, 0) for i, _ in rows if i < 100] + [(i, 1) for i in learnt]
    got = {r["doc_id"]: r for r in toxicity.scored(documents(llm_spark, rows), llm_spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    assert all(got[i]["predicted"] == 1 for i in (101, 103, 104, 105)) and all(got[i]["predicted"] == 0 for i in range(40))
    assert set(got[105]["neighbours"][:3]) == set(map(str, learnt))


def test_toxicity_held_out(llm_spark):
    docs, labels = read(llm_spark, "/root/testdata/sf0.1", "documents"), read(llm_spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.scored(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic = got[got.toxic == 1].predicted.mean()
    clean = got[got.toxic == 0].predicted.mean()
    assert toxic > 0.85 and clean < 0.02
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality_classifier, "quality")])
def test_classifiers_awkward(llm_spark, operator, label):
    docs = awkward(llm_spark)
    labels = llm_spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (6, 0), (9, 1)], f"doc_id bigint, {label} int")
    got = operator.scored(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and not (r["held_out"] and r["doc_id"] is None) for r in got)
    assert operator.scored(docs.limit(0), labels).count() == 0
    assert operator.scored(docs, labels.limit(0)).count() == docs.count()


def test_quality_classifier_held_out(llm_spark):
    docs, labels = read(llm_spark, "/root/testdata/sf0.1", "documents"), read(llm_spark, "/root/testdata/sf0.1", "labels")
    got = quality_classifier.scored(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.98


def test_discriminant_equals_density():
    rng = np.random.default_rng(1)
    size = len(quality_classifier.STATISTICS)
    x = {c: rng.normal(c, 1 + c, (400, size)) for c in (0, 1)}
    model = quality_classifier.Discriminant({c: (len(v), v.sum(axis=0), v.T @ v) for c, v in x.items()})
    covs = {c: np.linalg.inv(f.T @ f) for c, f in model.factor.items()}
    z = rng.normal(0.5, 1, (20, size))
    dens = {c: -0.5 * (np.einsum("ij,jk,ik->i", z - model.mean[c], np.linalg.inv(covs[c]), z - model.mean[c]) + np.linalg.slogdet(covs[c])[1]) for c in (0, 1)}
    odds = (dens[1] - dens[0]) / quality_classifier.TEMPER + np.log(model.share[1] / model.share[0])
    assert np.allclose(model.scores(z), 1 / (1 + np.exp(-np.clip(odds, -40, 40))))


# ---- sharding

def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_and_slots(llm_spark):
    docs = awkward(llm_spark).unionByName(read(llm_spark, SF, "documents").select("doc_id", "text", "lang", F.lit("").alias("n_words"), F.lit("").alias("fp"), F.lit(0).alias("_votes")))
    got = sharding.sharded(docs.repartition(7)).toPandas()
    assert len(got) == docs.count()
    for r in got.itertuples():
        key = sharding.key_hash(None if r.doc_id != r.doc_id else str(int(r.doc_id)))
        assert r.shard == plain_jump(key, 16) and r.grown_shard == plain_jump(key, 17) and r.grown_shard in (r.shard, 16)
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    texts = sorted((len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert sorted(zip(got["size"], got.text_crc32)) == texts
    assert sharding.sharded(docs.limit(0)).count() == 0


# ---- personal data

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = pii.digits_of(m.group())
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split(".")) or kind == 2 and 12 <= len(digits) <= 19 and pii.luhn(digits) \
                    or kind == 3 and 9 <= len(digits) <= 15:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_patterns(llm_spark):
    rng = random.Random(4)
    parts = ["1", "23", "255.", "4111 1111 1111 1111", ".", "-", " ", "+", "(", ")", "@", "a", "b.com", "é", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(5000)] + [r["text"] for r in read(llm_spark, SF, "documents").collect()]
    assert all(pii.base_spans(t) == plain_base(t) for t in texts)
    assert len(pii.base_spans("a@b.c" + "1" * 200_000 + "@" * 50_000 + "x" * 200_000)) <= 1  # linear


def test_crf_gradient_is_numeric_gradient():
    rng = np.random.default_rng(0)
    e, t = rng.normal(size=(5, 2, pii.TAGS)), rng.normal(size=(pii.TAGS, pii.TAGS))
    tags = np.array([[0, 1], [1, 2], [2, 0], [0, 3], [5, 4]])
    _, ge, gt = pii.crf_gradient(e, t, tags)
    for at in [(0, 0, 1), (2, 1, 0), (4, 0, 5), (3, 1, 7)]:
        d = np.zeros_like(e)
        d[at] = 1e-5
        assert (pii.crf_gradient(e + d, t, tags)[0] - pii.crf_gradient(e - d, t, tags)[0]) / 2e-5 == pytest.approx(ge[at], abs=1e-4)
    for at in [(0, 1), (1, 2), (0, 3), (2, 5)]:
        d = np.zeros_like(t)
        d[at] = 1e-5
        assert (pii.crf_gradient(e, t + d, tags)[0] - pii.crf_gradient(e, t - d, tags)[0]) / 2e-5 == pytest.approx(gt[at], abs=1e-4)


def test_lstm_gradient_is_numeric_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in pii.new_model(rng).items()}
    ids = rng.integers(1, pii.SIZE, (2, 6)).T
    weight = rng.normal(size=(6, 2, pii.HIDDEN)).astype(np.float32)
    trace = []
    pii.lstm(ids, p["xf"], p["hf"], trace)
    gx, gh = pii.lstm_back(ids, p["hf"], trace, weight, p["xf"].shape)
    loss = lambda x, h: float((pii.lstm(ids, x, h) * weight).sum())
    d = np.zeros_like(p["hf"])
    d[3, 11] = 1e-2
    assert (loss(p["xf"], p["hf"] + d) - loss(p["xf"], p["hf"] - d)) / 2e-2 == pytest.approx(gh[3, 11], abs=2e-2)
    d = np.zeros_like(p["xf"])
    d[ids[2, 1], 5] = 1e-2
    assert (loss(p["xf"] + d, p["hf"]) - loss(p["xf"] - d, p["hf"])) / 2e-2 == pytest.approx(gx[ids[2, 1], 5], abs=2e-2)


@pytest.fixture(scope="module")
def model(llm_spark):
    return pii.fitted(read(llm_spark, SF, "documents"))


def test_model_adds_and_keeps(llm_spark, model):
    rng = np.random.default_rng(77)
    right = {True: 0, False: 0}
    for i in range(400):
        piece = pii.made_span(rng, i % 4, True) if i % 5 else pii.made_other(rng)
        text = f"some words stand before {piece} and a few more behind it"
        at = text.index(piece)
        spans = pii.all_spans([text], model)[0]
        assert [s[:3] for s in spans if s[3]] == plain_base(text)
        right[bool(i % 5)] += (at, at + len(piece), i % 4) in [s[:3] for s in spans] if i % 5 else not spans
    assert right[True] > 0.7 * 320 and right[False] > 0.95 * 80


def test_regions_hold_whatever_can_be_added(monkeypatch):
    monkeypatch.setattr(pii, "MARGIN", 0)
    rng = random.Random(9)
    parts = ["a", "jo", "at", "dot", "AT", " ", "  ", "(", ")", "[", "]", ".", "@", "1", "23", "255", "4111", "-", "x-y", "\n", "/", "(at)", " at ", " dot ", "[.]", "é", "00"]
    found = 0
    for _ in range(800):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(4, 20)))
        read_spans = pii.regions(t)
        for a in range(len(t)):
            for b in range(a + 1, len(t) + 1):
                if any(pii.holds(t[a:b], k) for k in range(4)):
                    found += 1
                    assert any(x <= a and b <= y for x, y in read_spans), (t, t[a:b])
    assert found > 50
    name = "-".join(["department"] * 12)
    for t in (f"jane at {name} dot example dot org", f"{name} [at] mail.physics.university-of-somewhere.edu", f"jane dot {name}(at){name}[.]org"):
        (a, b), = pii.regions(f"ask {t} for more")
        assert a <= 4 and b >= 4 + len(t)


def test_long_addresses_are_masked_whole(monkeypatch):
    address = "jane [at] mail.physics." + "-".join(["university"] * 9) + ".edu"
    text = f"write to {address} for more"
    monkeypatch.setattr(pii, "model_spans", lambda texts, p: [[(0, 33, 0)]])  # ends inside the address, begins before it
    assert [(text[a:b], k, base) for a, b, k, base in pii.all_spans([text], {"": 0})[0]] == [(address, 0, False)]


def test_pii_masks(llm_spark, model):
    docs = documents(llm_spark, [(1, "write to jo.do@mail.example.com or +1 (555) 555-0100 now"), (2, "nothing here"), (3, None), (4, "")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.masked(docs, model=model).collect()}
    want = "write to <EMAIL> or <PHONE> now"
    assert got == {1: (want, len(want)), 2: ("nothing here", 12), 3: (None, None), 4: ("", 0)}
    odd = awkward(llm_spark)
    assert pii.masked(odd, model=model).columns == odd.columns and pii.masked(odd, model=model).count() == odd.count()
    assert pii.masked(odd.limit(0)).count() == 0


# ---- quality rules

def test_measures_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice(["aa", "b", " ", " ", "\n", "#", "|", "é", "\t", "aa b aa b aa b aa b "]) for _ in range(rng.randrange(80)))
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        inside = {p for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for p in range(i, i + 8)}
        lines = [x for x in text.split("\n") if x.strip(" \t\r\n\x0b\x0c")]
        got = quality_rules.measures(text)[0]
        assert got == [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)]


def test_em_finds_planted_accuracies():
    rng = random.Random(6)
    patterns = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        votes = []
        for known in [g for _, g in quality_rules.RULES.values()]:
            if known is None:
                votes.append("b" if rng.random() < (0.3 if not good else 0.005) else "a")
            else:
                votes.append(("g" if rng.random() < 0.95 else "a") if good else ("b" if rng.random() < 0.8 else "g"))
        patterns["".join(votes)] += 1
    post = quality_rules.fit(patterns)
    n = len(quality_rules.RULES)
    assert post["gg" + "a" * (n - 2)] > 0.9 and post["bb" + "b" * 2 + "a" * (n - 4)] < 0.01
    assert quality_rules.fit({}) == {}


def test_quality_rules_awkward(llm_spark):
    docs = awkward(llm_spark)
    names = [f"q_{n}" for n in quality_rules.NAMES]
    got = quality_rules.judged(docs, names).collect()
    assert len(got) == docs.count()
    assert all(r["q_base_failed"] and not r["q_kept"] and r["q_n_words"] == 0 for r in got if not (r["text"] or "").strip())
    assert quality_rules.keep_good(docs).columns == docs.columns and quality_rules.keep_good(docs.limit(0)).count() == 0


# ---- near-duplicates

def plain_components(fps, keys, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(fps)):
        if keys[i] is not None:
            least[find(i)] = min(least.get(find(i), keys[i]), keys[i])
    return [least.get(find(i)) for i in range(len(fps))]


def test_ball_hashing_brute_force(llm_spark):
    rng = random.Random(8)
    fps = [0, (1 << 64) - 1]
    for _ in range(60):  # chains and balls around random centres, with copies
        centre = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 8)):
            fps.append(centre)
            for b in rng.sample(range(64), rng.randrange(0, 5)):
                centre ^= 1 << b
    rows = [(i, simhash.signed(f)) for i, f in enumerate(fps)]
    df = llm_spark.createDataFrame(rows, "key bigint, fp bigint").repartition(5)
    got = {r["key"]: r["c"] for r in simhash.components(df, "fp", "key", "c").collect()}
    assert [got[i] for i in range(len(fps))] == plain_components(fps, list(range(len(fps))))


@pytest.mark.parametrize("slices", [1, 64, 256])
def test_each_pair_meets_in_some_slice(slices):
    rng = random.Random(slices)
    for d in (1, 2, 3):
        for _ in range(20):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), d):
                b ^= 1 << bit
            parts = simhash.to_slices(np.array([a, b], dtype=np.uint64), slices)
            assert any(len(simhash.ties_of_slice(f, s, slices)[0]) for s, f in parts.items())


def test_fingerprint_brute_force(llm_spark):
    import xxhash
    for text in [None, "", " ".join(f"w{i % 977}" for i in range(140_000)), "One", "one two", "a b c d e a b c A B C", "é ü x y\x0bz q"]:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
        grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) == want
    one = llm_spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()["h"]
    assert xxhash.xxh64_intdigest(b"a b c", 42) == one % (1 << 64)


def test_roots_of_long_chain(llm_spark):
    edges = llm_spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (300, 200), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in simhash.roots(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100, 300: 100}


def test_near_duplicates_awkward(llm_spark):
    docs = awkward(llm_spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count() and {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {2}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5, 6, 7]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_simhash_without_keys_keeps_one_of_a_component(llm_spark):
    words = [f"word{i}" for i in range(400)]
    base = " ".join(words)
    near = [" ".join(words[:-1] + [f"other{j}"]) for j in range(40)]
    close = next(t for t in near if 0 < (simhash.fingerprint(t) ^ simhash.fingerprint(base)).bit_count() <= 3)
    docs = llm_spark.createDataFrame([(None, base), (None, close), (None, base), (None, "something else entirely")], "doc_id bigint, text string")
    assert simhash.drop_near_duplicates(docs).count() == 2
    mixed = docs.unionByName(llm_spark.createDataFrame([(9, close), (4, base)], "doc_id bigint, text string"))
    assert sorted(r["doc_id"] or 0 for r in simhash.drop_near_duplicates(mixed).collect()) == [0, 4]


# ---- quotations

def test_quotations(llm_spark):
    rows = [(1, 0, "user", "hello there my good friend\nthe second line is here"), (1, 1, "assistant", "Fine words indeed my dear"),
            (1, 2, "user", "On Monday, Bob wrote:\n> hello there, my\n> good friend\n\nI agree with that\n>> not me"), (2, 0, "user", "> Fine words indeed my dear\nwhat is this about then"),
            (2, 1, "assistant", None), (None, None, "x", ""), (2, 2, "user", ">> what is this about then\n> nested reply\nown"), (2, 2, "user", ">> what is this about then\n> nested reply\nown"),
            (3, 0, "user", "same line said twice"), (3, 1, "user", "same line said twice"), (3, 2, "user", "> same line said twice\nyes")]
    got = quotations.linked(llm_spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    seen = {(r["conv_id"], r["reply_order"]): (r["text"], r["n_quotes"], r["reply_conv_id"], r["reply_turn"]) for r in got.collect()}
    assert seen == {
        (1, 0): (rows[0][3], 0, None, None), (1, 1): (rows[1][3], 0, 1, 0), (1, 2): ("I agree with that", 2, 1, 0),
        (2, 0): ("what is this about then", 1, 1, 1), (2, 1): ("", 0, 2, 0), (2, 2): ("own", 1, 2, 0), (2, 3): ("own", 1, 2, 0), (None, 0): ("", 0, None, None),
        (3, 0): (rows[8][3], 0, None, None), (3, 1): (rows[8][3], 0, 3, 0), (3, 2): ("yes", 1, 3, 1)}


def test_quotations_short_and_said_later(llm_spark):
    said = "The harbour is closed today."
    rows = [("a", 0, "x", "Hello."), ("a", 1, "x", "Why not?"), ("a", 2, "x", "Something else."), ("a", 3, "y", "> Why not?\n\nBecause."),
            ("b", 0, "x", f"> {said}\n\nReally?"), ("b", 1, "y", said), ("c", 4, "x", said), ("d", 0, "x", "> Why not?\n\nNo idea.")]
    got = {(r["conv_id"], r["turn"]): (r["reply_conv_id"], r["reply_turn"]) for r in quotations.linked(llm_spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()}
    assert got[("a", 3)] == ("a", 1)  # not the message before it
    assert got[("b", 0)] == ("c", 4)  # b itself says it only later
    assert got[("d", 0)] == (None, None)


def test_quotations_one_hot_conversation(llm_spark):
    rows = [(1, i, "user", f"message number {i} of this talk\n> message number {i - 1} of this talk" if i % 3 else f"message number {i} of this talk") for i in range(300)]
    df = llm_spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(6)
    got = sorted((r["turn"], r["reply_order"], r["reply_turn"]) for r in quotations.linked(df).collect())
    assert got == [(i, i, i - 1 if i else None) for i in range(300)]
    assert quotations.linked(df.limit(0)).count() == 0


# ---- pipeline

def test_pipeline_equals_plain_python(llm_spark, tokenizer):
    """The stages in plain Python: brute-force pairs, windows and spans; only vote weights and the model are shared."""
    docs = [r.asDict() for r in read(llm_spark, SF, "documents").collect()]
    items = [(str(r["item_id"]), r["text"]) for r in read(llm_spark, SF, "benchmark").collect()]
    votes = [quality_rules.measures(d["text"]) for d in docs]
    post = quality_rules.fit(Counter(quality_rules.vote(v[1]) for v in votes))
    left = [d for d, v in zip(docs, votes) if not quality_rules.base_failed(v[0][0], v[0][4]) and post[quality_rules.vote(v[1])] >= 0.5]
    groups = plain_components([simhash.fingerprint(d["text"]) for d in left], [d["doc_id"] for d in left])
    left = [d for d, g in zip(left, groups) if d["doc_id"] == g]
    hits = [naive_hits(d["text"], items) for d in left]
    left = [d for d, (n, h, _) in zip(left, hits) if not (h > 0 and 20 * h >= n)]
    own, _ = tokenizer
    got = {r["doc_id"]: r for r in corpus_pipeline.run(llm_spark, SF).collect()}
    assert set(got) == {d["doc_id"] for d in left} and len(left) > 50
    for d in left:
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(r["ids"]) // 4 and r["decoded_sha256"] == hashlib.sha256(own.decode(bytes(r["ids"])).encode()).hexdigest()
        if not plain_base(d["text"]) and not re.search(r"[0-9@]", d["text"]):
            assert bytes(r["ids"]) == own.encode(d["text"])


def test_pipeline_stages_keep_columns(llm_spark):
    docs = awkward(llm_spark).withColumn("n_chars", F.length("text"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(llm_spark, docs, SF).columns == docs.columns
        assert stage(llm_spark, docs.limit(0), SF).count() == 0
