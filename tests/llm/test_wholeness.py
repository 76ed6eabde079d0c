"""Nothing is cut short: drifting families, long keys, long labelled texts, clashing columns, page parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reportlake.llm import html_text, near_duplicates, order_minhash, secret_scan, toxicity
from reportlake.llm.mixing import pfair_mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def family(rnd, base, n, most):
    """Copies of ``base`` with up to ``most`` words changed each."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randrange(most + 1)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**9)}"
        out.append(" ".join(words))
    return out


def brute_classes(texts):
    """Class (least place) of each text by all pairs that are near."""
    hashes = order_minhash.kmers(texts)
    sets = [set(h.tolist()) for h in hashes]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    pairs = []
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.75 * min(len(sets[i]), len(sets[j])) and order_minhash.near(hashes[i], hashes[j]):
                pairs.append((i, j))
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))], pairs


def test_links_of_a_drifting_family(spark):
    """A family of 300 texts of which most pairs are alike but not near: at least 0.97 of the near pairs end in one class."""
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(400)}" for _ in range(180)]
    texts = family(rnd, base, 260, 12) + [" ".join(f"o{rnd.randrange(10**6)}" for _ in range(rnd.choice([12, 80, 200]))) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: r.class_id for r in order_minhash.order_minhash_classes(docs).collect()}
    want, pairs = brute_classes(texts)
    assert 500 < len(pairs) < 260 * 259 / 2 * 0.6  # most pairs of the family are not near
    together = sum(got[i] == got[j] for i, j in pairs)
    assert together >= 0.97 * len(pairs)
    # Nothing is linked that is not: classes are parts of the true ones.
    for i, c in got.items():
        assert want[i] == want[c]


def test_steep_checks_are_few(spark, monkeypatch):
    """In a family without near pairs the checks are a small share of all pairs."""
    rnd = random.Random(12)
    base = [f"w{rnd.randrange(400)}" for _ in range(200)]
    texts = []
    for _ in range(240):
        words = list(base)
        for at in rnd.sample(range(200), 11):
            words[at] = f"x{rnd.randrange(10**9)}"
        texts.append(" ".join(words))
    counted = []
    real = near_duplicates._steep_pairs

    def counting(*args):
        pairs = real(*args)
        counted.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_duplicates, "_steep_pairs", counting)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    got = order_minhash.order_minhash_classes(docs).collect()
    assert len({r.class_id for r in got}) > 230
    assert counted[0] < 0.15 * 240 * 239 / 2


@pytest.mark.parametrize("words, least", [(60, 0.80), (100, 0.88), (200, 0.93), (600, 0.95)])
def test_recall_of_steep_sketches(words, least):
    """Measured share of pairs at a similarity just above 0.8 with a steep key in common."""
    rnd = random.Random(words)
    found = total = 0
    for _ in range(150):
        a = [f"w{rnd.randrange(10**9)}" for _ in range(words)]
        b = list(a)
        n = words - 4
        # Changes far apart cost five 5-mers each: take as many as keep the similarity just above 0.8.
        for k in range(int(n * 0.2 / 1.8 * 1.0 // 5)):
            b[7 + 11 * k % (words - 10)] = f"y{rnd.randrange(10**9)}"
        x, y = order_minhash.kmers([" ".join(a), " ".join(b)])
        if order_minhash.near(x, y):
            total += 1
            found += len(np.intersect1d(order_minhash.steep_sketches(x), order_minhash.steep_sketches(y))) > 0
    assert total > 100 and found >= least * total


def test_private_keys_of_any_length():
    body = "\n".join("key lines, not plain base64: " + "Ab1+/" * 12 for _ in range(5000))
    key = f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    text = f"before {key} between -----BEGIN PRIVATE KEY----- no end here"
    spans = secret_scan.scanner(secret_scan.ALL_RULES)([text])[0]
    kind = [r.kind for r in secret_scan.ALL_RULES].index("private_key")
    assert (7, 7 + len(key), kind) in spans
    assert len(key) > 300_000 and sum(k == kind for *_, k in spans) == 2


def test_all_windows_of_long_texts_teach():
    """The toxic word stands once, in a late window of each of a few very long texts."""
    rnd = random.Random(1)
    plain = [f"p{i}" for i in range(300)]
    texts, toxic = [], []
    for i in range(60):
        words = [rnd.choice(plain) for _ in range(14_000 if i % 6 == 0 else 300)]
        if i % 2 == 0:
            words[-100:-95] = ["vilestuff"] * 5
        texts.append(" ".join(words))
        toxic.append(i % 2 == 0)
    net = toxicity.train(texts, toxic)
    score = toxicity.Scorer(net).scores([" ".join(["vilestuff"] * 5 + plain[:40]), " ".join(plain[:45])])
    assert score[0] > score[1] + 0.3


def test_training_takes_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(i % 4 * 3 + 2, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i * 3 + 2, i % 2) for i in range(4)], "doc_id long, toxic int")
    seen = []
    toxicity_train = toxicity.train
    try:
        toxicity.train = lambda texts, marks: seen.append((texts, marks))
        toxicity.train_on(docs, labels)
    finally:
        toxicity.train = toxicity_train
    used = sum(F_held(i * 3 + 2) for i in range(4))
    assert len(seen[0][0]) == used


def F_held(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 3 != 1


# --- columns -----------------------------------------------------------------------------------

CLASHES = ["mix_ratio", "mix_slot", "mix_block", "toxicity", "toxicity_score", "__digest", "__place", "__id", "__kept", "__file", "__row", "c0", "c3", "digest", "class_id"]


def test_stages_keep_values_of_clashing_columns(spark, tmp_path):
    rows = [(i, f"some words of text {i} " * (1 + i % 5), "en", f"s{i % 3}", 0) for i in range(40)]
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id")) for c in CLASHES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert [r[c] for c in CLASHES] == [f"{c} of {r.doc_id}" for c in CLASHES], name
            assert r.text == rows[r.doc_id][1] and r.source == rows[r.doc_id][3]
    docs.write.parquet(f"{tmp_path}/mixed")
    packed = corpus_pipeline.pack_bins(spark, spark.read.parquet(f"{tmp_path}/mixed"), str(tmp_path)).collect()
    assert sorted({r.doc_id for r in packed}) == list(range(40))


def test_mixing_keeps_other_mix_columns(spark):
    docs = spark.createDataFrame([(i, f"s{i % 2}", i * 0.5) for i in range(10)], "doc_id long, source string, mix_ratio double")
    got = pfair_mix(docs).collect()
    assert sorted((r.doc_id, r.mix_ratio) for r in got) == [(i, i * 0.5) for i in range(10)]


# --- pages -------------------------------------------------------------------------------------


@pytest.mark.parametrize("page, text", [
    ("<div id=content><p>main</p></div><aside><article>teaser</article></aside>", "main"),
    ("<div id=content><p>main</p></div><footer><article>teaser</article></footer>", "main"),
    ("<main><p>intro</p><article><p>story</p></article><p>closing</p></main>", "intro story closing"),
    ("<article><header><h1>Title</h1><p class=lead>lead</p><nav>menu</nav></header><section>part</section></article>", "Title lead part"),
    ("<div id=discussion><p>our findings</p></div><div class='search-engine-article'><p>on engines</p></div>", "our findings on engines"),
    ("<div class='site-header'>name</div><div id='main-menu'>links</div><div class='sidebar-widget'>w</div><p>text</p>", "text"),
    ("<div class='page-with-sidebar'><article><p>story</p></article></div>", "story"),
])
def test_main_part(page, text):
    assert html_text.main_text(page) == text


def plain_subtrees(e):
    """All block subtrees as nested tuples (a brute-force form of the hashes)."""
    def form(x):
        return " ".join(x.split()) if isinstance(x, str) else (x.tag, x.attrs.get("class", ""), x.attrs.get("id", ""), tuple(map(form, x.children)))

    out, todo = set(), [e]
    while todo:
        x = todo.pop()
        if x.tag in html_text.BLOCK and x.tag not in html_text.UNCOUNTED:
            out.add(form(x))
        if x.tag not in html_text.RAW:
            todo += [c for c in x.children if not isinstance(c, str)]
    return out


def test_subtree_counts_by_brute_force(spark):
    rnd = random.Random(8)
    blocks = [f"<div class=k{i}><ul><li>item {i}</li></ul><p>para {i}</p></div>" for i in range(12)]
    rows = []
    for i in range(80):
        own = "".join(rnd.sample(blocks, rnd.randrange(1, 5))) + f"<div><section>only {i}</section></div>"
        rows.append((i, f"http://h{i % 2}.org/{i}", own))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.host: len(set(r.templates)) for r in html_text.site_templates(pages).collect()}
    want = {}
    for host in ("h0.org", "h1.org"):
        own = [r for r in rows if host in r[1]]
        counts = {}
        for r in own:
            for form in plain_subtrees(html_text.parse(r[2])):
                counts[form] = counts.get(form, 0) + 1
        want[host] = sum(n >= html_text.MIN_PAGES and n >= html_text.SHARE * len(own) for n in counts.values())
    assert got == want and min(want.values()) > 5
