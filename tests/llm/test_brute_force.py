"""Every operator against a plain version on a small fixture."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from reportlake.llm import html_text, near_duplicates, order_minhash, packing, quality_rules, secret_scan, toxicity
from reportlake.llm.fingerprints import fingerprint_documents, minhash_classes
from reportlake.llm.mixing import in_mixed_order, period_schedule, pfair_mix
from reportlake.llm.queries import op2_secret_scan
from reportlake.llm.sharding import propagate_shards
from reportlake.llm.token_counts import PieceCounter, safe_pieces, safe_segments

WORDS = [f"{a}{b}" for a in "ba re ti no su la".split() for b in "mi do ka pe".split()]


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))


def corpus(seed=5, n=120):
    """(doc_id, text, lang, source, n_chars): a hot source, copies, near copies, short texts."""
    rnd = random.Random(seed)
    texts = [sentence(rnd, rnd.choice([2, 30, 60, 150])) for _ in range(n)]
    for i in range(0, n, 6):
        texts[i] = texts[(i + 7) % n]
    for i in range(3, n, 10):
        words = texts[1].split() * 3
        words[rnd.randrange(len(words))] = "changed"
        texts[i] = " ".join(words)
    return [(3 * i, t, "en", "hot" if i % 3 else f"s{i % 4}", len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


def shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def set_alike(x, y):
    return jaccard(shingles(x), shingles(y)) >= 0.8


def order_alike(x, y):
    a, b = ([tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] for w in (x.split(), y.split()))
    shared = (collections.Counter(a) & collections.Counter(b)).total()
    if shared < 0.8 * (len(a) + len(b) - shared):
        return False
    n = common_subsequence(a, b)
    return n >= 0.8 * (len(a) + len(b) - n)


def classes_of(rows, alike):
    parent = {r[0]: r[0] for r in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a, *_) in enumerate(rows):
        for j, b, *_ in rows[:k]:
            if alike(a, b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i in parent}


@pytest.mark.parametrize("classes, alike", [(order_minhash.order_minhash_classes, order_alike), (minhash_classes, set_alike)])
def test_near_duplicate_classes(docs, rows, classes, alike):
    got = classes(docs).collect()
    want = classes_of(rows, alike)
    assert {r.doc_id: r.class_id for r in got} == want
    assert {r.doc_id for r in got if r.is_kept} == set(want.values())


def common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_banded_alignment():
    rnd = random.Random(2)
    for _ in range(1500):
        a = [rnd.randrange(7) for _ in range(rnd.randrange(1, 28))]
        b = list(a)
        for _ in range(rnd.randrange(6)):
            b.insert(rnd.randrange(len(b) + 1), rnd.randrange(7)) if rnd.random() < 0.5 or not b else b.pop(rnd.randrange(len(b)))
        if b:
            n = common_subsequence(a, b)
            assert order_minhash.aligned(a, b, 40) == n
            assert order_minhash.similarity_at_least(a, b) == (n / (len(a) + len(b) - n) >= 0.8)


def test_sketches_follow_order():
    rnd = random.Random(3)
    words = [str(rnd.random()) for _ in range(80)]
    text, turned = " ".join(words), " ".join(words[40:] + words[:40])
    a, b, c = order_minhash.sign([text, turned, text])
    assert (a == c).all() and (a == b).mean() < 0.3
    assert not order_minhash.near(*order_minhash.kmers([text, turned]))


def test_base_columns_and_verdict(docs, rows, spark):
    junk = [(1001, "same line of words\n" * 30), (1002, "a | b | c | d ### " * 9), (1003, "SHOUT LOUD WORDS " + " ".join(f"WORD{i}" for i in range(40)))]
    more = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in junk], docs.schema)
    got = {r.doc_id: r for r in quality_rules.quality(docs.unionByName(more)).collect()}
    assert not any(got[i].kept for i, _ in junk)
    for i, t in [(r[0], r[1]) for r in rows] + junk:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = collections.Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
        covered = {j for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in t.split("\n") if x.strip()]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_cascade_order_and_short_circuit():
    seen = collections.Counter()

    def rule(name, hit):
        def rejects(batch):
            seen[name] += len(batch)
            return np.array([hit in t for t in batch.texts], bool)
        return quality_rules.QualityRule(name, rejects)

    rules = [rule("dear", "a"), rule("cheap", "b"), rule("never", "z")]
    plan = quality_rules.order_rules(rules, [1.0, 0.1, 0.01], np.array([[1, 1, 0, 0], [1, 0, 1, 0], [0, 0, 0, 0]], bool))
    assert [p.rule.name for p in plan] == ["cheap", "dear", "never"]
    alive = quality_rules.run_cascade(quality_rules.TextBatch(["ab", "a", "b", "c"]), plan, np.ones(4, bool))
    assert alive.tolist() == [False, False, False, True] and dict(seen) == {"cheap": 4, "dear": 2, "never": 1}


SECRET_TEXTS = [
    'Password = "abc123def" and API_KEY:zz', "apikey='0123456789abcdef0123456789abcdef'", "AKIA" + "Q7" * 9 + " AKIAshort", "secret:=x token: 1234567",
    "é\U0001f600 " + "deadbeef" * 4, "passwd=" + "f" * 30, "ſecret=abcdefgh toKen=abcdefgh", "nothing here", "ghp_" + "a1" * 20, "-----BEGIN RSA PRIVATE KEY-----"]


def base_spans(t):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [("assign", *m.span()) for m in assign.finditer(t) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_secrets(spark, tmp_path):
    rnd = random.Random(4)
    texts = SECRET_TEXTS + ["".join(rnd.choice(SECRET_TEXTS)[rnd.randrange(9):] for _ in range(4)) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for r in op2_secret_scan(spark, str(tmp_path)).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in want) for k in ("assign", "access", "hex")]
        found = [(m.start(), m.end(), x.kind) for x in secret_scan.ALL_RULES for m in re.finditer(x.pattern, texts[r.doc_id])
                 if len(m[x.group]) >= x.min_chars]
        assert sorted(s for s in r.spans.split(",") if s) == sorted(f"{k}:{a}:{b}" for a, b, k in found)
    clean = {r.doc_id: r.text for r in corpus_pipeline.redact(spark, docs, "").collect()}
    assert clean[7] == texts[7] and clean[9] == "[SECRET]" and not any(base_spans(t) for t in clean.values())


@pytest.mark.parametrize("end", ["\n-----END RSA PRIVATE KEY-----", ""])
@pytest.mark.parametrize("head", ["", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B2C\n\n"])
def test_redacted_keys_leave_no_lines(spark, end, head):
    rnd = random.Random(1)
    lines = ["".join(rnd.choice("ABCDxyz0123+/") for _ in range(n)) for n in (64, 64, 64, 30)] + ["Ab0+=="]
    key = "-----BEGIN RSA PRIVATE KEY-----\n" + head + "\n".join(lines) + end
    texts = [f"before\n{key}\nNot a part of it.\n{key}\nafter that", "a=" + key.replace("\n", "\\n") + '"; rest of it',
             "-----BEGIN PRIVATE KEY----- is a line\nof it"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = [r.text for r in secret_scan.redact_secrets(docs).orderBy("doc_id").collect()]
    assert not any(line in t for t in clean for line in lines)
    assert clean == ["before\n[SECRET]\nNot a part of it.\n[SECRET]\nafter that", 'a=[SECRET]"; rest of it', "[SECRET] is a line\nof it"]


def test_trigram_queries_are_necessary():
    assert secret_scan.trigram_query("[0-9a-f]{24,}") is True
    assert secret_scan.trigrams_of(secret_scan.trigram_query("AKIA[A-Z0-9]+")) == {b"aki", b"kia"}
    for rule in secret_scan.ALL_RULES:
        hits = [t for t in SECRET_TEXTS if re.search(rule.pattern, t)]
        index = secret_scan.SegmentIndex(sorted(secret_scan.trigrams_of(secret_scan.trigram_query(rule.pattern))))
        index.build(SECRET_TEXTS)
        assert set(map(SECRET_TEXTS.index, hits)) <= set(index.candidates(secret_scan.trigram_query(rule.pattern)).tolist())


def test_fingerprints(docs, rows):
    rows = sorted(rows)
    got = {r.doc_id: r for r in fingerprint_documents(docs).collect()}
    for k, (i, t, *_) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(t) // 2
        changed = t[:len(t) - n] + following[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert abs(r.near_edited - jaccard(shingles(t), shingles(changed))) < 0.2
        assert abs(r.near_next - jaccard(shingles(t), shingles(following))) < 0.2
    by_text = collections.defaultdict(set)
    for i, t, *_ in rows:
        by_text[t].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_token_counts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    rnd = random.Random(6)
    parts = ["word", " ", "  ", "\n", "\t", "’s", "'s", "don't", " 12", "é", " ", " ", "\x1c", "<|endoftext|>", " <|endoftext|>", "日本", "!!", "\U0001f600"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(3000)] + ["", " ", "a" * 5000]
    file = public_tokenizers.path("byte_bpe_50k.json")
    whole = [len(e) for e in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]
    assert PieceCounter(file).count(pa.array(texts)).tolist() == whole
    counter = PieceCounter(file)
    for t, n in zip(texts, whole):
        assert "".join(safe_pieces(t)) == t
        cut = safe_segments(t, 7)
        assert "".join(cut) == t and counter.count(pa.array(cut)).sum() == n


def test_shards(spark, docs, rows):
    for d, n in ((docs, 7), (docs.limit(5), 7), (docs.unionByName(docs).unionByName(docs), 4)):
        got = d.select("doc_id", "text").collect()
        out = propagate_shards(d, n).collect()
        by = collections.Counter(r.shard for r in out)
        counts = [by.get(s, 0) for s in range(n)]
        assert sum(counts) == len(got) and max(counts) - min(counts) <= 1
        for s in range(n):
            assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
        text = dict(got)
        assert all((r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 16, zlib.crc32(text[r.doc_id].encode())) for r in out)
    out = {r.doc_id: r.shard for r in propagate_shards(docs, 7).collect()}
    groups = collections.defaultdict(set)
    for i, t, *_ in rows:
        groups[t].add(out[i])
    assert sum(len(v) - 1 for v in groups.values()) <= 1  # 120 documents, shards of 17: copies stay together


def plain_edf(weights):
    """Slot by slot: the released block with the earliest deadline."""
    total, out, done = sum(weights), [], [0] * len(weights)
    for t in range(total):
        ready = [(-(-(done[i] + 1) * total // a), i) for i, a in enumerate(weights) if done[i] < a and done[i] * total // a <= t]
        i = min(ready)[1]
        done[i] += 1
        out.append(i)
    return out


def test_schedule_is_pfair(spark):
    weights = [("a", 5.0), ("b", 3.0), ("c", 1.0), ("d", 0.0), (None, 2.5)]
    rows = period_schedule(spark.createDataFrame(weights, "source string, weight double"), 60).collect()
    order = sorted({(r.source is not None, r.source or "", r.a) for r in rows})
    slots = [r.source for r in sorted(rows, key=lambda r: r.slot)]
    assert slots == [[o[1] or None for o in order][i] for i in plain_edf([o[2] for o in order])]
    period = len(slots)
    for r in rows:
        assert r.release <= r.slot < r.deadline
        for t in range(period + 1):
            assert abs(slots[:t].count(r.source) - t * r.a / period) < 1


def test_mixing(docs, rows):
    out = pfair_mix(docs, block_docs=4, grain=50).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(r[0] for r in rows)
    blocks = {}
    for r in out:
        blocks.setdefault((r.source, r.mix_block), set()).add(r.mix_slot)
        assert r.mix_release <= r.mix_slot < r.mix_deadline
    assert all(len(s) == 1 for s in blocks.values()) and len({min(s) for s in blocks.values()}) == len(blocks)
    ordered = in_mixed_order(pfair_mix(docs, block_docs=4, grain=50)).select("mix_slot", "mix_place").collect()
    assert [tuple(r) for r in ordered] == sorted(tuple(r) for r in ordered)


def plain_pack(sizes, sources, clusters, capacity):
    often, bins, out = collections.Counter(clusters), [], []
    for d in sorted(range(len(sizes)), key=lambda d: (-(sizes[d] % capacity), d)):
        rest = sizes[d] % capacity
        if rest:
            fit = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= rest and sources[d] not in b["s"]
                   and not (often[clusters[d]] > 1 and clusters[d] in b["c"])]
            k = min(fit)[1] if fit else len(bins)
            if not fit:
                bins.append({"left": capacity, "s": set(), "c": set()})
            bins[k]["left"] -= rest
            bins[k]["s"].add(sources[d])
            bins[k]["c"].add(clusters[d])
            out.append((d, k))
    return out


def test_best_fit():
    rnd = random.Random(8)
    for n in (1, 20, 300):
        sizes = [rnd.randrange(1, 260) for _ in range(n)]
        sources = [rnd.choice(["hot", "hot", "b", "c", "d", None]) for _ in range(n)]
        clusters = [rnd.randrange(n) for _ in range(n)]
        got = packing.pack(sizes, sources, clusters, 100)
        full = sum(s // 100 for s in sizes)
        assert [(d, b - full) for d, k, a, size, b, at in got if size < 100] == plain_pack(sizes, sources, clusters, 100)
        for d, size in enumerate(sizes):
            pieces = sorted((a, z) for x, _, a, z, _, _ in got if x == d)
            assert [a for a, _ in pieces] == list(range(0, size, 100)) and sum(z for _, z in pieces) == size


def test_html():
    page = ('<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/x">menu</a></li></ul></nav>'
            '<div class="cookie-notice">We use cookies</div><div class="box"><p>Our shop</p></div><article><h1>Head &amp; tail</h1>'
            '<p>One <b>two\n three</b>&nbsp;four<br>five<p>un<i>broken</i> &lt;x&gt; &#x41;<div class="share">Share</div><form><input>go</form>'
            '<section class="comments"><p>me too</p></section></article><aside>side</aside><footer>&copy; 1</footer>')
    assert html_text.main_text(page) == "Head & tail One two three four five unbroken <x> A"
    plain = "<body><div id=top>Site name</div><div><p>Text one</p>\n<p>two</p></div><div class=x>Imprint</div></body>"
    assert html_text.main_text(plain) == "Site name Text one two Imprint"


def test_article_text_is_not_dropped_by_loose_words():
    page = ('<body><article id="reply-to-critics"><h1>Title</h1><section id="discussion"><p>One</p></section><h2 id="related-work">Two</h2>'
            '<h2 id="search">Three</h2><p class="alert">Four</p><div class="widget">Five</div><div id="reply-to-critics">Six</div>'
            '<div class="search-trees">Seven</div><div class="ad">Buy</div><p class="big ad">Buy</p><div class="share">Share</div>'
            '<section class="comments">me too</section></article><article id="comment-7">no</article><article class="comment">no</article></body>')
    assert html_text.main_text(page) == "Title One Two Three Four Five Six Seven"


def test_site_templates(spark):
    def page(i):
        return f"<body><div id=top>Site name</div><div><p>Text {i}</p><p>two {i}</p></div><div class=x>Imprint</div></body>"

    rows = [(i, f"http://{'Big' if i < 12 else 'small'}.org:80/{i}", page(i)) for i in range(14)]
    out = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {
        i: f"Text {i} two {i}" if i < 12 else f"Site name Text {i} two {i} Imprint" for i in range(14)}


def test_gradients():
    net, r = toxicity.Network(1), np.random.default_rng(0)
    x = r.standard_normal((6, toxicity.INPUT)).astype(np.float32)
    at = r.integers(0, 7, (5, 9))
    at[:, 0] = 1
    mask, target, weight = (at < 6).astype(np.float32), np.array([1, 0, 1, 0, 0], np.float32), np.ones(5, np.float32)
    grads, dx, _ = net.gradients(x, at, mask, target, weight)
    for name, g in [*grads.items(), ("x", dx)]:
        for _ in range(4):
            table = x if name == "x" else net.p[name]
            i = tuple(int(r.integers(n)) for n in table.shape)
            old, losses = table[i], []
            for step in (1e-2, -1e-2):
                table[i] = old + step
                losses.append(net.gradients(x, at, mask, target, weight)[2])
            table[i] = old
            assert abs((losses[0] - losses[1]) / 2e-2 - g[i]) < 2e-3 + 0.05 * abs(g[i]), name


def test_toxic_words_are_learned():
    rnd = random.Random(9)

    def text(bad):
        words = sentence(rnd, rnd.choice([20, 90, 300])).split()
        for _ in range(3 if bad else 0):
            words[rnd.randrange(len(words))] = rnd.choice(["vilemoron", "vilescum", "vilerat"]) + rnd.choice(["", "s", "ly"])
        return " ".join(words)

    made = [(text(i % 4 == 0), i % 4 == 0) for i in range(700)]
    net = toxicity.train([t for t, _ in made[:500]], [y for _, y in made[:500]])
    got = toxicity.Scorer(net).scores([t for t, _ in made[500:]]) >= toxicity.THRESHOLD
    want = np.array([y for _, y in made[500:]])
    assert got[want].mean() > 0.9 and got[~want].mean() < 0.02
    assert toxicity.Scorer(net).scores(["", "..."]).tolist() == [0, 0]
    assert toxicity.train(["a", "b"], [False, False]) is None


@pytest.mark.parametrize("n, want", [(0, [0]), (64, [0]), (65, [0, 1]), (200, [0, 52, 104, 136])])
def test_windows_cover_the_text(n, want):
    assert toxicity.window_starts(n) == want


def test_classes_joined_by_two_members_that_lead_none(spark, monkeypatch):
    """1 ~ 3, 2 ~ 4 and 3 ~ 4 only: the classes of 1 and 2 meet by their second members."""
    texts = {uid: " ".join(f"w{i}" for i in range(at, at + 104)) for uid, at in [(1, 0), (3, 10), (4, 20), (2, 30)]}
    plain = spark.createDataFrame([(u, bytes([u]), t) for u, t in texts.items()], "id long, digest binary, text string")
    once = spark.createDataFrame([(u, bytes([u]), [7]) for u in texts], "uid long, digest binary, keys array<long>")
    members = spark.createDataFrame([(7, u, 1) for u in texts], "key long, uid long, lo long")
    monkeypatch.setattr(near_duplicates, "_rare_items", lambda items: items.selectExpr("7L AS key", "uid"))
    links, label = near_duplicates._settled(members, once, plain, order_minhash.kmers, order_minhash.near, 1)
    assert {(max(r), min(r)) for r in links.collect()} == {(3, 1), (4, 2), (4, 3)}
    assert {(r.uid, r.label) for r in label.collect()} == {(1, 1), (2, 1), (3, 1), (4, 1)}


def test_near_copies_of_short_texts_are_candidates():
    """Any two near texts of up to 64 5-mers share the keys that a candidate pair needs."""
    rnd = random.Random(3)
    near = 0
    for n in [5, 6, 9, 10, 12, 15, 20, 30, 45, 55, 60] * 6:
        a = sentence(rnd, n).split()
        at = rnd.randrange(n + 1)
        for b in (a[:at] + ["new"] + a[at:], a + ["new"], a[1:], a[:at] + a[at + 1:], a[:-1] + ["new"], a + a[-1:]):
            x, y = order_minhash.kmers([" ".join(a), " ".join(b)])
            if order_minhash.near(x, y):
                near += 1
                p, q = order_minhash.sign([" ".join(a), " ".join(b)])
                assert len(set(p.tolist()) & set(q.tolist())) >= order_minhash.SHARED
    assert near > 100


def test_bins_follow_the_mixture(spark, tmp_path, monkeypatch):
    """Runs of 2000 documents of the mixture are packed one after another; without the mixing stage bins differ."""
    docs = spark.range(5000).selectExpr(
        "id AS doc_id", "concat('text ', id) AS text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    packing_alone = corpus_pipeline.STAGES[-1:]

    def rows_of(stages):
        monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
        return sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))

    mixed = rows_of(corpus_pipeline.STAGES[-2:])
    assert rows_of(packing_alone) != mixed
    order = [r.doc_id for r in pfair_mix(docs).orderBy("mix_slot", "mix_place").collect()]
    assert {r[0]: r[5] >> 32 for r in mixed} == {d: i // 2000 for i, d in enumerate(order)}
