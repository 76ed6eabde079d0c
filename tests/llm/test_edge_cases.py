"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reportlake.llm.fingerprints import fingerprint_documents, minhash_classes
from reportlake.llm.html_text import extract_main_text
from reportlake.llm.mixing import pfair_mix
from reportlake.llm.order_minhash import order_minhash_classes
from reportlake.llm.packing import pack_documents
from reportlake.llm.quality_rules import quality
from reportlake.llm.secret_scan import redact_secrets, scan_secrets
from reportlake.llm.sharding import propagate_shards
from reportlake.llm.token_counts import count_tokens
from reportlake.llm.toxicity import score_documents, train_on

LONG = " ".join(f"word{i % 977} and" for i in range(60_000))
ROWS = [
    (1, "plain words here", "en", "a", 16), (None, "a row without an id", "en", None, 19), (3, None, None, "a", None),
    (4, "", "en", "b", 0), (5, " \n\t ", "en", "b", 4), (6, LONG, "en", "a", len(LONG)), (7, "plain words here", "en", "b", 16),
    (7, "plain words here", "en", "b", 16), (8, "Größe \U0001f600 naïve", "de", None, 14), (None, None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, or for results.
CLASHES = ["id", "digest", "uid", "key", "label", "link", "shard", "block", "spans", "toxicity_score", "hash", "range", "slot", "keys", "__nth", "__block"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def operators(spark):
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (6, 0, 0), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    file = public_tokenizers.path("byte_bpe_50k.json")
    return {
        "quality": quality, "secrets": scan_secrets, "redact": redact_secrets, "fingerprints": fingerprint_documents,
        "tokens": lambda d: count_tokens(d, file), "order": order_minhash_classes, "minhash": minhash_classes,
        "toxicity": lambda d: score_documents(d, train_on(d, labels)), "shards": lambda d: propagate_shards(d, 4), "mixing": pfair_mix,
    }


@pytest.mark.parametrize("name", ["quality", "secrets", "redact", "fingerprints", "tokens", "order", "minhash", "toxicity", "shards", "mixing"])
def test_one_row_for_each_row(spark, docs, name):
    op = operators(spark)[name]
    got = op(docs)
    rows = got.collect()
    assert sorted(r.doc_id or -1 for r in rows) == sorted(r[0] or -1 for r in ROWS)
    assert op(docs.limit(0)).collect() == []


def test_packing(spark, docs):
    rows = pack_documents(docs, 4096).collect()
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.piece_bytes
    want = {}
    for i, text, *_ in ROWS:
        want[i] = want.get(i, 0) + len((text or "").encode()) + 1
    assert total == want
    assert pack_documents(docs.limit(0)).collect() == []


def test_pages(spark):
    rows = [(1, "http://h.org/a", "<p>one"), (None, None, "<article>x<p>y</article>"), (3, "no url", None), (3, "no url", ""), (4, "http://h.org", "<" * 5 + "&amp;<b>t</b>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "templates", "text", "id")})
    got = extract_main_text(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got) == [
        (0, "", "x y", 3), (1, "http://h.org/a", "one", 3), (3, "no url", "", 0), (3, "no url", "", 0), (4, "http://h.org", "<<<<<&t", 7)]
    assert extract_main_text(pages.limit(0)).collect() == []


def test_stages_keep_the_columns(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = docs.drop(*CLASHES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, plain, str(tmp_path)).columns == plain.columns, name
        assert stage(spark, plain.limit(0), str(tmp_path)).collect() == [], name
    # three groups of copies: the plain words, the empty texts, and the blank one is like the empty ones in words only
    kept = corpus_pipeline.drop_near_duplicates(spark, plain, str(tmp_path)).collect()
    assert sorted((r.doc_id or -1, (r.text or "")[:5]) for r in kept) == [(-1, ""), (-1, "a row"), (1, "plain"), (5, " \n\t "), (6, "word0"), (8, "Größe")]
