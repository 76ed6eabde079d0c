"""Merkle manifests, filter audits and the quality classifier against plain versions."""

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reportlake.llm import queries, quality_classifier, sql
from reportlake.llm.filter_audit import Diagram, audit_documents, audit_part, plain_changes
from reportlake.llm.merkle import BLOCK, FIELDS, folded, leaf_hash, merkle_manifest, path_hash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def leaf_of(row):
    by_name = dict(zip(["doc_id", "text", "lang", "source", "n_chars"], row))
    values = [None if by_name[f] is None else str(by_name[f]) for f in FIELDS]
    return h("".join("-" if v is None else f"{len(v.encode('utf-8'))}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def beside(levels, at):
    found = []
    for level in levels[:-1]:
        first = at - at % 3
        found.append(("".join(level[first:at]), "".join(level[at + 1:first + 3])))
        at //= 3
    return found


def plain_manifest(rows):
    """(id, leaf, subroot, root, path) of each row, sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    trees = {}
    for s in names:
        leaves = sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r[0]) for r in groups[s]))
        trees[s] = leaves, levels_of([x[2] for x in leaves])
    top = levels_of([trees[s][1][-1][0] for s in names])
    out = []
    for i, s in enumerate(names):
        leaves, levels = trees[s]
        for j, (_, _, leaf, doc_id) in enumerate(leaves):
            out.append((str(doc_id), leaf, levels[-1][0], top[-1][0], tuple(beside(levels, j) + beside(top, i))))
    return sorted(out)


def collected(df):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in df.collect())


def documents(n, seed=3):
    """A hot source of a third and more, copies, nulls, empty texts, repeated rows."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = rnd.choice([None, "", "a copy\nof\nmany", f"text {i} naïve \U0001f600\n", f"{i} " * rnd.randrange(150)])
        rows.append((2 * i, text, rnd.choice(["en", "de", None]), rnd.choice(["hot", "hot", f"s{i % 7}", None, "ß", ""]), len(text or "")))
    return rows + [rows[0]] * 3 + [(None, "no id", "en", "hot", 5), (None, None, None, None, None), (4, "other text of id 4", "", "hot", 18)]


@pytest.mark.parametrize("n", [1, 2, 40, 3 * BLOCK + 100])
def test_manifest_is_the_plain_tree(spark, n):
    rows = documents(n)
    got = merkle_manifest(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert collected(got) == plain_manifest(rows)


def test_manifest_of_one_group_of_exactly_a_block_and_one_more(spark):
    for n in (BLOCK, BLOCK + 1):
        rows = [(i, f"t{i}", "en", "one", 2) for i in range(n)]
        assert collected(merkle_manifest(spark.createDataFrame(rows, SCHEMA))) == plain_manifest(rows)


def test_manifest_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle_manifest(empty).collect() == []
    lone = spark.createDataFrame([(1, "x", "en", "s", 1)], SCHEMA)
    row = merkle_manifest(lone).withColumn("proof", path_hash(F.col("path"))).first()
    assert row.leaf == row.subroot == row.root == leaf_of((1, "x", "en", "s", 1)) and row.path == [] and row.proof == h("")
    names = ["g", "node", "pos", "n", "part", "nth", "uid", "levels", "member", "path", "root", "id", "group"]
    rows = documents(12)
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in names})
    assert collected(merkle_manifest(clash)) == plain_manifest(rows)


def test_a_changed_row_is_told(spark):
    rows = documents(60)
    altered = leaf_hash([F.concat("text", F.lit("!")) if f == "text" else F.col(f) for f in FIELDS])
    got = merkle_manifest(spark.createDataFrame(rows, SCHEMA), carry={"altered": altered})
    got = got.select("leaf", "root", "altered", folded(F.col("leaf"), F.col("path")).alias("same"), folded(F.col("altered"), F.col("path")).alias("other"))
    for r in got.collect():
        assert r.same == r.root and (r.other == r.root) == (r.altered == r.leaf)


def test_long_text_leaf(spark):
    text = "lang ß\n" * 200_000
    row = (5, text, "de", "s", len(text))
    assert merkle_manifest(spark.createDataFrame([row], SCHEMA)).first().leaf == leaf_of(row)


def on_disk(spark, tmp_path, rows, labels):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    return con


def labels_of(rows):
    return [(r[0], i % 2, int(i % 5 == 0)) for i, r in enumerate(rows) if i % 4] + [(None, 1, 1), (0, 1, None), (0, None, 1)]


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_merkle_manifest"])
def test_sql_of_hard_rows(spark, tmp_path, name):
    rows = documents(90)
    con = on_disk(spark, tmp_path, rows, labels_of(rows))
    df = queries.QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))


def test_query_tampers_even_ids_only(spark, tmp_path):
    rows = documents(40)
    on_disk(spark, tmp_path, rows, [])
    for r in queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect():
        lines = any(x[0] == r.doc_id and "\n" in (x[1] or "") for x in rows)
        even = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        assert r.verified == (r.folded_root == r.root) and (r.verified or (even and lines))
    assert queries.SQL["op13_merkle_manifest"] == sql.MERKLE


# --- audits ------------------------------------------------------------------------------------


def plain_audit(n, counts):
    """As ``audit_part``: every order by itself, over the masks."""
    width = len(next(iter(counts.values())))

    def total(keep):
        return tuple(sum(c[i] for m, c in counts.items() if keep(m)) for i in range(width))

    removed = {}
    out = []
    for order in itertools.permutations(range(n)):
        for s, v in enumerate(order):
            before = sum(1 << x for x in order[:s])
            removed[order, v] = total(lambda m: m >> v & 1 and not m & before)
    for order in itertools.permutations(range(n)):
        for s, v in enumerate(order):
            before = sum(1 << x for x in order[:s + 1])
            gone = removed[order, v]
            fails = total(lambda m: m >> v & 1)
            out.append((order, s + 1, total(lambda m: not m & before), gone, tuple(a - b for a, b in zip(fails, gone)),
                        total(lambda m: m == 1 << v), sum(x[0] for (_, w), x in removed.items() if w == v)))
    return sorted(out)


def test_audit_of_masks():
    rnd = random.Random(4)
    for n in (1, 2, 3, 5):
        for filled in (0.2, 1.0):
            counts = {m: (rnd.randrange(50), rnd.randrange(9)) for m in range(1 << n) if rnd.random() <= filled} or {0: (1, 0)}
            assert sorted(audit_part(n, counts, 2)) == plain_audit(n, counts)


def test_plain_changes_visit_all_orders():
    for n in range(1, 7):
        order = list(range(n))
        seen = {tuple(order)}
        for k in plain_changes(n):
            order[k], order[k + 1] = order[k + 1], order[k]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert len(seen) == len(set(itertools.permutations(range(n))))


def test_equal_subdiagrams_are_one_node():
    d = Diagram(5, {m: (3,) for m in range(32)}, 1)
    assert [len(x) for x in d.levels] == [1] * 5 and len(d.leaves) == 1
    d.swap(2)
    assert [len(x) for x in d.levels] == [1] * 5 and d.passed()[0] == (96,)


def test_audit_documents(spark):
    rows = documents(80)
    lab = labels_of(rows)
    good, bad = {x[0] for x in lab if x[0] is not None and x[1] == 1}, {x[0] for x in lab if x[0] is not None and x[2] == 1}
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", r[0]), r[0])
    counts = {}
    for r in rows:
        t = r[1] or ""
        w = t.split()
        fails = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 any(c in "#$%&*|" for c in t), r[0] is not None and least[t] < r[0]]
        c = counts.setdefault(r[2] or "", {}).setdefault(sum(f << k for k, f in enumerate(fails)), [0, 0, 0])
        for i, x in enumerate((True, r[0] in good, r[0] in bad)):
            c[i] += x
    want = []
    for part, masks in counts.items():
        for order, step, kept, gone, redundant, only, total in plain_audit(5, {m: tuple(c) for m, c in masks.items()}):
            want.append((part, "".join("ABCDE"[v] for v in order), step, kept[0], gone[0], redundant[0], only[0], gone[1], gone[2], total))
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ["id", "part", "mask", "m0", "digest", "first", "A", "E", "good"]})
    labels = spark.createDataFrame(lab, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1))
    assert sorted(map(tuple, audit_documents(docs, labels).collect())) == sorted(want)
    assert audit_documents(docs.limit(0), labels).collect() == []


# --- quality -----------------------------------------------------------------------------------


def test_features_of_a_batch_are_those_of_each_text():
    texts = ["", " \n ", "one", "Plain words, in order.\nAnd more of them.", "LOUD!! LOUD!! LOUD!!\n" * 30, "a | b | c " * 50, "ß é \U0001f600 12"]
    whole = quality_classifier.features(texts)
    assert np.isfinite(whole).all() and whole.shape == (len(texts), quality_classifier.FEATURES)
    for t, row in zip(texts, whole):
        np.testing.assert_allclose(quality_classifier.features([t])[0], row, rtol=1e-5, atol=1e-6)


@pytest.mark.parametrize("push,loss", [
    (quality_classifier.logistic_push, lambda z, g, prior: np.logaddexp(0, -z[g]).mean() / 2 + np.logaddexp(0, z[~g]).mean() / 2),
    (quality_classifier.unbiased_push, lambda z, g, prior: prior * (1 - s(z[g])).mean() + s(z[~g]).mean() - prior * s(z[g]).mean()),
])
def test_slopes_are_those_of_the_risk(push, loss):
    r = np.random.default_rng(1)
    z, g = np.concatenate((r.normal(1, 1, 30) - 3, r.normal(0, 1, 50) + 1)), np.arange(80) < 30  # risk on bad texts above zero
    got = push(z, g, 0.4)
    for i in range(80):
        up, down = z.copy(), z.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert abs((loss(up, g, 0.4) - loss(down, g, 0.4)) / 2e-5 - got[i]) < 1e-7


def s(z):
    return 1 / (1 + np.exp(-z))


def test_negative_risk_is_stepped_back():
    z, g = np.concatenate((np.full(10, 3.0), np.full(10, -3.0))), np.arange(20) < 10
    assert s(z[~g]).mean() - 0.5 * s(z[g]).mean() < 0
    push = quality_classifier.unbiased_push(z, g, 0.5)
    assert (push[g] > 0).all() and (push[~g] < 0).all()  # raises that part of the risk


def test_network_gradients():
    r = np.random.default_rng(2)
    x = r.standard_normal((12, 6))
    net = quality_classifier.Network.fresh(x, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    push = r.standard_normal(12)
    grads = net.gradients(x, push)
    for k, v in net.p.items():
        for i in np.ndindex(v.shape):
            def total(d):
                p = {**net.p, k: v.copy()}
                p[k][i] += d
                return (push * (np.tanh(x @ p["w"] + p["b"]) @ p["o"] + p["c"][0])).sum()
            assert abs((total(1e-6) - total(-1e-6)) / 2e-6 - grads[k][i]) < 1e-6


def test_class_prior_of_known_mixtures():
    r = np.random.default_rng(5)
    for prior in (0.2, 0.6, 0.9):
        n = 20_000
        good = r.beta(6, 2, n)
        rest = np.concatenate((r.beta(6, 2, int(prior * n)), r.beta(2, 6, n - int(prior * n))))
        counts = [np.histogram(x, bins=quality_classifier.BINS, range=(0, 1))[0] for x in (good, rest)]
        assert abs(quality_classifier.class_prior(*counts) - prior) < 0.06


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    # Bad labels teach nothing: without them the result is the same but for their texts counting as unlabelled.
    got = quality_classifier.quality_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert len(got) > 50
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.97
    assert sum(r.predicted == 0 for r in got if r.quality == 0) / sum(r.quality == 0 for r in got) > 0.9


def test_quality_edges(spark):
    rows = documents(60)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ["id", "digest", "features", "good", "h", "fold", "score", "held_out"]})
    labels = spark.createDataFrame(labels_of(rows), "doc_id long, quality int, toxic int").withColumn("id", F.lit(1))
    got = quality_classifier.quality_scores(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    by_text = {}
    text_of = {}
    for r in rows:
        text_of.setdefault(r[0], set()).add(r[1] or "")
    for r in got:
        if len(text_of[r.doc_id]) == 1:
            by_text.setdefault(next(iter(text_of[r.doc_id])), set()).add(round(r.score, 12))
    assert all(len(v) == 1 for v in by_text.values())
    assert quality_classifier.quality_scores(docs.limit(0), labels).collect() == []
    none = quality_classifier.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and len(none) == len(rows)
