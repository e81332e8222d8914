"""Operators 11 to 13 against plain statements of their rules, and their SQL."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import merkle, mixing, queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, target string, mix_plan string, own string, rank string, at string, e string"
EXTRA = ("x",) * 7


def documents(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


@pytest.mark.parametrize("name", ["op9_token_counts", "op12_source_mixing", "op13_merkle_manifest"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(queries.oracle_sql()[name])
    at = [[d[0] for d in want.description].index(c) for c in cols]
    assert sorted(tuple(map(str, r)) for r in df.select(*cols).collect()) == sorted(tuple(str(r[i]) for i in at) for r in want.fetchall())


# Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(r):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], r[1])))


def plain_tree(hashes):
    """The root of hashes and, for each, what stands before and after it on every level."""
    paths, at, nodes = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // 3 * 3 : a // 3 * 3 + 3]
            paths[i].append(("".join(run[: a % 3]), "".join(run[a % 3 + 1 :])))
            at[i] = a // 3
        nodes = [digest("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows):
    first = lambda v: (v is not None, v if v is not None else 0)
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((first(r[0]), plain_leaf(r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda x: x[:2])
        trees[s] = plain_tree([x[1] for x in by[s]])
    root, tops = plain_tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for (_, leaf, r), path in zip(by[s], trees[s][1]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = plain_leaf((r[0], r[1].replace("\n", "") if r[1] is not None and hit else r[1], *r[2:]))
            folded = now
            for before, after in path + top:
                folded = digest(before + folded + after)
            out.append((r[0], leaf, trees[s][0], root, digest("".join(b + a for b, a in path + top)), folded, folded == root))
    return out


def test_manifest_against_a_plain_tree(spark):
    """Sources of one to more than a block's square of leaves, null and empty fields, repeated rows and ids, a very long text."""
    rng = np.random.default_rng(3)
    rows = [(i, f"text {i}\nmore", "en", "many", i) for i in rng.permutation(merkle.BLOCK * 4 + 2).tolist()]
    rows += [(i, None if i % 3 else "", None, s, None) for s, n in (("one", 1), ("é", 2), ("Z", 3), ("four", 4), ("", 9), (None, 28), ("block", merkle.BLOCK), ("over", merkle.BLOCK + 1)) for i in range(n)]
    rows += [(7, "same\n", "en", "one", 3)] * 5 + [(None, "a\nb", "de", None, 3), (None, None, None, None, None), (12, "x\n" * 300_000, "en", "four", 9)]
    told = merkle.manifest(documents(spark, rows).repartition(5), now=merkle.without_newlines())
    got = merkle.verified(told, "now").select("doc_id", "leaf", "subroot", "root", merkle.sha256(merkle.proof(F.col("path"))), "folded_root", "verified").collect()
    assert Counter(map(tuple, got)) == Counter(plain_manifest(rows))
    assert {r.verified for r in got} == {True, False}


def test_a_block_keeps_each_preimage_once(spark, monkeypatch):
    """A stored block is as wide as its leaves and their parents; with a path for each leaf, of some 270 KB, tasks ran out of memory."""
    kept, write = {}, merkle.materialize
    monkeypatch.setattr(merkle, "materialize", lambda df, label, *more: kept.setdefault(label, write(df, label, *more)))
    rows = [(i, f"text {i}", "en", "many", i) for i in range(merkle.BLOCK)]
    assert merkle.manifest(documents(spark, rows)).count() == merkle.BLOCK
    assert kept["merkle-blocks"].select(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] < 100_000


def test_manifest_does_not_depend_on_partitions_and_takes_an_empty_table(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 5}", i) for i in range(600)]
    both = [sorted(map(str, merkle.manifest(documents(spark, rows).repartition(n)).collect())) for n in (1, 7)]
    assert both[0] == both[1]
    assert merkle.manifest(documents(spark, []), now=merkle.leaf()).collect() == []
    assert len(merkle.manifest(documents(spark, rows[:1])).first().path) == 0


# Mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Shares by weight; what passes a bound is shared again until none does."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    held, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in held]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not over:
            return held | {s: weight[s] * level for s in open_}
        for s in over:
            held[s] = most * sizes[s]
            left -= held[s]


@pytest.mark.parametrize("share", [0.3, 1.5, 2])
def test_targets_against_plain_sharing(spark, share):
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(0, 30)), "en", s, 1) for i, s in enumerate(rng.choice(["a", "b", "é", "z", "Z", "long", "", "q"], 500, p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.05, 0.04, 0.01]).tolist())] + [(900, "one", "en", None, 1), (901, "", "en", "void", 0), (902, None, "en", "void", 0)]
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = plain_targets(sizes, share=share)
    got = {r.source: r for r in mixing.source_targets(documents(spark, rows), share=share).collect()}
    assert set(got) == set(want) and all(math.isclose(got[s].target, want[s], abs_tol=1e-6) and got[s].source_size == sizes[s] for s in want)
    with pytest.raises(ValueError):
        mixing.source_targets(documents(spark, rows), share=2.1)


def test_mix_comes_near_its_targets_in_every_run(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "word " * int(n), "en", s, 1) for i, (n, s) in enumerate(zip(rng.integers(1, 60, 6000), rng.choice(["hot", "a", "b", "c"], 6000, p=[0.7, 0.1, 0.1, 0.1]).tolist()))]
    docs = documents(spark, rows)
    plan = mixing.planned(docs).select("doc_id", "source", "mix.*").collect()
    taken = Counter()
    for r in plan:
        assert r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) and r.copies <= 2
        taken[r.source] += r.size * r.copies
    assert all(abs(taken[r.source] / r.target - 1) < 0.08 for r in plan)
    out = mixing.mix(docs.repartition(9))
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({r.doc_id: r.copies for r in plan if r.copies})


def test_mix_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "a", 0), (2, "x" * 500_000, "en", "a", 1), (2, "x" * 500_000, "en", "a", 1), (3, "y " * 200_000, "de", "b", 1)]
    got = mixing.planned(documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert {(r.doc_id, r.mix.size) for r in got} == {(None, 0), (1, 0), (2, 1), (3, 200_000)}
    assert len({r.mix.copies for r in got if r.doc_id == 2}) == 1 and all(r.mix.copies == 0 for r in got if r.source is None)
    assert mixing.planned(documents(spark, [])).collect() == [] and mixing.mix(documents(spark, [])).collect() == []


# Whitening


def plain_white(vectors, components=32):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    e, v = np.linalg.eigh(np.cov((x - s / n).T, bias=True))
    order = np.argsort(-e)[:components]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ v[:, order] / np.sqrt(e[order]), e[order] / e.sum()


@pytest.mark.parametrize("parts", [1, 20])
def test_whitening_against_a_plain_decomposition(spark, parts):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(700, 40)) * np.geomspace(40, 0.05, 40) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]).astype(np.float32)
    vectors[:200] = vectors[0]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    odd = [(-1, None, "x"), (-2, [1.0] * 39 + [None], "x"), (-3, [1.0] * 39 + [math.nan], "x"), (-4, [1.0] * 39 + [-math.inf], "x"), (-5, [], "x"), (-6, [1.0], "x")]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, n string").repartition(parts)
    got = {r.vec_id: r for r in whitening.whiten(table).collect()}
    n, deviation, white, explained = plain_white(vectors)
    assert set(got) == set(range(700)) and {r.n for r in got.values()} == {n}
    assert [got[i].deviation for i in range(700)] == deviation.tolist()
    ours = np.array([got[i].whitened for i in range(700)])
    assert np.abs(np.abs((ours * white).mean(axis=0)) - 1).max() < 1e-6 and np.abs(ours * np.sign((ours * white).mean(axis=0)) - white).max() < 1e-5
    assert np.abs(np.array(got[0].explained) / explained - 1).max() < 1e-8
    error = np.abs(np.cov(ours.T, bias=True) - np.eye(32)).max()
    assert {r.identity_error for r in got.values()} == {got[0].identity_error} and got[0].identity_error < 1e-9 and error < 1e-9


def test_states_merge_without_loss():
    rng = np.random.default_rng(9)
    x = rng.integers(-500, 500, (300, 12)) + 1_000_000
    x[:, 3] = 5
    whole, parts = whitening.State.of(x), None
    for at in (0, 1, 4, 90, 300):
        own = x[at : {0: 1, 1: 4, 4: 90, 90: 300}.get(at, at)]
        if len(own):
            parts = whitening.State.of(own) if parts is None else parts.merged(whitening.State.of(own))
    assert parts.sums == whole.sums and parts.n == whole.n
    assert np.allclose(parts.singular[:11], whole.singular[:11], rtol=1e-12) and parts.singular[11] < 1e-9
    covariance = (parts.vectors.T * parts.singular**2) @ parts.vectors
    assert np.allclose(covariance, (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), rtol=1e-9, atol=1e-4)


def test_whitening_of_few_equal_and_huge_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [4.0, 2.0, 3.0]), (None, [1.0, 5.0, 3.0]), (4, [1e300, 1.0, 1.0])], schema)
    got = {r.vec_id: r for r in whitening.whiten(few).collect()}
    assert set(got) == {1, 2, None} and all(len(r.whitened) == 2 and r.identity_error < 1e-9 for r in got.values())
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened) for r in same] == [(2, 0, [])] * 2
    wide = [(i, [float(v), 0.0]) for i, v in enumerate((0, 2**33, -(2**33)))]
    big = {r.vec_id: r.deviation for r in whitening.whiten(spark.createDataFrame(wide, schema)).collect()}
    assert big == {0: 0, 1: None, 2: None}
    for rows in ([], [(1, None), (2, [math.nan])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
