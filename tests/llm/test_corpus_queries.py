"""The registered corpus queries against their SQL, and against plain Python without."""

import glob
import math
import os
import re

import pytest

from tests.llm import test_native, test_texts
from tests.llm.conftest import vocabulary
from wattlake.llm import secrets
from wattlake.llm.oracles import ORACLES
from wattlake.llm.queries import QUERIES

import corpus_pipeline

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
if not os.path.exists(SF):
    pytest.skip("no test tables", allow_module_level=True)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, tables, name):
    got, want = QUERIES[name](spark, SF), tables.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got.columns, got.collect()) == table(want.columns, want.fetchall())


def test_registered():
    import __spark_entry__ as contract

    assert set(contract.queries()) >= {*QUERIES, "pipeline"}
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(n) for n in range(1, 14)}


def test_secrets_without_hints(spark, tables):
    """The fixed patterns as the contract has them, on every text."""
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    got = {r.doc_id: r for r in QUERIES["op8_secrets"](spark, SF).collect()}
    for doc_id, text in tables.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        base = [("assign", m) for m in assign.finditer(text) if len(m[2]) >= 6]
        base += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        r = got.pop(doc_id)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for x, _ in base) for k in secrets.KINDS[:3])
        assert {f"{k}:{m.start()}:{m.end()}" for k, m in base} <= set(r.spans.split(","))
    assert not got


def test_licenses_by_regular_expression(spark, tables):
    got = {r.doc_id: r for r in QUERIES["op9_licenses"](spark, SF).collect()}
    for doc_id, text in tables.sql("SELECT doc_id, text FROM documents").fetchall():
        r = got.pop(doc_id)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == test_texts.license_base(text)
    assert not got


def test_pipeline(spark, tables):
    """Every stage on the rows its predecessor kept, by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        rows[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == columns
        old = [(r.doc_id, r.text, r.source) for r in before.collect()]
        new = sorted(r.doc_id for r in rows[name])
        if name == "quality classifier":
            labels = dict(tables.sql("SELECT doc_id, quality FROM labels").fetchall())
            assert all(labels.get(i, 1) == 1 for i in new)
            assert sum(labels[i] for i in labels) == sum(i in set(new) for i in labels)
        elif name == "MinHash near-dedup":
            assert new == sorted(i for i, _, _, kept in test_texts.groups(old).values() if kept)
        elif name == "benchmark decontamination":
            items = tables.sql("SELECT item_id, text FROM benchmark").fetchall()
            leaks = {d for d, *_ in test_texts.contained(old, items)}
            assert new == sorted(i for i, *_ in old if i not in leaks)
        elif name == "mixing sources":
            taken, sizes = {}, {}
            texts = {i: len(test_native.words(t)) for i, t, _ in old}
            for i, _, source in old:
                sizes[source] = sizes.get(source, 0) + texts[i]
                taken[source] = taken.get(source, 0) + texts[i] * new.count(i)
            weights = {s: (5, 2, 1)[n % 3] for n, s in enumerate(sorted(sizes))}
            for source, target in test_native.fill(sizes, weights, sum(sizes.values()), 3).items():
                assert abs(taken[source] - target) <= max(texts[i] for i, _, s in old if s == source) / 2 + 1e-6
        else:
            assert sorted(map(tuple, rows[name])) == sorted(test_native.expected_shards(old, corpus_pipeline.SHARDS))
    final = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, final)) == sorted(map(tuple, rows["sharding"]))
    assert not math.isnan(sum(r.size for r in final))


def test_near_dedup_stage_without_ids_and_with_shared_ids(spark, make_docs):
    """One document of each group stays, whether or not rows have an id of their own."""
    texts = [vocabulary(60, seed=n) for n in range(6)]
    whole = [" ".join(t) for t in texts]
    near = [[" ".join(t[:-n] + ["other"] * n) for n in (1, 2)] for t in texts]
    rows = [
        (8, whole[0]), (8, whole[0]), (None, near[0][0]), (None, near[0][1]),  # a group with an id
        (None, whole[1]), (None, near[1][0]), (None, near[1][1]), (None, whole[1]),  # one without
        (2, whole[2]), (5, near[2][0]), (5, whole[3]),  # one id, two texts, one of them a copy
        (6, whole[4]), (6, near[4][0]),  # one id, two near copies
        (None, None), (None, ""), (9, ""),  # no words
    ]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, make_docs(rows), SF).collect()]
    assert sum(text in (whole[1], *near[1]) for _, text in got) == 1
    assert sum(doc_id == 6 for doc_id, _ in got) == 1
    rest = [r for r in got if r[1] not in (whole[1], *near[1]) and r[0] != 6]
    assert sorted(rest, key=repr) == sorted(
        [(8, whole[0]), (2, whole[2]), (5, whole[3]), (None, None), (None, ""), (9, "")], key=repr
    )


def test_stages_on_edge_cases(spark, make_docs):
    """No stage minds nulls, repeated rows, a long text, or columns with names of its own."""
    own = vocabulary(90, seed=40)
    rows = [(i, " ".join(own[i % 9 * 10 : i % 9 * 10 + 10] + [str(i)] * 3), ("a", "b", None)[i % 3]) for i in range(40)]
    rows += [(None, None, None), (None, "", "a"), (3, rows[3][1], "a"), (3, rows[3][1], "a"), (99, "long " * 200_000, "b")]
    names = ["mix_plan", "_copy", "mix_copies", "mix_size", "source_size", "planned_source", "own_source", "own_draw",
             "whole", "last_draw", "kept_id", "kept_hash", "text_hash", "component", "col", "key"]
    docs = make_docs(rows).selectExpr("*", *[f"'{n}' AS {n}" for n in names if n not in make_docs([]).columns])
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, given, SF)
            if name == "sharding":
                assert got.count() == given.count()
                continue
            assert got.columns == docs.columns, name
            out = got.collect()
            # What stays, stays as it was.
            assert {tuple(r) for r in out} <= {tuple(r) for r in given.collect()}, name
            if name == "benchmark decontamination":
                assert len(out) == given.count()
            if name == "MinHash near-dedup" and out:
                texts = [r.text for r in out]
                assert texts.count(rows[3][1]) == 1 and texts.count("long " * 200_000) == 1
