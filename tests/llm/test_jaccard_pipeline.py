"""Jaccard join against brute force; the pipeline against a brute-force version."""

import re
import uuid

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from designlab.llm import bpe, digest_index, jaccard, packing, stored
from designlab.llm.stored import components
from designlab.session import checkpoint_dir

from ..conftest import SF_SMALL
from .test_bpe_packing import check_pieces
from .test_quality_digest import direct as direct_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(id, set size, component) per row; rows without words stand alone."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return [(doc, len(s), low.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def near_rows():
    rng = np.random.default_rng(5)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, "a " * 500),
            (8, "A a a a a a"), (9, "É é é é é"), (10, "é é é é é"), (11, "x " * 5), (11, "other"), (None, "one two"),
            (None, "alone here"), (12, "a　b c")]
    base = [f"w{k}" for k in rng.integers(0, 10**6, 200)]
    # chains: each drifts from the one before, so ends link only through the middle
    for k in range(60):
        base = list(base)
        base[int(rng.integers(0, len(base)))] = f"n{k}"
        rows.append((100 + k, " ".join(base)))
    for k in range(150):
        words = [f"v{x}" for x in rng.integers(0, 50, int(rng.integers(5, 12)))]
        rows.append((300 + k, "all rights reserved by the owner " + " ".join(words[:k % 6])))
    return rows


def test_join_matches_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, comp string")
    got = sorted((tuple(r) for r in jaccard.join(docs).collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    assert jaccard.join(docs.limit(0)).count() == 0
    kept = jaccard.dedup(docs)
    assert kept.columns == docs.columns
    want = sorted(str(d) for d, _, c in brute(rows) if d is None or d == c)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_dedup_judges_rows_of_a_repeated_id_one_by_one(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (7, a + " more"), (7, c), (8, b), (8, b + " more"), (8, b + " more"), (9, b + " less"), (5, ""), (5, None),
            (6, c + " x y"), (3, a + " z"), (None, a)]
    docs = spark.createDataFrame([(t, k, i) for k, (i, t) in enumerate(rows)], "text string, node int, doc_id long")
    kept = jaccard.dedup(docs)
    assert kept.columns == docs.columns
    got = [rows[r["node"]] for r in kept.collect()]
    left = [r for r in got if r[0] == 8]
    assert len(left) == 1 and left[0] in rows
    # c is near 6, which has the smaller id; a row without a near copy stays whatever its id
    assert sorted((r for r in got if r[0] != 8), key=str) == sorted([(1, a), (5, ""), (5, None), (6, c + " x y"), (None, a)], key=str)
    rows = [(1, a), (7, a + " more"), (7, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.dedup(docs).collect()) == [(1, a), (7, c)]


def test_links_are_all_links(spark):
    rows = [*near_rows(), (500, "one TWO"), (500, "one two"), (None, "one two")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_links int, a string")
    sets = [shingles(t) for _, t in rows]
    want = [(doc, len(s), sum(bool(s and o) and k != j and 100 * len(s & o) >= 80 * len(s | o)
                              for j, o in enumerate(sets)), c)
            for k, ((doc, _), s, (_, _, c)) in enumerate(zip(rows, sets, brute(rows), strict=True))]
    got = [tuple(r) for r in jaccard.link_report(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    pairs = {(frozenset(x), frozenset(y)) for x in map(frozenset, sets) for y in map(frozenset, sets)
             if x and y and x != y and 100 * len(x & y) >= 80 * len(x | y)}
    found = [tuple(r) for r in jaccard.links(docs).collect()]
    assert len(found) == len(set(found)) == len(pairs) // 2 and all(a < b for a, b in found)
    assert jaccard.link_report(docs.limit(0)).count() == 0


def test_blocks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = jaccard.members(docs).where("n > 0").dropDuplicates(["node"])
    groups = nodes.select(jaccard.F.lit(1).cast("long").alias("key"), "node")
    none = spark.createDataFrame([], "node long, comp long")
    pairs = jaccard.residual_pairs(groups, nodes, none)
    links = {(r["a"], r["b"]) for r in jaccard.verified(pairs, docs, nodes).collect()}
    node = {}
    for r in jaccard.members(docs).collect():
        node.setdefault(r["doc_id"], r["node"])
    ids = [i for i, t in rows if i is not None and i >= 100]
    sets = {i: shingles(t) for i, t in rows}
    for x in ids:
        for y in ids:
            if x < y and sets[x] != sets[y]:
                want = 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])
                assert ((min(node[x], node[y]), max(node[x], node[y])) in links) == want


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if direct_quality(r["text"])[-1])
    seen, fresh = set(), []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if key not in seen:
            fresh.append((i, t))
        seen.add(key)
    rows = [r for r, (_, _, c) in zip(fresh, brute(fresh), strict=True) if r[0] == c]
    windows, left = {}, {}
    for i, t in rows:
        w = WORD.findall(t)
        gone = {p for k in range(len(w) - 12) if windows.setdefault(tuple(w[k:k + 13]), i) < i for p in range(k, k + 13)}
        left[i] = " ".join(x for p, x in enumerate(w) if p not in gone) if gone else t
    library = Tokenizer.from_file(bpe.default_vocabulary())
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in left.items()}
    check_pieces(corpus_pipeline.run(spark, SF_SMALL).collect(), want)


def test_pipeline_writes_tokens(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    rows = corpus_pipeline.packing_stage(spark, docs, "").collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    library = Tokenizer.from_file(bpe.default_vocabulary())
    got = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        got[r["doc_id"]] = got.get(r["doc_id"], []) + np.frombuffer(r["ids"], "<u4").tolist()
    assert got == {i: [*library.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for i, t in texts.items()}


def test_pipeline_stages_keep_columns_and_empty_tables(spark):
    schema = "doc_id long, text string, at string, _digest string, _id long, _h int"
    docs = spark.createDataFrame([(1, None, None, None, None, 1), (1, None, None, None, None, 1)], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), "").columns == docs.columns, name
        assert stage(spark, docs.limit(0), "").count() == 0, name
    assert corpus_pipeline.exact_stage(spark, docs, "").count() == 1


@pytest.mark.parametrize("block, size", [(2000, 1 << 25), (11, 20_000)])
def test_residual_links_connect_what_all_links_connect(spark, monkeypatch, block, size):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", size)
    rng = np.random.default_rng(8)
    rows = near_rows()
    base = [f"w{k}" for k in range(100)]
    for k in range(120):  # one large group of near copies, few of them near the first
        words = list(base)
        for at in rng.integers(0, 100, 4):
            words[int(at)] = f"n{int(rng.integers(0, 6))}"
        rows.append((1000 + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = jaccard.members(docs).where("n > 0").dropDuplicates(["node"]).cache()
    groups = nodes.select(jaccard.F.lit(1).cast("long").alias("key"), "node")
    none = spark.createDataFrame([], "node long, comp long")
    some = jaccard.residual_links(groups, docs, nodes, none).collect()
    every = jaccard.verified(jaccard.residual_pairs(groups, nodes, none), docs, nodes).collect()
    assert {tuple(sorted(r)) for r in some} <= {tuple(r) for r in every}
    assert tops([tuple(r) for r in some]) == tops([tuple(r) for r in every])
    if block > nodes.count():  # one block: a forest leaves it
        assert len(some) < nodes.count() and len(some) < len(every), (len(some), nodes.count(), len(every))
    settled = components(spark.createDataFrame([tuple(r) for r in every], "a long, b long"))
    assert jaccard.residual_links(groups, docs, nodes, settled).count() == 0


def tops(edges):
    """Smallest reachable node of every node that has an edge."""
    top = {n: n for e in edges for n in e}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    return {n: find(n) for n in top}


def test_components_of_chain_star_and_cycle(spark):
    rng = np.random.default_rng(2)
    chain = [(k, k + 1) for k in range(300)]
    star = [(5000, 1000 + k) for k in range(200)] + [(1000, 1000)]
    cycle = [(7000 + k, 7000 + (k + 1) % 50) for k in range(50)] * 2
    names = {n: int(x) for n, x in zip(sorted({n for e in chain + star + cycle for n in e}),
                                       rng.permutation(10**6)[:1000], strict=False)}
    edges = [(names[a], names[b]) for a, b in chain + star + cycle]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == tops(edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_steps_go_when_their_block_ends(spark):
    with stored.steps_removed():
        kept = stored.stored(spark.range(5))
        index = digest_index.temporary_index(spark)
        with stored.steps_removed():
            inner = stored.stored(spark.range(3))
            folder = stored._FOLDER[inner]
        assert not stored.has_folder(spark, folder) and kept.count() == 5
        gone = stored._FOLDER[kept]
        dropped = stored.stored(spark.range(2))
        at = stored._FOLDER[dropped]
        stored.drop(dropped)
        assert not stored.has_folder(spark, at)
    assert not stored.has_folder(spark, gone) and not stored.has_folder(spark, index.path)
    assert not spark.catalog.tableExists(index.name)


def test_pipeline_goes_on_after_its_last_finished_stage(spark, monkeypatch):
    rows = [(k, " ".join(f"d{k}w{j}" for j in range(60))) for k in range(6)]
    rows += [(9, rows[0][1]), (10, rows[1][1] + " more"), (11, "short")]
    schema = "doc_id long, text string"
    base = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    spark.createDataFrame(rows, schema).write.parquet(f"{base}/documents.parquet")
    ran, stages = [], corpus_pipeline.STAGES

    def counted(name, stage, fail):
        def run(spark, docs, sf_dir):
            ran.append(name)
            if fail and name == "substring_dedup":
                raise RuntimeError("lost")
            return stage(spark, docs, sf_dir)
        return name, run

    run_id = uuid.uuid4().hex
    monkeypatch.setattr(corpus_pipeline, "STAGES", [counted(*s, True) for s in stages])
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, base, run_id)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [counted(*s, False) for s in stages])
    got = corpus_pipeline.run(spark, base, run_id)
    names = [name for name, _ in stages]
    assert ran == names[:4] + names[3:]
    assert sorted({r["doc_id"] for r in got.collect()}) == list(range(6))
    left = checkpoint_dir(spark) + f"/pipeline_{run_id}"
    assert [stored.has_folder(spark, f"{left}/{i}_{n}") for i, n in enumerate(names)] == [False] * 4 + [True]
