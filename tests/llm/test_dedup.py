import collections
import hashlib
import random

import numpy as np
import pytest

from tidewatch.llm import content_sort, jaccard
from tidewatch.llm.graph import components
from tidewatch.llm.queries import ORACLE, REGISTRY
from tests.conftest import DATA


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def plain_components(docs, percent=75):
    sets = {i: shingles(t) for i, t in docs}
    found, lists = [], collections.defaultdict(list)
    for i, own in sets.items():
        for j, both in collections.Counter(j for s in own for j in lists[s]).items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                found.append((i, j))
        for s in own:
            lists[s].append(i)
    names = union_find(list(sets), found)
    return {i: (len(sets[i]), names[i]) for i in sets}


def spark_components(frame, **options):
    rows = jaccard.jaccard_components(frame, counter_bits=options.pop("counter_bits", 20), **options).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_exact_groups_agree_with_sql(spark):
    import duckdb

    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = duckdb.sql(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({ORACLE['op8_content_sort']})").fetchall()
    assert sorted(tuple(r) for r in REGISTRY["op8_content_sort"](spark, DATA).collect()) == sorted(want)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("buckets", [1, 7])
def test_exact_groups_with_a_hot_text(spark, corpus, edges, keep, buckets):
    rows = [*edges, *((100 + i, "hot text") for i in range(60)), *((300 + i, f"text {i % 9}") for i in range(40))]
    got = content_sort.exact_groups(corpus(rows), keep, buckets=buckets).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for digest, ids in by_digest.items():
        mine = [r for r in got if r.text_sha256 == digest]
        named = [i for i in ids if i is not None]
        best = (max(named) if keep == "largest" else min(named)) if named else None
        assert {(r.keep_id, r.group_size) for r in mine} == {(best, len(ids))}
        assert [r.doc_id for r in mine if r.kept] == [best]


def test_normalised_copies_are_equal(spark, corpus):
    rows = [(1, "A  b"), (2, "a b"), (3, "a\tB"), (4, "ab")]
    got = content_sort.exact_groups(corpus(rows), lower=True, squeeze=True).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == [(1, 3), (2, 3), (3, 3), (4, 4)]


def test_deduplicated_rows_keep_their_columns(spark, corpus, edges):
    frame = corpus(edges)
    out = content_sort.deduplicate_texts(frame)
    assert out.columns == frame.columns
    assert out.count() == len({t or "" for _, t in edges})
    assert content_sort.deduplicate_texts(corpus([])).count() == 0


def test_main_path_is_native(spark):
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    plan = content_sort.exact_groups(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_components_of_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = union_find(nodes, links)
    assert got == {n: want[n] for n in nodes}


def test_jaccard_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in REGISTRY["op5_jaccard_join"](spark, DATA).collect()}
    assert got == plain_components(docs)


def test_jaccard_sql_agrees_with_brute_force():
    import duckdb

    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    docs = db.sql("SELECT doc_id, text FROM documents").fetchall()
    rows = db.sql(f"SELECT doc_id, n_shingles, component_id FROM ({ORACLE['op5_jaccard_join']})").fetchall()
    assert {i: (n, c) for i, n, c in rows} == plain_components(docs)


@pytest.mark.parametrize("bits", [16, 20])
def test_jaccard_near_the_threshold(spark, corpus, bits, monkeypatch):
    """Loose families, a passage that many share, chains of edits; with few minimum hashes the lists have to find the links."""
    monkeypatch.setattr(jaccard, "MEETINGS", 1)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 8)
    rng = random.Random(bits)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(30)]
    texts = []
    for k in range(12):
        texts += near_copies(rng, [word() for _ in range(40 + 5 * k)], 9, 4)
    texts += [" ".join([*passage, *(word() for _ in range(rng.randint(3, 25)))]) for _ in range(60)]
    chain = [word() for _ in range(80)]
    for _ in range(25):
        chain[rng.randrange(80)] = word()
        texts.append(" ".join(chain))
    texts += ["one two three", "ONE two  three", "one two", "", " ", "one"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    want = plain_components(docs)
    assert spark_components(corpus(docs), counter_bits=bits) == want
    assert len({name for _, name in want.values()}) < len(docs) - 60


def test_jaccard_edges(spark, corpus, edges):
    got = jaccard.jaccard_components(corpus(edges), counter_bits=16).collect()
    assert len(got) == len(edges)
    found = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert found[(1, 0)] == 1 and found[(2, 0)] == 2 and found[(3, 0)] == 3
    assert found[(9, 3)] == -3 and found[(10, 3)] == -3 and found[(-3, 4)] == -3
    assert found[(None, 0)] is None
    kept = jaccard.keep_representatives(corpus(edges))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id in (-3, 9, 10)) == [-3]
    assert jaccard.jaccard_components(corpus([]), counter_bits=16).count() == 0


def test_divide_retains_what_can_reach_the_overlap():
    short = [[(1, 8), (2, 8)], [(1, 8), (3, 8)], [(1, 8)]]
    # A query of 8 shingles has 5 long lists; 7 of 8 are needed with another set of 8.
    assert list(jaccard.divide(short, 8, 75)) == [1]
    assert jaccard.probe(np.array([1, 5, 9], np.uint64), np.array([0, 1, 9, 11], np.uint64)) == 2
    assert jaccard.least_overlap(8) == 6 and jaccard.least_overlap(8, 8) == 7


def test_divide_keeps_a_longer_document_met_by_a_shorter_query():
    """The document's rare shingles push those that it shares out of its short part, so few of them are met."""
    # 100 and 120 shingles, 95 shared: 94 are needed, the short parts hold 26 and 31, of which the document has 25 of its own.
    assert list(jaccard.divide([[(1, 120)]] * 6, 100, 75)) == [1]
    assert list(jaccard.divide([[(1, 120)]] * 4, 100, 75)) == []
    # The larger of both sets counts, whichever side asks.
    assert list(jaccard.divide([[(1, 100)]] * 6, 120, 75)) == [1]


def test_lists_alone_find_insertions(spark, corpus, monkeypatch):
    """No leaders: every link between texts with insertions over shared passages has to come from the lists."""
    monkeypatch.setattr(jaccard, "meet_leaders", lambda candidates: candidates.sparkSession.createDataFrame([], jaccard.PAIR_SCHEMA))
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 8)
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(100_000)}"
    passages = [[word() for _ in range(30)] for _ in range(4)]
    texts = []
    for _ in range(40):
        base = [*rng.choice(passages), *(word() for _ in range(70))]
        at = rng.randrange(len(base))
        longer = [*base[:at], *(word() for _ in range(rng.randint(15, 27))), *base[at:]]
        pair = [" ".join(base), " ".join(longer)]
        rng.shuffle(pair)
        texts += pair
    docs = list(enumerate(texts))
    want = plain_components(docs)
    assert len({name for _, name in want.values()}) < 60
    assert spark_components(corpus(docs)) == want


@pytest.mark.parametrize("original", ["first", "last"])
def test_pairs_of_a_group_of_near_copies_grow_with_its_size(spark, corpus, monkeypatch, original):
    # Each copy of a text links to it and few to each other; the text itself may have any identifier.
    counted = []
    search = jaccard.search_lists

    def spy(*args):
        out = search(*args)
        counted.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "search_lists", spy)
    for n in (150, 300):
        rng = random.Random(n)
        base = [f"b{i}" for i in range(150)]
        copies = []
        for k in range(n):
            words = list(base)
            for at in rng.sample(range(150), 2 + k % 3):
                words[at] = f"w{rng.randrange(10**6)}"
            copies.append(" ".join(words))
        texts = [" ".join(base), *copies] if original == "first" else [*copies, " ".join(base)]
        rows = list(enumerate(texts, 1))
        assert spark_components(corpus(rows)) == plain_components(rows)
    assert counted[-1] <= 2 * 300
