import hashlib
import math
import random
import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm import boosting, secrets, tiling, url_filter
from tidewatch.llm.queries import REGISTRY, URL_RULES
from tidewatch.llm.tokens import default_vocabulary
from tidewatch.llm.words import WordIds, runs, tidy_ids
from tests.conftest import DATA

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    fits = [
        (len(rule), rule, verdict)
        for rule, verdict in URL_RULES
        if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/") :])
    ]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme.com/en/", "http://", "http://Example.COM/en/x?y#z", "https://www.example.com/en/1", "x://a.www.example.com/en/",
    "http://notexample.com/en/", "http://com", "http://com/", "http://a.net/fr/?q=1&r=2", "http://a.net?/fr/", "http://a.net/es", "ftp://b.org/deep/er/#a?b",
    "http://ÜBER.com/Ä", "http://a.com/x://b.net/es/", "http://a.net:80/es/", "http://" + "long" * 5000 + ".org/",
]


def test_urls_against_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(5, URLS[5]), (None, URLS[4])], "page_id long, url string")
    pages = pages.withColumn("host", F.lit(1)).withColumn("rule", F.lit(2)).withColumn("score", F.lit("x"))
    rows = url_filter.judge_urls(pages, URL_RULES).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        if r.page_id is None:
            continue
        host, path = plain_parts(URLS[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= url_filter.BLOCK_AT else "allow"))
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_url_query_follows_the_rules(spark):
    urls = dict(spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url").collect())
    rows = REGISTRY["op3_url_filter"](spark, DATA).collect()
    assert len(rows) == len(urls)
    for r in rows:
        rule, verdict = plain_rule(*plain_parts(urls[r.page_id]))
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)


def test_suffix_statistics_count_every_url(spark):
    rows = [("a.com", 0)] * 300 + [("b.net", 1)] * 40 + [("c.net", 0)] * 10 + [("", 1)]
    rates, counts = url_filter.suffix_statistics(spark.createDataFrame(rows, "host string, blocked int"))
    at = url_filter.suffix_bin("net")
    assert counts[at] == 50 and rates[at] == pytest.approx((40 + url_filter.PRIOR / 2) / (50 + url_filter.PRIOR))
    assert counts[url_filter.suffix_bin("com")] == 300
    assert url_filter.suffixes("x.y.co.uk") == ("uk", "co.uk")


def test_boosted_trees_learn_and_hold_out():
    rng = np.random.default_rng(2)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.6) ^ (x[:, 3] < 0.3)).astype(float)
    model = boosting.train(x[:3000], y[:3000], trees=60)
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    assert boosting.train(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]
    assert boosting.train(x[:9], np.ones(9)).probability(x[:1])[0] > 0.9


def plain_base(text):
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


PARTS = ["token", "SECRET", "api_key", "apikey", "passwd", '"', "'", " ", "=", ":", "abcdef", "AKIA", "ABCDEFGH0123", "0123456789ab", "ſecret", "\n", "x", "é", "-"]


@given(st.lists(st.sampled_from(PARTS), max_size=24).map("".join))
@settings(max_examples=400, deadline=None)
def test_base_spans_against_plain_patterns(text):
    assert sorted(secrets.base_spans(text)) == plain_base(text)


def counter():
    import public_tokenizers

    return secrets.token_counter(default_vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_token_test_finds_random_strings_only():
    rng = random.Random(4)
    letters = string.ascii_letters + string.digits
    found = [secrets.is_random("".join(rng.choices(letters, k=32)), counter()) for _ in range(200)]
    assert sum(found) > 190
    for text in (
        hashlib.md5(b"x").hexdigest(), hashlib.sha256(b"x").hexdigest(), "550e8400-e29b-41d4-a716-446655440000", "1234567890123456789012",
        "configuration_settings_2024", "internationalisation", "path/to/some/module/2",
    ):
        assert not secrets.is_random(text, counter())


def test_names_in_front_do_not_hide_secrets():
    rng, letters = random.Random(5), string.ascii_letters + string.digits
    for front, n in (("production_database_connection_key=", 32), ("/services/notifications/incoming/webhooks/", 32), ("client_credential_value=", 24)):
        hits = 0
        for _ in range(100):
            secret = "".join(rng.choices(letters, k=n))
            spans = [x for x in secrets.all_spans(f"see {front}{secret} now", counter()) if x[1] == 3]
            hits += any(b <= 4 + len(front) and e == 4 + len(front) + n for b, _, e in spans)
        assert hits >= 97, (front, hits)
    # Letters alone, what is left beside a base span, and readable runs.
    assert secrets.is_random("qXzTmLwKpVbRsYcdGhJkNvQw", counter())
    text = "AKIA" + "Z" * 16 + "_qX9zT4mLw82KpVb7RsYc1d"
    assert [x[1] for x in secrets.all_spans(text, counter())] == [1, 3]
    for text in ("production_database_connection_key=value", "/services/notifications/incoming/webhooks/list", "id=550e8400-e29b-41d4-a716-446655440000"):
        assert not [x for x in secrets.all_spans(text, counter()) if x[1] == 3] or "550e" in text


def test_heaviest_stretches():
    assert secrets.heaviest([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5]) == [(0, 1), (2, 3), (4, 11)]
    assert secrets.heaviest([-1, -2]) == [] and secrets.heaviest([1, 0, 1]) == [(0, 3)]


def test_secrets_query_and_edges(spark, corpus, edges):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in REGISTRY["op4_secret_scan"](spark, DATA).collect()}
    for i, text in docs:
        base = plain_base(text)
        joined = ",".join(f"{secrets.KINDS[k]}:{b}:{e}" for b, k, e in base)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [rows[i].n_assign, rows[i].n_access, rows[i].n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
        assert set(joined.split(",")) - {""} <= set(rows[i].spans.split(","))
    import public_tokenizers

    scan = lambda frame: secrets.find_secrets(frame, default_vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    extra = [(50, 'é token = "abcdef" ' + "Zq8" * 3000), (51, "key qX9zT4mLw82KpVb7RsYc1d here")]
    got = scan(corpus([*edges, *extra])).collect()
    assert len(got) == len(edges) + 2
    assert [tuple(s) for r in got if r.doc_id == 51 for s in r.spans] == [("random", 4, 26)]
    assert [tuple(s)[0] for r in got if r.doc_id == 50 for s in r.spans][0] == "assign"
    assert scan(corpus([])).count() == 0


def plain_tiles(doc, item, least):
    """Greedy string tiling by trying all pairs of places."""
    doc_free, item_free, total = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and doc_free[i + n] and item_free[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        total += n
        doc_free[i : i + n], item_free[j : j + n] = [False] * n, [False] * n


@given(st.lists(st.sampled_from("abc"), min_size=8, max_size=26), st.lists(st.sampled_from("abc"), min_size=8, max_size=16))
@settings(max_examples=150, deadline=None)
def test_tiles_against_all_pairs(doc, item):
    bench = tiling.Benchmark([(7, " ".join(item))], least=3, item_words=3)
    share, name, n = bench.check(tidy_ids(" ".join(doc), WordIds()), threshold=0.0)
    assert share * len(item) == pytest.approx(plain_tiles(doc, item, 3))
    assert name == (7 if share else None)


def test_reordered_passages_are_caught(spark, corpus):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=5))
    item = [word() for _ in range(40)]
    clean = [word() for _ in range(300)]
    moved = [*clean[:50], *item[20:], *clean[50:90], *item[:20], *clean[90:]]
    part = [*clean[:100], *item[:15], *clean[100:]]
    docs = [(1, " ".join(moved).upper()), (2, " ".join(clean)), (3, " ".join(part)), (4, ", ".join(item) + "."), (5, None), (6, ""), (4, " ".join(item))]
    bench = spark.createDataFrame([(9, " ".join(item)), (9, " ".join(item)), (10, "too short"), (None, None)], "item_id long, text string")
    for chars in (10**6, 100):
        out = tiling.mark_contaminated(corpus(docs), bench, block_chars=chars)
        rows = out.select("row.*", "coverage", "item_id", "contaminated").collect()
        assert sorted((r.doc_id, r.contaminated) for r in rows) == [(1, True), (2, False), (3, False), (4, True), (4, True), (5, False), (6, False)]
        assert {r.score for r in rows} == {"x"}
    assert tiling.mark_contaminated(corpus(docs), bench.limit(0)).filter("contaminated").count() == 0
    assert tiling.mark_contaminated(corpus([]), bench).count() == 0


def test_short_items_true_coverage_and_ties_for_any_blocks(spark, corpus):
    """Items under eight words have to be held whole; coverage below the threshold is what it is; equal ones go to the smallest name."""
    word = lambda k: f"w{k}x"
    items = {i: " ".join(word(10 * i + k) for k in range(10)) for i in (8, 4, 2, 1)}
    rows = [(i, t) for i, t in items.items()] + [
        (20, "alpha beta gamma"), (21, "delta"), (22, "!!"), (None, "alpha beta gamma"), (23, "one two three four five six"), (8, items[8])
    ]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = [
        (1, "so Alpha, beta gamma!"), (2, "alpha gamma beta"), (3, "delta"), (4, "one two three four five seven six"),
        (5, " ".join(items[2].split()[:5]) + " and other words"), (6, " ".join(items[i] for i in (4, 8, 2))),
        (7, "one two three four five six"), (8, None), (9, "beta gamma"),
    ]
    want = {
        1: (1.0, 20, 2), 2: (0.0, None, 0), 3: (1.0, 21, 1), 4: (0.0, None, 0), 5: (0.5, 2, 0), 6: (1.0, 2, 4), 7: (1.0, 23, 1),
        8: (0.0, None, 0), 9: (0.0, None, 0),
    }
    for chars in (10**9, 120, 60, 20):
        out = tiling.mark_contaminated(corpus(docs), bench, block_chars=chars).select("row.doc_id", "coverage", "item_id", "n_items", "contaminated")
        assert {r.doc_id: (r.coverage, r.item_id, r.n_items) for r in out.collect()} == want
        assert all(r.contaminated == (r.n_items > 0) for r in out.collect())


def test_tiling_query_finds_whole_items(spark):
    docs = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = {r.doc_id: r.contaminated for r in REGISTRY["op7_string_tiling"](spark, DATA).collect()}
    holds = {i for i, t in docs.items() if any(x in t for x in items)}
    assert holds <= {i for i, bad in got.items() if bad} and sum(got.values()) <= len(holds) + 3
    assert math.isclose(len(got), len(docs))


def test_runs_are_the_same_for_the_same_words():
    words = WordIds()
    a, b = runs(words.of("A b  c d e f"), 3), runs(words.of("x a B c"), 3)
    assert len(a) == 4 and a[0] == b[1] and len(runs(words.of(""), 3)) == 0 and len(runs(words.of("a b"), 3)) == 1
