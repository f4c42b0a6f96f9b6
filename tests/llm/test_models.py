import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import counters, gru, language_model, neighbours, toxicity
from tidewatch.llm.queries import REGISTRY
from tidewatch.llm.samples import fitting, fold, labelled_sample
from tidewatch.llm.words import WordIds
from tidewatch.sources.tables import Scratch

LARGER = "/root/testdata/sf0.01"


def test_fold_is_the_crc_of_the_text(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, -3, 10**12)] + [(None,)], "doc_id long").select("doc_id", fold(F.col("doc_id"), 3).alias("f"))
    for r in rows.collect():
        assert r.f == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 3


def test_hash_bound_takes_its_share(spark):
    from tidewatch.llm.samples import hash_below

    share = spark.range(20_000).filter(F.xxhash64("id") <= hash_below(0.25)).count() / 20_000
    assert 0.23 < share < 0.27 and hash_below(5) == 2**63 - 1 and hash_below(0) == -(2**63)


def test_sample_is_bounded_and_keeps_to_its_fold(spark, corpus):
    docs = corpus([(i, f"text {i}") for i in range(200)] + [(3, "again")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(4, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    texts, marks = labelled_sample(docs, labels, "toxic", F.col("doc_id") % 4 != 2, 20, 10**6)
    assert len(texts) == len(set(texts)) <= 40 and set(marks) == {0, 1}
    for text, mark in zip(texts, marks, strict=True):
        i = int(text.split()[-1]) if text != "again" else 3
        assert i % 4 != 2 and mark == i % 2
    again = labelled_sample(docs.repartition(7), labels, "toxic", F.col("doc_id") % 4 != 2, 20, 10**6)
    assert sorted(map(str, again[1])) == sorted(map(str, marks))
    assert sum(map(len, labelled_sample(docs, labels, "toxic", F.lit(True), 50, 100)[0])) <= 100
    assert labelled_sample(docs.limit(0), labels, "toxic", F.lit(True), 5, 100) == ([], [])


def test_an_identifier_with_two_labels_or_texts_gives_one_row(spark, corpus):
    """The smallest label, and one text whatever the order of the rows."""
    rows = [(1, "one"), (1, "uno"), (2, "two"), (2, "two"), (3, None), (None, "none")]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, None), (2, 1), (3, 1), (9, 1)], "doc_id long, toxic int")
    seen = {
        tuple(sorted(zip(*labelled_sample(corpus(order, parts=k), labels.repartition(k), "toxic", F.lit(True), 10, 1000))))
        for order, k in ((rows, 1), (rows[::-1], 3))
    }
    assert len(seen) == 1
    found = next(iter(seen))
    assert [y for _, y in sorted(found, key=lambda x: x[1])] == [0, 1, 1] and {t for t, y in found if y} == {"two", ""}


def test_long_text_does_not_end_the_sample():
    # One text over the whole budget comes first, and the frequent class would use up what the rare one needs.
    order = [(0, 1, 5000), *((i, int(i % 10 == 0), 30) for i in range(1, 101))]
    taken = fitting(order, 1000)
    assert 0 not in taken and sum(30 for _ in taken) <= 1000 and len(taken) == 33
    assert sum(i % 10 == 0 for i in taken) == 10
    # What one class leaves goes to the other.
    assert fitting([(i, 0, 10) for i in range(20)], 100) == list(range(10))


def test_long_text_is_skipped_on_tables(spark, corpus):
    docs = corpus([(i, "x" * (3000 if i == 0 else 20)) for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    texts, marks = labelled_sample(docs, labels, "toxic", F.lit(True), 50, 1000)
    assert len(texts) == 39 and sum(marks) == 20


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net = gru.Network(3)
    net.p = {name: value.astype(np.float64) for name, value in net.p.items()}
    g = rng.standard_normal((3, 5, 6 * gru.HIDDEN)) * 0.5
    mask = np.ones((3, 5))
    mask[1, 3:] = 0
    mask[2, :] = 0
    slope = np.array([0.7, -0.4, 0.2])
    d_g, grad = net.backward(g, mask, net.forward(g, mask, keep=True)[1], slope)

    def loss():
        return float(net.forward(g, mask) @ slope)

    for array, found in ((g, d_g), *((net.p[k], grad[k]) for k in ("u", "v", "o", "b"))):
        for at in [tuple(rng.integers(0, n) for n in array.shape) for _ in range(12)]:
            kept, step = array[at], 1e-4
            array[at] = kept + step
            up = loss()
            array[at] = kept - step
            down = loss()
            array[at] = kept
            assert found[at] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_windows_cover_every_word():
    for n in range(0, 90):
        seen = {s + k for s in gru.windows(n) for k in range(gru.WINDOW)}
        assert set(range(n)) <= seen and len(gru.windows(n)) >= 1


def test_window_outputs_do_not_depend_on_the_company():
    scorer = gru.Scorer(gru.Network(5), remember=40)
    texts = ["", "one", "a b c " * 30, "word " * 200, "x" * 9000 + " tail", "!!! ???"]
    together = scorer.window_outputs(texts, block=7)
    for text, out in zip(texts, together, strict=True):
        alone = scorer.window_outputs([text])[0]
        assert len(out) == len(alone) and np.allclose(out, alone, atol=1e-5)


def test_network_learns_a_word_and_a_prefix():
    rng = np.random.default_rng(8)
    vocabulary = [f"{a}{b}" for a in ("ta", "ri", "mo", "ke", "lu") for b in ("sen", "dor", "vik", "pal", "gem", "fit")]

    def text(bad):
        words = list(rng.choice(vocabulary, rng.integers(5, 120)))
        if bad:
            words[rng.integers(0, len(words))] = rng.choice(["nasty", "blorg" + rng.choice(vocabulary)])
        return " ".join(words)

    y = [int(i % 4 == 0) for i in range(700)]
    texts = [text(bad) for bad in y]
    scorer = gru.train(texts[:500], y[:500])
    scores, held = scorer.scores(texts[500:]), np.array(y[500:])
    assert scores[held == 1].mean() > 0.85 and scores[held == 0].mean() < 0.1
    assert gru.train([], []).scores(["", "a"]).tolist() == [0.5, 0.5]
    assert gru.train(["a", "b"], [0, 0]).scores(["a"])[0] < 0.5


def held_out(spark, name, label):
    rows = REGISTRY[name](spark, LARGER)
    marks = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    assert rows.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    pairs = rows.join(marks, "doc_id").filter("held_out").select("score", "label", "predicted").collect()
    assert all(0 <= r.score <= 1 for r in pairs)
    good, bad = [r.score for r in pairs if r.label], [r.score for r in pairs if not r.label]
    return np.mean([np.mean([g > b for b in bad]) for g in good])


def test_toxicity_ranks_held_out_documents(spark):
    assert held_out(spark, "op9_toxicity", "toxic") > 0.8


def plain_score(scorer, text):
    """The strongest window of a text, word by word, gate by gate."""
    p, h = {k: v.astype(float) for k, v in scorer.network.p.items()}, gru.HIDDEN
    words = gru.tidy(text)

    def sig(x):
        return 1 / (1 + np.exp(-x))

    def projected(word):
        chars = gru.char_rows([word])[1]
        return np.concatenate([p["word"][gru.word_row(word)], p["char"][chars].sum(0) / np.sqrt(max(1, len(chars)))]) @ p["w"] + p["c"]

    best = -np.inf
    for start in range(0, max(1, len(words) - gru.WINDOW + gru.STRIDE), gru.STRIDE):
        inputs = [projected(w) for w in words[start : start + gru.WINDOW]]
        ways = []
        for way in (0, 1):
            state, states = np.zeros(h), []
            for x in inputs[:: -1 if way else 1]:
                x, r = x[3 * h * way : 3 * h * (way + 1)], state @ p["u"][way]
                keep, reset = sig(x[:h] + r[:h]), sig(x[h : 2 * h] + r[h : 2 * h])
                new = np.tanh(x[2 * h :] + reset * r[2 * h :])
                state = keep * state + (1 - keep) * new
                states.append(state)
            ways.append(states[:: -1 if way else 1])
        joined = [np.concatenate(pair) for pair in zip(*ways)]
        context = np.zeros(2 * h)
        if joined:
            weight = np.exp([j @ p["v"] for j in joined])
            context = sum(w * j for w, j in zip(weight / weight.sum(), joined))
        best = max(best, float(context @ p["o"] + p["b"][0]))
    return sig(scorer.scale[0] * best + scorer.scale[1])


def test_scores_are_those_of_a_network_run_word_by_word():
    rng = np.random.default_rng(8)
    words = [f"wörd{i}" for i in range(30)] + ["bad,", "awful!", "...", "a"]
    texts = ["", "a", "bad", *(" ".join(rng.choice(words, n)) for n in (3, 15, 16, 17, 24, 25, 60, 133))]
    train = [" ".join(rng.choice(words, 20)) for _ in range(60)]
    scorer = gru.train(train, [int("bad," in t or "awful!" in t) for t in train], rounds=1, epochs=2)
    assert scorer.scores(texts) == pytest.approx([plain_score(scorer, t) for t in texts], abs=2e-5)


def test_quality_ranks_held_out_documents(spark):
    assert held_out(spark, "op10_quality_neighbours", "quality") > 0.95


def test_scores_of_edges(spark, corpus, edges):
    frame = corpus(edges)
    scorer = gru.train(["bad word here", "good word here", "fine text", "nothing"] * 3, [1, 0, 0, 0] * 3)
    out = toxicity.score_toxicity(frame, scorer).select("row.doc_id", "row.score", F.col("score").alias("given")).collect()
    assert len(out) == len(edges) and {r.score for r in out} == {"x"} and all(0 <= r.given <= 1 for r in out)
    assert toxicity.score_toxicity(corpus([]), scorer).count() == 0
    labels = spark.createDataFrame([(4, 1), (9, 0), (6, 1)], "doc_id long, quality int")
    voters = neighbours.train_quality(frame, labels, F.lit(True))
    out = neighbours.score_quality(frame, voters).collect()
    assert len(out) == len(edges) and all(0 <= r.score <= 1 for r in out)
    nobody = neighbours.train_quality(corpus([]), labels, F.lit(True))
    assert {r.score for r in neighbours.score_quality(frame, nobody).collect()} == {0.5}
    assert neighbours.score_quality(corpus([]), voters).count() == 0


def test_voters_against_plain_cosines():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["red", "green", "blue", "grey", "pink"], 12)) for _ in range(60)]
    labels = [int("red" in t) for t in texts]
    voters = neighbours.Voters(texts, labels, np.ones(neighbours.TERMS), rank=10)
    counts = np.stack([neighbours.term_counts(t, WordIds()) for t in texts])
    vectors = voters.latent(neighbours.weighted(counts, voters.idf))
    got = voters.scores(counts, k=7)
    share = (sum(labels) + 0.5) / 61
    for i in range(60):
        cosine = vectors @ vectors[i] / np.linalg.norm(vectors, axis=1) / np.linalg.norm(vectors[i])
        near = sorted(cosine.tolist(), reverse=True)[:7]
        weights = [(max(c, 0) ** 4, labels[j]) for j, c in enumerate(cosine) if c >= near[-1] - 1e-6][:9]
        if len(weights) == 7:
            want = (sum(w * y for w, y in weights) + 0.01 * share) / (sum(w for w, _ in weights) + 0.01)
            assert got[i] == pytest.approx(want, abs=2e-3)


def test_document_frequencies_count_all(spark, corpus, edges):
    holders, n = neighbours.document_frequencies(corpus(edges, parts=4))
    words = WordIds()
    assert n == len(edges)
    assert (holders == sum((neighbours.term_counts(t or "", words) > 0).astype(int) for _, t in edges)).all()


def test_counters_add_up(spark):
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 1 << 18, 5000).astype(np.uint32) for _ in range(6)]
    parts.append(np.full(70_000, 77, dtype=np.uint32))
    rows = [row for part in parts for row in zip(*counters.pack_counts(part), strict=True)]
    frame = spark.createDataFrame([(c, bytearray(b)) for c, b in rows], counters.BLOB_SCHEMA)
    want = np.bincount(np.concatenate(parts), minlength=1 << 18)
    assert (counters.gather(frame, 18).view("<u4") == want).all()
    levels = counters.level_of(counters.gather(frame, 18, counters.as_levels), np.arange(1 << 18, dtype=np.uint64))
    assert (levels == np.searchsorted(counters.LEVELS, want, side="right")).all() and levels.max() <= 15


def test_language_models_against_plain_counts(spark, corpus):
    good, rest = ["a b c a b", "a b d", None], ["x y z x", "", "a x y q"]
    docs = corpus(list(enumerate(good + rest)))
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 1), (3, 0), (0, 1)], "doc_id long, quality int")
    with Scratch(spark, "test-models") as scratch:
        models = language_model.train_difference(docs, labels, scratch)
        rows = {r.doc_id: r for r in language_model.score_difference(docs, models).collect()}
        # Documents that were not learnt from ask for the same counts.
        others = {r.doc_id: r for r in language_model.score_difference(corpus(list(enumerate(good + rest))), models).collect()}
        assert others == rows
        assert language_model.score_difference(corpus([]), models).count() == 0
    corpora = [[t.split() for t in texts if t] for texts in (good, good + rest)]
    vocabulary = {w for w in "abcdxyzq" if sum(t.count(w) for t in corpora[1]) >= 2}

    def loss(words, texts):
        every = [w for t in texts for w in t]
        unknown = sum(w not in vocabulary for w in every)
        pair = [p for t in texts for p in zip(t, t[1:])]
        out = []
        for k, w in enumerate(words):
            own = every.count(w) if w in vocabulary else unknown
            alone = (own + 1) / (len(every) + len(vocabulary) + 1)
            before = every.count(words[k - 1]) if k else 0
            both = pair.count((words[k - 1], w)) if k and w in vocabulary else 0
            out.append(np.log((both + 4 * alone) / (before + 4)))
        return np.array(out)

    for i, text in enumerate(good + rest):
        words = (text or "").split()
        assert rows[i].n_words == len(words)
        if words:
            assert rows[i].score == pytest.approx(float((loss(words, corpora[0]) - loss(words, corpora[1])).mean()), abs=1e-6)
        else:
            assert rows[i].score is None


def test_language_models_of_edges(spark, corpus, edges):
    """Null identifiers, repeated rows and identifiers, very long texts: each row keeps its place and its score is that of its text."""
    labels = spark.createDataFrame([(5, 1), (7, 1), (None, 1), (9, None), (99, 1)], "doc_id long, quality int")
    with Scratch(spark, "test-models") as scratch:
        docs = corpus(edges, parts=4)
        got = language_model.score_difference(docs, language_model.train_difference(docs, labels, scratch, slice_bytes=100_000)).collect()
        small = language_model.score_difference(docs, language_model.train_difference(docs, labels, scratch, slice_bytes=40)).collect()
        none = language_model.train_difference(corpus([]), labels, scratch)
        assert (none.every, none.size) == (0, 1)
        alone = language_model.score_difference(docs, none).collect()
    rows = sorted(((r.doc_id, r.n_words) for r in got), key=str)
    assert rows == sorted(((i, len((t or "").split())) for i, t in edges), key=str)

    def by_row(found):
        return sorted((str(r.doc_id), r.n_words, round(r.score, 9) if r.score is not None else None) for r in found)

    assert by_row(got) == by_row(small) and all((r.score is None) == (r.n_words == 0) for r in got)
    assert all(r.score is None or abs(r.score) < 1e-12 for r in alone)


def test_unlike_words_never_share_a_count(spark, corpus):
    """Two words that would share a cell of 2^22, in one slice and in several: all counts stay exact."""
    seen, twin = {}, None
    words = WordIds()
    for i in range(100_000):
        cell = int(words[f"w{i}".encode()]) >> (64 - 22)
        if cell in seen:
            twin = (seen[cell], f"w{i}")
            break
        seen[cell] = f"w{i}"
    once, often = twin
    docs = corpus([(0, f"a {once} b a"), (1, f"{often} a {often} b"), (2, f"b {often} a")])
    labels = spark.createDataFrame([(1, 1), (0, 0)], "doc_id long, quality int")
    got = []
    for size in (1, 1 << 20):
        with Scratch(spark, "test-models") as scratch:
            model = language_model.train_difference(docs, labels, scratch, slice_bytes=size)
            assert (model.every, model.mine, model.size, model.unknown_every, model.unknown_mine) == (11, 4, 4, 1, 0)
            got.append({r.doc_id: r.score for r in language_model.score_difference(docs, model).collect()})
    assert got[0] == pytest.approx(got[1], abs=1e-12)
    # Text 0, by hand: a, the unknown word, b, a. Words and pairs of target (4, 1 a, 2 often, 1 b) and background (11, 4 a, 3 often, 3 b, 1 once).
    mine = [4 * 2 / 8, (4 * 1 / 8) / 5, 4 * 2 / 8 / 4, (4 * 2 / 8) / 5]
    every = [4 * 5 / 15, (4 * 2 / 15) / 8, 4 * 4 / 15 / 5, (1 + 4 * 5 / 15) / 7]
    mine[0], every[0] = mine[0] / 4, every[0] / 4
    mine[2], every[2] = (4 * 2 / 8) / 4, (1 * 1 + 4 * 4 / 15) / 5
    assert got[0][0] == pytest.approx(float(np.mean(np.log(mine) - np.log(every))), abs=1e-9)


def test_language_model_query_prefers_good_documents(spark):
    rows = REGISTRY["op6_language_models"](spark, LARGER)
    marks = spark.read.parquet(f"{LARGER}/labels.parquet")
    means = {r.quality: r.m for r in rows.join(marks, "doc_id").groupBy("quality").agg(F.avg("score").alias("m")).collect()}
    assert means[1] > means[0] + 1
