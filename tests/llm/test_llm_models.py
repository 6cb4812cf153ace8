"""Trained operators, chat windows, nearest neighbours and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aquifold.llm import chat, language, packing, prefix_forest, quality, registry, toxicity

SF = "/root/testdata/sf0.01"


# chat -------------------------------------------------------------------------------


def digest_of(turns):
    by = {}
    for conv, turn, role, text in turns:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, rows in by.items():
        rows.sort()
        learned = "".join(t for *_, role, t in rows if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for *_, role, t in rows)
        out[conv] = (
            len(rows), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()
        )
    return out


HARD = [
    (7, 0, "sys\nte\\m", "a\\b<s>\\<s>[INST]\\\\[/INST]</s>\\"), (7, 1, None, None), (7, None, "assistant", "<\\s>\n\n</s>"),
    (None, 1, "assistant", "x"), (None, 1, "user", "y"), (-1, 0, "user", "</s>[INST] ok [/INST]"),
    (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (9, 0, "system", "be kind"), (9, 5, "user", "dup"), (9, 5, "user", "dup"),
] + [(9, i, "assistant" if i % 2 == 0 else "user", f"word{i} " * (600 if i % 9 == 0 else 20)) for i in range(1, 150)]


def test_windows_give_back_every_turn_once(spark):
    turns = spark.createDataFrame(HARD, "conv_id long, turn long, role string, text string").withColumn("n_tokens", F.lit("x"))
    windows = chat.format_windows(turns, budget=400).cache()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.conversation_digest(windows).collect()}
    assert got == digest_of(HARD)
    rows = windows.filter("conv_id = 9").orderBy("first_turn").collect()
    assert len(rows) > 10
    for r in rows:
        assert r.n_tokens <= 400 or r.n_turns == 1
        assert r.text.startswith("<s>system\nbe kind</s>")
        assert r.text.count("<s>") == r.text.count("</s>") == r.n_turns + r.n_context
    assert any(r.n_context > 1 for r in rows[1:])
    assert chat.format_windows(turns.limit(0)).count() == 0


@pytest.mark.parametrize("system_words", [2, 60, 250, 450, 600, 3000])
def test_no_window_exceeds_the_budget(spark, system_words):
    """Whatever the system turn takes, unless one new turn alone does; it is kept while it takes at most half of the budget."""
    rng = random.Random(system_words)
    rows = [(1, 0, "system", "word " * system_words)]
    rows += [(1, i, ("user", "assistant")[i % 2], "word " * rng.choice([1, 5, 40, 90, 200, 500 if i % 9 == 0 else 30])) for i in range(1, 120)]
    rows += [(None, 0, "system", "word " * system_words), (None, 0, "system", "a tie"), *[(None, i, "user", "word " * 70) for i in range(1, 40)]]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    tokens = {(r.conv_id, r.position): r.tokens for r in chat.numbered_turns(turns).collect()}
    windows = chat.format_windows(turns, budget=1000).collect()
    assert sorted(p for r in windows if r.conv_id == 1 for p in range(r.first_turn, r.first_turn + r.n_turns)) == list(range(120))
    for r in windows:
        new = sum(tokens[r.conv_id, p] for p in range(r.first_turn, r.first_turn + r.n_turns))
        system = tokens[r.conv_id, 0]
        assert r.n_tokens <= (1000 if new <= 1000 else new + system)
        if r.first_turn and system <= 500 and new + system <= 1000:
            assert r.text.startswith("<s>system")
    if system_words == 450:
        assert any(r.n_tokens > 800 for r in windows)


# nearest neighbours ---------------------------------------------------------------------


def test_small_tables_are_searched_in_full(spark):
    rng = np.random.default_rng(2)
    points = rng.standard_normal((400, 8)).round(2).tolist()
    rows = [(i, p) for i, p in enumerate(points)] + [(400 + i, points[0]) for i in range(60)]
    bad = [(1000, None), (1100, [0.0] * 8), (1200, [None] + [1.0] * 7), (1300, [math.nan] + [1.0] * 7), (None, points[1]), (1400, [math.inf] * 8), (1500, [])]
    vectors = spark.createDataFrame(rows + bad + [(5, points[5])], "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    got = {}
    for r in prefix_forest.nearest(vectors, vectors.filter("vec_id % 100 = 0"), query_rows=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 100, 200, 300, 400}
    for query, found in got.items():
        vector = np.array(dict(rows)[query])
        want = sorted((math.dist(vector, p), i) for i, p in rows if i != query)[:10]
        assert [v for _, v, _ in sorted(found)] == [i for _, i in want]
        assert [s for *_, s in sorted(found)] == pytest.approx([d for d, _ in want])
    assert prefix_forest.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def test_forest_takes_longest_prefixes_first():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 16)) * 4
    data = np.repeat(centres, 50, axis=0) + rng.standard_normal((2000, 16)) * 0.3
    forest = prefix_forest.HashForest(data, 8)
    low, high = forest.ranges(data[:50])
    strings = forest.strings(data)
    found = 0
    for i in range(50):
        rows = forest.candidates(low[i], high[i], 150)
        shared = np.array([[prefix_forest.BITS - int(a ^ b).bit_length() for a, b in zip(strings[i], s, strict=True)] for s in strings])
        longest = shared.max(axis=1)
        assert len(rows) >= 150 and longest[rows].min() > np.delete(longest, rows).max()
        distance = ((data - data[i]) ** 2).sum(axis=1)
        found += len(set(np.argsort(distance)[:11]) & set(rows.tolist()))
    assert found / (50 * 11) > 0.9


# language ----------------------------------------------------------------------------------


def test_probabilities_of_all_characters_sum_to_one(spark):
    texts = [("a", "abra cadabra abra"), ("a", "barca"), ("b", "dodo dedo, DODO!"), (None, "zz"), ("b", None)]
    model = language.fit(spark.createDataFrame(texts, "lang string, text string"))
    model.prepare()
    assert model.languages == ["a", "b"]
    letters = sorted({ord(c) for _, t in texts[:3] for c in t.lower() if c.isalpha()} | {32})
    for context in ("\x00\x00\x00", "abr", " do", "xyz"):
        head = sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context))
        known = np.exp(model.log_probability(np.array([head | c for c in letters], np.uint64))).sum(axis=0)
        other = np.exp(model.log_probability(np.array([head | 0x4E00], np.uint64)))[0]
        spare = model._letters - len(letters)
        assert known + spare * other == pytest.approx(np.ones(2), abs=1e-5)


def plain_kneser_ney(texts):
    """chance(context and character) as a function, from dictionaries keyed by strings."""
    counts = {n: {} for n in range(1, 5)}
    for text in texts:
        padded = "\x00" * 3 + text
        for i in range(len(text)):
            counts[4][padded[i : i + 4]] = counts[4].get(padded[i : i + 4], 0) + 1
    for n in (3, 2, 1):
        for g in counts[n + 1]:
            counts[n][g[1:]] = counts[n].get(g[1:], 0) + 1
    totals, followers, discount = {}, {}, {}
    for n, own in counts.items():
        ones, twos = (sum(v == k for v in own.values()) for k in (1, 2))
        discount[n] = ones / (ones + 2 * twos) if ones else 0.5
        for g, v in own.items():
            totals[n, g[:-1]] = totals.get((n, g[:-1]), 0) + v
            followers[n, g[:-1]] = followers.get((n, g[:-1]), 0) + 1

    def chance(gram, letters):
        p = 1 / letters
        for n in range(1, 5):
            g, d = gram[-n:], discount[n]
            total = totals.get((n, g[:-1]), 0)
            if total:
                p = (max(counts[n].get(g, 0) - d, 0) + d * followers[n, g[:-1]] * p) / total
        return p

    return chance, counts


def test_models_of_many_distinct_grams_are_exact(spark, monkeypatch):
    monkeypatch.setattr(language, "CHUNK_CHARS", 20_000, raising=False)
    rng = random.Random(6)
    texts = [(g, "".join(chr(0x4E00 + rng.randrange(at, at + 2500)) for _ in range(1500))) for g, at in (("a", 0), ("b", 1200)) for _ in range(30)]
    docs = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    model = language.fit(docs)
    model.prepare()
    plain = [plain_kneser_ney([t for h, t in texts if h == g]) for g in "ab"]
    letters = len({c for _, counts in plain for c in counts[1]} | {"\x00"}) + 1
    assert model._letters == letters
    wanted = [*plain[0][1][4], *(t[i : i + 4] for _, t in texts[30:33] for i in range(500))]
    grams = np.array([sum(ord(c) << 16 * (3 - i) for i, c in enumerate(g)) for g in wanted], np.uint64)
    want = np.log([[chance(g, letters) for chance, _ in plain] for g in wanted])
    assert model.log_probability(grams) == pytest.approx(want, rel=1e-5)
    rows = {r.doc_id: r for r in language.cross_entropies(model, docs).collect()}
    assert len(rows) == len(texts) and {r.letters for r in rows.values()} == {1500}
    for i in (0, 29, 30, 59):
        padded = "\x00" * 3 + texts[i][1]
        mean = [-np.mean([math.log(chance(padded[k : k + 4], letters)) for k in range(1500)]) for chance, _ in plain]
        assert rows[i].entropies == pytest.approx(mean, rel=1e-5)


def test_language_of_odd_rows_and_held_out_documents(spark):
    odd = [(10, None, "en"), (11, "", "en"), (12, "12 %% 34", None), (None, "the and of that", None), (13, "x" * 50_000, "en")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = language.identify_held_out(docs.unionByName(spark.createDataFrame([(i and i + 10**9, t, g) for i, t, g in odd], docs.schema)))
    pairs = rows.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in pairs if r.held_out]
    assert len(held) > 100 and np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in pairs)
    got = {r.doc_id: r.lang_pred for r in rows.filter("doc_id >= 1000000000").collect()}
    assert [got[10**9 + i] for i in (10, 11, 12)] == ["und"] * 3 and got[10**9 + 13] != "und"
    assert language.identify_held_out(docs.limit(0)).count() == 0


def test_language_replaces_clashing_columns_and_keeps_repeated_rows(spark):
    model = language.fit(spark.createDataFrame([("a", "lorem ipsum dolor"), ("b", "zwölf boxkämpfer jagen")], "lang string, text string"))
    rows = [(1, "dolor", 7.0, "own", "x"), (1, "dolor", 7.0, "own", "x"), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, entropies double, lang_pred string, note string")
    got = language.identify(model, docs)
    assert sorted(got.columns) == ["doc_id", "lang_pred", "note", "rejected", "score"]
    assert sorted((r.doc_id, r.lang_pred, r.note) for r in got.collect()) == [(1, "a", "x"), (1, "a", "x"), (2, "und", None)]
    assert language.identify(model, docs.limit(0)).count() == 0


# toxicity ------------------------------------------------------------------------------------


def test_gradients_against_differences():
    network = toxicity.Network.new(np.random.default_rng(0))
    network.parameters = {k: v.astype(np.float64) for k, v in network.parameters.items()}
    features = toxicity.word_features([b"idiot", b"the", b"a"])
    windows = np.array([[0, 1, 2] + [-1] * 21, [2, 2, 1] + [0] * 21])
    labels, weights = np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def gates():
        own = network.inputs(features) @ network.parameters["input"] + network.parameters["bias"]
        return np.concatenate([own, np.zeros((1, own.shape[1]))])

    def loss():
        p = 1 / (1 + np.exp(-network.run(gates(), windows)))
        return -(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / weights.sum()

    grads, by_word = network.gradient(gates(), windows, labels, weights)
    grads["input"] = network.inputs(features).T @ by_word
    for name, at in (("forward", (2, 5)), ("backward", (1, 20)), ("attend", (3, 2)), ("focus", (1,)), ("out", (9,)), ("input", (20, 40))):
        value = network.parameters[name]
        value[at] += 1e-3
        above = loss()
        value[at] -= 2e-3
        below = loss()
        value[at] += 1e-3
        assert grads[name][at] == pytest.approx((above - below) / 2e-3, rel=0.05, abs=1e-7)


def test_planted_toxic_words_are_found_in_unseen_texts(spark):
    rng = random.Random(8)
    clean = ["".join(rng.choice("abcdeghilmnoprstu") for _ in range(rng.randint(2, 7))) for _ in range(800)]
    bad = ["vilezork", "grumblug", "snotface"]

    def text(toxic):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 120))]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "ed", "ing"]))
        return " ".join(words)

    labels = [i % 4 == 0 for i in range(600)]
    network = toxicity.train([text(t) for t in labels], [int(t) for t in labels], steps=240)
    rows = [(i, text(i % 2), i % 2, 0.1) for i in range(200)] + [(900, None, 0, 0.1), (901, "", 0, 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, truth long, score double")
    got = toxicity.score_documents(network, docs).collect()
    assert np.mean([r.predicted == r.truth for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(network, docs.limit(0)).count() == 0


def test_forward_pass_against_a_plain_one():
    """Scores of whole texts equal a network run word by word, window by window, in plain Python."""
    network = toxicity.Network.new(np.random.default_rng(3))
    network.parameters = {k: (v * 3).astype(np.float64) for k, v in network.parameters.items()}
    p, h = network.parameters, toxicity.HIDDEN

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def inputs(word):
        whole, grams, _ = toxicity.word_features([word])
        return np.concatenate([p["word"][whole[0]], np.mean([p["char"][g] for g in grams], axis=0)])

    def direction(words, name, side):
        state, states = np.zeros(h), []
        for word in words:
            x = (inputs(word) @ p["input"] + p["bias"])[side * 3 * h : (side + 1) * 3 * h]
            u = state @ p[name]
            z, r = sigmoid(x[:h] + u[:h]), sigmoid(x[h : 2 * h] + u[h : 2 * h])
            state = (1 - z) * np.tanh(x[2 * h :] + r * u[2 * h :]) + z * state
            states.append(state)
        return states

    def window(words):
        back = direction(words[::-1], "backward", 1)[::-1]
        states = [np.concatenate(pair) for pair in zip(direction(words, "forward", 0), back, strict=True)]
        raw = np.exp([np.tanh(s @ p["attend"]) @ p["focus"] for s in states])
        return sum(w * s for w, s in zip(raw / raw.sum(), states, strict=True)) @ p["out"] + p["offset"][0]

    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (1, 40, 90, 400)]
    for text, got in zip(texts, toxicity._Scorer(network).score(texts), strict=True):
        words = toxicity._words(text)
        starts = range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        want = max((window(words[a : a + toxicity.WINDOW]) for a in starts), default=0) if words else p["offset"][0]
        assert got == pytest.approx(want, rel=1e-4, abs=1e-4), text


def test_evidence_needs_support():
    """A word of one toxic text among few is weaker evidence than one of many, and a common word is none."""
    labels = np.array([1] * 20 + [0] * 80)
    pairs = [(0, 1)] + [(i, 2) for i in range(12)] + [(i, 3) for i in range(100)]
    docs, buckets = (np.array(x) for x in zip(*pairs, strict=True))
    once, often, common = toxicity.evidence((docs, buckets), labels, 2)[1:]
    assert often > once + 1 and often > 2 and common < 0


def test_few_labels_of_the_given_table_suffice(spark):
    """At scale 0.01 some thirty labelled toxic texts are learned from; a fifth of the held-out ones have no toxic word."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = labels.filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = registry.op10_toxicity(spark, SF).filter("held_out").join(known, "doc_id").dropDuplicates(["doc_id"]).collect()
    toxic, clean = ([r for r in rows if r.toxic == y] for y in (1, 0))
    above = np.mean([(a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean])
    assert len(toxic) >= 15
    assert above >= 0.85
    assert sum(r.predicted for r in toxic) >= 0.5 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_toxicity_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score_documents(toxicity.fit(docs, none), docs).collect()
    assert len({r.score for r in rows}) == 1


# quality -------------------------------------------------------------------------------------


def test_quality_against_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    judged = quality.judge(quality.fit(docs, labels), docs.withColumn("keep", F.lit("mine")))
    rows = judged.join(labels, "doc_id").collect()
    assert np.mean([r.keep == (r.quality == 1) for r in rows]) > 0.97
    assert np.mean([r.keep for r in rows if r.quality == 1]) > 0.99


def test_sparse_sites_shrink_toward_the_global_rate(spark):
    rows = [("big", "x", 1.0)] * 90 + [("big", "x", 0.0)] * 10 + [("bad", "x", 0.0)] * 100 + [("big", "tiny", 0.0), ("lone", "x", 0.0)]
    rates = {(r.host, r.path): r.rate for r in quality._posteriors(spark.createDataFrame(rows, "host string, path string, good double"), 0.45).collect()}
    assert rates["bad", "x"] < 0.05 and 0.8 < rates["big", "x"] < 0.92
    assert rates["bad", "x"] < rates["lone", "x"] < 0.45 and rates["bad", "x"] < rates["big", "tiny"] < rates["big", "x"]


def test_quality_of_odd_rows_and_without_labels(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None), (None, "", "en", "http://a.org/b/c"), (1, "fine text.", "en", "a.org")],
        "doc_id long, text string, lang string, source string",
    )
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judge(quality.fit(docs, none), docs).count() == 3
    assert quality.keep_good(docs.limit(0), none).count() == 0
    placed = docs.select(quality.host_of(F.col("source")).alias("h"), quality.path_of(F.col("source"), F.col("lang")).alias("p")).collect()
    assert [tuple(r) for r in placed] == [("", ""), ("a.org", "b"), ("a.org", "en")]


# pipeline and registry ---------------------------------------------------------------------------


def test_pipeline_stages_keep_the_documents_schema_and_pack_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = docs.columns
    sizes = [docs.count()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, SF).cache()
        assert docs.columns == given, name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] > 0.6 * sizes[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
    assert docs.filter(F.col("text").rlike(r"[a-z]@[a-z]+\d?\.example")).isEmpty()


def test_packing_hands_few_texts_at_once_to_python(spark, monkeypatch):
    def sizes(docs):
        def run(batches):
            for batch in batches:
                n = pa.array([batch.num_rows], pa.int64())
                yield pa.RecordBatch.from_arrays([n] * 6 + [pa.array([b""], pa.binary())], names=[c.split()[0] for c in packing.PIECES.split(", ")])

        return docs.mapInArrow(run, packing.PIECES)

    monkeypatch.setattr(corpus_pipeline, "pack", sizes)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 4500, 1, 1).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = [r.doc_id for r in corpus_pipeline.packing(spark, docs, SF).collect()]
    assert sum(found) == 4500 and max(found) <= 1000
    assert spark.conf.get(key) == before


def test_registry_names():
    names = list(registry.queries())
    assert [n for n in names if n.startswith("op")] == sorted((n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
