"""Limb codes, mixing and the Merkle manifest against plain Python, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from aquifold.llm import limb_codes, merkle, mixing
from aquifold.llm.prefix_sums import starts

SF = "/root/testdata/sf0.001"


# limb codes ----------------------------------------------------------------------


@pytest.mark.parametrize("size", [3, 20, 30])
@pytest.mark.parametrize("width", [1, 4, 33])
def test_products_are_exact(size, width):
    rng = np.random.default_rng(size)
    top = 1 << size - (2 if size == 30 and width == 33 else 0)
    a = rng.integers(-top, top, (2, 5, width))
    b = rng.integers(-top, top, (2, width, 7))
    a[0, 0], b[0, :, 0] = -top, -top
    want = np.matmul(a.astype(object), b.astype(object))
    assert np.array_equal(limb_codes.exact_products(a, b).astype(object), want)
    for parts in (limb_codes.limbs(a, width), limb_codes.limbs(b, width)):
        assert all(np.abs(p).max() ** 2 * width <= 2**53 for p in parts)
    assert size < 30 or len(limb_codes.limbs(a, width)) > 1


def test_products_beyond_64_bits_on_the_way_cancel():
    a = np.array([[2**40, -(2**40), 3]])
    b = np.array([[2**40 + 5], [2**40], [7]])
    assert limb_codes.exact_products(a, b)[0, 0] == 5 * 2**40 + 21


def plain_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [
        (i, label, [math.floor(scale * float(x)) for x in v]) for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = len(kept[0][2]) // parts
    part = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[2]))[:entries]
    books = [[part(v, p) for _, _, v in first] for p in range(parts)]

    def nearest(piece, book):
        return min((sum((a - b) ** 2 for a, b in zip(piece, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, _, v in kept:
                members[nearest(part(v, p), books[p])[1]].append(part(v, p))
            for i, m in members.items():
                books[p][i] = [sum(c) // len(m) for c in zip(*m)]
    out, per_label = [], defaultdict(int)
    for i, label, v in kept:
        found = [nearest(part(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{c:02x}" for _, c in found), sum(d for d, _ in found), label))
        per_label[label] += out[-1][2]
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(((i, c, e, per_label[l]) for i, c, e, l in out), key=repr), hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("spread", [1.0, 1e5])
def test_codes_equal_plain_clustering(spark, spread):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, spread) for _ in range(32)], rng.choice([0, 1, None])) for i in range(150)]
    rows += [rows[5], rows[5], (7, rows[9][1], 1), (None, rows[3][1], 0), (None, [0.0] * 32, None)]
    rows += [(900, None, 1), (901, [1.0] * 31 + [None], 1), (902, [1.0] * 31 + [math.nan], 0), (903, [math.inf] + [0.0] * 31, 0)]
    rng.shuffle(rows)
    want, digest = plain_codes(rows)
    odd = [(*r, "x", 5) for r in rows] + [(904, [], 1, "x", 5), (905, [1.0] * 16, 1, "x", 5), (906, [1.0] * 7, 1, "x", 5)]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>, label int, code string, error long").repartition(3)
    coded, books = limb_codes.compress(df)
    got = coded.select("vec_id", limb_codes.code_text(), "error", "group_error").collect()
    assert sorted(map(tuple, got), key=repr) == want
    assert books.digest() == digest


def test_codes_of_empty_small_and_too_large_tables(spark):
    ddl = "vec_id long, embedding array<float>, label int"
    coded, books = limb_codes.compress(spark.createDataFrame([(1, None, 0)], ddl))
    assert books is None and coded.collect() == [] and coded.columns == ["vec_id", "embedding", "label", "code", "error", "group_error"]
    rows = [(2, [float(i) for i in range(16)], None), (1, [0.0] * 16, None)]
    coded, books = limb_codes.compress(spark.createDataFrame(rows, ddl))
    want, digest = plain_codes(rows)
    assert sorted(tuple(r) for r in coded.select("vec_id", limb_codes.code_text(), "error", "group_error").collect()) == want
    assert books.digest() == digest and books.entries.shape == (16, 2, 1)
    with pytest.raises(ValueError, match="64-bit"):
        limb_codes.compress(spark.createDataFrame([(1, [1e12] * 16, 0)], ddl))


# mixing ------------------------------------------------------------------------------

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_targets(sizes, weights, percent, epochs):
    share, capped = {}, set()
    total = Fraction(percent * sum(sizes.values()), 100)
    while True:
        among = sum(weights[s] for s in sizes if s not in capped)
        rest = total - sum(epochs * sizes[s] for s in capped)
        for s in sizes:
            share[s] = Fraction(epochs * sizes[s]) if s in capped else Fraction(weights[s]) * rest / (among or 1)
        over = {s for s in sizes if share[s] > epochs * sizes[s]}
        if not over:
            return share
        capped |= over


def plain_mix(rows, weights, percent=150, epochs=2, seed=0):
    sizes, order = defaultdict(int), defaultdict(list)
    for doc_id, source, text in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        body = hashlib.md5(("-" if text is None else text).encode()).hexdigest()
        key = hashlib.md5(f"{seed}:{'-' if doc_id is None else doc_id}:{body}".encode()).hexdigest()
        order[source].append((key, doc_id, n))
    out = []
    for source, target in plain_targets(sizes, weights, percent, epochs).items():
        repeats, left = divmod(math.floor(target), sizes[source]) if sizes[source] else (0, 0)
        for _, doc_id, n in sorted(order[source], key=lambda r: r[0]):
            first = min(n, left)
            left -= first
            out.append((doc_id, n, sizes[source], float(target), repeats * n + first))
    return sorted(out, key=repr)


def cycled(sources):
    ranked = sorted(sources, key=lambda s: (s is None, (s or "").encode()))
    return {s: [5, 2, 1][i % 3] for i, s in enumerate(ranked)}


def odd_mix_rows():
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "a", "a", "b", "é", "z", None]), "w " * rng.randint(0, 30)) for i in range(300)]
    rows += [(None, "b", "no id here"), (None, None, None), (3, "b", "same"), (3, "b", "same"), (3, "b", "other text"), (4, "", "x\ty\nz\x1cq"), (5, "empty", ""), (6, "long", "word " * 40_000)]
    return rows


@pytest.mark.parametrize("bin_rows", [1024, 3])
def test_mix_equals_plain_mix(spark, bin_rows, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL_DIGITS", 1)
    rows = odd_mix_rows()
    df = spark.createDataFrame([(*r, 1, "k", 2.5) for r in rows], "doc_id long, source string, text string, size int, weight string, target double")
    weights = mixing.cyclic_weights(df, [5, 2, 1])
    mixed = mixing.mix(df, weights, bin_rows=bin_rows)
    got = sorted((tuple(r) for r in mixed.select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)
    want = plain_mix(rows, cycled({r[1] for r in rows}))
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-12)
    assert all(g[4] <= 2 * g[1] for g in got)
    sums = {r["source"]: r for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert all(0 <= r["target"] - r["taken"] < 1 for r in sums.values())


def test_mix_without_words_weights_or_rows(spark):
    ddl = "doc_id long, source string, text string"
    for rows in ([], [(1, "a", None), (2, None, " ")]):
        df = spark.createDataFrame(rows, ddl)
        got = mixing.mix(df, mixing.cyclic_weights(df, [5, 2, 1])).select("doc_id", "size", "target", "taken").collect()
        assert sorted(map(tuple, got)) == [(r[0], 0, 0.0, 0) for r in rows]
    df = spark.createDataFrame([(1, "a", "one two"), (2, "b", "three")], ddl)
    weights = spark.createDataFrame([("a", 1)], "source string, weight int")
    for percent, epochs in ((500, 2), (200, 2), (200, 3)):
        got = {r["doc_id"]: r["taken"] for r in mixing.mix(df, weights, percent, epochs).collect()}
        assert got == {1: min(percent * 3 // 100, epochs * 2), 2: 0}


def test_mixed_texts_hold_the_words_taken(spark):
    rows = odd_mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mixing.mix(df, mixing.cyclic_weights(df, [5, 2, 1]), texts=True)
    copies = mixing.mixed_texts(mixed).select("source", "text", "copy").collect()
    words = defaultdict(int)
    for r in copies:
        assert r["copy"] in (1, 2, 3)
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    taken = {r[0]: r[1] for r in mixed.groupBy("source").agg(F.sum("taken")).collect()}
    assert {s: words[s] for s in taken} == taken


def test_prefix_sums_through_levels(spark):
    rng = random.Random(2)
    rows = sorted({(rng.choice([None, 0, 1]), rng.choice([None, 3, 5]), rng.randint(0, 9)) for _ in range(60)}, key=lambda r: tuple((x is not None, x) for x in r))
    df = spark.createDataFrame([(*r, 1 + i) for i, r in enumerate(rows)], "g int, a int, b int, v long")
    got = {tuple(r)[:3]: r["start"] for r in starts(df, ["g"], ["a", "b"], "v").collect()}
    seen = defaultdict(int)
    for i, r in enumerate(rows):
        assert got[r] == seen[r[0]]
        seen[r[0]] += 1 + i


# manifest ------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(nodes):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([sha(*rows[-1][i : i + 2]) for i in range(0, len(rows[-1]), 2)])
    return rows


def plain_climb(node, place, rows):
    siblings = []
    for row in rows[:-1]:
        run = row[place // 2 * 2 : place // 2 * 2 + 2]
        siblings += [d for i, d in enumerate(run) if i != place % 2]
        node = sha(*[node if i == place % 2 else d for i, d in enumerate(run)])
        place //= 2
    return node, siblings


def plain_manifest(rows, tampered):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    trees, order = {}, sorted(by_lang, key=lambda l: (l is not None, (l or "").encode()))
    for lang, members in by_lang.items():
        members.sort(key=lambda r: (r[0] is not None, r[0], plain_leaf(r)))
        trees[lang] = plain_tree([plain_leaf(r) for r in members])
    top = plain_tree([trees[l][-1][0] for l in order])
    root, out = top[-1][0], []
    for at, lang in enumerate(order):
        for place, row in enumerate(by_lang[lang]):
            leaf = changed = plain_leaf(row)
            if tampered(row) and row[3] is not None:
                changed = plain_leaf((*row[:3], row[3] + 1, row[4]))
            sub, siblings = plain_climb(changed, place, trees[lang])
            folded, more = plain_climb(sub, at, top)
            out.append((row[0], lang, place, leaf, trees[lang][-1][0], root, sha(*siblings, *more), folded, folded == root))
    return sorted(out, key=repr)


def odd_manifest_rows():
    rng = random.Random(6)
    rows = [(i, f"s{i % 3}", rng.choice(["en", "en", "de", None]), rng.choice([None, i]), f"text {i} é東") for i in range(0, 400, 2)]
    rows += [(rng.randint(-(2**62), 2**62), "far", "en", 1, "t") for _ in range(30)]
    rows += [(i, "next", "fr", 5, "") for i in range(32_760, 32_776)]
    rows += [(10, "s", "en", 1, "again"), (10, "s", "en", 1, "again"), (10, None, "en", 1, "again"), (10, "s", "en", 1, "other")]
    rows += [(None, "s", "en", 3, "x"), (None, "s", "en", 3, "x"), (None, None, None, None, None), (7, "s", "lone", 2, "long " * 50_000)]
    return rows


@pytest.mark.parametrize("slot_bits", [10, 4])
def test_manifest_equals_plain_tree(spark, slot_bits):
    rows = odd_manifest_rows()
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, root string, verified boolean")
    out = merkle.manifest(
        df.repartition(5), changed={"n_chars": F.col("n_chars") + 1}, is_changed=F.col("doc_id") % 7 == 0, slot_bits=slot_bits,
    )
    names = ["doc_id", "lang", "position", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    got = sorted((tuple(r) for r in out.select(names).collect()), key=repr)
    want = plain_manifest(rows, lambda r: r[0] is not None and r[0] % 7 == 0)
    assert got == want
    assert {g[-1] for g in got} == {True, False}


def test_manifest_of_no_and_one_row(spark):
    ddl = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], ddl)).collect() == []
    row = (1, "a", None, 2, "t")
    only = merkle.manifest(spark.createDataFrame([row], ddl)).first()
    assert only["leaf"] == only["subroot"] == only["root"] == only["folded_root"] == plain_leaf(row)
    assert only["proof"] == sha() and only["path"] == [] and only["verified"]
