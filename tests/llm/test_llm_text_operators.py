"""Operators on texts against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aquifold.llm import decontaminate, jaccard_join, packing, personal_data, token_files
from aquifold.llm.components import components
from aquifold.llm.tokens import CorpusTokenizer

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, start int"


def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Null and empty texts, a null and a repeated id, a long text, columns named like results."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id here at all, really", "en", "a", 5),
        (3, "the same words again and again here", "en", "b", 3), (3, "the same words again and again here", "en", "b", 3),
        (4, long_text, "en", "b", 9), (5, "  \t\n double  blanks \n\n and tabs\t end ", None, "b", 9), (6, "%%% *** !!!", "de", None, 9),
        (7, "Ünïcode ŒUVRE <|endoftext|> ‘quotes’ 东京 🙂 don't stop... e.g. 3.14", "fr", "c", 9),
    ]
    return spark.createDataFrame([(*r, 7, 0.5, 1) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# token ids ---------------------------------------------------------------------


@pytest.mark.parametrize("name", FILES)
def test_ids_are_those_of_the_library(name, odd_docs, documents):
    texts = [r.text or "" for r in odd_docs.collect()] + [r.text for r in documents.limit(40).collect()]
    rng = random.Random(5)
    texts += ["".join(rng.choice(["a", "Bc", " ", " ", "\n", ".", "!!", "é", "\x1c", " ", "'s", "12", "\x01"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    encoder, whole = CorpusTokenizer(name), library(name)
    for _ in range(2):
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
        assert got == [whole(t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_ids_do_not_depend_on_what_is_remembered(name, monkeypatch):
    monkeypatch.setattr("aquifold.llm.tokens.MAX_REMEMBERED", 40)
    monkeypatch.setattr("aquifold.llm.tokens.SLICE_CHARS", 300)
    rng = random.Random(8)
    parts = ["it's", "Ab,", "c.'s", "ΑΣ.", "don't!?", "e\u0301.", "x.1", "\u65e5\u672c\u3002", "#%a", "a#%'re", "\u0120b", "</w>", "q\nr"]
    words = [rng.choice(parts) + "".join(rng.choices("abXY.,'é7", k=rng.randint(0, 5))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(200)] + ["", " ", "\n", " a", "a ", "\na", "x" * 5000]
    encoder, whole = CorpusTokenizer(name), library(name)
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [whole(t) for t in texts]


def test_words_that_come_again_stay_remembered(monkeypatch):
    monkeypatch.setattr("aquifold.llm.tokens.MAX_REMEMBERED", 60)
    monkeypatch.setattr("aquifold.llm.tokens.SLICE_CHARS", 1)
    encoder = CorpusTokenizer(FILES[0])
    words = [a + b for a in "bcdfghklmn" for b in ("ax", "ey", "oz")]
    for text in (["x often b"] * 2 + [f"x {' '.join(words)}", f"x {' '.join(w + 'q' for w in words)}"]):
        list(encoder.encode([text]))
    assert "often" in encoder._pool.slots and words[0] not in encoder._pool.slots


def test_words_before_signs_share_an_entry():
    encoder = CorpusTokenizer(FILES[0])
    list(encoder.encode(["x one two"]))
    known = len(encoder._pool.slots)
    list(encoder.encode(["x one, two! one. two; one,b"]))
    assert len(encoder._pool.slots) - known == 5  # the signs, and the one that a letter follows


def test_chunks_are_looked_up_once_a_slice():
    encoder = CorpusTokenizer("byte_bpe_50k.json")
    asked = []

    class Slots(dict):
        def get(self, chunk, other=None):
            asked.append(chunk)
            return super().get(chunk, other)

        def __getitem__(self, chunk):
            asked.append(chunk)
            return super().__getitem__(chunk)

    encoder._pool.slots = Slots()
    words = ["".join(p) for p in itertools.product("abcdef", repeat=3)]
    text = " ".join(words)
    found = list(encoder.encode([text, text]))
    assert found == [np.array(encoder._library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()] * 2
    assert len(asked) == len(set(asked))


def test_freed_arrays_of_a_slice_go_back():
    """In a process of its own, so that nothing else counts: memory left after texts of 30 MB with few words."""
    code = """
import re
import pyarrow as pa
from aquifold.llm.tokens import CorpusTokenizer
def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
encoder = CorpusTokenizer("word_bpe_49k.json")
words = [a + b + c for a in "bdfghklmnprst" for b in ("a", "en", "o") for c in ("ri", "so", "tu")]
column = pa.array([" ".join(words[i % 50 :] * 20) + "," for i in range(3200)])
pa.default_memory_pool().release_unused()
before = held()
for _ in encoder.encode_column(column):
    pass
print(held() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert float(out.stdout) < 20


def test_columns_of_texts_with_nulls():
    for name in FILES:
        encoder, whole = CorpusTokenizer(name), library(name)
        texts = [None, "", "one, two", "a  b", None, "caf\u00e9!", "a.\x02b", "\x02"]
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode_column(pa.array(texts))]
        assert got == [whole(t) for t in texts]
        assert not list(encoder.encode_column(pa.array([], pa.string())))


def test_ids_are_counted_across_texts_of_both_widths(spark):
    rows = [(np.array([i % 3, 70_000], "<u4").tobytes(), 4) for i in range(30)] + [(np.array([5], "<u2").tobytes(), 2)]
    counts = token_files._id_counts(spark.createDataFrame(rows, "ids binary, width int").coalesce(1))
    assert {int(i): int(counts[i]) for i in np.flatnonzero(counts)} == {0: 10, 1: 10, 2: 10, 5: 1, 70_000: 30}


@pytest.mark.parametrize("size", [0, 1, 63, 64, 1000, 70_001])
def test_coder_round_trip_and_checksum(size):
    rng = np.random.default_rng(size)
    ids = np.minimum(rng.zipf(1.3, size), 50_000).astype(np.uint32)
    counts = np.bincount(ids, minlength=10) if size else np.ones(10)
    coder = token_files.RangeCoder(token_files.scaled_frequencies(counts))
    payload = coder.encode(ids)
    assert np.array_equal(coder.decode(payload), ids)
    if size == 70_001:
        assert len(payload) < 4 * size
        broken = payload[:-2] + bytes([payload[-2] ^ 1]) + payload[-1:]
        with pytest.raises(ValueError, match="checksum"):
            coder.decode(broken)


def test_token_files_of_odd_rows(odd_docs):
    rows = token_files.token_file_digest(odd_docs).collect()
    encode = library(FILES[0])
    docs = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want, start = [], 0
    for r in docs:
        ids = [*encode(r.text), 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in rows), key=lambda r: r[1]) == want
    assert token_files.token_file_digest(odd_docs.limit(0)).count() == 0


# packing ---------------------------------------------------------------------------


def test_packing_of_odd_rows(odd_docs):
    rows = packing.pack(odd_docs, group_tokens=20_000).collect()
    encode = library(FILES[1])
    want = sorted(zlib.crc32(np.array([*encode(r.text), 2], "<u4").tobytes()) for r in odd_docs.collect())
    whole, parts = [], {}
    for r in rows:
        parts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (_, tokens), pieces in parts.items():
        pieces.sort(key=lambda r: r.start)
        copies = sum(r.length for r in pieces) // tokens
        for k in range(copies):
            whole.append(zlib.crc32(b"".join(bytes(p.ids) for p in pieces[k::copies])))
    assert sorted(whole) == want
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for sequence in placed.values():
        ends = 0
        for offset, length in sorted(sequence):
            assert offset == ends
            ends += length
        assert ends <= 4096
    assert packing.pack(odd_docs.limit(0)).count() == 0


def test_documents_go_to_the_cheapest_sequence_with_room():
    rng = random.Random(1)
    lengths = [rng.randint(1, 300) for _ in range(60)]
    pieces, count = packing.assign(lengths, 256)
    assert count == sum(n // 256 for n in lengths) + -(-sum(n % 256 for n in lengths) // 256)
    # Plain replay: descending rests, lowest cost (then number) among those with room, else cut at the most room.
    waiting = sorted(((-(n % 256), d, n - n % 256) for d, n in enumerate(lengths) if n % 256))
    first = sum(n // 256 for n in lengths)
    room, cost, want = [256] * (count - first), [0.0] * (count - first), []
    while waiting:
        n, d, start = min(waiting)
        waiting.remove((n, d, start))
        fit = [i for i in range(len(room)) if room[i] >= -n]
        if fit:
            i, size = min(fit, key=lambda i: (cost[i], i)), -n
        else:
            most = max(room)
            i, size = min((i for i in range(len(room)) if room[i] == most), key=lambda i: (cost[i], i)), most
            waiting.append((n + size, d, start + size))
        want.append((d, start, size, first + i, 256 - room[i]))
        room[i] -= size
        cost[i] += size + size * size / 4096
    assert sorted(p for p in pieces if p[3] >= first) == sorted(want)


# decontamination -----------------------------------------------------------------------


def hits(text, items, window):
    words, hit, found = words_of(text), set(), set()
    for name, item in items:
        w = words_of(item)
        n = min(window, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add("" if name is None else str(name))
    return len(words), len(hit), sorted(found), bool(hit)


@pytest.mark.parametrize("pass_words", [decontaminate.PASS_WORDS, 500])
def test_contamination_against_brute_force(spark, documents, odd_docs, pass_words):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    items = given + [(None, "again and again"), (900, "words AGAIN"), (901, ""), (902, None), (903, "%%"), (10, given[0][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text")).withColumn("matches", F.lit("mine"))
    rows = decontaminate.find_contamination(docs, benchmark, pass_words=pass_words).collect()
    assert sum(r.contaminated for r in rows) > 3
    for r in rows:
        assert (r.n_words, r.n_hit, r.item_ids, r.contaminated) == hits(r.text, items, 10)
        words = words_of(r.text)
        texts = {"" if i is None else str(i): [words_of(t) for j, t in items if j == i] for i, t in items}
        for m in r.matches:
            here = words[m.doc_start : m.doc_start + m.length]
            assert any(here == w[m.item_start : m.item_start + m.length] for w in texts[m.item_id])
    kept = decontaminate.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.filter("matches <> 'mine'").isEmpty()
    assert kept.count() == sum(not r.contaminated for r in rows)


def test_contamination_of_empty_tables(odd_docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.find_contamination(odd_docs, none).collect())
    assert decontaminate.find_contamination(odd_docs.limit(0), none).count() == 0


# near duplicates -------------------------------------------------------------------------


def brute_links(rows):
    sets = []
    for _, text in rows:
        w = words_of(text)
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    links = [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]:
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                    links[i].add(j)
                    links[j].add(i)
    return links


def test_similar_documents_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL_NODE", 12)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng = random.Random(3)
    rows = []
    for family in range(12):
        base = [f"f{family}w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 9, 60, 150]))]
        for _ in range(rng.choice([1, 2, 3, 30])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                text[rng.randrange(len(text))] = f"x{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(text)))
    rows += [(900, None), (901, ""), (902, "!!"), (None, rows[0][1]), (3, rows[3][1])]
    links = brute_links(rows)
    got = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    root = list(range(len(rows)))
    for i, own in enumerate(links):
        for j in own:
            a, b = root[i], root[j]
            root = [min(a, b) if x in (a, b) else x for x in root]
    for i, (doc_id, text) in enumerate(rows):
        row = by_id[doc_id][0]
        if doc_id is None:
            assert (row.class_id, row.n_links) == (None, 0)
            continue
        members = [rows[j][0] for j in range(len(rows)) if root[j] == root[i]]
        assert (row.class_id, row.n_links) == (min(members), len(links[i]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1))
    kept = jaccard_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted({min(rows[j][0] for j in range(len(rows)) if root[j] == root[i]) for i in range(len(rows)) if rows[i][0] is not None})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert jaccard_join.similar_documents(docs.limit(0)).count() == 0


def test_repeated_ids_are_decided_text_by_text(spark):
    def text(name, changed=0):
        return " ".join(f"{name}{'x' if i < changed else ''}{i}" for i in range(80))

    rows = [
        (1, text("a")), (2, text("a")), (2, text("b")), (3, text("c")), (3, text("c", 1)), (4, text("d")), (4, text("d").upper()),
        (4, text("d")), (5, text("c", 2)), (6, text("e")), (6, text("f")), (7, text("f", 1)), (8, "!"), (8, "!"), (8, None), (8, None), (8, ""),
        (None, text("a")), (None, text("a")),
    ]
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, key string")
    kept = jaccard_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.key) for r in kept.collect()), key=str)
    third = [g[1] for g in got if g[0] == 3]
    assert len(third) == 1 and third[0] in (text("c"), text("c", 1))
    want = [(1, text("a")), (2, text("b")), (3, third[0]), (4, text("d").upper()), (6, text("e")), (6, text("f")), (8, "!"), (8, None), (8, "")]
    assert got == sorted(((*r, "mine") for r in want + [(None, text("a"))] * 2), key=str)


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(160, 130), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 161)}


# personal data ------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sound(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_base_spans_against_the_patterns(spark):
    rng = random.Random(11)
    parts = [
        "a.b@c.d_e@f.g", "x@y..z", "x@y.z.", "..q@r-s.t", "@", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.003.0255",
        "4111 1111 1111 1111", "4111-1111-1111-1111-", "41111111  11111111", "4012888888881881", "+1 (555) 555-1234", "+44 20--", "+1",
        "++12345678", "é", "🙂", "\n", " ", "-", "password=abc123def456ghi789", "version 2.0.", "12", ".",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None, "", "7 " * 20_000, "a." * 20_000 + "b@c.d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    rows = personal_data.find_personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        want = [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if sound(k, m[0])]
        assert [tuple(s) for s in r.base_spans] == want
        assert set(want) <= {tuple(s) for s in r.spans}
        kinds = [*BASE, personal_data.OTHER]
        assert [tuple(s) for s in r.spans] == sorted((tuple(s) for s in r.spans), key=lambda s: (kinds.index(s[0]), s[1], s[2]))


def test_learned_spans_add_secrets_and_leave_numbers(spark):
    texts = [f"the key token = \"{hashlib.md5(bytes([i])).hexdigest()}\" was seen" for i in range(40)]
    texts += [f"mail me{i}@host.example.com or 10.0.{i}.7" for i in range(40)]
    texts += ["Licensed under version 2.0 of the text, page 12"] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_chars", F.lit(0).cast("long"))
    out = {r.doc_id: r for r in personal_data.redact(docs).collect()}
    assert out[0].text == 'the key token = "[SECRET]" was seen' and out[0].n_chars == len(out[0].text)
    assert out[40].text == "mail [EMAIL] or [IP]"
    assert out[100].text == texts[100]
    assert personal_data.find_personal_data(docs.limit(0)).count() == 0


def test_overlapping_spans_leave_no_tail_in_clear_text(spark):
    texts = [
        "at 1.2.3.4.john.smith@x.com.", "call +1 555-1234567.jane@x.com now", "4111111111111111@host.example", "two a@b.c d@e.f",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in personal_data.find_personal_data(docs).collect()}
    assert {s.kind for s in found[0].spans} >= {"ip", "email"} and {s.kind for s in found[1].spans} >= {"phone", "email"}
    got = {r.doc_id: r.text for r in personal_data.redact(docs).collect()}
    assert got[0] == "at [IP]." and got[1] == "call [PHONE] now" and "host" not in got[2] and got[3] == "two [EMAIL] [EMAIL]"
