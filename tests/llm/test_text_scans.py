"""Licences and secrets against plain loops and regular expressions."""

import hashlib
import random
import re

import numpy as np
import pytest

from barflow.llm import licenses, secret_scan
from barflow.llm.words import word_hash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def places(words, phrases=licenses.PHRASES):
    found = []
    for phrase, label in phrases.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(parts)] == parts]
    return found


def test_automaton_gives_matching_statistics():
    rng = random.Random(3)
    templates = [[rng.randrange(4) for _ in range(rng.randrange(3, 12))] for _ in range(12)]
    automaton = licenses.SuffixAutomaton()
    for t in templates:
        automaton.add(t)
    automaton.mark(templates)
    everywhere = {tuple(t[a:b]) for t in templates for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    state = matched = 0
    text = [rng.randrange(5) for _ in range(2000)]
    for i, word in enumerate(text):
        state, matched = automaton.step(state, matched, word)
        longest = max((n for n in range(1, min(i + 1, 12) + 1) if tuple(text[i + 1 - n:i + 1]) in everywhere), default=0)
        assert matched == longest
        if matched:
            here = {(t, p) for t, seq in enumerate(templates) for p in range(matched - 1, len(seq))
                    if seq[p + 1 - matched:p + 1] == text[i + 1 - matched:i + 1]}
            assert {x for x in automaton.places[state] if x[1] + 1 >= matched} == here


def test_phrases_in_random_word_soup():
    rng = random.Random(4)
    phrases = {"a b a": "x", "a b a b": "y", "b c a": "z"}
    scanner = licenses.Scanner({"t": ["a b a b c a b", "c a b a"]}, phrases)
    for _ in range(30):
        words = [rng.choice("abcd") for _ in range(200)]
        numbers = scanner.numbers(np.array([word_hash(w) for w in words], np.uint64))
        found = []
        for _, begin, end in scanner.stretches(numbers, np.array([0, len(words)])):
            found += scanner.scan(numbers[begin:end].tolist(), begin)[0]
        assert sorted((s, scanner.labels[t]) for s, t in found) == sorted(places(words, phrases))


def check_licences(rows, texts):
    for row, text in zip(rows, texts):
        words = words_of(text)
        found = places(words)
        starts, own = [s for s, _ in found], {label for _, label in found}
        assert (row["n_words"], row["n_base"]) == (len(words), len(found))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted(own))
        assert own <= set(filter(None, row["labels"].split(","))) and 0 <= row["score"] <= 1


def test_licences_of_documents(docs, messy, nothing):
    for frame in (docs.limit(150), messy):
        frame = frame.cache()
        texts = [r["text"] for r in frame.collect()]
        check_licences(licenses.scan(frame).collect(), texts)
    assert licenses.scan(nothing).count() == 0


def test_covered_passages_get_their_label(spark):
    mit = " ".join(licenses.TEMPLATES["mit"][1].split())
    changed = mit.replace("of charge to any", "of all charges, to any").replace("without limitation", "with no limit")
    texts = [mit, f"so it is. {changed} and on", "permission is hereby granted", "under the MIT License",
             "the of the and to the rights of any person to use copy", (licenses.TEMPLATES["gpl-3"][1] + " ") * 50]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = licenses.scan(frame).collect()
    assert [r["labels"] for r in rows] == ["mit", "mit", "", "mit", "", "gpl-3"]
    assert [r["score"] == 1 for r in rows] == [True, False, False, True, False, True]
    (span,) = rows[1]["spans"]
    assert span["first"] == 3 and span["end"] <= len(words_of(texts[1])) - 2 and span["part"] > 0.7
    assert rows[2]["score"] < 0.3 and len(rows[5]["spans"]) == 50


KIND = {"assign": 0, "access": 1, "hex": 2}
CASED = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def fixed(text):
    text = text or ""
    found = [("assign", m) for m in CASED.finditer(text) if len(m[2]) >= 8]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted((m.start(), KIND[k], m.end(), k) for k, m in found)


def check_secrets(rows, texts):
    for row, text in zip(rows, texts):
        spans = fixed(text)
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [
            sum(s[1] == i for s in spans) for i in range(3)]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in row["spans"].split(",") if not s.startswith("random")] == joined.split(",")


ODD = [
    "secret: api_key: abcdefghij", 'PassWd = "x1y2z3w4"', "tokens: abcdefghij", "paſſword=abcdefgh1 Token:ABCDEFGH",
    "é" * 9 + "token='" + "a1" * 20 + "'", "AKIAAKIA1234567890 AKIA123", "ab" * 20 + "g" + "0f" * 16, None, "",
]


def test_secrets_of_documents(spark, docs, messy, nothing):
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").coalesce(1)
    for frame in (docs, messy, odd):
        frame = frame.cache()
        check_secrets(secret_scan.find(frame).collect(), [r["text"] for r in frame.collect()])
    assert secret_scan.find(nothing).count() == 0


def test_random_tokens_are_told_from_ordinary_ones(spark, docs):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(letters) for _ in range(44)) for _ in range(20)]
    ordinary = ["thentionandthereforetheresthereshanding", "xyzxyzxyzxyzxyzxyzxyzxyzxyzxyzxyzxyz",
                "0123456789abcdefghijklmnopqrstuvwxyz", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz"]
    texts = [f"see {x} here" for x in [*keys, *ordinary]]
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = secret_scan.find(docs.select("doc_id", "text").unionByName(more)).filter("doc_id >= 10000").orderBy("doc_id").collect()
    assert sum(r["spans"] == "random:4:48" for r in rows[:20]) >= 17
    assert all(r["spans"] == "" for r in rows[20:])


def test_limit_is_the_weighted_rule():
    rng = random.Random(6)
    p = [(10 ** -rng.uniform(0, 9), rng.choice([20, 40, 80])) for _ in range(400)]
    counted = {}
    for value, n in p:
        bin_, weight = secret_scan._bin(value, n), min(n, secret_scan.HEAVY)
        old = counted.get(bin_, (0, 0))
        counted[bin_] = (old[0] + 1, old[1] + weight)
    least = secret_scan.limit([(b, *c) for b, c in counted.items()], 0.01)
    mean = sum(min(n, secret_scan.HEAVY) for _, n in p) / len(p)
    ranked = sorted((value * mean / min(n, secret_scan.HEAVY)) for value, n in p)
    exact = max((i + 1 for i, q in enumerate(ranked) if q <= 0.01 * (i + 1) / len(p)), default=0)
    kept = sum(n for b, (n, _) in counted.items() if b >= least)
    assert 0.9 * exact <= kept <= exact
    assert secret_scan.limit([], 0.01) > 10**6


def test_battery_accepts_random_and_rejects_patterns():
    rng = np.random.default_rng(1)
    passed = [min(secret_scan.battery(rng.integers(0, 62, 60), 62)) >= secret_scan.FAIR for _ in range(500)]
    assert np.mean(passed) > 0.98
    for codes in (np.arange(60) % 62, np.repeat([1, 60], 30), np.tile([1, 60], 30), np.zeros(60, int)):
        assert min(secret_scan.battery(codes, 62)) < secret_scan.FAIR


def test_redaction(spark, docs, messy):
    frame = docs.unionByName(messy.select(docs.columns)).cache()
    found = {(r["doc_id"], r["text"]) for r in frame.collect() if fixed(r["text"])}
    hidden = secret_scan.redact(frame).cache()
    assert hidden.columns == frame.columns and hidden.count() == frame.count()
    assert hidden.filter("text LIKE '%<secret>%'").count() == len(found) > 0
    assert not [r for r in hidden.collect() if fixed(r["text"])]
    assert hidden.filter("text IS NULL").count() == frame.filter("text IS NULL").count()
    assert hidden.filter("text LIKE '%<secret>%' AND n_chars <> length(text)").count() == 0
    assert secret_scan._masked("abcdef", [(1, 0, 3), (2, 2, 4)], "*") == "a*ef"


@pytest.mark.parametrize("text", ["AKIA" + "Z" * 12, "x" * 10])
def test_very_long_text(spark, text):
    frame = spark.createDataFrame([(1, ("word " * 400_000) + text)], "doc_id long, text string")
    (row,) = secret_scan.find(frame, secret_scan.Model([1.0] * 256, 1 << 30)).collect()
    assert row["n_access"] == text.startswith("AKIA")
