"""Fingerprints, repetition rules, substring dedup and byte-level BPE against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_rows import LONG, ODD

from claimlens.llm import bpe, fingerprint, queries, repeats, repetition, words
from claimlens.llm.words import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = ODD + [(10 + i, f"alpha beta {i % 3} gamma delta epsilon zeta {i % 2} eta theta iota " * (1 + i % 4)) for i in range(30)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


def test_edited_texts_and_likeness(docs):
    rows = sorted(ROWS, key=order)
    got = sorted(fingerprint.compare_with_edits(docs(ROWS)).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    texts = [t or "" for _, t in rows]
    want = []
    for i, (d, _) in enumerate(rows):
        half = len(texts[i]) // 2
        want.append((d, len(texts[i]), sha(texts[i][: len(texts[i]) - half] + texts[(i + 1) % len(rows)][:half])))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted((str(d), n, h) for d, n, h in want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    marks = {}
    by_id = {d: t for d, t in rows if d is not None}
    for r in got:
        if r.doc_id is not None:
            assert marks.setdefault(by_id[r.doc_id] or "", r.fingerprint) == r.fingerprint


def test_one_row_is_its_own_successor_and_empty_tables(docs):
    got = fingerprint.compare_with_edits(docs([(3, "abcd")])).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in got] == [(3, sha("abab"), 1.0)]
    assert fingerprint.compare_with_edits(docs([])).collect() == []


def test_collision_rate_is_the_generalised_jaccard_similarity():
    rng = np.random.default_rng(0)
    engine = fingerprint.Sampler(fingerprint.Sampling(samples=4000))
    term = fingerprint.mix(np.arange(60, dtype=np.uint64))
    a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    b[:20] = 0
    sides = []
    for w in (a, b):
        keep = w > 0
        sides.append(engine.signatures(np.zeros(keep.sum(), np.int64), term[keep], w[keep], 1))
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(fingerprint.likeness(*sides)[0] - want) < 0.03


def brute_quality(text):
    words = WORD.findall(text or "")
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered), failed


def test_repetition_counts(docs):
    rng = random.Random(1)
    noise = ["".join(rng.choice(["a", "b", " ", "\n", "é", "\t", "#", "中", "\x0b", "\x85"]) for _ in range(rng.choice([1, 5, 90]))) for _ in range(300)]
    rows = ROWS + [(100 + i, t) for i, t in enumerate(noise)]
    report = repetition.repetition_report(docs(rows))
    got = [(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in report.collect()]
    assert sorted(got) == sorted((str(d), *brute_quality(t)) for d, t in rows)
    assert report.where("base_failed and kept").count() == 0


def test_quality_filter_keeps_columns_and_clean_rows(docs):
    clean = " ".join(f"word{i}" for i in range(60))
    kept = repetition.filter_by_quality(docs([(1, clean), (2, "x y " * 50), (3, "***a &&&b " * 30), (4, None)]))
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [r.doc_id for r in kept.collect()] == [1]
    assert repetition.filter_by_quality(docs([])).count() == 0


@pytest.mark.parametrize("group", [2000, 1])
def test_repeated_windows(docs, group):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = ROWS + [(200 + i, " ".join([f"r{rng.random()}" for _ in range(40)] + [passage] + [f"q{rng.random()}" for _ in range(i)])) for i in range(12)]
    rows += [(300, "z " * 40), (301, "y " * 34), (302, "v " * 35)]
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    count = Counter(tuple(w[i : i + 35]) for _, w in words for i in range(len(w) - 34))
    want = []
    for d, w in words:
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        want.append((str(d), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    got = repeats.repeated_words(docs(rows), repeats.Repeats(group=group)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(want)
    assert all(sum(s.length for s in r.spans) == r.n_removed for r in got)
    assert repeats.repeated_words(docs([])).collect() == []


def brute_windows(rows):
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    count = Counter(tuple(w[i : i + 35]) for _, w in words for i in range(len(w) - 34))
    for d, w in words:
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        yield str(d), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


def test_an_edit_in_the_middle_of_a_recurring_phrase(docs):
    # the phrase of least hash among many is the anchor of all windows that hold it
    phrases = [" ".join(f"a{i}b{j}" for j in range(8)) for i in range(30000)]
    phrase = phrases[int(Texts(pa.array(phrases)).grams(8)[1].argmin())]
    rows, parts = [], []
    for k in range(24):
        lines = [f"{phrase} field{n}" for n in range(60)]
        lines[30] = f"{phrase} own{k}"
        rows.append((k, " ".join(lines)))
        parts.append((500 + k, " ".join(lines[28:33])))
    # the middle of some copies stands in a third text too
    rows += parts[:6]
    got = repeats.repeated_words(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(brute_windows(rows))


def encoding():
    lines = queries.vocabulary()
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(lines), special_tokens={})


def test_tokens_equal_the_library(docs):
    rng = random.Random(2)
    bits = ["a", "the", "ing", " ", "  ", "\n", "12", "é", "ß", "中文", "'s", "'ll", "''", "\x1c", "\x85", "　", "​", "!", "😀", "²", "ⅷ"]
    rows = ODD + [(400 + i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    own = encoding()
    got = bpe.encode_documents(docs(rows), queries.vocabulary(), public_tokenizers.PATTERN)
    want = sorted((str(d), own.encode_ordinary(t or ""), sha(t or "")) for d, t in rows)
    assert sorted((str(r.doc_id), r.ids, r.decoded_sha256) for r in got.collect()) == want
    back = bpe.decode_documents(got, queries.vocabulary(), public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(d), t or "") for d, t in rows)
    assert bpe.encode_documents(docs([]), queries.vocabulary(), public_tokenizers.PATTERN).collect() == []


def test_prefix_tables_append_and_edit():
    engine = bpe.Encoder(bpe.load_ranks(queries.vocabulary()), public_tokenizers.PATTERN)
    rng = random.Random(5)
    for _ in range(60):
        data = bytes(rng.choice(b"abcdeinorst ") for _ in range(rng.randint(1, 25)))
        state = engine.append(bpe.Prefixes(), data[:7])
        assert engine.tokens(engine.append(state, data[7:])) == engine.merged(data)
        a, b = sorted((rng.randint(0, len(data)), rng.randint(0, len(data))))
        assert engine.tokens(engine.edit(state, a, b, b"xyz")) == engine.merged(data[:a] + b"xyz" + data[b:])


def test_other_patterns_use_the_library_of_patterns():
    engine = bpe.Encoder(bpe.load_ranks(queries.vocabulary()), r"\S+|\s+")
    ids, first = engine.encode_many(pa.array(["ab cd", None, "  x"]))
    assert [engine.decode(ids[a:b]).tobytes() for a, b in zip(first, first[1:])] == [b"ab cd", b"", b"  x"]


def test_long_texts_are_whole():
    assert len(LONG.split()) == 30000


def test_encoding_holds_little_at_a_time():
    texts = pa.RecordBatch.from_pydict({"__text": ["ab " * 200_000] * 3})
    assert [p.num_rows for p in words.pieces(texts, "__text", bpe.ENCODE_BYTES)] == [1, 1, 1]
    engine = bpe.Encoder(bpe.load_ranks(queries.vocabulary()), public_tokenizers.PATTERN)
    engine.encode("unbelievably reorganised tokenisations")
    assert engine.fits(97, 98) == (engine.merged(engine.token[97] + engine.token[98]) == [97, 98])
    assert engine.pairs and all(isinstance(k, int) for k in engine.pairs)
