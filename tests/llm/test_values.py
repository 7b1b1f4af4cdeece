"""Pseudonyms, scores, mixing and chat formatting against plain Python."""

import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

from claimlens.llm import chat, context_tree, frames, lines, mixing, pseudonyms, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(number):
    d = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for i, x in enumerate(d)) % 10 == 0


FOUND = {
    "card": ["4539578763621486", "4539 5787 6362 1486"],
    "date": ["2024-02-29", "31.12.1999", "01/31/1801"],
    "ssn": ["665-01-0001", "667-99-9999"],
    "ip": ["10.0.255.1"],
    "phone": ["+1 (743) 555-3824", "(212) 555-0100", "415-555-2671"],
    "email": ["jane.doe.19@mail5.example.com"],
    "secret": ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff"],
}
CLEAN = ["4539578763621487", "1111111111111111", "2023-02-29", "31.13.1999", "000-12-3456", "666-12-3456", "300.1.1.1", "version 2.0.", "room 12", "1234567", "abcdefabcdefabcdefabcdefabcdefab"]


def test_values_move_inside_their_format_and_come_back(docs):
    rows = [(i, f"before {v} after {v}, end") for i, v in enumerate(itertools.chain(*FOUND.values()))]
    out = pseudonyms.pseudonymize(docs(rows), "key").orderBy("doc_id").collect()
    kinds = [k for k, vs in FOUND.items() for _ in vs]
    for r, kind, (_, text) in zip(out, kinds, rows):
        assert r.kinds == [kind] and r.n_found == 2, (text, r.kinds)
        before, after = r.pieces[0].before, r.pieces[0].after
        assert after != before and before not in r.text and r.text.count(after) == 2
        if kind == "ip":
            assert re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", after) and max(map(int, after.split("."))) < 256
        else:
            assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", after)) == re.sub("[0-9]", "9", re.sub("[a-z]", "a", before))
        if kind == "card":
            assert luhn(after)
    back = docs([(r.doc_id, r.text) for r in out])
    assert [r.text for r in pseudonyms.pseudonymize(back, "key", invert=True).orderBy("doc_id").collect()] == [t for _, t in rows]
    other = pseudonyms.pseudonymize(docs(rows), "other key").orderBy("doc_id").collect()
    assert all(a.text != b.text for a, b in zip(out, other))


FOLLOWED = ["190.137.223.204", "5.6.7.8", "2024", "17", "+1 (212) 555-0100", "(212) 555-0100", "415-555-2671", "31.12.1999", "2024-02-29", "665-01-0001", "4539 5787 6362 1486"]


def test_a_phone_ends_where_the_next_value_begins(docs):
    phones = ["+1 (826) 555-4081", "+1 826 555 4081", "+18265554081", "+44 20 7946 0958", "+44 (20) 7946 0958", "+49 (301) 555-4081"]
    rows = [(100 * i + j, f"call {p} {v} now") for i, p in enumerate(phones) for j, v in enumerate([*FOLLOWED, "at once"]) if (v, p[:3]) != ("17", "+44")]
    out = pseudonyms.pseudonymize(docs(rows), "key").orderBy("doc_id").collect()
    linked = defaultdict(set)
    for r, (d, text) in zip(out, rows):
        p, v = phones[d // 100], [*FOLLOWED, "at once"][d % 100]
        want = [p] + [v] * (v not in ("2024", "17", "at once"))
        assert [x.before for x in r.pieces] == want, text
        assert all(x.before not in r.text for x in r.pieces), text
        linked[p].add(r.pieces[0].after)
    assert all(len(after) == 1 for after in linked.values())
    back = pseudonyms.pseudonymize(docs([(r.doc_id, r.text) for r in out]), "key", invert=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == [t for _, t in rows]
    # a group of unknown length stays whole
    whole = ["+49 30 1234 5678", "+33 12.34.56.78", "+1-212-555-1234-5678", "+91 98765 43210"]
    got = pseudonyms.pseudonymize(docs([(i, p) for i, p in enumerate(whole)]), "key").orderBy("doc_id").collect()
    assert [[x.before for x in r.pieces] for r in got] == [[p] for p in whole]


def test_values_that_fail_validation_and_odd_rows_stay(docs):
    rows = [(100 + i, f"x {v} y") for i, v in enumerate(CLEAN)] + [(d, t) for d, t in ODD]
    out = pseudonyms.pseudonymize(docs(rows), "key").collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == sorted((str(d), str(t)) for d, t in rows)
    assert {r.n_found for r in out} == {0}
    assert pseudonyms.pseudonymize(docs([]), "key").collect() == []


def plain_feistel(left, right, a, b, key, tag, invert=False):
    """The rounds undone, one step, the rounds done again, in plain Python."""
    def mask(i, part, modulus):
        return int(hashlib.sha256(f"{key}|{tag}|{i}|{part}".encode()).hexdigest()[:13], 16) % modulus

    def run(order, sign):
        nonlocal left, right
        for i in order:
            if i % 2 == 0:
                left = (left + sign * mask(i, right, a)) % a
            else:
                right = (right + sign * mask(i, left, b)) % b

    run(reversed(range(pseudonyms.ROUNDS)), -1)
    left = (left + (-1 if invert else 1)) % a
    run(range(pseudonyms.ROUNDS), 1)
    return left, right


def test_rounds_are_a_bijection_without_fixed_points(work):
    pairs = work.range(189 * 773).select((F.col("id") / 773).cast("long").alias("a"), (F.col("id") % 773).alias("b"))
    out = pairs.select("a", "b", pseudonyms.feistel(F.col("a"), F.col("b"), 189, 773, "k", "t").alias("s")).select("a", "b", "s.l", "s.r").toPandas()
    assert len(set(zip(out.l, out.r))) == 189 * 773
    assert out.l.between(0, 188).all() and out.r.between(0, 772).all()
    assert not ((out.a == out.l) & (out.b == out.r)).any()
    for row in out.sample(200, random_state=1).itertuples():
        assert plain_feistel(row.a, row.b, 189, 773, "k", "t") == (row.l, row.r)


def test_values_are_those_of_plain_python(docs):
    def halves(number, tag):
        cut = len(number) // 2
        l, r = plain_feistel(int(number[:cut]), int(number[cut:]), 10**cut, 10 ** (len(number) - cut), "key", tag)
        return f"{l:0{cut}d}{r:0{len(number) - cut}d}"

    values = {"10.0.255.1": None, "665-01-0001": None, "4539578763621486": None, "+1 (743) 555-3824": None}
    got = {}
    for r in pseudonyms.pseudonymize(docs(list(enumerate(values))), "key").collect():
        got[r.pieces[0].before] = r.pieces[0].after
    l, r = plain_feistel(10 * 256, 255 * 256 + 1, 65536, 65536, "key", "ip")
    assert got["10.0.255.1"] == f"{l // 256}.{l % 256}.{r // 256}.{r % 256}"
    body = halves("453957876362148", "card")
    assert got["4539578763621486"][:-1] == body and luhn(got["4539578763621486"])
    assert re.sub(r"\D", "", got["+1 (743) 555-3824"]) == "1743" + halves("5553824", "phone")
    l, r = plain_feistel(664, 0, 898, 99 * 9999, "key", "ssn")
    assert got["665-01-0001"] == f"{l + (2 if l + 1 >= 666 else 1):03d}-{r // 9999 + 1:02d}-{r % 9999 + 1:04d}"


SHORT = [*"abcxyzAZ059", "a1", "Zz", "9_", "b.", "00", "q%"]


def test_no_value_is_its_own_pseudonym(docs):
    parts = SHORT + ["abc", "a.b", "x--", "jane.doe.19", "A" * 40 + ".9", "z" * 64]
    dates = [f"{1800 + 7 * i}-0{i % 9 + 1}-1{i % 9}" for i in range(50)]
    rows = [(i, f"{p}@mail.example.com") for i, p in enumerate(parts)] + [(100 + i, d) for i, d in enumerate(dates)]
    # one plan for many keys: the key is a constant of each
    frame = docs(rows)
    for key in ("key3", "other"):
        out = pseudonyms.pseudonymize(frame, key).orderBy("doc_id").collect()
        assert [r.n_found for r in out] == [1] * len(rows)
        assert all(r.text != t for r, (_, t) in zip(out, rows)), key
        assert len({r.text for r in out}) == len(rows)
        for r, (_, t) in zip(out, rows):
            assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", r.text))) == re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", t)))
    back = pseudonyms.pseudonymize(docs([(r.doc_id, r.text) for r in out]), key, invert=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == [t for _, t in rows]
    # short words run through one cycle of all words of their shape
    for n in (10, 26, 100, 260, 676):
        for i in range(50):
            to = pseudonyms.cycle(f"key{i}", "short", n)
            assert sorted(to) == list(range(n)) and all(x != y for x, y in enumerate(to))


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


def brute_tree(rows):
    """log10 probabilities by walking every node in plain Python."""
    depth, edge = context_tree.DEPTH, 255
    zero, one, kids = defaultdict(int), defaultdict(int), defaultdict(set)

    def steps(text):
        data = [edge] * depth + list(text.lower().encode() if text.isascii() else text.encode()) + [edge]
        for i in range(depth, len(data)):
            q = 1
            for k in range(7, -1, -1):
                bit = data[i] >> k & 1
                yield tuple(data[i - depth : i]), q, bit
                q = q << 1 | bit

    for _, text, train in rows:
        for context, q, bit in steps(text):
            for d in range(depth + 1):
                node = (context[depth - d :], q)
                if d < depth:
                    kids[node].add((context[depth - d - 1 :], q))
                if train:
                    (one if bit else zero)[node] += 1
    weighted, stop = {}, {}

    def weigh(node):
        if node not in weighted:
            own = kt(zero[node], one[node])
            if len(node[0]) == depth:
                weighted[node], stop[node] = own, 1.0
            else:
                below = sum(weigh(k) for k in kids[node])
                weighted[node] = np.logaddexp(own, below) - math.log(2)
                stop[node] = math.exp(own - math.log(2) - weighted[node])
        return weighted[node]

    out = []
    for _, text, _ in rows:
        total = 0.0
        for context, q, bit in steps(text):
            p = 0.0
            for d in range(depth, -1, -1):
                node = (context[depth - d :], q)
                weigh(node)
                p = stop[node] * (zero[node] + 0.5) / (zero[node] + one[node] + 1) + (1 - stop[node]) * p
            total += math.log10(1 - p if bit else p)
        out.append(total)
    return out


def test_scores_equal_a_walk_over_the_tree(docs):
    rng = random.Random(1)
    texts = [None, "", "A a a B", "abab" * 9] + [" ".join(rng.choice(["The", "cat", "sat", "mat", "q"]) for _ in range(12)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the cat"), (3, "abab" * 9)]
    held = F.col("doc_id") % 5 == 1
    got = context_tree.score_documents(docs(rows), held, context_tree.Scoring(block_bytes=200)).collect()
    plain = [(d, t or "", not (d is not None and d % 5 == 1)) for d, t in rows]
    tokens = [[*WORD.findall(t.lower()), None] for _, t, _ in plain]
    count = Counter(x for (_, _, train), ts in zip(plain, tokens) for x in ts if train)
    n, v = sum(count.values()), len(count)
    base = [sum(math.log10((count[x] + 1) / (n + (v + 1))) for x in ts) for ts in tokens]
    want = sorted(
        (str(d), not train, len(ts), sum(count[x] > 0 for x in ts), n, round(b, 6), round(s, 6))
        for (d, _, train), ts, b, s in zip(plain, tokens, base, brute_tree(plain))
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    assert context_tree.score_documents(docs([]), held).collect() == []


def test_a_branch_takes_a_few_hundred_bytes_a_gram():
    rng = np.random.default_rng(3)
    letters = np.frombuffer(b"etaoinshr ", np.uint8)[np.minimum(rng.geometric(0.25, (300_000, 6)) - 1, 9)].astype(np.uint64)
    key = np.unique((letters << np.arange(0, 48, 8, dtype=np.uint64)).sum(axis=1, dtype=np.uint64))
    upper = [(np.full((256, 256), 0.5), np.full((256, 256), 0.5))] * 2
    tracemalloc.start()
    try:
        logs = context_tree.Branch(key, rng.integers(0, 9, len(key))).log10(upper)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(logs) == len(key) > 50_000 and (logs < 0).all()
    assert peak < 500 * len(key)


def test_texts_reach_the_tree_in_small_batches(work, docs, monkeypatch):
    sizes = work.sparkContext.accumulator(0)
    kept = context_tree._gram_counts

    def seen(batches):
        def watch():
            for batch in batches:
                sizes.add(batch.nbytes > 6 << 20)
                yield batch

        yield from kept(watch())

    monkeypatch.setattr(context_tree, "_gram_counts", seen)
    rows = docs([(0, "")]).limit(0).unionByName(
        work.range(0, 400, numPartitions=1).selectExpr(
            "id AS doc_id", "repeat(concat('w', id, ' '), 8000) AS text", "'en' AS lang", "'a' AS source", "0L AS n_chars", "7 AS n_words"
        )
    )
    assert context_tree.score_documents(rows, F.lit(False)).count() == 400
    assert sizes.value == 0
    assert work.conf.get(frames.BATCH_BYTES, None) is None


def test_scores_of_odd_rows_and_the_held_out_share(work, docs):
    assert len(context_tree.score_documents(docs(ODD), F.col("doc_id") == 4).collect()) == len(ODD)
    got = {r.doc_id: r.held_out for r in queries.QUERIES["op8_context_tree"](work, SF).collect()}
    assert got == {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in got}


def best_below(lengths, counts, budget):
    sums = {0}
    for size, n in zip(lengths, counts):
        sums = {s + k * size for s in sums for k in range(n + 1) if s + k * size <= budget}
    return max(sums)


def test_budgets_are_met_as_nearly_as_any_choice_can():
    rng = random.Random(3)
    cases = [(rng.sample(range(1, 60), rng.randint(1, 6)), 4) for _ in range(400)]
    # few very long texts, whose sums no table could hold
    cases += [(rng.sample(range(1, 90_000), rng.randint(1, 8)), 3) for _ in range(40)]
    for some, most in cases:
        lengths = np.array(sorted(some))
        counts = np.array([rng.randint(1, most) for _ in lengths])
        budget = rng.randint(0, int((lengths * counts).sum()))
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert int((take * lengths).sum()) == best_below(lengths.tolist(), counts.tolist(), budget)
    assert int(mixing.fit_budget(np.array([1, 54, 57]), np.array([2, 2, 3]), 109) @ np.array([1, 54, 57])) == 109


def test_budgets_beyond_the_first_window():
    lengths, counts = np.array([70_000, 80_000, 90_000]), np.ones(3, np.int64)
    for budget, best in ((75_000, 70_000), (95_040, 90_000), (150_000, 150_000)):
        assert int((mixing.fit_budget(lengths, counts, budget) * lengths).sum()) == best
    # no single length fits the gap that the shares leave; taken documents have to go back
    lengths, counts = np.array([20_011, 30_029]), np.array([40, 40])
    for budget in (700_123, 1_000_001):
        want = max(a * 20_011 + b * 30_029 for a in range(41) for b in range(41) if a * 20_011 + b * 30_029 <= budget)
        assert int((mixing.fit_budget(lengths, counts, budget) * lengths).sum()) == want


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, budget, target = set(names), 1.5 * sum(sizes.values()), {}
    while left:
        level = budget / sum(weight[s] for s in left)
        full = {s for s in left if level * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in left}
        for s in full:
            target[s] = 2 * sizes[s]
            budget -= target[s]
        left -= full
    return target


def test_mix_meets_targets_and_is_stable(docs):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(0, 60)), rng.choice(["b", "a", "Z", "é", None, "c"])) for i in range(400)]
    rows += [(d, t, "odd") for d, t in ODD] + [(i, "hot word here", "hot") for i in range(1000, 1900)]
    out = mixing.mix_documents(docs(rows)).collect()
    assert len(out) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = brute_targets(dict(sizes))
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 3 for s in want if s != "odd")
    again = mixing.mix_documents(docs(rows[::-1])).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, out))


def test_mix_of_nothing(docs):
    assert mixing.mix_documents(docs([])).collect() == []
    assert [r.taken for r in mixing.mix_documents(docs([(1, None), (2, " ")])).collect()] == [0, 0]
    rows = docs([(1, "a b"), (2, "c"), (3, None)])
    assert mixing.repeat_by_mix(rows).columns == rows.columns


def test_copies_follow_the_plan_where_ids_are_null_or_repeat(docs):
    rng = random.Random(6)
    rows = [(rng.choice([None, 1, i]), " ".join("w" * rng.randint(0, 30)) + f" u{rng.randrange(150)}", rng.choice(["a", "b", "c", None])) for i in range(400)]
    rows += [(None, "the same row again", "a")] * 50 + [(7, "also the same row", "b")] * 50
    plan, taken = Counter(), Counter()
    for r in mixing.mix_documents(docs(rows)).collect():
        plan[r.source] += r.taken
    out = mixing.repeat_by_mix(docs(rows)).collect()
    for r in out:
        taken[r.source] += len(WORD.findall(r.text))
    assert taken == plan
    given = Counter(rows)
    assert all(n <= 2 * given[k] for k, n in Counter((r.doc_id, r.text, r.source) for r in out).items())


def brute_fold(events):
    """Replay the events of one conversation one by one."""
    messages = {}
    for _, m, kind, role, text in events:
        if kind == "regenerate":
            for later in [x for x in messages if x > m]:
                del messages[later]
        if kind in ("edit", "regenerate"):
            messages[m] = [messages.get(m, [None])[0], ""]
        entry = messages.setdefault(m, [None, ""])
        entry[0], entry[1] = role or entry[0], entry[1] + (text or "")
    return [(m, t) for m, (_, t) in sorted(messages.items())]


def test_folding_replays_the_log(work):
    rng = random.Random(8)
    logs = {
        c: [(s, rng.randint(1, 5), rng.choice(["message", "delta", "delta", "edit", "regenerate", None]), rng.choice(["user", "assistant"]), rng.choice(["a", "", None, "b c"])) for s in range(25)]
        for c in range(20)
    }
    rows = [(c, *e, 1) for c, log in logs.items() for e in log]
    rng.shuffle(rows)
    events = work.createDataFrame(rows, "conv_id long, seq long, message long, kind string, role string, text string, at int")
    got = defaultdict(list)
    for r in chat.fold_events(events).collect():
        got[r.conv_id].append((r.message, r.text))
    for c, log in logs.items():
        assert sorted(got[c]) == brute_fold(log)


HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "\\", "\\l \\b \\\\l", "<<SYS>>x<</SYS>>", "a\\", "", None, "<s><|endoftext|>", "line\nline", "[INST", "é😀<|"]


def test_rendering_can_be_undone(work):
    rows = [(1, i, role, t) for i, (t, role) in enumerate(zip(HARD * 2, ["user", "assistant", "system", None, "odd\nrole", "<|im_end|>\\n"] * 4))]
    rows += [(2, 0, "assistant", "only"), (2, 0, "assistant", "only"), (None, 0, "user", "x")]
    table = work.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(chat.conversation_events(table))
    want = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    for r in chat.digest(made).collect():
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    first = made.where("conv_id = 1").first().formatted
    body = first.replace(chat.TURN_OPEN, "").replace(chat.TURN_CLOSE, "")
    assert first.count(chat.TURN_OPEN) == first.count(chat.TURN_CLOSE) == len(want[1])
    assert not any(c in body for c in chat.CONTROL)
    assert chat.digest(chat.format_conversations(chat.conversation_events(table.limit(0)))).collect() == []


CLASHING = ("removed_lines", "n_found", "kinds", "pieces", "size", "target", "copies", "block", "root", "fingerprint", "taken", "output", "code")


def test_columns_of_any_name_pass_the_pipeline_stages(work, docs):
    frame = docs([(i, f"line one\nline two number {i} with some words of its own", f"s{i}") for i in range(12)])
    for c in CLASHING:
        frame = frame.withColumn(c, F.lit("mine"))
    for _, stage in corpus_pipeline.STAGES[1:2] + corpus_pipeline.STAGES[3:4]:
        out = stage(work, frame, SF)
        assert out.columns == frame.columns
        assert all(r[c] == "mine" for r in out.collect() for c in CLASHING)
    plain = pseudonyms.pseudonymize(frame, "key")
    assert sorted(plain.columns) == sorted(frame.columns) and {r.n_found for r in plain.select("n_found").collect()} == {0}
    cut = lines.remove_boilerplate(frame)
    assert sorted(cut.columns) == sorted(frame.columns) and sum(r.removed_lines for r in cut.select("removed_lines").collect()) == 11
    with pytest.raises(ValueError, match="names of kept"):
        mixing.mix_documents(frame, keep=("doc_id", "size"))
