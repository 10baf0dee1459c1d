import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.llm import conversation_trie, periodic, quality
from cyclewise.llm.double_array import DoubleArray
from cyclewise.llm.recompression import Grammar


# ------------------------------------------------------------------ conversation trie
def brute_trie(rows):
    """The contract by plain dictionaries."""
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        start = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        seq = tuple(own.get(start, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(int)
    for s in members:
        if s:
            kids[s[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += kids[s] == 0
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1].encode()) if s else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s], sha(ends[s]))
                  for s, m in members.items())


def conversation_rows():
    rng = random.Random(3)
    rows = []
    for c in [*range(120), -7, -5, 10**12, 10**12 + 3, 2**63 - 1, 2**63 - 2]:
        first = rng.choice(["hot", "hot", "warm", f"own{c}"])
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 12, 30])):
            rows.append((c, t, ("user", "assistant")[t % 2], first if t == 0 else rng.choice(["yes", "no", f"é{c % 3}", "x" * 40]), 9, "k"))
    for c in range(200, 260):  # many equal conversations
        rows += [(c, 0, "user", "hot", 1, "k"), (c, 1, "assistant", "same", 1, "k")]
    rows += [(300, None, None, None, 1, "k"), (300, 2, "user", "", 1, "k"), (300, 2, "user", "tie", 1, "k"), (300, 2, "user", "tie", 1, "k")]
    rows += [(None, 0, "user", "nobody", 1, "k"), (301, 0, "user", "long " * 5000, 1, "k")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("layer", [4, 128])
def test_prefix_trie_equals_brute_force(spark, layer):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n long, key string").repartition(5)
    out = [tuple(r) for r in conversation_trie.prefix_trie(df, layer).collect()]
    none_first = lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, *r[3:])
    assert sorted(map(none_first, out)) == sorted(map(none_first, brute_trie(rows)))


def test_prefix_trie_without_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie.prefix_trie(empty).count() == 0
    lost = spark.createDataFrame([(None, 1, "user", "a")], "conv_id long, turn long, role string, text string")
    assert conversation_trie.prefix_trie(lost).count() == 0


def test_double_array_finds_its_sequences_and_no_others():
    rng = np.random.default_rng(1)
    seqs = sorted({tuple(rng.integers(0, 9, rng.integers(1, 7)).tolist()) for _ in range(400)})
    longest = max(map(len, seqs))
    levels = [tuple(np.array(x) for x in zip(*[(i, s[d]) for i, s in enumerate(seqs) if len(s) > d])) for d in range(longest)]
    trie = DoubleArray.of(levels, len(seqs), 9)
    known = {s[:d] for s in seqs for d in range(1, len(s) + 1)}
    slots = {}
    for _ in range(3000):
        s = tuple(rng.integers(0, 9, rng.integers(1, 7)).tolist())
        at = np.array([0])
        for x in s:
            at = trie.step(at, np.array([x])) if at[0] >= 0 else at
        assert (at[0] >= 0) == (s in known)
        if at[0] >= 0:
            assert slots.setdefault(int(at[0]), s) == s
    for s in seqs:
        at = np.array([0])
        for x in s:
            at = trie.step(at, np.array([x]))
        assert at[0] > 0
    assert np.count_nonzero(trie.check >= 0) == len(known) + 1


# ------------------------------------------------------------------ periodic runs
def brute_runs(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, q, m) for (s, m), q in out.items())


def word_lists():
    rng = random.Random(1)
    lists = [[], [0], [1] * 5, [1] * 6, [1] * 400, [0, 1] * 300, [0, 0, 1] * 50 + [0, 0, 1, 0], list(range(50))]
    for _ in range(400):
        w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([3, 7, 30, 80, 200]))]
        if rng.random() < 0.7:
            part = [rng.randrange(3) for _ in range(rng.randint(1, 12))] * rng.randint(1, 30)
            at = rng.randrange(len(w))
            w[at:at] = part[: rng.randint(1, len(part))]
        lists.append(w)
    return lists


def test_runs_equal_brute_force():
    lists = word_lists()
    runs = periodic.find_runs([np.array(w, np.int64) for w in lists])
    found = defaultdict(list)
    for d, s, m, q in zip(runs.doc.tolist(), runs.start.tolist(), runs.length.tolist(), runs.period.tolist()):
        found[d].append((s, q, m))
    assert [found[k] for k in range(len(lists))] == [brute_runs(w) for w in lists]


def test_grammar_extensions_equal_word_by_word():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 3, 90), np.tile(rng.integers(0, 2, 7), 30), np.zeros(60, np.int64), rng.integers(0, 40, 200)]
    text = [-1]
    for k, p in enumerate([*parts, parts[0], parts[1][3:]]):
        text += [*p.tolist(), -2 - k]
    text = np.array(text)
    grammar = Grammar(text)
    i, j = rng.integers(1, len(text) - 1, (2, 4000))
    i, j = i[i != j], j[i != j]
    for forward, sign in ((True, 1), (False, -1)):
        got = grammar.extend(i, j, forward)
        for a, b, n in zip(i.tolist(), j.tolist(), got.tolist()):
            m = 0
            while 0 <= a + sign * m < len(text) and 0 <= b + sign * m < len(text) and text[a + sign * m] == text[b + sign * m] and text[a + sign * m] >= 0:
                m += 1
            assert n == m


def brute_digest(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    drop = {i for s, q, m in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
            sha("".join(f"{s},{m},{q}\n" for s, q, m in sorted(runs)).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_run_digest_equals_brute_force(spark, corpus, corpus_rows, nothing):
    rows = [r[:2] for r in corpus_rows] + [(1000 + k, " ".join("w%d" % x for x in w)) for k, w in enumerate(word_lists()[:120])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_runs", F.lit("x")).repartition(4)
    got = [tuple(r) for r in periodic.run_digest(df, periodic.planted).collect()]
    assert sorted(map(repr, got)) == sorted(repr(brute_digest(*r)) for r in rows)
    assert periodic.run_digest(nothing, periodic.planted).count() == 0
    assert len(periodic.run_digest(corpus).collect()) == len(corpus_rows)


def test_collapse_runs_keeps_rows_and_columns(spark):
    rows = [(1, "a " * 9 + "end"), (2, None), (3, "x y z"), (4, "a  b\n" * 5)]
    out = {r.doc_id: r for r in periodic.collapse_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[k].collapsed for k in (1, 2, 3, 4)] == ["a end", "", "x y z", "a b"]
    assert [out[k].text for k, _ in rows] == [t for _, t in rows]


# ------------------------------------------------------------------ quality
def quality_rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    rows, labels = [], []
    for i in range(900):
        kind = rng.choice(["good", "good", "signs", "loud", "pipe", "again"])
        w = [rng.choice(["the", "of", "and", word()]) for _ in range(rng.randint(20, 120))]
        text = {"good": lambda: " ".join(w) + ".", "signs": lambda: " ".join(x + "***" for x in w), "loud": lambda: " ".join(w).upper() + "!!",
                "pipe": lambda: " | ".join(w), "again": lambda: " ".join([w[0]] * 40)}[kind]()
        rows.append((i, text, "en", "s", 1, 0.5))
        labels.append((i, int(kind == "good"), 0))
    return rows, labels


def test_quality_on_held_out_rows_and_odd_ones(spark, nothing):
    rows, labels = quality_rows()
    rows += [(5000, None, "en", "s", 1, 0.5), (5001, "", None, None, 1, 0.5), (None, "no id", "en", "s", 1, 0.5), rows[0], (5002, " \n", "en", "s", 1, 0.5),
             (5003, "the of and " * 20000, "en", "s", 1, 0.5)]
    labels += [(0, None, 0), (None, 1, 0), (777777, 0, 0), (5000, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, label int, score double").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality.learn_and_score(docs, known).collect()
    assert len(out) == len(rows)
    truth = {i: q for i, q, _ in labels[:900]}
    held = [r for r in out if r.doc_id in truth and r.held_out]
    assert {r.held_out for r in out if r.doc_id is not None} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert len({r.score for r in out if r.doc_id in (5000, 5001, 5002)}) == 1
    again = {r.doc_id: r.score for r in quality.learn_and_score(docs.repartition(7), known).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-4 for r in out)
    assert quality.learn_and_score(nothing, known).count() == 0
    assert {r.score for r in quality.learn_and_score(docs, known.limit(0)).collect()} == {0.5}


def test_context_sums_equal_counting_by_hand(spark):
    texts = ["the cat the dog", "", "Dog cat-cat", "alone", None]
    words = [*quality.CLASSES, "cat", "dog", "the"]
    docs = spark.createDataFrame([(i, t or "") for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    place, sign = quality.index_vectors(words)
    want = np.zeros((len(words), quality.DIM))
    for line in (["the", "cat", "the", "dog"], ["dog", "cat", "<sign>", "<same>"]):
        for a, x in enumerate(line):
            for b, y in enumerate(line):
                if 0 < abs(a - b) <= quality.WINDOW:
                    for k in range(quality.NONZERO):
                        want[words.index(x), place[words.index(y), k]] += sign[words.index(y), k]
    assert (quality.context_sums(docs, words) == want).all()


def test_network_gradients_and_temperature():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 5)), rng.integers(0, 2, 40).astype(float)
    net = quality.Network(x.mean(0), x.std(0), rng.normal(size=(5, 3)), rng.normal(size=3), rng.normal(size=3), 0.2)
    _, grads = quality.loss_and_gradient(net, x, y)
    for name, grad in zip(("w1", "b1", "w2"), grads):
        value = getattr(net, name)
        for at in np.ndindex(value.shape):
            side = []
            for step in (1e-6, -1e-6):
                moved = value.copy()
                moved[at] += step
                setattr(net, name, moved)
                side.append(quality.loss_and_gradient(net, x, y)[0])
            setattr(net, name, value)
            assert abs((side[0] - side[1]) / 2e-6 - grad[at]) < 1e-6
    logits = rng.normal(size=20000)
    seen = (rng.random(20000) < 1 / (1 + np.exp(-logits / 3))).astype(float)
    assert abs(quality.temperature(logits, seen) - 3) < 0.3


# ------------------------------------------------------------------ nearest vectors of different length
def test_vectors_of_another_length_take_no_part(spark):
    from cyclewise.llm import rpforest

    rng = np.random.default_rng(6)
    good = {i: rng.normal(size=4).tolist() for i in range(30)}
    rows = [*good.items(), (100, [1.0, 2.0]), (101, [1.0] * 7), (102, []), (103, None), (104, [3.0] * 7)]
    found = rpforest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, k=3).collect()
    assert {r.query_id for r in found} == {0, 10, 20} and {r.vec_id for r in found} <= set(good)
    alone = rpforest.search(spark.createDataFrame(list(good.items()), "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, k=3).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, alone))
