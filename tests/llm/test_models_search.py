import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.llm import html_text, langid, licenses, ngrams, rpforest, toxicity
from cyclewise.llm.common import crc_fold
from cyclewise.llm.levenshtein import OPEN_STEM, STEM, WORD, LexiconAutomaton, edits_allowed

from test_dedup_mix_pack import AZ, key


# ------------------------------------------------------------------ language ID
def test_language_id(corpus, corpus_rows, nothing):
    out = langid.learn_and_identify(corpus).collect()
    assert len(out) == len(corpus_rows)
    rows = {r[0]: r for r in corpus_rows if r[0] != 3}
    right = [r.lang_pred == rows[r.doc_id][2] for r in out if r.doc_id in rows and rows[r.doc_id][2] and len(rows[r.doc_id][1] or "") > 60]
    assert np.mean(right) > 0.9
    for r in out:
        if r.doc_id in rows and not any(c.isalpha() for c in rows[r.doc_id][1] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert 0 <= r.score <= 1
    assert langid.identify(nothing, langid.fit(nothing)).count() == 0
    assert {r.lang_pred for r in langid.identify(corpus, langid.fit(nothing)).collect()} == {"und"}


def test_foreign_texts_are_dropped_at_any_length(spark):
    rng = np.random.default_rng(4)
    word = lambda low, high: "".join(map(chr, rng.integers(low, high, rng.integers(2, 9))))
    texts = [" ".join(word(0x430, 0x450) for _ in range(n)) for n in (50, 250, 1000, 5000) for _ in range(4)]
    texts += [" ".join([word(0x5D0, 0x5EB) for _ in range(n)] + ["ana"]) for n in (50, 1000)]  # one known word
    h = rng.integers(0, 2**64, 12000, dtype=np.uint64)
    model = langid.LanguageFilter(["en"], np.array([9]), np.zeros(1 << 18, np.uint8), np.zeros(1))
    low, owner, _ = ngrams.letters(["banana ananas"])
    for part in (h, *(ngrams.hashes(low, owner, n)[0] for n in langid.SIZES)):
        for p in model.positions(part):
            model.slices[p] |= np.uint8(1)
    model.false_rate[0] = (np.count_nonzero(model.slices) / len(model.slices)) ** langid.HASHES
    rows = list(enumerate([*texts, "banana", "ananas banana " * 500, "banana " + word(0x430, 0x450)]))
    kept = langid.drop_unknown(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert sorted(r.doc_id for r in kept) == [len(texts), len(texts) + 1, len(texts) + 2]


def test_filter_holds_all_grams_and_few_others():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    model = langid.LanguageFilter(["a", "b"], np.array([1, 1]), np.zeros(1 << 16, np.uint8), np.zeros(2))
    for k, part in enumerate((h[:2000], h[1000:])):
        for p in model.positions(part):
            model.slices[p] |= np.uint8(1 << k)
    found = model.lookup(h)
    assert ((found[:2000] & 1) > 0).all() and ((found[1000:] & 2) > 0).all()
    assert (model.lookup(rng.integers(0, 2**63, 20000, dtype=np.uint64)) > 0).mean() < 0.02


def test_ngrams_stay_in_texts_and_words():
    texts = ["Ab, cd", "", "12", "éa"]
    low, owner, has = ngrams.letters(texts)
    assert has.tolist() == [True, False, False, True]
    assert "".join(map(chr, low[owner == 0])) == " ab cd "
    h, who = ngrams.hashes(low, owner, 3)
    assert sorted(who.tolist()) == [0, 0, 0, 0, 3, 3]  # " ab", "ab ", " cd", "cd " and " éa", "éa "


# ------------------------------------------------------------------ toxicity
def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(prev + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_automaton_against_distances():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("abc", k=n))
    terms = sorted({(word(rng.randint(3, 11)), rng.choice([WORD, STEM, OPEN_STEM])) for _ in range(12)})
    auto = LexiconAutomaton(terms)
    for _ in range(600):
        w = word(rng.randint(1, 13))
        best = None
        for t, kind in terms:
            if kind == WORD:
                d = distance(w, t)
            else:
                d = min((distance(w[:n], t) for n in range(1, len(w) + (kind == STEM))), default=99)
            if d <= edits_allowed(len(t)):
                best = d if best is None else min(best, d)
        got = auto.match(w)
        assert (got and got[0]) == best, (w, got, best)


def test_context():
    looks = toxicity._Looks(LexiconAutomaton([("idiot", WORD)]))
    plain = toxicity.find_hits("you are an idiiot today", looks)
    assert plain[:3] == ([0], [1], [1.0])
    quoted = toxicity.find_hits('the judge said: "you idiot", and left', looks)
    assert quoted[2][0] < 0.3
    assert toxicity.find_hits(None, looks) == ([], [], [], 0)


def test_toxicity_held_out(spark, corpus, nothing):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(240):
        words = ["".join(rng.choices("aeioustrn", k=rng.randint(2, 7))) for _ in range(rng.randint(8, 60))]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["scoundrel", "blockhead"]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks + [(5, None), (None, 1)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.learn_and_score(docs, labels).collect()}
    held = [i for i in out if out[i].held_out]
    assert held and all(out[i].predicted == marks[i][1] for i in held)
    model = toxicity.fit(docs, labels)
    odd = toxicity.score(corpus, model).collect()
    assert len(odd) == corpus.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(nothing, model).count() == 0
    empty = toxicity.fit(docs, labels.limit(0))
    assert empty.terms == [] and toxicity.score(docs, empty).count() == 240


# ------------------------------------------------------------------ licences
def places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
    found = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), sorted(found)


TEXTS = [
    None, "", "!!", "Under the MIT license", "under the mit license under THE mit license.", "Apache License, Version 2.0 and cc by nc cc-by-nc cc by nc sa 4.0",
    "xunder the mit license", "under the mit licensed", "Licensed under the GNU General Public License, version 3 or any later version", "ünder the mit license",
    "All rights reserved. Released under the Apache License, Version 2.0", "SPDX-License-Identifier: BSD-3-Clause", "mit license mit license", "a" * 50 + " " + "cc by nc " * 400,
    "der Mann mit dem Hut", "cc by nc",
]


def test_license_scan(spark, nothing):
    rows = [(i, t, 9, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 9, "x"), (None, TEXTS[4], 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, labels string")
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows)
    brute = {}
    for i, t in enumerate(TEXTS):
        n, found = places(t)
        starts = [x for x, _ in found]
        brute[t] = (n, len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))
    want = [(i, *brute[t]) for i, t, *_ in rows]
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=key) == sorted(want, key=key)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[8] == "gpl-3-or-later" and labels[11] == "bsd-3-clause" and labels[14] == "" and labels[12] == "mit"
    assert labels[10] == "all-rights-reserved,apache-2"
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert licenses.scan(nothing).count() == 0


def test_license_rules_find_their_own_names():
    assert len(licenses.rules()) > 200
    for text in (" licensed  under  the  mozilla  public  license  version  2  0 ", " see  the  mozilla  public  license  version  2  0 "):
        assert {"mpl-2", "mpl"} == {r["label"] for r in licenses.rules() if re.search(r["pattern"], text)}


# ------------------------------------------------------------------ nearest vectors
def brute_nearest(rows, k, is_query):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float)
    out = {}
    for q in filter(is_query, good):
        scores = [(-round(float(good[q] @ x / np.linalg.norm(good[q]) / np.linalg.norm(x)), 12), i) for i, x in good.items() if i != q]
        out[q] = [i for _, i in sorted(scores)[:k]]
    return out


def test_nearest_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    rows[7] = (7, rows[50][1])
    rows += [(1000 + i, rows[100][1]) for i in range(30)]  # copies of a query's own vector: ties
    rows += [(2000, None), (2050, [0.0] * 8), (2100, [None] + [1.0] * 7), (2150, [float("nan")] + [1.0] * 7), (2200, [float("inf")] + [1.0] * 7), (None, [1.0] * 8),
             (2250, [1e-300] * 8), (2300, [1e300] * 8), rows[3]]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = rpforest.search(df, F.col("vec_id") % 50 == 0, k=5).collect()
    want = brute_nearest(rows, 5, lambda i: i % 50 == 0)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == set(want) and all(len(v) == 5 for v in found.values())
    assert np.mean([len(set(found[q]) & set(want[q])) / 5 for q in want if q < 2000]) >= 0.9
    assert found[100] == [1000, 1001, 1002, 1003, 1004]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r["rank"], r.vec_id) for r in rpforest.search(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 2), (2, 1)]
    assert rpforest.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# ------------------------------------------------------------------ HTML
PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><!-- x -->"
    "<div class=\"ad\">Buy this now.</div><article><h1>A &amp; B</h1><p>First  par&shy;agraph\n of <b>the</b> text&nbsp;here.<br>More <i>of it</p>"
    "<script>var t='</p>';</script><p>{body}</article><footer>&copy; someone</footer></body></html>"
)


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        body = "<p>".join(" ".join("".join(rng.choices("aeioustrn", k=5)) for _ in range(rng.randint(5, 50))) + "." for _ in range(rng.randint(1, 9)))
        rows.append((i, f"http://x/{i}", PAGE.replace("{body}", body), "q"))
    rows += [(60, None, None, "q"), (61, "u", "", "q"), (62, "u", "<b>", "q"), rows[0], (63, "u", "<article><p>" + "long words here. " * 20000 + "</article>", "q"), (None, "u", rows[1][2], "q")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


def test_blocks():
    blocks = html_text.blocks_of(PAGE.replace("{body}", "Last &lt;one&gt;"))
    assert [b.text for b in blocks] == ["Home", "Buy this now.", "A & B", "First par\xadagraph of the text here. More of it", "Last <one>", "© someone"]
    assert blocks[0].linked == 4 and blocks[2].path[-2:] == ("article", "h1")
    assert html_text.blocks_of(None) == [] and html_text.blocks_of("<p") != 1


def test_gradient():
    model, rng = html_text.Labeller(), np.random.default_rng(0)
    d = html_text.PATH_DIMS + html_text.WORD_DIMS + html_text.EXTRA
    seqs = [rng.normal(0, 0.3, (n, d)).astype(np.float32) for n in (3, 5)]
    marks = [np.array([1, 0, 1.0]), np.array([0, 1, 0, 1, 1.0])]
    _, g = model.gradient(seqs, marks)
    for k in ("fh", "bh", "fc", "bc", "out", "skip"):
        at = np.unravel_index(int(np.argmax(np.abs(g[k]))), g[k].shape)
        old = model.p[k][at]
        loss = []
        for e in (0.01, -0.01):
            model.p[k][at] = old + e
            loss.append(model.gradient(seqs, marks)[0])
        model.p[k][at] = old
        assert abs((loss[0] - loss[1]) / 0.02 - g[k][at]) < 0.02 * abs(g[k][at]) + 1e-4


def test_whole_tag_path_is_read():
    deep = ("html", "body", "section.comments", *["ul", "li"] * 6, "p")
    plain = ("html", "body", "section", *["ul", "li"] * 6, "p")
    assert (html_text._path_vector(deep) != html_text._path_vector(plain)).any()
    assert html_text.named_label(deep) == 0


def test_pages_without_names_keep_their_article(spark):
    words = "the river runs past old mills and quiet fields where people walk on long warm days".split()
    rows = []
    for i in range(40):
        paragraphs = "".join(f"<p>{' '.join(words[(i + k + j) % len(words)] for j in range(25 + k))}.</p>" for k in range(5))
        rows.append((i, f"u{i}", f"<html><body><div>{paragraphs}</div></body></html>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = html_text.extract(pages, html_text.fit(pages)).collect()
    assert len(out) == 40
    assert all(r.n_kept == r.n_blocks == 5 for r in out)


def test_extract(pages):
    model = html_text.fit(pages, sample_pages=40)
    out = {r.page_id: r for r in html_text.extract(pages, model).collect()}
    assert html_text.extract(pages, model).count() == pages.count()
    for r in pages.collect():
        if r.page_id is not None and r.page_id < 60:
            want = [b.text for b in html_text.blocks_of(r.html) if "article" in b.path]
            assert out[r.page_id].text == "\n\n".join(want) and out[r.page_id].n_chars == len(out[r.page_id].text)
    assert out[60].text == out[61].text == out[62].text == ""
    other = ("<div class=header><h1>Site</h1></div><div class='menu'><ul><li><a>One</a><li><a>Two</a></ul></div><div class='post-content'><p>Aeio ustr nasto riu, "
             "astor noi usta rino. Sati ronu stai.</p><p>Another one of these, with a few more words in it.</p></div><div id=sidebar><p>Try our app</p></div>"
             "<section id=comments><div class=comment><p>Nice text, thank you for it.</p></div></section><form><label>Name</label></form><div class=footer>Legal</div>")
    blocks = html_text.blocks_of(other)
    kept = [b.text for b, p in zip(blocks, model.probabilities([html_text.vectors(blocks)])[0], strict=True) if p >= 0.5]
    assert kept == [b.text for b in blocks if any(x.startswith("div.post") for x in b.path)]
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0


def test_folds(spark):
    import zlib

    df = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 3 for r in df.select("doc_id", crc_fold(F.col("doc_id"), 3).alias("f")).collect())


# ------------------------------------------------------------------ licence prefilter
def test_license_prefilter_keeps_what_rules_match(spark):
    texts = ["This code is under GPL v2.", "Use is subject to the MPL 2.0.",
             "permission is hereby granted. Permission to use copy modify and or distribute this\nsoftware for any purpose", "under the sun we discuss examples"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(docs).collect()} == {0: "gpl-2", 1: "mpl-2", 2: "isc", 3: ""}


# ------------------------------------------------------------------ licence keywords
def spellings(pattern):
    """Every string that a pattern without repetition matches."""
    def of(tokens):
        out = [""]
        for op, arg in tokens:
            op = str(op)
            if op == "LITERAL":
                some = [chr(arg)]
            elif op == "IN":
                some = [chr(c) for kind, x in arg for c in (range(x[0], x[1] + 1) if str(kind) == "RANGE" else [x])]
            elif op == "SUBPATTERN":
                some = of(arg[-1])
            elif op == "BRANCH":
                some = [x for branch in arg[1] for x in of(branch)]
            else:
                assert op == "MAX_REPEAT" and arg[:2] == (0, 1), op
                some = ["", *of(arg[2])]
            out = [a + b for a in out for b in some]
        return out

    return of(re._parser.parse(pattern))


def test_license_keywords_are_in_every_match():
    for r in licenses.rules():
        for text in spellings(r["pattern"]):
            assert any(k in text for k in r["first"]), (r["label"], text)
            assert any(k in text for k in r["second"]) or r["priority"] == 2, (r["label"], text)  # 2: a bare name


def test_license_scan_agrees_without_its_prefilter(spark):
    rules = licenses.rules()
    texts = ["This code is under GPL v2.", "Use is subject to the MPL 2.0.", "Licence : MIT", "Released under terms of MIT", "see the Creative Commons License BY 4.0",
             "permission to use copy modify and or distribute this\nsoftware for any purpose", "der Mann mit dem Hut", "under the sun we discuss examples"]
    for r in rules:
        some = spellings(r["pattern"])
        texts += [("\n" if r["rule"] % 2 else "-").join(x.split()).capitalize() for x in {min(some, key=len), max(some, key=len)}]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.rule) for r in licenses.detections(docs).select("doc_id", "rule").distinct().collect()}
    named = {r["rule"] for r in rules if r["second"] == ["license", "licence"]}
    want = set()
    for i, t in enumerate(texts):
        words = "".join(f" {w} " for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(AZ)))
        want |= {(i, r["rule"]) for r in rules if re.search(r["pattern"], words) and (r["rule"] not in named or "license" in words or "licence" in words)}
    assert got == want
    labels = {i: {rules[n]["label"] for d, n in got if d == i} for i in range(8)}
    assert [sorted(labels[i]) for i in range(8)] == [["gpl", "gpl-2"], ["mpl", "mpl-2"], ["mit"], ["mit"], ["cc-by"], ["isc"], [], []]
