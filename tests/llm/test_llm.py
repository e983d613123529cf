"""The training-data operators: SQL, brute force, round trips, held-out accuracy, and odd inputs."""

import base64
import collections
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from modelpulse.llm import byte_bpe, decontamination, fixity, html_text, license_scan, line_dedup, near_dedup, quality, substring_dedup, toxicity
from modelpulse.llm.catalogue import ORACLE, QUERIES
from modelpulse.sources.tables import load
from tests.oracle import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in load(spark, sf_dir, "documents").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, equal rows, names that the operators use themselves."""
    long = "Word after word goes by. " * 20_000
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", "en", "s", 1), (3, long, "en", "s", 2), (4, "a b", None, "s", 3)]
    rows += [(5, "same text here, again and again\nline", "en", "s", 4)] * 2 + [(6, " \t\n\n ", "xx", "s", 5)]
    extra = ["_doc", "_key", "_norm", "_gone", "_others", "n_words", "hits", "digest", "kept", "toxic", "_text", "n_lines", "labels", "score", "removed"]
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in extra])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def brute_base(text):
    words = WORD.findall(text or "")
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_base_rules(spark, sf_dir, texts):
    rows = QUERIES["op2_quality_rules"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_kneser_ney_adds_up_and_both_scorings_agree(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the cat sat on the mat. the hat", "en"), (2, "le chat et le chien", "fr"), (3, "", None)], "doc_id bigint, text string, lang string")
    model = quality.kneser_ney(quality.count_ngrams(docs)).where("cost IS NOT NULL")
    # Seen continuations and the backoff of a context make one: p of the seen ones alone is at most one.
    sums = model.where("n = 4").groupBy("lang", F.shiftrightunsigned("gram", 16).alias("h")).agg(F.sum(F.exp(-F.col("cost") / 1e6)).alias("p"))
    assert all(0 < r.p <= 1.00001 for r in sums.collect())
    unigrams = model.where("n = 1").groupBy("lang").agg(F.sum(F.exp(-F.col("cost") / 1e6)).alias("p")).collect()
    assert all(abs(r.p - 1) < 1e-4 for r in unigrams)
    sent = quality.score(docs).orderBy("doc_id").collect()
    monkeypatch.setattr(quality, "MAX_SHIPPED", 0)
    assert quality.score(docs).orderBy("doc_id").collect() == sent


def test_both_scorings_agree_on_a_held_out_model(spark, monkeypatch):
    schema = "doc_id bigint, text string, lang string"
    model = quality.kneser_ney(quality.count_ngrams(spark.createDataFrame([(1, "the cat sat on the mat. the hat", "en")], schema)))
    docs = spark.createDataFrame([(2, "the zebra sat: qqq \u2603\u2603", "en"), (3, "le chat", "fr"), (4, "the cat", "en"), (5, None, "en")], schema)
    sent = quality.score(docs, model=model).orderBy("doc_id").collect()
    monkeypatch.setattr(quality, "MAX_SHIPPED", 0)
    assert quality.score(docs, model=model).orderBy("doc_id").collect() == sent
    assert [r.micronats == 20_000_000 * r.n_grams for r in sent] == [False, True, False, True]


def test_perplexity_bands_reject_another_language(spark):
    r = random.Random(3)
    speak = lambda alphabet: " ".join("".join(r.choice(alphabet) for _ in range(r.randrange(2, 8))) for _ in range(200))
    rows = [(i, speak("etaoinshr"), "en") for i in range(60)] + [(60, speak("zqxjkvwyp"), "en")]
    got = quality.quality_verdicts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert {r.doc_id for r in got if not r.kept} == {60}


def test_bands_reject_labelled_junk(spark):
    """Of the labelled texts of the larger table that pass the base rules, nearly all low ones go and nearly all good ones stay."""
    docs, labels = (load(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got = quality.quality_verdicts(docs).where("NOT base_failed").join(labels, "doc_id", "left")
    n = {(r.quality, r.littered): r for r in got.groupBy("quality", (F.col("n_symbols") > 0.3 * F.col("n_words")).alias("littered")).agg(F.count("*").alias("all"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    total = lambda keep, what: sum(getattr(r, what) for k, r in n.items() if keep(*k))
    for keep, least, most in ((lambda q, s: q == 0, 0, 0.1), (lambda q, s: s, 0, 0.02), (lambda q, s: q == 1, 0.99, 1)):
        share = total(keep, "kept") / total(keep, "all")
        print(total(keep, "kept"), "of", total(keep, "all"), "kept")
        assert least <= share <= most


def brute_kneser_ney(texts, order=4):
    """Probabilities of the interpolated modified Kneser-Ney model by its definition, from strings."""
    grams = {order: collections.Counter(t[i : i + order] for t in texts for i in range(len(t) - order + 1))}
    for n in range(order - 1, 0, -1):
        grams[n] = collections.Counter(g[1:] for g in grams[n + 1])
    p = {"": 1 / len(grams[1])}
    for n in range(1, order + 1):
        c = grams[n]
        n1, n2, n3, n4 = (sum(v == k for v in c.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0
        off = []
        for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
            d = k - (k + 1) * y * b / a if n1 and n2 and a else 0
            off.append(d if 0 < d < k else 0.5)
        for g, v in c.items():
            same = [x for h, x in c.items() if h[:-1] == g[:-1]]
            gamma = sum(off[min(x, 3) - 1] for x in same) / sum(same)
            p[g] = (v - off[min(v, 3) - 1]) / sum(same) + gamma * p[g[1:]]
    return p


def test_kneser_ney_equals_its_definition(spark):
    texts = ["the cat sat on the mat. the hat", "a cat and a hat sat, that is that", "mad as a hatter"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    want = brute_kneser_ney(texts)
    rows = quality.kneser_ney(quality.count_ngrams(docs)).where("cost IS NOT NULL").collect()
    assert len(rows) == len(want) - 1
    for r in rows:
        packed = r.gram & (1 << 64) - 1
        gram = "".join(chr(packed >> 16 * k & 0xFFFF) for k in range(r.n - 1, -1, -1))
        assert abs(r.cost - -1e6 * math.log(want[gram])) <= 1, gram


def test_lower_band_rejects_a_list_of_common_words(spark):
    """Nothing in it repeats, so the base rules pass it, but every next letter is what the model expects most."""
    r = random.Random(4)
    common, rare = ["the", "and", "of"], ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 9))) for _ in range(400)]
    prose = lambda: " ".join(r.choice(common) if r.random() < 0.3 else r.choice(rare) for _ in range(300))
    easy = " ".join(r.choice(common) for _ in range(26))
    rows = [(i, prose(), "en") for i in range(80)] + [(80, easy, "en")]
    got = {x.doc_id: x for x in quality.quality_verdicts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not got[80].base_failed and not got[80].kept
    assert got[80].log_perplexity < min(x.log_perplexity for n, x in got.items() if n != 80)
    assert all(x.kept for n, x in got.items() if n != 80)


def test_quality_of_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "some words", "en", 7, 8, 9)], "doc_id bigint, text string, lang string, low int, high int, _low int")
    row = quality.quality_verdicts(docs).first()
    assert (row.low, row.high, row._low, row.kept) == (7, 8, 9, False)


def test_a_text_is_not_scored_by_its_own_ngrams(spark):
    docs = spark.createDataFrame([(i, "word after word goes by", "en") for i in range(5)] + [(9, "qqzz xxyy", "en")], "doc_id bigint, text string, lang string")
    model = quality.held_out_model(docs)
    for r in docs.select(quality.model_key(docs, "text", "lang", False).alias("key"), "text").distinct().collect():
        own = set(quality.signed(quality.char_ngrams(quality.read([r.text], lower=True))[0]).tolist())
        assert not own & {m.gram for m in model.where((F.col("lang") == r.key) & (F.col("n") == 4)).collect()}


def test_byte_bpe_equals_tiktoken(spark, sf_dir, texts):
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op4_byte_bpe"](spark, sf_dir).collect():
        ids = other.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    coder, rand = byte_bpe.Coder(byte_bpe.public_vocabulary()), random.Random(1)
    for _ in range(500):
        text = "".join(rand.choice("ab e\n\t é日🎉'sdthé.,!?  0123ÿ\x00") for _ in range(rand.randrange(150)))
        assert coder.encode(text) == other.encode_ordinary(text)
    assert coder.encode("a" * 30_000) == other.encode_ordinary("a" * 30_000)


def test_perfect_hash_is_minimal():
    keys = [b"k%d" % i for i in range(5000)]
    table = byte_bpe.PerfectHash(keys)
    assert sorted(map(table.slot, keys)) == list(range(5000))
    assert table.slot(b"other") == -1


def test_license_scan(spark, sf_dir, texts):
    token = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in QUERIES["op5_license_scan"](spark, sf_dir).collect():
        words = token.findall((texts[r.doc_id] or "").translate(FOLD))
        places = [(i, label) for phrase, label in license_scan.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_rules(spark):
    assert len(license_scan.rules()) > 300
    cases = {
        "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
        "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
        "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
        "mit freundlichen Grüßen": "",
        "GNU General Public License, version 3": "gpl",
    }
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")).orderBy("doc_id")
    assert [r.labels for r in got.collect()] == list(cases.values())


def alternatives(pattern):
    """All strings that a pattern of literals, sets, groups, branches and options stands for."""
    from re import _constants as C, _parser

    def of(parsed):
        out = [""]
        for op, value in parsed:
            if op is C.LITERAL:
                here = [chr(value)]
            elif op is C.IN:
                here = [chr(c) for kind, v in value for c in (range(v[0], v[1] + 1) if kind is C.RANGE else [v])]
            elif op is C.SUBPATTERN:
                here = of(value[3])
            elif op is C.BRANCH:
                here = [x for branch in value[1] for x in of(branch)]
            else:
                assert op is C.MAX_REPEAT and value[:2] == (0, 1)
                here = ["", *of(value[2])]
            out = [a + b for a in out for b in here]
        return out

    return of(_parser.parse(pattern))


def test_license_gates_pass_every_alternative(spark):
    forms = [alternatives(form.replace("{name}", "@")) for _, form in license_scan.FORMS]
    for _, key, name in license_scan.LICENSES:
        assert all(key in f" {x} " for x in alternatives(name)), name
    assert all(any(stem in f" {x} " for stem in license_scan.STEMS) for form in forms for x in form)
    for _, _, key, pattern in license_scan.TEXTS:
        assert all(key in x and any(stem in f" {x} " for stem in license_scan.STEMS) for x in alternatives(pattern)), pattern
    texts = [(x.split("@")[0] + name + x.split("@")[1], label) for label, _, pattern in license_scan.LICENSES for name in alternatives(pattern) for x in forms[0][:1]]
    texts += [(x.replace("@", "vim"), "vim") for form in forms for x in form]
    texts += [(x, label) for _, label, _, pattern in license_scan.TEXTS for x in alternatives(pattern)]
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(texts)], "doc_id bigint, text string").repartition(8)
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(rows).collect()}
    assert [text for i, (text, _) in enumerate(texts) if not got[i]] == []
    # What is found in place of a rule's own label is a longer or more exact name of the same words.
    assert sum(label not in got[i].split(",") for i, (_, label) in enumerate(texts)) < len(texts) / 20


def test_short_and_spaced_license_names(spark):
    cases = {
        "Licensed under GPLv2": "gpl-2.0-short",
        "Licensed under the GNU GPLv3.": "gpl-3.0-short",
        "released under LGPLv3": "lgpl",
        "released under AGPLv3": "agpl-3.0-short",
        "Licensed under the GPL": "gpl",
        "Licensed under the GNU General Public License": "gpl",
        "License: Creative Commons Attribution-Share Alike 3.0": "cc-by-sa-3.0",
        "License: Creative Commons Attribution-Non-Commercial 4.0": "cc-by-nc-4.0",
        "License: Creative Commons Attribution-NoDerivs": "cc-by-nd-4.0",
        "Unauthorized copying of this file": "proprietary",
        "Neither the name of the copyright holder": "bsd-3-clause",
    }
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")).orderBy("doc_id")
    assert [r.labels for r in got.collect()] == list(cases.values())


def brute_components(texts, percent):
    sets = {}
    for n, text in texts.items():
        w = WORD.findall((text or "").translate(FOLD))
        sets[n] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    parent = {n: n for n in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: (len(sets[n]), root(n)) for n in sets}


def test_near_duplicates_equal_brute_force(spark, sf_dir, texts):
    got = QUERIES["op10_near_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_dense_group_of_near_copies_keeps_every_link(spark, monkeypatch):
    """Copies of one text with a few changed words each: most pairs lie near the threshold."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rand, base = random.Random(5), [f"w{i}" for i in range(120)]
    rows = {}
    for n in range(90):
        words = list(base)
        for _ in range(rand.randrange(1, 5)):
            words[rand.randrange(120)] = f"x{rand.randrange(10**6)}"
        rows[n] = " ".join(words)
    got = near_dedup.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id bigint, text string"), percent=85)
    want = brute_components(rows, 85)
    assert {r.doc_id: r.component_id for r in got.collect()} == {n: c for n, (_, c) in want.items()}


def test_decontamination_finds_planted_items_only(spark):
    rand = random.Random(2)
    item = lambda: " ".join(f"t{rand.randrange(300)}" for _ in range(rand.randrange(15, 150)))
    items = {i: item() for i in range(30)}
    docs = {n: item() for n in range(40)}
    planted = set()
    for n in range(0, 40, 4):
        docs[n] = docs[n] + ". " + items[n % 30].upper() + " " + item()
        planted.add((n, n % 30))
    got = decontamination.contaminated(
        spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    )
    assert {(r.doc_id, r.item_id) for r in got.collect()} == planted


def test_block_max_wand_equals_exhaustive_search():
    rand = random.Random(4)
    postings = [(i, 0, t, rand.random() / 8) for i in range(200) for t in rand.sample(range(60), 12)]
    index = decontamination.Index(postings, {i: [1] for i in range(200)})
    weight = {(i, t): w for i, _, t, w in postings}
    for _ in range(50):
        terms = sorted(rand.sample(range(60), 20))
        want = {i for i in range(200) if sum(weight.get((i, t), 0) for t in terms) >= 0.4}
        assert {index.item[p] for p, _ in index.search(terms, 0.4)} == want


def test_toxicity_on_held_out_labels(spark):
    """A quarter of the labels of the larger table is held out; a few hundred rows teach too little."""
    docs, labels = (load(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    labels = labels.withColumn("low_quality", 1 - F.col("quality"))
    test = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(4)) == 0
    got = toxicity.flag_toxic(docs, labels.where(~test), ["low_quality", "toxic"])
    rows = got.join(labels.where(test).select("doc_id", F.col("toxic").alias("is")), "doc_id").collect()
    right = sum(r.toxic == bool(r["is"]) for r in rows)
    clean = [r for r in rows if not r["is"]]
    assert right >= 0.95 * len(rows), (right, len(rows))
    assert sum(not r.toxic for r in clean) >= 0.98 * len(clean), (sum(r.toxic for r in clean), len(clean))


def test_substring_dedup_removes_later_copies(spark):
    rand = random.Random(6)
    talk = lambda n: " ".join(f"{rand.choice('abcdefgh')}{rand.randrange(10**4)}" + ("." if rand.random() < 0.15 else "") for _ in range(n)) + "."
    passage = talk(70)
    docs = {n: talk(60) for n in range(20)}
    for n in (3, 8, 15):
        docs[n] = docs[n] + "\n" + passage + "\n" + talk(40)
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r.doc_id: r for r in substring_dedup.drop_repeated_sentences(frame).collect()}
    assert {n for n, r in got.items() if r.n_removed} == {8, 15}
    assert got[8].first_docs == got[15].first_docs == [3]
    for n in (8, 15):
        assert WORD.findall(got[n].text) == WORD.findall(docs[n].replace(passage, ""))
    assert all(got[n].text == docs[n] for n in docs if n not in (8, 15))


def test_substring_dedup_finds_a_long_sentence_alone(spark):
    line = " ".join(f"item{i}" for i in range(60))
    short = " ".join(f"thing{i}" for i in range(40))
    docs = [(n, f"Before {n} it was.\n{line}\n{short}\nAfter {n} it is.") for n in (1, 2)]
    got = {r.doc_id: r for r in substring_dedup.drop_repeated_sentences(spark.createDataFrame([(n, t.replace(short, f"{short} {n}")) for n, t in docs], "doc_id bigint, text string")).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 1 and got[2].first_docs == [1]
    assert line not in got[2].text and short in got[2].text


def test_substring_dedup_of_different_texts_under_one_id(spark):
    passage = " ".join(f"word{i}." for i in range(30))
    own = " ".join(f"other{i}." for i in range(40))
    docs = [(1, passage), (2, own + " " + passage), (2, "Just one sentence."), (2, " ".join(f"more{i}." for i in range(80)))]
    got = substring_dedup.drop_repeated_sentences(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((r.text.strip(), r.n_removed) for r in got) == sorted([(passage, 0), (own, 30), (docs[2][1], 0), (docs[3][1], 0)])


def test_decontamination_of_items_without_or_with_shared_ids(spark):
    rand = random.Random(7)
    item = lambda: " ".join(f"t{rand.randrange(10**6)}" for _ in range(40))
    a, b, c, d = (item() for _ in range(4))
    items = spark.createDataFrame([(None, a), (1, b), (1, c), (2, d), (3, d)], ITEMS)
    docs = spark.createDataFrame([(i, f"{item()} {x} {item()}") for i, x in enumerate((a, b, c, d, item()))], "doc_id bigint, text string")
    assert [r.doc_id for r in decontamination.keep_uncontaminated(docs, items).collect()] == [4]
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(0, None), (1, 1), (2, 1), (3, 2), (3, 3)}


def test_html_text(spark, sf_dir):
    page = (
        "<html><head><title>t</title><script>var a='<p>';</script></head><body><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies.</div>"
        "<article><h1>Big &amp; small</h1><p>First  paragraph,\nwith <b>bold</b> words.<p>Second &lt;one&gt;.</p></article><div id=comments><p>Nice!</p></div><footer>(c)</footer>"
    )
    rows = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", page)], "page_id bigint, url string, html string")
    got = html_text.extract_text(load(spark, sf_dir, "pages").select("page_id", "url", "html").unionByName(rows)).collect()
    text = "Big & small\nFirst paragraph, with bold words.\nSecond <one>."
    assert sum(r.text == text for r in got) == 2 and sum(r.text == "" and r.n_chars == 0 for r in got) == 2
    assert all(r.n_chars == len(r.text) for r in got)


def test_minimum_cut_equals_exhaustive():
    rand = random.Random(8)
    for _ in range(60):
        n = rand.randrange(1, 8)
        source, sink = [rand.randrange(20) for _ in range(n)], [rand.randrange(20) for _ in range(n)]
        edges = [(a, b, rand.randrange(1, 12)) for a in range(n) for b in range(a + 1, n) if rand.random() < 0.5]
        cost = lambda side: sum(sink[i] if side[i] else source[i] for i in range(n)) + sum(c for a, b, c in edges if side[a] != side[b])
        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert cost(html_text.minimum_cut(source, sink, edges)) == best


def test_fixity_audit_finds_changed_missing_and_extra(spark):
    rows = [(i // 50, i % 50 * 40_000, 40_000, f"d{i}") for i in range(200)]
    other = [r if r[3] != "d77" else (*r[:3], "bad") for r in rows if r[3] != "d120"] + [(9, 0, 5, "new")]
    schema = "archive bigint, offset bigint, length bigint, digest string"
    got = fixity.fixity_audit(spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)).collect()
    assert {(r.archive, r.offset, r.status) for r in got} == {(1, 27 * 40_000, "changed"), (2, 20 * 40_000, "missing"), (9, 0, "extra")}
    assert fixity.fixity_audit(spark.createDataFrame(rows, schema), spark.createDataFrame(rows, schema)).count() == 0
    none = spark.createDataFrame([], schema)
    assert fixity.fixity_audit(none, none).count() == 0


def test_fixity_audit_of_odd_rows(spark):
    """Several records at one offset, repeated rows, null values and columns named as the audit's own."""
    schema = "archive bigint, offset bigint, length bigint, digest string, node string, status int, hash string, _tie int"
    rows = [(1, 0, 5, d, None, 1, "h", 2) for d in ("a", "b", "b", "c")] + [(2, 9, 5, "x", "n", None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    assert fixity.fixity_audit(frame, frame).count() == 0
    other = spark.createDataFrame([*rows[:2], *rows[3:]], schema)
    got = fixity.fixity_audit(frame, other)
    assert got.columns == ["archive", "offset", "status", "length", "digest", "node", "hash", "_tie"]
    assert sorted((r.archive, r.offset, r.status, r.digest) for r in got.collect()) == [(1, 0, "changed", "b"), (1, 0, "missing", "c")]


ITEMS = "item_id bigint, text string"


def everything(spark, docs):
    items = spark.createDataFrame([(1, "some item of the test with words"), (None, "x y z"), (2, None), (3, "")], ITEMS)
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 1), (None, 1, 1), (4, None, 1), (3, 0, 1)], "doc_id bigint, low_quality int, toxic int")
    return {
        "quality": quality.quality_verdicts(docs),
        "good": quality.keep_good(docs),
        "bpe": byte_bpe.encode_texts(docs, byte_bpe.public_vocabulary()),
        "license": license_scan.scan_licenses(docs),
        "lines": line_dedup.drop_repeated_lines(docs),
        "near": near_dedup.near_duplicates(docs),
        "one": near_dedup.keep_one(docs),
        "leaks": decontamination.contaminated(docs, items),
        "clean": decontamination.keep_uncontaminated(docs, items),
        "toxic": toxicity.flag_toxic(docs, labels, ["low_quality", "toxic"]),
        "spans": substring_dedup.drop_repeated_sentences(docs),
        "html": html_text.extract_text(docs.withColumn("html", F.col("text")).drop("text")),
        "warc": fixity.warc_records(docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))),
    }


def test_odd_rows_have_defined_results(spark, odd):
    n = odd.count()
    got = {k: v.collect() for k, v in everything(spark, odd).items()}
    for name in ("quality", "bpe", "license", "lines", "near", "toxic", "spans", "html", "warc"):
        assert len(got[name]) == n, name
    assert got["leaks"] == [] and len(got["clean"]) == n and len(got["one"]) == n and got["good"] == []
    near = {r.doc_id: r for r in got["near"]}
    assert near[1].component_id == 1 and near[1].n_shingles == 0 and near[5].component_id == 5
    assert near[None].kept and near[None].component_id is None
    assert not any(r.toxic for r in got["toxic"] if r.doc_id == 2)
    assert {r.text for r in got["lines"] if r.doc_id in (1, 2)} == {""}


def test_empty_tables(spark, empty):
    assert all(v.count() == 0 for v in everything(spark, empty).values())


def test_pipeline_stages(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    good = corpus_pipeline.quality_rules(spark, docs, sf_dir)
    assert good.columns == docs.columns
    kept = {r.doc_id for r in QUERIES["op2_quality_rules"](spark, sf_dir).where("kept").collect()}
    assert {r.doc_id for r in good.select("doc_id").collect()} == kept
    result = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in result.collect()} <= kept and result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_stages_one_by_one(spark, sf_dir, texts):
    """What each stage after the first does to the whole table, against brute force."""
    docs = load(spark, sf_dir, "documents")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    seen = collections.Counter(k for t in texts.values() for k in {key(x) for x in (t or "").split("\n")} if k)
    want = {n: "\n".join(x for x in (t or "").split("\n") if seen[key(x)] < 10) for n, t in texts.items()}
    lined = corpus_pipeline.line_dedup(spark, docs, sf_dir)
    assert lined.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in lined.collect()} == {n: (t, len(t)) for n, t in want.items()}
    assert any(t != want[n] for n, t in texts.items())
    near = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    assert near.columns == docs.columns
    assert {r.doc_id for r in near.select("doc_id").collect()} == {n for n, (_, c) in brute_components(texts, 80).items() if n == c}
    items = [r.text for r in load(spark, sf_dir, "benchmark").collect()]
    kept = {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, sf_dir).select("doc_id").collect()}
    words = {n: WORD.findall((t or "").translate(FOLD)) for n, t in texts.items()}
    asked = [WORD.findall(i.translate(FOLD)) for i in items]
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    some = set().union(*(grams(w, 4) for w in asked))
    holds = {n for n, w in words.items() if any(" ".join(i) in " ".join(w) for i in asked)}
    clean = {n for n, w in words.items() if not grams(w, 4) & some}
    assert holds and clean and not holds & kept and clean <= kept
    tokens = corpus_pipeline.byte_bpe(spark, docs, sf_dir).collect()
    assert sorted(r.doc_id for r in tokens) == sorted(texts)
    assert all(r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest() for r in tokens)
