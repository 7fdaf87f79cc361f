import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import SF, docs_of, frame, words

from pyspark.sql import functions as F

from chromasea.llm import containment, graph, mixture, partenum, rules, spans
from chromasea.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

ASCII_SPACE = " \t\n\v\f\r"


def split(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in ASCII_SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, width=5):
    w = split(lower(text))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


# Rule ledger


def slow_measures(text):
    text, w = text or "", split(text)
    lines = [x for x in text.split("\n") if split(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_measures():
    r = random.Random(1)
    bits = ["a", "b", "c d", "\n", " ", "|", "é\xa0", "\n\n", "a b a b", "\x1c", "x y z x y z"]
    for _ in range(500):
        text = " ".join(r.choice(bits) for _ in range(r.randrange(30)))
        assert rules.measure_text(text) == slow_measures(text), repr(text)
    assert rules.measure_text(None) == rules.measure_text("") == (0,) * 6


def test_ledger_and_ablations(spark, awkward):
    rows = rules.ledger(rules.measure(frame(spark, awkward)))
    assert rows.count() == len(awkward)
    got = rules.apply_policies(rows).collect()
    names = [n for n, _ in rules.RULES]
    counts = Counter()
    for r in got:
        failing = [n for i, n in enumerate(names) if r.failed >> i & 1]
        assert r.kept_v1 == (not failing) and r.kept_base == (not {"few_words", "repeated_words"} & set(failing))
        for n in failing:
            counts[n, "failing"] += 1
            counts[n, "failing_alone"] += len(failing) == 1
            counts[n, "failing_with_others"] += len(failing) > 1
    for r in rules.ablations(rows, rules.POLICIES["v1"]).collect():
        assert all(r[k] == counts[r.rule, k] for k in ("failing", "failing_alone", "failing_with_others"))
    assert rules.ablations(rules.ledger(rules.measure(frame(spark, []))), rules.POLICIES["v1"]).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    status, note = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert status == "ok", note


# Containment


def test_span_reports_replace_a_column_of_the_name(spark):
    repeated = "One two three four five six seven. Eight nine ten eleven twelve thirteen. Some more words stand in here now. "
    docs = frame(spark, [(1, repeated), (2, "Alpha beta. " + repeated), (3, repeated + repeated), (None, repeated + repeated), (4, None), (5, "")])
    odd = docs.withColumn("N_removed", F.lit("clash")).withColumn("_hashes", F.lit(1))
    got = {r.doc_id: (r.n_removed, r.text) for r in spans.remove_repeated(odd, report=True).collect()}
    assert got[1] == (0, repeated) and got[2] == (3, "Alpha beta. ") and got[3] == (6, "") and got[4] == (0, None) and got[5] == (0, "")
    assert got[None] == (3, repeated) and "N_removed" in spans.remove_repeated(odd).columns


def test_containment(spark, awkward):
    items = [(1, " ".join(words(40, 5))), (2, "one TWO three"), (3, "One"), (4, ""), (5, None), (6, " ".join(words(9, 6))), (7, " ".join(words(40, 5)))]
    base = split(items[0][1])
    docs = awkward + [
        (20, " ".join(words(900, 7) + base + words(900, 8))), (21, " ".join(base[:34])), (22, " ".join(base[:30])), (23, "x y one two three z"),
        (24, items[0][1].upper()), (25, " ".join(words(9, 6)[:8])), (26, " ".join(words(9, 6)[:4])), (20, "another row"),
    ]
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = Counter((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in containment.contaminated(frame(spark, docs), bench).collect())
    wanted = Counter()
    for key, text in docs:
        for item, item_text in items:
            s = shingle_set(item_text)
            width = min(5, len(split(item_text)))
            w = split(lower(text))
            mine = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} & s if s else set()
            if s and 10 * len(mine) >= 8 * len(s):
                wanted[key, item, len(s), len(mine)] += 1
    assert got == wanted and wanted[21, 1, 36, 30]
    kept = containment.without_contaminated(frame(spark, docs), bench)
    assert kept.columns == frame(spark, docs).columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(d for d in docs if d[0] not in (3, 4, 20, 21, 23, 24, 25) or d[1] == "another row")


@pytest.mark.parametrize("limit", [200_000, 0])
def test_repeated_items_ids_with_two_texts_and_capitals(spark, monkeypatch, limit):
    monkeypatch.setattr(containment, "BROADCAST_ROWS", limit)  # 0: all joins are by shuffle
    one, two = " ".join(words(26, 5)), " ".join(words(30, 6))
    items = [(1, one), (1, one), (2, one), (2, two), (2, "only three words"), (None, one), (3, "École des Élèves à Paris"), (4, " ".join(words(10, 5)))]
    docs = [
        (10, "before " + one + " behind"), (11, " ".join(words(26, 5)[:16]) + " " + " ".join(words(60, 9))), (12, one + " x " + two), (13, one + " " + two + " only three words"),
        (14, "l'école des élèves à paris"), (15, "x ÉCOLE"), (16, "y École DES Élèves À paris"), (17, "z École DES Élèves à PARIS"), (10, "before " + one + " behind"),
    ]
    bench = spark.createDataFrame(items, "item_id int, text string").withColumn("width", F.lit("clash"))
    got = Counter((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in containment.contaminated(frame(spark, docs), bench).collect())
    shingles = defaultdict(set)
    for item, text in items:
        if item is not None:
            shingles[item] |= shingle_set(text)
    wanted = Counter()
    for key, text in docs:
        w = split(lower(text))
        for item, s in shingles.items():
            n = len({g for g in s if any(tuple(w[i:i + len(g)]) == g for i in range(len(w)))})
            if 10 * n >= 8 * len(s):
                wanted[key, item, len(s), n] += 1
    assert got == wanted and wanted[10, 1, 22, 22] == 2 and (17, 3, 1, 1) in wanted and (16, 3, 1, 1) not in wanted
    status, note = compare_rows(spark, docs, items)
    assert status == got, note


def compare_rows(spark, docs, items):
    """The registered SQL over rows of the test."""
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    rows = con.execute(ORACLES["op5_benchmark_containment"]).fetchall()
    # The SQL counts rows of an id once, as documents of one id are one in it.
    return Counter({(d, i, n, k): sum(x == d for x, _ in docs) for d, i, n, k, _ in rows}), rows


def test_containment_of_nothing(spark, awkward):
    none = spark.createDataFrame([], "item_id int, text string")
    assert containment.contaminated(frame(spark, awkward), none).count() == 0
    assert containment.without_contaminated(frame(spark, awkward), none).count() == len(awkward)
    assert containment.contaminated(frame(spark, []), spark.createDataFrame([(1, "a b c d e f")], "item_id int, text string")).count() == 0


# Near duplicates


def slow_components(docs):
    sets = defaultdict(list)
    for key, text in docs:
        if key is not None:
            sets[key].append(shingle_set(text))
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            for s in sets[a]:
                for t in sets[b]:
                    both = len(s & t)
                    if both and 100 * both >= 80 * (len(s) + len(t) - both):
                        x, y = find(a), find(b)
                        parent[max(x, y)] = min(x, y)
    return Counter((k, len(s), find(k)) for k in sets for s in sets[k])


def variants(seed, n, size, edits):
    r, base = random.Random(seed), words(size, seed)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_components_of_variants(spark, awkward):
    texts = [t for seed, size in enumerate((6, 9, 14, 30, 60, 150, 400)) for t in variants(seed, 25, size, max(1, size // 25))]
    shared = " ".join(words(60, 99))
    texts += [f"{shared} {' '.join(words(20, 200 + i))}" for i in range(40)]
    docs = awkward + [(100 + i, t) for i, t in enumerate(texts)] + [(500, texts[3]), (501, texts[3].upper()), (10, texts[0])]
    random.Random(3).shuffle(docs)
    got = partenum.similar_components(frame(spark, docs)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == slow_components(docs)
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]


def test_components_query(spark):
    docs = [(r.doc_id, r.text) for r in docs_of(spark).collect()]
    got = QUERIES["op8_ngram_jaccard_join"](spark, SF).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == slow_components(docs)


def test_one_of_each(spark, awkward):
    kept = partenum.one_of_each(frame(spark, awkward + [(30, "Same TEXT here")])).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [0, 1, 2, 3, 4, 5, 6, 8, 9, 10]
    assert sum(r.doc_id is None for r in kept) == 2
    assert partenum.one_of_each(frame(spark, [])).count() == 0


def test_blocks_are_compared_in_full(spark):
    texts = variants(3, 60, 60, 3)
    sets = [partenum.shingles(t) for t in texts]
    docs = list(enumerate(texts))
    groups = {2**10 | 5: range(60), 2**11 | 5: range(20), 2**12 | 5: [7], 2**13 | 5: [3, 50]}
    rows = spark.createDataFrame([(s, n, n, len(g)) for s, g in groups.items() for n in g], "sig long, node long, component long, size long")
    sketches = partenum.sketches_of(frame(spark, docs), rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = sorted(map(tuple, partenum.block_pairs(rows, sketches, block=8).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    links = {(a, b) for a in range(60) for b in range(a + 1, 60) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert links and links <= set(got) and len(got) == len(set(got)) < 60 * 59 / 2


def test_sketches_of_several_lengths_are_compared_at_once():
    r = np.random.default_rng(7)
    length = [6, 6, 9, 6, 9, 9, 6, 9]
    sketches = [bytes(r.integers(0, 3, k).astype(np.uint8)) for k in length]
    n = np.array([9, 18, 27, 30, 12, 40, 22, 31])
    pairs = [(a, b) for a in range(8) for b in range(8) if a != b and length[a] == length[b]]
    x, y = map(np.array, zip(*pairs))
    got = partenum._near(x, y, n, partenum._by_width(pa.array([b"0", *sketches], pa.binary()).slice(1)))
    assert got.tolist() == [sum(p != q for p, q in zip(sketches[a], sketches[b])) <= (n[a] + n[b]) // 9 for a, b in pairs]
    assert got.any() and not got.all()


def test_shingles_are_distinct_sorted_and_depend_on_order():
    words_ = [f"w{i % 7}" for i in range(40)]
    assert len(partenum.shingles(" ".join(words_))) == len({tuple(words_[i : i + 5]) for i in range(36)})
    both = [partenum.shingles(" ".join(w)) for w in (["a", "b", "c", "d", "e", "f"], ["a", "c", "b", "d", "e", "f"], ["a", "b", "c"], ["a", "b", "c", "d"])]
    assert len(np.unique(np.concatenate(both))) == 6 and all((np.diff(b) > 0).all() for b in both)
    # Sets whose words are the same in another order have other keys.
    assert len({partenum._key(partenum.shingles(t)) for t in ("a b c d x y e f g h", "a b c d y x e f g h")}) == 2


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(1)
    for _ in range(1500):
        n = int(r.integers(1, 400))
        pool = r.integers(0, 2**63, 2 * n + 2).astype(np.uint64)
        a = set(pool[:n].tolist())
        gone = int(r.integers(0, n // 5 + 2))
        b = set(list(a)[gone:]) | set(pool[n : n + int(r.integers(0, n // 5 + 2))].tolist())
        if a and b and a != b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = (set(partenum.signatures(np.array(sorted(s), np.uint64)).tolist()) for s in (a, b))
            assert x & y, (len(a), len(b), len(a & b))


def test_shared_signatures_across_batches(spark):
    r = random.Random(1)
    rows = [(r.randrange(300), r.randrange(40)) for _ in range(2000)] + [(10_000 + i, i) for i in range(500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = partenum.shared_signatures(spark.createDataFrame(rows, "sig long, doc_id long")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    groups = defaultdict(set)
    for s, d in rows:
        groups[s].add(d)
    assert sorted(map(tuple, got)) == sorted((s, d) for s, ds in groups.items() if len(ds) > 1 for d in ds)


def test_graph_components(spark):
    r = random.Random(5)
    links = [(i, i + 1) for i in range(200, 260)] + [(r.randrange(100), r.randrange(100)) for _ in range(60)] + [(5, 5), (7, 3), (3, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((k, find(k)) for k in parent)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Sentence spans


def prose(seed, n):
    r = random.Random(seed)
    return [" ".join(f"p{seed}x{r.randrange(900)}" for _ in range(r.randrange(4, 25))) + r.choice(". ! ?".split()) for _ in range(n)]


def test_repeated_passages(spark, awkward):
    passage = prose(1, 8)
    docs = awkward + [
        (50, " ".join(prose(2, 5) + passage + prose(3, 5))), (51, " ".join(prose(4, 5) + passage + prose(5, 4))), (52, "\n".join(prose(6, 3) + passage + prose(6, 3)[:1])),
        (53, " ".join(prose(7, 10))), (54, " ".join(prose(8, 4) + passage[:1] + prose(9, 4))), (55, " ".join(prose(10, 5) + passage + passage)),
    ]
    got = {r.doc_id: r for r in spans.remove_repeated(frame(spark, docs), report=True).collect()}
    before = dict(docs)
    assert {k for k in got if k is not None and got[k].n_removed} == {7, 51, 52, 55}
    for key in (50, 53, 54, 0, 1, 2, 3, 4, 5, 6, 8, 9, 10):
        assert got[key].text == before[key] and got[key].n_removed == 0
    for key in (51, 52, 55):
        assert sum(p in got[key].text for p in passage) <= 1 and got[key].n_chars == len(got[key].text)
    assert all(p in got[51].text for p in prose(4, 5) + prose(5, 4))
    assert got[7].text == ""


def test_spans_against_every_run(spark):
    """The same decisions from a list of all runs of all documents."""
    docs = [(r.doc_id, r.text) for r in docs_of(spark).collect()]
    first, hits = {}, defaultdict(set)
    for key, text in sorted(docs):
        starts, counts, hashes = spans.sentences(text)
        for i in range(len(counts)):
            j = i
            while j < len(counts) and (j - i < spans.RUN_SENTENCES or sum(counts[i:j]) < spans.RUN_WORDS):
                j += 1
            if j - i < spans.RUN_SENTENCES or sum(counts[i:j]) < spans.RUN_WORDS:
                break
            run = tuple(hashes[i:j])
            if run in first:
                hits[key].update(range(i, j))
            first.setdefault(run, key)
    got = {r.doc_id: r.n_removed for r in QUERIES["op7_sentence_spans"](spark, SF).collect()}
    assert got == {k: len(hits.get(k, ())) for k, _ in docs} and hits


def test_passages_at_any_offset_in_a_sentence(spark):
    """50 words without a sentence end, behind any number of words: found as by windows of raw words."""
    passage = [f"q{i * i % 83}r{i % 7}" for i in range(50)]
    docs = [(k, " ".join([f"a{k}x{i}" for i in range(k)] + passage + [f"b{k}x{i}" for i in range(3 * k % 17)])) for k in range(21)]
    docs += [(30 + k, " ".join([*prose(30 + k, 2), f"c{k}", *["d"] * k, *passage, f"e{k}.", *prose(60 + k, 2)])) for k in range(3)]
    seen, expected = set(), {}
    for key, text in docs:
        w = split(text)
        windows = {tuple(w[i : i + 50]) for i in range(len(w) - 49)}
        expected[key], seen = bool(windows & seen), seen | windows
    got = {r.doc_id: r for r in spans.remove_repeated(frame(spark, docs), report=True).collect()}
    assert {k: r.n_removed > 0 for k, r in got.items()} == expected and sum(expected.values()) == len(docs) - 1
    for key, text in docs[1:]:
        kept = split(got[key].text)
        # Everything around stays, and of the passage less than two parts at either end.
        assert [x for x in split(text) if x not in passage] == [x for x in kept if x not in passage]
        assert sum(x in passage for x in kept) < 4 * spans.PART_WORDS
        assert sum(x in passage for x in kept) <= 50 - spans.RUN_WORDS


def test_every_passage_of_fifty_words_has_a_common_run():
    r = random.Random(4)
    for n in range(300):
        passage = [f"v{r.randrange(30 if n % 2 else 3000)}" + r.choice(["", "", "", "", ".", "\n"] if n % 3 == 0 else [""]) for _ in range(50)]
        found = []
        for side in "ab":
            text = " ".join([f"{side}{i}" for i in range(r.randrange(25))] + passage + [f"z{side}{i}" for i in range(r.randrange(25))])
            found.append(set(spans.runs(*spans.sentences(text)[1:])[1].tolist()))
        assert found[0] & found[1], passage


def test_spans_of_nothing(spark):
    assert spans.remove_repeated(frame(spark, [])).count() == 0


# Languages


def test_languages(spark):
    docs = docs_of(spark)
    got = QUERIES["op9_language_mixture"](spark, SF).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_mixtures_and_awkward_texts(spark, awkward):
    model = mixture.train(docs_of(spark))
    texts = {}
    for r in docs_of(spark).collect():
        texts.setdefault(r.lang, r.text[:1500])
    both = f"{texts['en']} {texts['de']}"
    found, shares = model.shares(both)
    assert set(found) == {"en", "de"} and abs(sum(shares) - 1) < 1e-6 and min(shares) > 0.3
    assert model.shares(texts["fr"])[0] == ["fr"]
    rows = mixture.languages_of(frame(spark, awkward), model).collect()
    assert [r.doc_id for r in rows if not r.languages and r.doc_id is not None] and len(rows) == len(awkward)
    empty = mixture.predict(frame(spark, []))
    assert empty.count() == 0
    kept = mixture.with_language(frame(spark, awkward).withColumnRenamed("source", "languages"))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 4, 5, 6, 7, 8, 9, 10, 10] and "languages" in kept.columns


def test_nothing_learned(spark):
    rows = mixture.predict(frame(spark, [(1, "abc")]).selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]


def plain_trigrams(text):
    small = (text or "").lower()
    if not any(c.isalpha() for c in small):
        return []
    letters, was = [" "], False
    for c in small:
        if c.isalpha():
            letters.append(c)
        elif was:
            letters.append(" ")
        was = c.isalpha()
    letters.append(" ")
    out = []
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        mixed = (ord(a) * 0x9E3779B1 + ord(b) * 0x85EBCA77 + ord(c) * 0xC2B2AE3D) % 2**32
        out.append((mixed ^ mixed >> 15) * 0x85EBCA77 % 2**32 >> 17)
    return out


def plain_fit(grams, odds):
    """Shares and mean log likelihood by expectation maximisation, gram by gram."""
    share = {k: 1 / len(odds) for k in odds}
    total = sum(grams.values())
    for _ in range(mixture.STEPS if len(odds) > 1 else 0):
        new = dict.fromkeys(odds, 0.0)
        for g, n in grams.items():
            whole = sum(odds[k][g] * share[k] for k in odds)
            for k in odds:
                new[k] += n / total * odds[k][g] * share[k] / whole
        done = max(abs(new[k] - share[k]) for k in odds) < 1e-4
        share = new
        if done:
            break
    return share, sum(n / total * np.log(sum(odds[k][g] * share[k] for k in odds)) for g, n in grams.items())


def test_language_mixture_by_brute_force(spark):
    """Counting, expectation maximisation and the removal of languages written plainly."""
    import zlib

    docs = [(r.doc_id, r.text, r.lang) for r in docs_of(spark).collect() if len(r.text or "") < 2500]
    mixed = [(9000 + i, f"{a[1]} {b[1]}", None) for i, (a, b) in enumerate(zip(docs[:6], docs[6:12]))]
    docs += [*mixed, (9100, None, "en"), (9101, "12 34", "de"), (9102, "ß", None)]
    counts, fold = defaultdict(Counter), {k: zlib.crc32(str(k).encode()) % 5 == 0 for k, _, _ in docs}
    for key, text, lang in docs:
        if not fold[key] and lang is not None and text is not None:
            counts[lang].update(plain_trigrams(text))
    odds = {k: [(c[g] + mixture.SMOOTHING) / (sum(c.values()) + mixture.SMOOTHING * mixture.BUCKETS) for g in range(mixture.BUCKETS)] for k, c in sorted(counts.items())}
    expected = {}
    for key, text, _ in docs:
        grams = Counter(plain_trigrams(text))
        n = sum(grams.values())
        if not n:
            expected[key] = ("und", 0.0)
            continue
        left = dict(odds)
        share, fit = plain_fit(grams, left)
        while True:
            small = {k for k in left if share[k] < min(mixture.LEAST_SHARE, max(share.values()))}
            if small:
                left = {k: v for k, v in left.items() if k not in small}
                share, fit = plain_fit(grams, left)
            if len(left) == 1:
                break
            least = min(left, key=lambda k: share[k])
            fewer = {k: v for k, v in left.items() if k != least}
            share_1, fit_1 = plain_fit(grams, fewer)
            if (fit - fit_1) * n / mixture.OVERLAP > 0.5 * np.log(n):
                break
            left, share, fit = fewer, share_1, fit_1
        first = max(left, key=lambda k: share[k])
        logs = {k: sum(m * np.log(odds[k][g]) for g, m in grams.items()) / mixture.OVERLAP for k in odds}
        chance = {k: np.exp(v - max(logs.values())) for k, v in logs.items()}
        expected[key] = (first, share[first] * chance[first] / sum(chance.values()))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("shares", F.lit("clash"))
    got = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in mixture.predict(df).collect()}
    assert got.keys() == expected.keys() and {k: v[0] for k, v in got.items()} == fold
    assert {k: v[1] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    assert all(got[k][2] == pytest.approx(expected[k][1], abs=1e-6) for k in expected)
