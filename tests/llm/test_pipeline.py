"""The whole pipeline against its stages written out one document at a time."""

import corpus_pipeline
from chromasea.llm import spans
from llm_helpers import SF, docs_of, frame, words
from test_texts import prose, shingle_set, slow_components
from test_tokens import WORD, check_packing


def slow_spans(docs):
    """docs: (id, text) with distinct ids. Texts without the sentences under a run that came before."""
    seen, out = set(), []
    for key, text in sorted(docs):
        starts, counts, hashes = spans.sentences(text)
        covered, own = set(), []
        for i in range(len(counts)):
            j = i + spans.RUN_SENTENCES
            while j <= len(counts) and sum(counts[i:j]) < spans.RUN_WORDS:
                j += 1
            if j > len(counts):
                break
            run = tuple(hashes[i:j])
            if run in seen:
                covered.update(range(i, j))
            seen.add(run)
            own.append(run)
        ends = [*starts[1:], len(text)]
        out.append((key, "".join(text[a:b] for n, (a, b) in enumerate(zip(starts, ends)) if n not in covered) if len(counts) else text))
    return out


def slow_pipeline(docs, items):
    docs = [(k, t) for k, t in docs if any(c.isalpha() for c in t or "")]
    first = {k for k, _, c in slow_components(docs) if k == c}
    docs = slow_spans([d for d in docs if d[0] in first])
    sets = [shingle_set(t) for t in items]
    kept = []
    for key, text in docs:
        own = shingle_set(text)
        if not any(s and 10 * len(own & s) >= 8 * len(s) for s in sets):
            kept.append((key, text))
    return kept


def test_run(spark):
    docs = [(r.doc_id, r.text) for r in docs_of(spark).collect()]
    items = [r.text for r in docs_of(spark, "benchmark").collect()]
    wanted = slow_pipeline(docs, items)
    assert 0 < len(wanted) < len(docs)
    check_packing(corpus_pipeline.run(spark, SF).collect(), wanted, WORD, 2048)


def test_stages_keep_columns_and_awkward_rows(spark, awkward):
    passage = prose(1, 8)
    docs = frame(spark, [*awkward, (50, " ".join(prose(2, 5) + passage)), (51, " ".join(passage + prose(3, 6))), (52, " ".join(words(50, 3)))]).selectExpr("*", "1 AS _key", "2 AS rank", "'x' AS languages")
    ids = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_key", "rank", "languages"]
        ids.append(sorted(r.doc_id for r in docs.collect() if r.doc_id is not None))
    assert ids[0] == [3, 4, 5, 6, 7, 8, 9, 10, 10, 50, 51, 52] and ids[1] == ids[2] == ids[3] == [3, 4, 5, 6, 8, 9, 10, 50, 51, 52]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {*ids[3], None}


def test_stages_of_nothing(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0 if "piece" in docs.columns else docs.columns[:2] == ["doc_id", "text"]
