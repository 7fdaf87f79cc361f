"""The registered queries of the subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_warc_revisits", """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    w AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS original FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN original <> page_id THEN original END AS refers_to FROM w""")
def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back."""
    from chromasea.llm.warc import deduplicated_archives, read_archives

    records = read_archives(deduplicated_archives(table(spark, sf_dir, "pages")))
    return records.select(F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_token_ids")
def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as compressed token ids, read back from the shards."""
    from chromasea.llm.idsfile import read_ids, write_ids

    shards, dictionary = write_ids(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return read_ids(shards, dictionary)


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    from chromasea.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


_MEASURES = """
    WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    g AS (SELECT doc_id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) >= 2),
    c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
    l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
                 coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
          FROM w LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id))"""


@query("op4_rule_ledger", f"""{_MEASURES},
    f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * word_chars < 25 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines) AS kept
    FROM f""")
def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents under the current policy."""
    from chromasea.llm.rules import POLICIES, fails, ledger, measure

    rows = ledger(measure(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        fails(POLICIES["base"]).alias("base_failed"), (~fails(POLICIES["v1"])).alias("kept"),
    )


_V1 = ("few_words", "n_words < 50"), ("repeated_words", "100 * n_repeat_words > 50 * n_words"), ("short_mean_word", "10 * word_chars < 25 * n_words"), \
    ("long_mean_word", "word_chars > 15 * n_words"), ("many_symbols", "10 * n_symbols > n_words"), ("repeated_lines", "100 * n_dup_lines > 30 * n_lines")


@query("ledger_ablations", f"""{_MEASURES},
    f AS (SELECT {', '.join(f'({sql}) AS {name}' for name, sql in _V1)} FROM m),
    n AS (SELECT *, {' + '.join(f'{name}::BIGINT' for name, _ in _V1)} AS n_failed FROM f)
    SELECT * FROM ({' UNION ALL '.join(
        f"SELECT '{name}' AS rule, count(*) FILTER ({name}) AS failing, count(*) FILTER ({name} AND n_failed = 1) AS failing_alone, "
        f"count(*) FILTER ({name} AND n_failed > 1) AS failing_with_others, count(*) FILTER (n_failed = 0) AS kept, "
        f"count(*) FILTER (n_failed = 0 OR ({name} AND n_failed = 1)) AS kept_without FROM n" for name, _ in _V1)})""")
def ledger_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy does to all documents, from the stored ledger: kept with it, and without it."""
    from chromasea.llm.rules import POLICIES, ablations, apply_policies, ledger, measure
    from chromasea.llm.shared import materialise

    rows = materialise(ledger(measure(table(spark, sf_dir, "documents"))), "ledger")
    kept = apply_policies(rows, {"v1": POLICIES["v1"]}).agg(F.count_if("kept_v1").alias("kept")).first().kept
    return ablations(rows, POLICIES["v1"]).withColumns({"kept": F.lit(kept).cast("long"), "kept_without": F.lit(kept) + F.col("failing_alone")})


@query("op7_sentence_spans")
def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of repeated passages, and how many went."""
    from chromasea.llm.spans import remove_repeated

    return remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"), report=True)


@query("op8_ngram_jaccard_join")
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size of every document's shingle set, and the component of similar ones it is in."""
    from chromasea.llm.partenum import similar_components

    return similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_benchmark_containment", """
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
    b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
    bi AS (SELECT item_id, w, least(len(w), 5) AS k FROM b WHERE len(w) > 0),
    bs AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM bi)),
    bn AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
    ks AS (SELECT DISTINCT k FROM bs),
    ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
    m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (k, s) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM m JOIN bn USING (item_id) WHERE 10 * n_shared >= 8 * n_item""")
def op5_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    from chromasea.llm.containment import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_language_mixture")
def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main language of every document's mixture."""
    from chromasea.llm.mixture import predict

    return predict(table(spark, sf_dir, "documents"))


@query("op6_rule_ensemble")
def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    from chromasea.llm.rulefit import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_attention_lm")
def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document under the word model and the attention model."""
    import public_tokenizers

    from chromasea.llm.lmscore import score

    return score(table(spark, sf_dir, "documents"), (tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def _kmeans_sql(k: int = 8, rounds: int = 10) -> str:
    """Assignment and means by turns, a pair of CTEs a round."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    steps = [
        """WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
               WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n, x FROM v ORDER BY sha256('3:' || vec_id) LIMIT {k})",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT v.vec_id, v.x, min(({distance}, c.n)) AS best FROM v, c{r} c GROUP BY ALL)"
        )
        if r < rounds:
            steps.append(
                f"c{r + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (SELECT n, list(floored ORDER BY i) AS x FROM "
                f"(SELECT n, i, (s - ((s % q) + q) % q) // q AS floored FROM (SELECT best[2] AS n, i, sum(x[i])::BIGINT AS s, count(*) AS q "
                f"FROM a{r}, range(1, 65) d(i) GROUP BY ALL)) GROUP BY n) m USING (n))"
            )
    return ", ".join(steps) + f"""
        SELECT vec_id, best[2]::INTEGER AS cluster, best[1]::BIGINT AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
               (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON c.n = a.best[2]"""


@query("op11_threshold_centroids", _kmeans_sql())
def op11_threshold_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after ten rounds of means."""
    from chromasea.llm.centroids import cluster

    return cluster(table(spark, sf_dir, "embeddings"))


@query("op12_main_text")
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from chromasea.llm.maintext import extract

    return extract(table(spark, sf_dir, "pages"))


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda a, b:
    list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query("op13_prefix_trie", f"""
    WITH t AS (SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS u,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS i
               FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT c, list(u ORDER BY i) AS own, ({_CRC32} % 9)::BIGINT AS h FROM t GROUP BY c),
    s AS (SELECT a.c, list_concat(coalesce(b.own, [])[1:a.h], a.own[a.h + 1:]) AS turns FROM o a LEFT JOIN o b ON b.c = a.c - a.c % 5),
    m AS MATERIALIZED (SELECT c, d, sha256(turns[1:d]::JSON::VARCHAR) AS node, CASE WHEN d > 0 THEN sha256(turns[1:d - 1]::JSON::VARCHAR) END AS parent,
                 CASE WHEN d > 0 THEN strlen(turns[d].t) ELSE 0 END AS bytes, len(turns) = d AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM s)),
    n AS MATERIALIZED (SELECT node, parent, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS own,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY ALL),
    k AS MATERIALIZED (SELECT parent, count(*) AS n_children FROM n GROUP BY parent),
    p AS (SELECT DISTINCT a.node, a.d, b.node AS below, b.d AS below_d FROM m a JOIN m b ON a.c = b.c AND b.d >= a.d),
    g AS (SELECT p.node, p.d, count(*) FILTER (k.parent IS NULL) AS n_leaves, sum(n.own)::BIGINT AS saved_tokens
          FROM p JOIN n ON n.node = p.below AND n.d = p.below_d LEFT JOIN k ON k.parent = n.node GROUP BY ALL)
    SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, g.n_leaves, g.saved_tokens, n.ends_sha256
    FROM n JOIN g USING (node, d) LEFT JOIN k ON k.parent = n.node LEFT JOIN n u ON u.node = n.parent""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    from chromasea.llm.prefixtrie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))
