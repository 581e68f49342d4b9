"""The operators bound to the test tables: one query each, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.llm import (
    chat,
    exact_dedup,
    fingerprints,
    html_extraction,
    mixing,
    near_dedup,
    pieces,
    prefix_trie,
    search,
    secrets,
    structure_repair,
    token_counts,
    toxicity,
)
from hackney.llm.frames import pick

Query = Callable[[SparkSession, str], DataFrame]

BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, tokens and an over-length mark for every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_PAIRS, limit=512)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by kind, a digest of the base spans, and all spans of every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "lexed")

    def told(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
        count("lexed"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives its text."""
    return pieces.encode(table(spark, sf_dir, "documents"), PIECES)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds the template's marks, formatted and read back."""
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    says = r"'\### Assistant: </turn> ok'"
    marked = spark.range(2).selectExpr("-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"r{says} AS text")
    return chat.read_back(chat.format_turns(rows.unionByName(marked)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score, verdict and toxic spans of every document."""
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, its blocks joined by newlines."""
    found = html_extraction.extract_text(table(spark, sf_dir, "pages"))
    text = F.array_join("blocks", "\n")
    return found.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all sources takes of every document."""
    return mixing.mix_sizes(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of equal texts that every document belongs to, and whether it stays."""
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document, and whether it stays."""
    return near_dedup.near_copies(table(spark, sf_dir, "documents"), similarity=0.8)


def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each document whose id is divisible by 100, taken as a query."""
    documents = table(spark, sf_dir, "documents")
    queries = pick(documents, "doc_id", "text").where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id")
    return search.top_k(documents, queries, k=10)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are."""
    found = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        F.concat_ws("", "fingerprint").alias("fingerprint"),
        F.concat_ws("", "edited_fingerprint").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with counts over its subtree."""

    def borrowed(conv_id: Column) -> Column:
        return F.crc32(conv_id.cast("string").cast("binary")) % 4

    turns = prefix_trie.rebuild(table(spark, sf_dir, "conversations"), family=20, heads=4, borrowed=borrowed)
    return prefix_trie.prefix_trie(turns)


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    return structure_repair.repair_digests(structure_repair.damage(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_secret_scan": op2_secret_scan,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_chat_format": op4_chat_format,
    "op5_toxicity": op5_toxicity,
    "op6_html_extraction": op6_html_extraction,
    "op7_source_mix": op7_source_mix,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_near_dedup": op9_near_dedup,
    "op10_top_k_search": op10_top_k_search,
    "op11_fingerprints": op11_fingerprints,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_structure_repair": op13_structure_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op7_source_mix": r"""
        WITH measured AS (
          SELECT doc_id, source,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
            ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS place
          FROM documents),
        sizes AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            row_number() OVER (ORDER BY source NULLS LAST) AS turn
          FROM measured GROUP BY source),
        weighted AS (
          SELECT *, CASE turn % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight FROM sizes),
        filling AS (
          SELECT *, row_number() OVER f AS step, sum(weight) OVER (
              ORDER BY source_size / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier,
            sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
              ORDER BY source_size / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining
          FROM weighted WINDOW f AS (ORDER BY source_size / weight, turn)),
        level AS (
          SELECT step AS at, remaining, heavier FROM filling
          WHERE 3 * source_size * heavier >= weight * remaining ORDER BY step LIMIT 1),
        targets AS (
          SELECT f.source, f.source_size, CASE WHEN f.step < l.at THEN CAST(3 * f.source_size AS DOUBLE)
            ELSE CAST(f.weight * l.remaining AS DOUBLE) / CAST(l.heavier AS DOUBLE) END AS target
          FROM filling f, level l),
        plan AS (
          SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies
          FROM targets),
        places AS (
          SELECT m.source, m.place, sum(m.size) AS held,
            sum(sum(m.size)) OVER (PARTITION BY m.source ORDER BY m.place) AS running
          FROM measured m GROUP BY m.source, m.place),
        extra AS (
          SELECT p.source, p.place FROM places p JOIN plan t ON p.source IS NOT DISTINCT FROM t.source
          WHERE p.running <= floor(t.target - t.copies * t.source_size)
            OR (p.running - p.held <= floor(t.target - t.copies * t.source_size)
              AND 2 * (floor(t.target - t.copies * t.source_size) - p.running + p.held) >= p.held))
        SELECT m.doc_id, CAST(m.size AS BIGINT) AS size, t.source_size, t.target,
          CAST(m.size * (t.copies + CASE WHEN e.place IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
        FROM measured m JOIN plan t ON m.source IS NOT DISTINCT FROM t.source
        LEFT JOIN extra e ON m.source IS NOT DISTINCT FROM e.source AND m.place = e.place""",
    "op8_exact_dedup": """
        WITH normal AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
          FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
          doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM normal""",
    "op10_top_k_search": r"""
        WITH words AS (
          SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS term FROM documents),
        held AS (SELECT doc_id, term, count(*) AS times FROM words GROUP BY doc_id, term),
        lengths AS (SELECT doc_id, sum(times) AS length FROM held GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, (SELECT sum(length) FROM lengths) / count(*) AS mean FROM documents),
        rarity AS (
          SELECT term, ln(1 + (any_value(docs) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
          FROM held, total GROUP BY term),
        scored AS (
          SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.times * idf * d.times * 2.2
            / (d.times + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
          FROM held q JOIN held d USING (term) JOIN rarity USING (term) JOIN lengths l ON l.doc_id = d.doc_id, total
          WHERE q.doc_id % 100 = 0 GROUP BY q.doc_id, d.doc_id),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS place FROM scored)
        SELECT query_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10""",
    "op11_fingerprints": r"""
        WITH placed AS (
          SELECT doc_id, coalesce(text, '') AS t, count(*) OVER () AS docs,
            row_number() OVER (ORDER BY doc_id NULLS LAST, md5(coalesce(text, ''))) AS place FROM documents),
        edited AS (
          SELECT a.doc_id, a.place, b.place AS next_place, length(a.t) AS n_chars, a.t,
            left(a.t, length(a.t) - length(a.t) // 4) || left(b.t, length(a.t) // 4) AS e
          FROM placed a JOIN placed b ON b.place = a.place % a.docs + 1),
        worded AS (
          SELECT place, kind, regexp_extract_all(lower(x), '[\p{L}\p{N}]+') AS w
          FROM (SELECT place, 'own' AS kind, t AS x FROM edited UNION ALL SELECT place, 'edited', e FROM edited)),
        sketched AS (
          SELECT place, kind, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_sort(list_distinct(list_transform(
            range(0, greatest(len(w) - 5, 0) + 1),
            lambda i: substr(md5(array_to_string(w[i + 1:i + 5], ' ')), 1, 16))))[1:128] END AS f FROM worded),
        compared AS (
          SELECT d.doc_id, d.n_chars, d.e, o.f, x.f AS xf, n.f AS nf,
            list_sort(list_distinct(list_concat(o.f, x.f)))[1:128] AS ox,
            list_sort(list_distinct(list_concat(o.f, n.f)))[1:128] AS onext
          FROM edited d JOIN sketched o ON o.place = d.place AND o.kind = 'own'
          JOIN sketched x ON x.place = d.place AND x.kind = 'edited'
          JOIN sketched n ON n.place = d.next_place AND n.kind = 'own')
        SELECT doc_id, n_chars, sha256(e) AS edited_sha256, array_to_string(f, '') AS fingerprint,
          array_to_string(xf, '') AS edited_fingerprint,
          CASE WHEN len(ox) = 0 THEN 1.0 ELSE CAST(len(list_intersect(list_intersect(ox, f), xf)) AS DOUBLE) / len(ox) END AS near_edited,
          CASE WHEN len(onext) = 0 THEN 1.0 ELSE CAST(len(list_intersect(list_intersect(onext, f), nf)) AS DOUBLE) / len(onext) END AS near_next
        FROM compared""",
    "op12_prefix_trie": r"""
        WITH ordered AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
          FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (
          SELECT conv_id, xor(list_reduce(
            flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: [CAST(ascii(s) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
            lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384), CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
          FROM (SELECT DISTINCT conv_id FROM ordered)),
        rebuilt AS (
          SELECT i.conv_id, pos, role, text FROM ids i JOIN ordered o ON o.conv_id = i.conv_id - i.conv_id % 20 AND o.pos <= i.h
          UNION ALL SELECT i.conv_id, pos + 4, role, text FROM ids i JOIN ordered o ON o.conv_id = i.conv_id AND o.pos > i.h),
        whole AS (
          SELECT conv_id, coalesce(s, []) AS s
          FROM ids LEFT JOIN (SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS s FROM rebuilt GROUP BY conv_id) USING (conv_id)),
        paths AS (
          SELECT conv_id, d, s[1:d] AS k, d = len(s) AS ends,
            CASE WHEN d > 0 THEN len(regexp_extract_all(s[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
          FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM whole)),
        counted AS (
          SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
            string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ended
          FROM paths GROUP BY k, d),
        nodes AS (
          SELECT c.*, coalesce(n_children, 0) AS n_children
          FROM counted c LEFT JOIN (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM counted WHERE d > 0 GROUP BY 1) USING (k)),
        climbed AS (
          SELECT p.k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * n.words) AS saved
          FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.d <= n.d GROUP BY p.k)
        SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
          CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ended, '')) AS ends_sha256
        FROM nodes n JOIN climbed USING (k) LEFT JOIN nodes p ON n.d > 0 AND p.k = n.k[1:n.d - 1]""",
}
