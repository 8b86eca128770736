"""The operators applied to their whole tables, under the names the driver runs, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import (
    classifier,
    exact_dedup,
    filter_audit,
    language,
    line_dedup,
    mixing,
    near_dup,
    packing,
    pii,
    prefix_trie,
    quality_rules,
    token_files,
    warc,
)
from bazaarlens.llm.base import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality_rules.fails(quality_rules.BASE).alias("base_failed"),
        (~quality_rules.fails(quality_rules.POLICIES[quality_rules.CURRENT])).alias("kept"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "text", "n_lines", "n_removed")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    return classifier.score(docs, model).select(
        "doc_id",
        classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    found = language.identify(docs, model)
    return found.select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.replace_pii(table(spark, sf_dir, "documents"), key="change me in production")
    return rows.select("doc_id", "text", "n_entities")


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages carry no time of capture; they get one second each, in the order of their ids."""
    time = F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce(F.pmod("page_id", F.lit(10**9)), F.lit(0)))
    captures = warc.capture_histories(table(spark, sf_dir, "pages"), time)
    digest = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return captures.select(*digest, "urlkey", "timestamp", "range", "nth")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.words_taken(mixed.pieces).select("doc_id", "size", "source_size", "target", "taken")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_files.written_and_read(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_language_id": op7_language_id,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_warc_index": op9_warc_index,
    "op10_mixing": op10_mixing,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLES = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_quality_rules": r"""
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        windows AS (
            SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
            FROM split, unnest(range(1, len(words) - 1)) AS t(i)),
        again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, unnest([0, 1, 2]) AS t(k) GROUP BY doc_id),
        counted AS (
            SELECT doc_id, len(words) AS n_words,
                   CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(list_max(list_transform(words, lambda x: length(x))), 0) AS longest
            FROM split LEFT JOIN covered USING (doc_id)),
        judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
                    OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR longest > 1000) AS kept
        FROM judged
    """,
    "op5_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, coalesce(source, '') AS site, i, string_split(text, chr(10))[i] AS line
            FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)),
        keyed AS (
            SELECT *, regexp_matches(line, '[\p{L}\p{N}]') AS counts, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
            FROM lines),
        shared AS (SELECT key FROM keyed WHERE counts GROUP BY key HAVING count(DISTINCT site) >= 5),
        judged AS (SELECT *, counts AND key IN (SELECT key FROM shared) AS gone FROM keyed),
        rest AS (
            SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS rest,
                   CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed, count(*) AS n_lines
            FROM judged GROUP BY doc_id)
        SELECT doc_id, rest AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
        FROM documents LEFT JOIN rest USING (doc_id)
    """,
    # The first source by room for weight that the water level leaves open gives the level.
    "op10_mixing": f"""
        WITH sized AS (SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
            FROM sized GROUP BY source),
        weighted AS (
            SELECT *, CASE source_no % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * 2 AS room
            FROM sources),
        levels AS (
            SELECT *, row_number() OVER fill AS nth,
                   (sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - coalesce(sum(room) OVER ahead, 0))
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0)) AS level
            FROM weighted
            WINDOW fill AS (ORDER BY room / weight, source_no),
                   ahead AS (ORDER BY room / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        chosen AS (SELECT min(nth) AS nth FROM levels WHERE level <= room / weight),
        targets AS (
            SELECT source, source_size,
                   least(CAST(room AS DOUBLE),
                         coalesce((SELECT level FROM levels JOIN chosen USING (nth)) * weight, room)) AS target
            FROM levels),
        placed AS (
            SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS take,
                   CAST(sum(size) OVER (PARTITION BY sized.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
                                        ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start
            FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
        SELECT doc_id, size, source_size, target,
               greatest(0, least(size, take - start)) + greatest(0, least(size, take - source_size - start)) AS taken
        FROM placed
    """,
    "op11_filter_audit": r"""
        WITH split AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        judged AS (
            SELECT doc_id, part,
                   CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS failed
            FROM split),
        known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        counted AS (
            SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM judged LEFT JOIN known USING (doc_id) GROUP BY part, failed),
        letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(letter, bit)),
        orders AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        steps AS (
            SELECT filter_order, step, letter, bit,
                   (SELECT coalesce(sum(l.bit), 0) FROM letters l WHERE contains(substr(filter_order, 1, step - 1), l.letter)) AS ahead
            FROM orders, unnest(range(1, 6)) AS t(step) JOIN letters ON letter = substr(filter_order, step, 1)),
        summed AS (
            SELECT part, filter_order, step, letter,
                   coalesce(sum(n) FILTER (failed & (ahead | bit)::BIGINT = 0), 0) AS kept,
                   coalesce(sum(n) FILTER (failed & ahead::BIGINT = 0 AND failed & bit > 0), 0) AS removed,
                   coalesce(sum(n) FILTER (failed & ahead::BIGINT > 0 AND failed & bit > 0), 0) AS redundant,
                   coalesce(sum(n) FILTER (failed = bit), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (failed & ahead::BIGINT = 0 AND failed & bit > 0), 0) AS good_lost,
                   coalesce(sum(toxic) FILTER (failed & ahead::BIGINT = 0 AND failed & bit > 0), 0) AS toxic_lost
            FROM counted, steps GROUP BY part, filter_order, step, letter)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM summed
    """,
    # A CRC-32 bit by bit over the digits of an id; then every prefix of every rebuilt conversation as a list.
    "op13_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (
            SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
                   xor(list_reduce(list_prepend(4294967295::BIGINT,
                       list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
                       lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda x, y: xor(x >> 1, (x & 1) * 3988292384 + y))), 4294967295) % 4 AS h
            FROM turns),
        built AS (
            SELECT ids.conv_id, pos AS nth, role, text FROM ids JOIN turns ON turns.conv_id = base WHERE pos <= h
            UNION ALL SELECT conv_id, pos AS nth, role, text FROM ids JOIN turns USING (conv_id) WHERE pos > h),
        whole AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY nth) FILTER (nth IS NOT NULL) AS turns
            FROM ids LEFT JOIN built USING (conv_id) GROUP BY conv_id),
        sized AS (SELECT conv_id, coalesce(turns, []) AS turns, coalesce(len(turns), 0) AS n FROM whole),
        members AS (SELECT conv_id, n, d AS depth, turns[1:d] AS prefix FROM sized, unnest(range(0, n + 1)) AS t(d)),
        nodes AS (
            SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS longest,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
                   CASE depth WHEN 0 THEN 0 ELSE len(regexp_extract_all(prefix[depth].text, '[^\x20\x09-\x0D]+')) END AS words
            FROM members GROUP BY prefix, depth),
        below AS (
            SELECT top.prefix, count(*) FILTER (low.depth = top.depth + 1) AS n_children,
                   count(*) FILTER (low.depth = low.longest) AS n_leaves, sum((low.n_convs - 1) * low.words) AS saved_tokens
            FROM nodes low, unnest(range(0, low.depth + 1)) AS t(d) JOIN nodes top ON top.prefix = low.prefix[1:d]
            GROUP BY top.prefix)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN below USING (prefix) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
    """,
}
