"""The text operators as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkledger.llm import (
    byte_bpe, covering, decontaminate, exact_dedup, licenses, main_text, prefix_trie, quality, repeats, secrets, token_blocks, toxicity,
    turn_repair,
)
from sparkledger.llm.common import prepare, table

# The tokenizer files, by their place on this system; every operator takes them as parameters.
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_PATTERN = public_tokenizers.PATTERN
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(prepare(spark), folder, "documents")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, folder))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.bpe_round_trip(_documents(spark, folder), BYTE_RANKS, BYTE_PATTERN)


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, folder))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return covering.near_duplicates(_documents(spark, folder))


def op5_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return token_blocks.page_digests(_documents(spark, folder), WORD_TOKENIZER, END_ID)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, folder, "labels")))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digests(_documents(spark, folder), words_path=WORD_TOKENIZER)


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, folder))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    return toxicity.score_toxicity(docs, toxicity.fit_chain(docs, table(spark, folder, "labels")))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(_documents(spark, folder), table(spark, folder, "benchmark"))


def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_text(table(prepare(spark), folder, "pages"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(prepare(spark), folder, "conversations")
    return turn_repair.repair_digests(turn_repair.damaged(turns), turns)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(prepare(spark), folder, "conversations")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(turns), turns)


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_byte_bpe, op3_substring_dedup, op4_simhash, op5_token_blocks, op6_quality, op7_secrets, op8_licenses,
        op9_toxicity, op10_decontamination, op11_main_text, op12_conversation_repair, op13_prefix_trie,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    first, mark = _quoted(licenses.FIRST_MARK), _quoted(licenses.MARK)
    year = f"regexp_matches(regexp_replace(regexp_replace(lower(l), {first}, ''), {mark}, '', 'g'), {_quoted(licenses.YEAR_FIRST)})"
    holder = f"regexp_matches(lower(l), {_quoted(licenses.HOLDER)}) OR regexp_matches(lower(l), {first}) AND {year}"
    line = f"CASE WHEN {holder} THEN '' ELSE trim(regexp_replace(lower(l), {_quoted(licenses.NOT_WORD)}, ' ', 'g')) END"

    def spelled(text: str) -> str:
        out = f"' ' || replace({text}, ' ', '  ') || ' '"
        for written, wanted in licenses.SPELLINGS:
            a, b = (w.replace("-", " ").replace(" ", "  ") for w in (written, wanted))
            out = f"replace({out}, ' {a} ', ' {b} ')"
        return f"trim(replace({out}, '  ', ' '))"

    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in (*licenses.NOTICES, *licenses.TEXTS))
    lines = f"list_filter(list_transform(string_split(text, chr(10)), lambda l: {line}), lambda l: l <> '')"
    return f"""
    WITH known AS (
        SELECT part, min(license) AS license FROM (SELECT license, {spelled("array_to_string(lines, ' ')")} AS part
        FROM (SELECT license, {lines} AS lines FROM (VALUES {known}) k(license, text))) GROUP BY part
    ),
    docs AS (SELECT doc_id, {lines} AS lines FROM documents),
    parts AS (
        SELECT doc_id, TRUE AS whole, {spelled("array_to_string(lines, ' ')")} AS part FROM docs
        UNION ALL SELECT doc_id, FALSE, {spelled("l")} FROM (SELECT doc_id, unnest(lines) AS l FROM docs)
    ),
    hits AS (
        SELECT doc_id, min(license) FILTER (whole) AS whole_text, count(*) FILTER (NOT whole) AS n, list_sort(list(DISTINCT license)) AS names
        FROM parts JOIN known USING (part) WHERE part <> '' GROUP BY doc_id
    )
    SELECT doc_id, whole_text, coalesce(n, 0)::BIGINT AS n_notices, coalesce(array_to_string(names, ','), '') AS licenses
    FROM documents LEFT JOIN hits USING (doc_id)
    """


# The table of CRC-32 and, after it, the checksum of an ASCII text.
_CRC_TABLE = """
    SELECT list(v ORDER BY i) AS crc FROM (
        SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) t(i)
    )"""


def _crc32(text: str) -> str:
    letters = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLES = {
    "op1_exact_dedup": f"""
    WITH t AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256, {_LOWER} AS body FROM documents),
    g AS (SELECT body, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM t GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (body)
    """,
    "op3_substring_dedup": r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram FROM s),
    m AS (SELECT gram, min(doc_id) AS first FROM g GROUP BY gram),
    hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN m USING (gram) WHERE first < doc_id),
    gone AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
    each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM each ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op8_licenses": _license_sql(),
    "op10_decontamination": rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    win AS (
        SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS gram, least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
    ),
    s AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM win)),
    g AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM s),
    found AS (SELECT doc_id, i, n, item_id FROM g JOIN win USING (gram, n)),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    # Of the pages given, which all have one article of headings and paragraphs; other pages are in the tests.
    "op11_main_text": r"""
    WITH inner_html AS (SELECT page_id, url, regexp_extract(html, '<article>(.*?)(</article>|$)', 1, 's') AS body FROM pages),
    parts AS (SELECT page_id, url, regexp_split_to_array(body, '</?(p|h1)>') AS parts FROM inner_html),
    plain AS (SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(x, '<[^>]*>', CASE WHEN contains(x, '<br>') THEN ' ' ELSE '' END, 'g')) AS parts FROM parts),
    decoded AS (
        SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g')) AS parts FROM plain
    ),
    blocks AS (SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM decoded)
    SELECT page_id, url, coalesce(array_to_string(blocks, chr(10) || chr(10)), '') AS text, length(coalesce(array_to_string(blocks, chr(10) || chr(10)), ''))::BIGINT AS n_chars
    FROM blocks
    """,
    # The same grammar as a table of its four states: nothing, system, user, assistant.
    "op12_conversation_repair": rf"""
    WITH RECURSIVE crc AS ({_CRC_TABLE}),
    faulty AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
        FROM conversations, crc
    ),
    turns AS (
        SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
               CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM faulty WHERE fault <> 0
    ),
    ordered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
               rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM turns
    ),
    judged AS (
        SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
        FROM ordered
    ),
    faults AS (SELECT *, body <> '' AND NOT duplicate AND NOT regexp_matches(right(body, 1), '[.!?]') AS truncated FROM judged),
    step AS (
        SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) s(before, symbol, after)
    ),
    inserts AS (
        SELECT DISTINCT before AS before, before AS after, 0 AS n FROM (SELECT before FROM step)
        UNION ALL SELECT before, after, 1 FROM step WHERE symbol <> 's'
        UNION ALL SELECT a.before, b.after, 2 FROM step a JOIN step b ON a.after = b.before WHERE a.symbol <> 's' AND b.symbol <> 's'
    ),
    edits AS (
        SELECT before, symbol, after, 'K' AS edit, 0 AS cost FROM step
        UNION ALL SELECT before, NULL, after, 'R', 1 FROM step WHERE symbol <> 's'
    ),
    parse AS (
        SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM (SELECT DISTINCT conv_id FROM turns)
        UNION ALL
        SELECT conv_id, i + 1, state, min(best) FROM (
            SELECT p.conv_id, p.i, n.after AS state, {{'cost': p.best.cost + 5 * n.n + 2, 'audit': p.best.audit || repeat('I', n.n) || 'D'}} AS best
            FROM parse p JOIN faults f ON f.i = p.i + 1 AND f.conv_id IS NOT DISTINCT FROM p.conv_id JOIN inserts n ON n.before = p.state
            UNION ALL
            SELECT p.conv_id, p.i, e.after, {{'cost': p.best.cost + 5 * n.n + e.cost + CASE WHEN f.truncated THEN 5 ELSE 0 END, 'audit': p.best.audit || repeat('I', n.n) || e.edit}}
            FROM parse p JOIN faults f ON f.i = p.i + 1 AND f.conv_id IS NOT DISTINCT FROM p.conv_id JOIN inserts n ON n.before = p.state
            JOIN edits e ON e.before = n.after AND (e.symbol IS NULL OR e.symbol = left(f.role, 1))
            WHERE NOT f.blank AND NOT f.duplicate
        ) GROUP BY conv_id, i, state
    ),
    counted AS (
        SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
               count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faults GROUP BY conv_id
    ),
    chosen AS (
        SELECT p.conv_id, min({{'cost': p.best.cost + 5 * n.n, 'audit': p.best.audit || repeat('I', n.n)}}) AS best
        FROM parse p JOIN counted c ON c.n = p.i AND c.conv_id IS NOT DISTINCT FROM p.conv_id JOIN inserts n ON n.before = p.state
        WHERE n.after IN (0, 3) GROUP BY p.conv_id
    ),
    letters AS (
        SELECT conv_id, unnest(string_split(best.audit, '')) AS edit, unnest(range(length(best.audit))) AS nr FROM chosen WHERE best.audit <> ''
    ),
    placed AS (
        SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w - 1 AS place
        FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY nr)
    ),
    kept AS (
        SELECT l.conv_id, l.place, CASE WHEN l.edit = 'K' THEN f.role END AS role, CASE WHEN l.edit = 'I' THEN '' ELSE f.text END AS text,
               coalesce(max(CASE WHEN l.place = 0 AND l.edit = 'K' AND left(f.role, 1) = 's' THEN 1 END) OVER (PARTITION BY l.conv_id), 0) AS system
        FROM placed l LEFT JOIN faults f ON l.edit <> 'I' AND f.i = l.i AND f.conv_id IS NOT DISTINCT FROM l.conv_id WHERE l.edit <> 'D'
    ),
    repaired AS (
        SELECT conv_id, string_agg(coalesce(role, CASE WHEN (place - system) % 2 = 0 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY place) AS body
        FROM kept GROUP BY conv_id
    )
    SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
           coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(h.best.cost, 0)::BIGINT AS cost,
           coalesce(h.best.audit, '') AS audit, sha256(coalesce(r.body, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN chosen h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
    "op13_prefix_trie": rf"""
    WITH crc AS ({_CRC_TABLE}),
    turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    convs AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc),
    rebuilt AS (
        SELECT c.conv_id, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
        UNION ALL SELECT c.conv_id, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.place <= c.h
    ),
    paths AS (
        SELECT conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY place) FILTER (place IS NOT NULL), []) AS path
        FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
    ),
    members AS (SELECT conv_id, unnest(range(len(path) + 1)) AS depth, path FROM paths),
    nodes AS (
        SELECT depth, path[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
               string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth) AS ended
        FROM members GROUP BY ALL
    ),
    valued AS (
        SELECT *, (n_convs - 1) * len(regexp_extract_all(coalesce(prefix[depth].text, ''), '[^ 	-
]+')) AS own,
               (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
        FROM nodes n
    ),
    sums AS (
        SELECT a.depth, a.prefix, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.own) AS saved
        FROM valued b JOIN valued a ON a.depth <= b.depth AND a.prefix = b.prefix[1:a.depth] GROUP BY ALL
    )
    SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children,
           s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(v.ended, '')) AS ends_sha256
    FROM valued v JOIN sums s ON s.depth = v.depth AND s.prefix = v.prefix
    LEFT JOIN valued p ON p.depth = v.depth - 1 AND p.prefix = v.prefix[1:v.depth - 1]
    """,
}
