"""DuckDB twins of the operators' queries."""

from __future__ import annotations

from statewise.llm.repetition import LEAST_WORDS, MOST_COVERED, MOST_IN_LINES, MOST_REPEATED_PERCENT

CONTAMINATION = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), starts AS (
    SELECT item, words, least(13, len(words)) AS n,
           unnest(range(1, len(words) - least(13, len(words)) + 2)) AS i
    FROM item WHERE len(words) > 0
), wanted AS (
    SELECT DISTINCT item, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS gram FROM starts
), lengths AS (
    SELECT DISTINCT n FROM wanted
), seen AS (
    SELECT doc_id, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS gram
    FROM (SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS i
          FROM doc, lengths WHERE len(words) >= n)
), hits AS (
    SELECT doc_id, seen.n, i, item FROM seen JOIN wanted USING (n, gram)
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(DISTINCT item) AS n_items,
           string_agg(DISTINCT item, ',' ORDER BY item) AS named
    FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(named, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def repetition() -> str:
    """Measures of repetition; one set of common tables per n-gram length."""
    lengths = sorted({3, *MOST_COVERED})
    parts = [
        f"doc AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents)",
        "word AS (SELECT doc_id, i AS p, length(words[i]) AS chars "
        "FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM doc))",
        "line AS (SELECT doc_id, i, lines[i] AS line FROM (SELECT doc_id, lines, "
        "unnest(range(1, len(lines) + 1)) AS i FROM "
        "(SELECT doc_id, string_split(text, chr(10)) AS lines FROM doc)))",
        r"later AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth "
        r"FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))",
        r"dup_line AS (SELECT doc_id, count(*) AS n_dup_lines, "
        r"sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS dup_line_chars "
        r"FROM later WHERE nth > 1 GROUP BY doc_id)",
    ]
    for n in lengths:
        parts.append(
            f"gram{n} AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM "
            f"(SELECT doc_id, i, array_to_string(list_slice(words, i, i + {n - 1}), ' ') AS gram "
            f"FROM (SELECT doc_id, words, unnest(range(1, len(words) - {n} + 2)) AS i "
            f"FROM doc WHERE len(words) >= {n})))"
        )
        parts.append(
            f"dup{n} AS (SELECT doc_id, count(*) AS n_words_in, sum(chars) AS chars_in FROM "
            f"(SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS p FROM gram{n} WHERE times > 1) "
            "JOIN word USING (doc_id, p) GROUP BY doc_id)"
        )
    joins = " ".join(f"LEFT JOIN dup{n} USING (doc_id)" for n in lengths)
    columns = ", ".join(
        f"CAST(coalesce(dup{n}.chars_in, 0) AS BIGINT) AS dup{n}_chars" for n in MOST_COVERED
    )
    parts.append(
        f"counts AS (SELECT doc_id, len(words)::BIGINT AS n_words, "
        r"length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, "
        r"(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, "
        "coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, "
        "coalesce(dup3.n_words_in, 0)::BIGINT AS n_repeat_words, "
        f"coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, {columns} "
        f"FROM doc LEFT JOIN dup_line USING (doc_id) {joins})"
    )
    failed = (
        f"(n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words)"
    )
    passed = " AND ".join(
        [f"100 * dup_line_chars <= {MOST_IN_LINES} * word_chars"]
        + [f"100 * dup{n}_chars <= {percent} * word_chars" for n, percent in MOST_COVERED.items()]
    )
    return (
        f"WITH {', '.join(parts)} SELECT *, {failed} AS base_failed, "
        f"NOT {failed} AND {passed} AS kept FROM counts"
    )


MIXING = r"""
WITH queue AS (
    SELECT row_number() OVER () AS row, doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
    FROM documents
), ranked AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS rank,
           CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
    FROM queue GROUP BY source
), filled AS (
    SELECT *, sum(source_size) OVER () AS budget,
           coalesce(sum(3 * source_size) OVER before, 0) AS words_before,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM ranked
    WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT *, CAST(budget - words_before AS DOUBLE) / CAST(weight_left AS DOUBLE) AS level FROM filled
), flagged AS (
    SELECT *, 3 * source_size <= weight * level AS is_full FROM levels
), targets AS (
    SELECT source, source_size, rank, weight, budget,
           CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
                ELSE weight * coalesce((SELECT level FROM flagged WHERE NOT is_full
                    ORDER BY 3.0 * source_size / weight, source NULLS LAST LIMIT 1), 0) END AS target
    FROM flagged
), stood AS (
    SELECT row, doc_id, size, source_size, target, rank, weight, budget,
           sum(size) OVER (PARTITION BY queue.source ORDER BY key, doc_id, size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
    FROM queue JOIN targets ON queue.source IS NOT DISTINCT FROM targets.source
), copies AS (
    SELECT *, unnest(range(0, 3)) AS copy FROM stood WHERE size > 0
), packets AS (
    SELECT *, unnest(range(0, size, 100)) AS first_word FROM copies
), timed AS (
    SELECT row, rank, weight, budget, least(100, size - first_word) AS words,
           CAST(copy * source_size + so_far - size + first_word
                + least(100, size - first_word) AS BIGINT) AS passed
    FROM packets
), served AS (
    SELECT row, words, budget,
           sum(words) OVER (ORDER BY CAST(passed AS DOUBLE) / weight, rank, passed
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mix_end
    FROM timed
), taken AS (
    SELECT row, sum(greatest(0, words - greatest(0, mix_end - budget))) AS taken FROM served GROUP BY row
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM stood LEFT JOIN taken USING (row)
"""

LINE_SPREAD = r"""
WITH line AS (
    SELECT doc_id, source, i, lines[i] AS line, trim(lines[i], E' \t\x0b\x0c\r') AS body
    FROM (SELECT doc_id, source, lines, unnest(range(1, len(lines) + 1)) AS i
          FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents))
), shared AS (
    SELECT body FROM line WHERE body <> '' GROUP BY body HAVING count(DISTINCT source) >= 10
), judged AS (
    SELECT line.*, shared.body IS NOT NULL AS gone FROM line LEFT JOIN shared USING (body)
), found AS (
    SELECT doc_id, count(*) FILTER (WHERE body <> '') AS n_lines,
           count(*) FILTER (WHERE gone) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS rest
    FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN n_removed > 0 THEN rest ELSE text END AS text
FROM documents LEFT JOIN found USING (doc_id)
"""


PREFERENCES = r"""
WITH answer AS (
    SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS last_text
    FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), pair AS (
    SELECT c.conv_id, turn, role, text,
           CASE WHEN role = 'assistant' AND turn = mine.last_turn
                THEN coalesce(other.last_text, '') ELSE text END AS other_text
    FROM conversations AS c LEFT JOIN answer AS mine ON c.conv_id = mine.conv_id
         LEFT JOIN answer AS other ON xor(c.conv_id, 1) = other.conv_id
), marked AS (
    SELECT *, bool_and(text = other_text) OVER (PARTITION BY conv_id ORDER BY turn) AS common,
           '<|im_start|>' || role || chr(10) AS header
    FROM pair
), placed AS (
    SELECT *, header || text || '<|im_end|>' || chr(10) AS whole,
           header || other_text || '<|im_end|>' || chr(10) AS other_whole
    FROM marked
), summed AS (
    SELECT *,
           sum(CASE WHEN common THEN 0 ELSE length(whole) END) OVER up_to AS below,
           sum(CASE WHEN common THEN 0 ELSE length(other_whole) END) OVER up_to AS other_below
    FROM placed WINDOW up_to AS (PARTITION BY conv_id ORDER BY turn)
)
SELECT conv_id, count(*) FILTER (WHERE common) AS n_prompt_turns,
       coalesce(string_agg(whole, '' ORDER BY turn) FILTER (WHERE common), '') AS prompt,
       coalesce(string_agg(whole, '' ORDER BY turn) FILTER (WHERE NOT common), '') AS chosen,
       coalesce(string_agg(other_whole, '' ORDER BY turn) FILTER (WHERE NOT common), '') AS rejected,
       coalesce(string_agg(concat(below - length(whole) + length(header), ':', below), ',' ORDER BY turn)
           FILTER (WHERE NOT common AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(concat(other_below - length(other_whole) + length(header), ':', other_below), ','
           ORDER BY turn) FILTER (WHERE NOT common AND role = 'assistant'), '') AS rejected_mask
FROM summed GROUP BY conv_id
"""

FIXITY = r"""
WITH record AS (
    SELECT page_id, 66 + strlen(url) + length(CAST(strlen(html) AS VARCHAR)) + strlen(html) + 8 AS n_bytes,
           substr(md5(CAST(page_id AS VARCHAR)), 1, 2) AS pick
    FROM pages
), placed AS (
    SELECT *, sum(n_bytes) OVER (ORDER BY page_id) - n_bytes AS start FROM record
)
SELECT page_id, CAST(start AS BIGINT) AS "offset", n_bytes,
       CASE pick WHEN '00' THEN 'changed' ELSE 'missing' END AS status
FROM placed WHERE pick IN ('00', '01')
"""

EXACT_COPIES = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _field(name: str, value: str | None = None) -> str:
    text = f"CAST({value or name} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _levels(name: str, leaves: str) -> str:
    """A table of all levels over ``leaves`` (``tree, level, pos, hash, n``)."""
    return f"""{name} AS (
    SELECT tree, level, pos, hash, n FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (n + 15) // 16
    FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 16, n
), {name}_run AS (
    SELECT tree, level, pos // 16 AS up, list(hash ORDER BY pos) AS hashes
    FROM {name} WHERE n > 1 GROUP BY ALL
)"""


def _ascent(name: str, start: str, runs: str) -> str:
    """``start`` (``doc_id, tree, level, pos, folded, proof``) through ``runs``."""
    left = "array_to_string(hashes[1:pos % 16], '')"
    right = "array_to_string(hashes[pos % 16 + 2:], '')"
    return f"""{name} AS (
    SELECT doc_id, tree, level, pos, folded, proof FROM {start}
    UNION ALL
    SELECT doc_id, tree, level + 1, pos // 16, sha256({left} || folded || {right}),
           proof || {left} || {right}
    FROM {name} JOIN {runs} USING (tree, level) WHERE pos // 16 = up
), {name}_end AS (
    SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1
)"""


_REST = " || ".join(_field(name) for name in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MANIFEST = f"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], LAMBDA c, _:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS entry
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
), doc AS (
    SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
            string_split(CAST(doc_id AS VARCHAR), ''), LAMBDA x: CAST(ascii(x) AS BIGINT))),
            LAMBDA c, x: xor(c >> 8, entry[xor(c, x) % 256 + 1])), 4294967295) % 5 = 0 AS picked,
        sha256({_REST} || {_field("text")}) AS leaf,
        sha256({_REST} || {_field("text", _LOWERED)}) AS lowered,
        coalesce('=' || source, '-') AS tree
    FROM documents, crc
), leaf AS (
    SELECT doc_id, tree, 0 AS level, leaf AS hash, CASE WHEN picked THEN lowered ELSE leaf END AS folded,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos,
           count(*) OVER (PARTITION BY tree) AS n, '' AS proof
    FROM doc
), {_levels("node", "leaf")}, subroot AS (
    SELECT '^' AS tree, tree AS grp, 0 AS level, hash, count(*) OVER () AS n,
           row_number() OVER (ORDER BY tree <> '-', tree) - 1 AS pos
    FROM node WHERE n = 1
), {_levels("top", "subroot")}, {_ascent("climb", "leaf", "node_run")}, halfway AS (
    SELECT doc_id, s.tree, s.level, s.pos, folded, proof
    FROM climb_end c JOIN subroot s ON c.tree = s.grp
), {_ascent("finish", "halfway", "top_run")}
SELECT doc_id, leaf.hash AS leaf, subroot.hash AS subroot, root.hash AS root,
       sha256(finish_end.proof) AS proof_sha256, finish_end.folded AS folded_root,
       finish_end.folded = root.hash AS verified
FROM leaf JOIN subroot ON leaf.tree = subroot.grp JOIN finish_end USING (doc_id),
     (SELECT hash FROM top WHERE n = 1) AS root
"""
