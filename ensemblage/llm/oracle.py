"""The same questions in SQL, where SQL can say them.

Not expressible: sharding (medians over hashes), the language model and the classifier (sampling and fitting),
encoded lengths, packing and byte-level BPE (a tokenizer), conversation repair (CRC-32 and least strings of edits),
decontamination (overlapping windows could be listed, but every word of every document would be joined), near-duplicates and fuzzy lines (signatures); tests compare those with
brute-force versions.
"""

from ensemblage.llm import rules

ORACLES: dict[str, str] = {}

ORACLES["op9_chat"] = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)),
    escaped AS (
        SELECT *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS shown_role,
               replace(replace(text, '\', '\\'), '<|', '<\|') AS shown FROM turns)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length('<|im_start|>') + length(shown_role) + length(shown) + length('<|im_end|>') + 2)::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id"""

_CLASSES = ["[a-z]", r"[ \t\n\x0B\f\r]", "[A-Z]", "[0-9]", "[#*$%&|<>]", r"[\x00-\x7F]"]


def _classes() -> str:
    """Counts of the character classes: each taken out of what the ones before left."""
    steps, left = [], "t"
    for i, pattern in enumerate(_CLASSES):
        rest = f"regexp_replace({left}, '{pattern}+', '', 'g')"
        steps.append(f"length({left}) - length({rest}) AS c{i}")
        left = rest
    return ", ".join([*steps, f"length({left}) AS c6"])


def _distance(counts: list[str], references: list[str]) -> str:
    """Jensen-Shannon distance (base 2) of two rows of counts."""
    total, all_ = (f"({' + '.join(x)})::DOUBLE" for x in (counts, references))
    parts = []
    for c, r in zip(counts, references, strict=True):
        p, q = f"({c} / {total})", f"({r} / {all_})"
        for a in (p, q):
            parts.append(f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({p} + {q}) / 2)) ELSE 0 END")
    return f"sqrt(greatest(({' + '.join(parts)}) / 2, 0))"


_C = [f"c{i}" for i in range(7)]
ORACLES["op10_divergence"] = rf"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents),
    split AS (
        SELECT doc_id, lang, t, list_filter(string_split_regex(t, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words,
               list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \t\n\x0B\f\r]')) AS lines, {_classes()} FROM docs),
    tokens AS (SELECT doc_id, lang, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
    threes AS (
        SELECT doc_id, i, lead(i, 2) OVER d AS last, row(word, lead(word) OVER d, lead(word, 2) OVER d) AS three
        FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
    repeated AS (
        SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS n FROM threes WHERE last IS NOT NULL) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) s(k) GROUP BY doc_id),
    counts AS (SELECT lang, word, count(*) AS n FROM tokens GROUP BY ALL),
    common AS (SELECT lang, word FROM counts QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {rules.COMMON}),
    mine AS (SELECT doc_id, lang, word, count(*) AS n FROM tokens JOIN common USING (lang, word) GROUP BY ALL),
    sizes AS (SELECT *, len(words) AS n_words FROM split),
    langs AS (
        SELECT lang, sum(n_words) AS total, {', '.join(f'sum(c{i}) AS r{i}' for i in range(7))} FROM sizes GROUP BY lang),
    refs AS (SELECT lang, word, n AS ref FROM counts JOIN common USING (lang, word)),
    cells AS (
        SELECT doc_id, lang, n_words, total, coalesce(m.n, 0) / n_words::DOUBLE AS p, ref / total::DOUBLE AS q
        FROM sizes JOIN langs USING (lang) JOIN refs USING (lang) LEFT JOIN mine m USING (doc_id, lang, word) WHERE n_words > 0
        UNION ALL
        SELECT doc_id, lang, n_words, total, 1 - coalesce((SELECT sum(n) FROM mine m WHERE m.doc_id = s.doc_id), 0) / n_words::DOUBLE,
               1 - (SELECT sum(ref) FROM refs r WHERE r.lang = s.lang) / total::DOUBLE
        FROM sizes s JOIN langs USING (lang) WHERE n_words > 0),
    words_far AS (
        SELECT doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
               + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS far FROM cells GROUP BY doc_id),
    judged AS (
        SELECT s.doc_id, n_words, c0 + c2 + c3 + c4 + c5 + c6 AS word_chars, c4 AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(v.n, 0) AS n_repeat_words, n_words < {rules.MIN_WORDS} OR 100 * coalesce(v.n, 0) > 50 * n_words AS base_failed,
               total >= {rules.MIN_REFERENCE_WORDS} AND n_words >= {rules.MIN_WORDS} AS guarded,
               CASE WHEN length(t) > 0 THEN {_distance(_C, [f'r{i}' for i in range(7)])} END AS js_classes, w.far AS js_words
        FROM sizes s JOIN langs USING (lang) LEFT JOIN covered v ON v.doc_id = s.doc_id LEFT JOIN words_far w ON w.doc_id = s.doc_id),
    named AS (
        SELECT *, CASE WHEN n_words < {rules.MIN_WORDS} THEN 'short' WHEN base_failed THEN 'repeats'
                       WHEN guarded AND js_classes > {rules.CHARACTER_LIMIT} THEN 'characters'
                       WHEN guarded AND js_words > {rules.WORD_LIMIT} THEN 'words' END AS reason FROM judged)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
           n_repeat_words::BIGINT AS n_repeat_words, base_failed, reason IS NULL AS kept, reason
    FROM named"""


def _book_round(number: int) -> str:
    """Parts at their nearest entries of one codebook, and the next one."""
    places = range(1, 5)
    gap = " + ".join(f"(a.q{i} - b.q{i}) * (a.q{i} - b.q{i})" for i in places)
    means = ", ".join(f"((sum(q{i}) - ((sum(q{i}) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS q{i}" for i in places)
    return f"""
    near{number} AS (
        SELECT a.row, a.p, {", ".join(f"any_value(a.q{i}) AS q{i}" for i in places)}, min(({gap}) * 64 + b.e) AS m
        FROM parts a JOIN book{number} b ON a.p = b.p GROUP BY a.row, a.p),
    mean{number} AS (SELECT p, m % 64 AS e, {means} FROM near{number} GROUP BY ALL),
    book{number + 1} AS (
        SELECT b.p, b.e, {", ".join(f"coalesce(n.q{i}, b.q{i}) AS q{i}" for i in places)}
        FROM book{number} b LEFT JOIN mean{number} n ON n.p = b.p AND n.e = b.e)"""


#: For vectors of 64 components, as in the given table.
ORACLES["op13_codes"] = f"""
    WITH kept AS (
        SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS (
        SELECT row, p, {", ".join(f"v[(p * 4 + {i})::BIGINT] AS q{i}" for i in range(1, 5))} FROM kept CROSS JOIN (SELECT unnest(range(16)) AS p)),
    book0 AS (SELECT p, row - 1 AS e, q1, q2, q3, q4 FROM parts WHERE row <= 64),
    {_book_round(0)}, {_book_round(1)}, {_book_round(2)},
    sums AS (
        SELECT row, string_agg(lower(lpad(printf('%x', m % 64), 2, '0')), '' ORDER BY p) AS code, sum(m // 64)::BIGINT AS error
        FROM near2 GROUP BY row),
    labelled AS (SELECT label, sum(error)::BIGINT AS label_error FROM kept JOIN sums USING (row) GROUP BY label),
    books AS (SELECT sha256(string_agg(concat_ws(',', q1, q2, q3, q4), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
    SELECT vec_id, code, error, label_error, codebooks_sha256
    FROM kept JOIN sums USING (row) JOIN labelled l ON l.label IS NOT DISTINCT FROM kept.label CROSS JOIN books"""
