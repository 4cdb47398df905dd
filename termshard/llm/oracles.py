"""For the operators that SQL can express, the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from termshard.llm.common import UPPER
from termshard.llm.risk_rules import CUTOFFS, GOOD_WEIGHT

RISK, ERROR = 0.05, 0.05


def lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"


OP5 = f"""WITH normal AS (SELECT doc_id, {lowered('text')} AS norm FROM documents),
    placed AS (SELECT doc_id, norm, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) AS place
        FROM normal WINDOW same AS (PARTITION BY norm))
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM placed"""


OP1 = """WITH calls AS (SELECT conv_id, turn, 'c' || turn AS call_id, text,
        CASE WHEN role = 'user' THEN 'ask' ELSE 'configure' END AS name
        FROM conversations WHERE role <> 'assistant'),
    chosen AS (SELECT *, count(*) OVER (PARTITION BY conv_id, call_id) AS n_calls FROM calls
        WHERE conv_id IS NOT NULL AND call_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY conv_id, call_id ORDER BY name, text) = 1),
    answers AS (SELECT conv_id, 'c' || (turn - 1) AS call_id, min(turn) AS result_turn,
        min(text) AS result, count(*) AS n_results
        FROM conversations WHERE role = 'assistant' GROUP BY 1, 2)
    SELECT conv_id, call_id, name, turn, turn AS position, 0::BIGINT AS hops, result_turn, n_calls,
        coalesce(n_results, 0) AS n_results, text IS NOT NULL OR name = 'configure' AS valid,
        CASE WHEN text IS NULL AND name = 'ask' THEN 'missing text' ELSE '' END AS errors,
        json_object('arguments', json_object('text', text, 'turn', turn), 'id', call_id,
            'name', name, 'result', result)::VARCHAR AS record
    FROM chosen LEFT JOIN answers USING (conv_id, call_id)"""


def _strength(level: str) -> str:
    """The prior strength of a relation with n, k and m."""
    return f"""(SELECT CASE WHEN groups = 0 OR total <= groups OR spread <= groups THEN 1000.0
            ELSE least(1000.0, greatest(1.0, 1 / ((spread - groups) / (total - groups)) - 1)) END
        FROM (SELECT sum(n * (k / n - m) ** 2 / (m * (1 - m))) AS spread, count(*) AS groups, sum(n) AS total
            FROM {level} WHERE n > 0 AND m * (1 - m) > 0))"""


def _posterior(level: str, name: str, columns: str) -> str:
    return f"""{name} AS (SELECT {columns}, (k + m * s) / (n + s) AS rate, n, s
        FROM {level}, (SELECT {_strength(level)} AS s))"""


def _host(url: str) -> str:
    return f"translate(regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}')"


def _path(url: str) -> str:
    return f"regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


OP2 = f"""WITH judged AS (SELECT page_id, url, {_host('url')} AS host, {_path('url')} AS path FROM pages),
    known AS (SELECT host, count(*) AS n, sum(quality) AS k
        FROM judged JOIN labels ON doc_id = try_cast(regexp_extract(path, '/([0-9]+)', 1) AS BIGINT)
        WHERE quality IS NOT NULL GROUP BY host),
    parts AS (SELECT host, string_split(host, '.') AS p, coalesce(n, 0) AS n, coalesce(k, 0) AS k
        FROM (SELECT DISTINCT host FROM judged) LEFT JOIN known USING (host)),
    hosts AS (SELECT host, p[-1] AS suffix, array_to_string(p[-2:], '.') AS domain, n, k FROM parts),
    above AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(k) + 0.5::DOUBLE) / (sum(n) + 1) ELSE 0.5 END AS m FROM hosts),
    l1 AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, any_value(m) AS m FROM hosts, above GROUP BY suffix),
    {_posterior('l1', 'p1', 'suffix')},
    l2 AS (SELECT h.suffix, h.domain, sum(h.n)::DOUBLE AS n, sum(h.k)::DOUBLE AS k, any_value(rate) AS m
        FROM hosts h JOIN p1 USING (suffix) GROUP BY h.suffix, h.domain),
    {_posterior('l2', 'p2', 'suffix, domain')},
    l3 AS (SELECT host, h.n::DOUBLE AS n, h.k::DOUBLE AS k, rate AS m FROM hosts h JOIN p2 USING (suffix, domain)),
    {_posterior('l3', 'p3', 'host')},
    betas AS (SELECT host, rate, rate * (n + s) AS a, (1 - rate) * (n + s) AS b FROM p3),
    bounds AS (SELECT host, rate, 1 - list_sum(list_transform(range(0, (200 + greatest(b - a, 0))::BIGINT), lambda i:
            exp(lgamma(a + b + i) - lgamma(b) - lgamma(a + 1 + i) + (a + b + i) * ln(0.5::DOUBLE)))) AS p_good FROM betas),
    rules(rule, verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'),
        ('org/fr/', 'allow')),
    fits AS (SELECT page_id, rule, verdict FROM judged, rules
        WHERE ('.' || host) LIKE '%.' || split_part(rule, '/', 1)
          AND starts_with(path, substring(rule, strpos(rule, '/')))
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule DESC) = 1)
    SELECT page_id, host, path, rule,
        coalesce(verdict, CASE WHEN p_good < 0.05 THEN 'block' ELSE 'allow' END) AS verdict,
        round(rate, 6) AS good_rate, round(p_good, 6) AS p_good
    FROM judged JOIN bounds USING (host) LEFT JOIN fits USING (page_id)"""

OP9 = f"""WITH split AS (SELECT doc_id, lang, text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM documents),
    runs AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM split WHERE len(words) > 4),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS run FROM runs)
        QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
    covered AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY doc_id),
    counts AS (SELECT doc_id, lang, len(words) AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        length(regexp_replace(coalesce(text, ''), '[^!]', '', 'g')) AS n_shouts,
        length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_capitals, len(lines) AS n_lines
        FROM split LEFT JOIN covered USING (doc_id)),
    shares AS (SELECT doc_id, lang, unnest([
            {{'rule': 'symbols', 'share': coalesce(n_symbols / nullif(n_words, 0), 0)}},
            {{'rule': 'dup_lines', 'share': coalesce(n_dup_lines / nullif(n_lines, 0), 0)}},
            {{'rule': 'repeats', 'share': coalesce(n_repeat_words / nullif(n_words, 0), 0)}},
            {{'rule': 'shouts', 'share': coalesce(n_shouts / nullif(n_words, 0), 0)}},
            {{'rule': 'capitals', 'share': coalesce(n_capitals / nullif(word_chars, 0), 0)}}], recursive := true)
        FROM counts),
    worst AS (SELECT doc_id, lang, max(share) AS share FROM shares GROUP BY doc_id, lang),
    outcome AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    strata AS (SELECT lang, count(*) FILTER (good = 1) >= ln(count(*) OVER () / {ERROR!r}::DOUBLE) / -ln(1 - {RISK!r}::DOUBLE) AS own
        FROM worst JOIN outcome USING (doc_id) GROUP BY lang),
    named AS (SELECT lang, own, CASE WHEN own THEN 'own ' || coalesce(lang, 'null') ELSE 'rest' END AS stratum FROM strata),
    cells AS (SELECT stratum, cutoff, count(*) FILTER (good = 1) AS n, count(*) FILTER (good = 0) AS m,
        count(*) FILTER (good = 1 AND share >= cutoff) AS k, count(*) FILTER (good = 0 AND share >= cutoff) AS b
        FROM worst JOIN outcome USING (doc_id) JOIN named ON worst.lang IS NOT DISTINCT FROM named.lang,
            (SELECT unnest({list(CUTOFFS)})::DOUBLE AS cutoff)
        GROUP BY stratum, cutoff),
    tested AS (SELECT *, (SELECT count(DISTINCT stratum) FROM cells) AS tests,
        max(CASE WHEN k < n * {RISK!r}::DOUBLE THEN list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1)
                - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK!r}::DOUBLE) + (n - i) * ln(1 - {RISK!r}::DOUBLE))))
            ELSE 1.0 END) OVER (PARTITION BY stratum ORDER BY cutoff DESC) AS worst FROM cells),
    chosen AS (SELECT stratum, cutoff FROM tested WHERE worst <= {ERROR!r}::DOUBLE / tests AND b > 0
        QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY b / m - {GOOD_WEIGHT} * (k / n) DESC, cutoff DESC) = 1),
    failed AS (SELECT DISTINCT doc_id FROM worst s JOIN named ON s.lang IS NOT DISTINCT FROM named.lang
        JOIN chosen c USING (stratum) WHERE share >= cutoff)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND f.doc_id IS NULL AS kept
    FROM counts LEFT JOIN failed f USING (doc_id)"""

OP12 = """WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    split AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least
        FROM texts),
    said AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
        FROM labels GROUP BY doc_id),
    judged AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, concat(
            CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
            CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
            CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
            CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
            CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS fails
        FROM split LEFT JOIN said USING (doc_id)),
    cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM judged GROUP BY part, fails),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE list_unique([a.x, b.x, c.x, d.x, e.x]) = 5),
    steps AS (SELECT filter_order, step, filter_order[step] AS letter, left(filter_order, step - 1) AS before
        FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)),
    met AS (SELECT part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS failed,
            translate(before, fails, '') <> before AS gone, fails = letter AS alone
        FROM cells, steps),
    counted AS (SELECT part, filter_order, step, letter,
            coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (NOT gone AND failed), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (gone AND failed), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
            coalesce(sum(good) FILTER (NOT gone AND failed), 0)::BIGINT AS good_lost,
            coalesce(sum(toxic) FILTER (NOT gone AND failed), 0)::BIGINT AS toxic_lost
        FROM met GROUP BY part, filter_order, step, letter)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
        (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
    FROM counted"""

OP13 = """WITH vectors AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS id, b.label,
        list_inner_product(a.v, b.v)::BIGINT AS score
        FROM vectors a, vectors b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place
        FROM pairs WHERE label = anchor_label QUALIFY place <= 5),
    negatives AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, n.id AS negative_id,
        n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.id)::INTEGER AS rank
        FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND n.label <> p.anchor_label
            AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_tool_calls": OP1, "op2_host_reputation": OP2, "op5_content_sort": OP5,
        "op9_risk_controlled_rules": OP9, "op12_filter_audit": OP12, "op13_hard_negatives": OP13,
    }
