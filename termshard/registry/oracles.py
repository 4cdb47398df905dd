"""For every query the ANSI SQL that gives the same rows, written for DuckDB.

Its regular expressions know no look-around and no back-references, and its ``\\s`` is
ASCII, so patterns are spelled out here instead of taken from the library.
"""

from __future__ import annotations

from string import ascii_lowercase

from termshard.registry import queries as Q
from termshard.functions.tokens import ENGLISH_STOP_WORDS, HEADER_WORDS
from termshard.sources.stopwords import INDONESIAN_STOP_WORDS

SPACE = (
    r"\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}"
)
TRIPLES = "|".join(c * 3 for c in ascii_lowercase)


def sub(text: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


def words_sql(lowered: str) -> str:
    links = sub(lowered, rf"(https?://|www\.)[^{SPACE}]+")
    return f"trim({sub(sub(links, r'@[\p{L}\p{N}_]+'), '[^a-z]+')})"


def plain_sql(text: str) -> str:
    return words_sql(f"lower({text})")


def quoted_sql(text: str) -> str:
    return words_sql(sub(f"lower({text})", r'["\x{201c}\x{201d}\x{a0}\n]'))


def headed_sql(text: str) -> str:
    glued = rf"(ABSTRAK|Judul|Latar[{SPACE}]*Belakang)([A-Z])"
    return quoted_sql(sub(text, glued, r"\1 \2"))


def query_letters_sql(text: str) -> str:
    return sub(f"lower({text})", rf"[^a-z{SPACE}]", "")


def squeeze_sql(text: str) -> str:
    return f"trim({sub(text, f'[{SPACE}]+')})"


def split_sql(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda x: x <> '')"


def listed(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in sorted(set(words))) + ")"


def without(tokens: str, words) -> str:
    return f"list_filter({tokens}, lambda x: x NOT IN {listed(words)})"


def not_noise(x: str) -> str:
    return (
        f"(length({x}) >= 3 AND regexp_matches({x}, '[aeiou]') "
        f"AND NOT regexp_matches({x}, '{TRIPLES}') AND NOT regexp_matches({x}, '^[0-9]+$'))"
    )


def denoised(tokens: str) -> str:
    return f"list_filter({tokens}, lambda x: {not_noise('x')})"


def joined(tokens: str) -> str:
    return f"coalesce(array_to_string({tokens}, ' '), '')"


HEADED_TEXT = "concat('ABSTRAK', text, ' Latar Belakang', text, ' Judul', text)"

DOCS = "docs AS (SELECT source AS theme, doc_id, text FROM documents)"
TOKS = f"{DOCS}, toks AS (SELECT theme, doc_id, {split_sql(plain_sql('text'))} AS tokens FROM docs)"
WORDS = f"""{TOKS}, words AS (
  SELECT theme, doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos FROM toks)"""
TF = f"""{WORDS}, tf AS (
  SELECT theme, doc_id, term, count(*) AS tf FROM words WHERE length(term) >= 2 GROUP BY ALL)"""
VOCAB = f"""{TF}, vocab AS (
  SELECT theme, term, row_number() OVER (PARTITION BY theme ORDER BY term) - 1 AS term_id,
         count(*) AS df, sum(tf) AS cf FROM tf GROUP BY theme, term)"""
STOPPED = INDONESIAN_STOP_WORDS


def query_ctes(source: str) -> str:
    kept = f"array_to_string({without(f'string_split(letters, {chr(39)} {chr(39)})', STOPPED)}, ' ')"
    return f"""asked AS ({source}),
qtoks AS (SELECT query_id, {split_sql(squeeze_sql(kept))} AS tokens
  FROM (SELECT query_id, {query_letters_sql('text')} AS letters FROM asked
        WHERE {squeeze_sql('text')} <> '')),
qtf AS (SELECT query_id, term, count(*) AS qtf
  FROM (SELECT query_id, unnest(tokens) AS term FROM qtoks) WHERE length(term) >= 2 GROUP BY ALL)"""


BENCHMARK = "SELECT item_id AS query_id, text FROM benchmark"
SPOKEN = "SELECT conv_id * 1000 + turn AS query_id, text FROM conversations"


def cosine_ctes(source: str) -> str:
    return f"""{TF}, norms AS (SELECT theme, doc_id, sum(tf * tf) AS norm_sq FROM tf GROUP BY ALL),
{query_ctes(source)},
known AS (SELECT query_id, theme, term, qtf FROM qtf JOIN (SELECT DISTINCT theme, term FROM tf) USING (term)),
qnorm AS (SELECT query_id, theme, sum(qtf * qtf) AS q_norm_sq FROM known GROUP BY ALL),
dots AS (SELECT query_id, theme, doc_id, sum(tf * qtf) AS dot
  FROM tf JOIN known USING (theme, term) GROUP BY ALL),
scored AS (SELECT query_id, theme, doc_id,
    dot::DOUBLE / sqrt(norm_sq::DOUBLE * q_norm_sq::DOUBLE) AS similarity_score
  FROM dots JOIN norms USING (theme, doc_id) JOIN qnorm USING (query_id, theme))"""


def ranked(source: str, n: int, theme_order: str = "theme") -> str:
    return f"""{cosine_ctes(source)},
per_theme AS (SELECT *, row_number() OVER (PARTITION BY query_id, theme
    ORDER BY round(similarity_score, 12) DESC, doc_id) AS theme_rank FROM scored),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id
    ORDER BY round(similarity_score, 12) DESC, {theme_order}, doc_id) AS rank
  FROM per_theme WHERE theme_rank <= {n} QUALIFY rank <= {n})"""


def cosine_sql(source: str, n: int, theme_order: str = "theme") -> str:
    return f"""WITH {ranked(source, n, theme_order)}
SELECT query_id, theme, doc_id, round(similarity_score, 6) AS similarity_score,
       theme_rank::BIGINT AS theme_rank, rank::BIGINT AS rank FROM hits"""


def per_theme_sql(where: str, n: int) -> str:
    return f"""WITH {ranked(BENCHMARK, n)}
SELECT query_id, theme, doc_id, round(similarity_score, 6) AS similarity_score,
       theme_rank::BIGINT AS theme_rank FROM per_theme WHERE theme_rank <= {n} AND {where}"""


# --- stemming ------------------------------------------------------------------------------

ROOTS = f"""roots AS (SELECT DISTINCT form FROM (SELECT unnest({split_sql(plain_sql('text'))}) AS form
  FROM conversations))"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


# The rules of both stemmers, written out here so that the SQL shares nothing with what it tests.
# Indonesian endings, infixes, prefix rules as family, pattern and what is left.
PARTICLES = "lah kah tah pun".split()
POSSESSIVES = "ku mu nya".split()
ENDINGS = "i kan an is isme isasi".split()
INFIXES = "er el em in".split()
NEVER_TOGETHER = "be-i di-an ke-i ke-kan me-an se-i se-kan te-an".split()
PREFIXES = [line.split() for line in r"""
di ^di(..) \1
ke ^ke(..) \1
se ^se(..) \1
be ^ber([aiueo]) \1
be ^be(r[aiueo]) \1
be ^ber([^aiueor]) \1
be ^bel(ajar)$ \1
be ^be([^aiueorl]er[^aiueo]) \1
te ^ter([aiueo]) \1
te ^te(r[aiueo]) \1
te ^ter([^aiueor]) \1
te ^te([^aiueor]er[^aiueo]) \1
me ^me([lrwy][aiueo]) \1
me ^mem([bfv]) \1
me ^mem(pe) \1
me ^mem(p[^e]) \1
me ^me(mr?[aiueo]) \1
me ^mem(r?[aiueo]) p\1
me ^men([cdjszt]) \1
me ^me(n[aiueo]) \1
me ^men([aiueo]) t\1
me ^meng([ghqk]) \1
me ^meng([aiueo]) \1
me ^meng([aiueo]) k\1
me ^menge([^aiueo]) \1
me ^me(ny[aiueo]) \1
me ^meny([aiueo]) s\1
pe ^pe([wy][aiueo]) \1
pe ^per([aiueo]) \1
pe ^pe(r[aiueo]) \1
pe ^per([^aiueor]) \1
pe ^pem([bfv]) \1
pe ^pe(mr?[aiueo]) \1
pe ^pem(r?[aiueo]) p\1
pe ^pen([cdjz]) \1
pe ^pe(n[aiueo]) \1
pe ^pen([aiueo]) t\1
pe ^peng([ghq]) \1
pe ^peng([aiueo]) \1
pe ^peng([aiueo]) k\1
pe ^penge([^aiueo]) \1
pe ^pe(ny[aiueo]) \1
pe ^peny([aiueo]) s\1
pe ^pel(ajar)$ \1
pe ^pe(l[aiueo]) \1
pe ^pe([^aiueorwylmn]er[aiueo]) \1
pe ^pe([^aiueorwylmn][^e]) \1
ku ^ku(..) \1
ka ^kau(..) \1
""".strip().splitlines()]
# English suffixes and what takes their place; words with a stem of their own.
SECOND_STEP = """ational ate, tional tion, enci ence, anci ance, izer ize, bli ble, alli al, entli ent, eli e,
    ousli ous, ization ize, ation ate, ator ate, alism al, iveness ive, fulness ful, ousness ous, aliti al,
    iviti ive, biliti ble, fulli ful"""
THIRD_STEP = "icate ic, ative, alize al, iciti ic, ical ic, ful, ness"
FOURTH_STEP = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
OWN_STEMS = """sky sky, skies sky, dying die, lying lie, tying tie, news news, inning inning, innings inning,
    outing outing, outings outing, canning canning, cannings canning, howe howe, proceed proceed,
    exceed exceed, succeed succeed"""


def _pairs(listed_: str) -> list[tuple[str, str]]:
    return [(p.split() + [""])[:2] for p in listed_.split(",")]


def _ending_cte(name: str, before: str, endings, suffix: str) -> str:
    rows = _values((e,) for e in endings)
    return f"""{name} AS (SELECT * FROM {before} UNION ALL
  SELECT term, left(form, length(form) - length(e)), {suffix}, stripped + 1, family, prefixes, path
  FROM {before}, (VALUES {rows}) v(e) WHERE suffix(form, e) AND length(form) - length(e) >= 2)"""


def _prefix_cte(round_no: int) -> str:
    name, before = f"p{round_no}", "e3" if round_no == 1 else f"p{round_no - 1}"
    banned = f"AND left(form, 2) || '-' || suffix NOT IN {listed(NEVER_TOGETHER)}" if round_no == 1 else ""
    return f"""{name} AS (SELECT * FROM {before} UNION ALL SELECT * FROM (
  SELECT term, regexp_replace(form, pattern, keep) AS form, suffix, stripped, rule_family, {round_no},
         path * 100 + n
  FROM {before} JOIN rules ON left(form, 2) = rule_family
  WHERE prefixes = {round_no - 1} AND family <> rule_family {banned} AND regexp_matches(form, pattern))
  WHERE length(form) >= 2)"""


def indonesian_ctes(terms: str) -> str:
    """From a relation with ``term`` and ``uses`` to ``id_stems (term, id_stem, uses)``."""
    rules = _values((family, pattern, left, n) for n, (family, pattern, left) in enumerate(PREFIXES, 1))
    infixes = _values((f"^([^aiueo]){x}([aiueo])", n) for n, x in enumerate(INFIXES, len(PREFIXES) + 1))
    first = r"^(be.+lah|be.+an|me.+i|di.+i|pe.+i|te.+i)$"
    return f"""{ROOTS},
rules AS (SELECT * FROM (VALUES {rules}) r(rule_family, pattern, keep, n)),
e0 AS (SELECT term, term AS form, '' AS suffix, 0 AS stripped, '' AS family, 0 AS prefixes,
       0::BIGINT AS path FROM {terms} WHERE length(term) >= 4),
{_ending_cte('e1', 'e0', PARTICLES, 'suffix')},
{_ending_cte('e2', 'e1', POSSESSIVES, 'suffix')},
{_ending_cte('e3', 'e2', ENDINGS, 'e')},
{_prefix_cte(1)},
{_prefix_cte(2)},
{_prefix_cte(3)},
p4 AS (SELECT * FROM p3 UNION ALL SELECT * FROM (
  SELECT term, regexp_replace(form, pattern, '\\1\\2') AS form, suffix, stripped, family, prefixes + 1, path * 100 + n
  FROM p3, (VALUES {infixes}) v(pattern, n) WHERE regexp_matches(form, pattern)) WHERE length(form) >= 2),
found AS (SELECT term, form, path, CASE
    WHEN prefixes = 0 AND stripped = 0 THEN 0
    WHEN stripped = 0 AND prefixes > 0 AND regexp_matches(term, '{first}') THEN prefixes
    WHEN prefixes = 0 THEN 10 + stripped
    ELSE 20 + (3 - stripped) * 5 + prefixes END AS step
  FROM p4 JOIN roots USING (form)),
best AS (SELECT term, form FROM found
  QUALIFY row_number() OVER (PARTITION BY term ORDER BY step, path, form) = 1),
id_stems AS (SELECT t.term, coalesce(best.form, t.term) AS id_stem, uses
  FROM {terms} t LEFT JOIN best USING (term))"""


def stem_rules_sql() -> str:
    made = ["form"]
    for affix in Q.AFFIXES:
        before, after = affix.split("_")
        body = "substring(form, 2)" if before.endswith("-") else "form"
        if after.endswith("."):
            body, after = f"left(form, 1) || '{after[:-1]}' || substring(form, 2)", ""
        made.append(f"'{before.rstrip('-')}' || {body} || '{after}'")
    return f"""WITH made AS (SELECT DISTINCT term, 1 AS uses FROM (SELECT unnest([{', '.join(made)}]) AS term FROM
  (SELECT DISTINCT unnest({split_sql(plain_sql('text'))}) AS form FROM conversations))),
{indonesian_ctes('made')} SELECT term, id_stem AS stem FROM id_stems"""


def _shape(word: str) -> str:
    shape = f"translate({word}, 'abcdefghijklmnopqrstuvwxz', 'VCCCVCCCVCCCCCVCCCCCVCCCC')"
    first = f"regexp_replace(regexp_replace({shape}, '^y', 'C'), 'Vy', 'VC', 'g')"
    return f"replace(regexp_replace({first}, 'yy', 'VC', 'g'), 'y', 'V')"


def _m(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'VC', ''))) // 2)"


def _cut(column: str, k: int) -> str:
    return f"left({column}, length({column}) - {k})"


def _cases(rules) -> str:
    out = "CASE"
    for suffix, to, condition in rules:
        k = len(suffix)
        new = f"{_cut('w', k)} || '{to}'"
        if condition:
            test = condition(_cut("w", k), _cut("s", k))
            new = f"CASE WHEN {test} THEN {new} ELSE w END"
        out += f" WHEN suffix(w, '{suffix}') THEN {new}"
    return out + " ELSE w END"


def _cvc(w: str, s: str) -> str:
    return f"((suffix({s}, 'CVC') AND NOT regexp_matches({w}, '[wxy]$')) OR {s} = 'VC')"


def english_ctes(terms: str) -> str:
    """From a relation with ``term`` to ``en_stems (term, en_stem)``."""
    def m0(w, s):
        return f"{_m(s)} > 0"

    def m1(w, s):
        return f"{_m(s)} > 1"

    def vowel(w, s):
        return f"contains({s}, 'V')"

    double = "(" + " OR ".join(
        f"suffix({_cut('w', 1)}, '{c * 2}')" for c in "bcdfghjklmnpqrstvwxz") + ")"
    stem, stem_shape = _cut("w", 1), _cut("s", 1)
    steps = [
        f"CASE WHEN regexp_matches(w, '^.ies$') THEN {_cut('w', 1)} ELSE "
        + _cases([("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None)])
        + " END",
        f"CASE WHEN suffix(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {_cut('w', 1)} "
        f"ELSE {_cut('w', 2)} END ELSE "
        + _cases([("eed", "ee", m0), ("ed", "+", vowel), ("ing", "+", vowel)]) + " END",
        f"CASE WHEN NOT suffix(w, '+') THEN w "
        f"WHEN regexp_matches({stem}, '(at|bl|iz)$') THEN {stem} || 'e' "
        f"WHEN {double} AND regexp_matches({stem}, '[lsz]$') THEN {stem} "
        f"WHEN {double} THEN {_cut('w', 2)} "
        f"WHEN {_m(stem_shape)} = 1 AND {_cvc(stem, stem_shape)} THEN {stem} || 'e' "
        f"ELSE {stem} END",
        _cases([("y", "i", lambda w, s: f"length({w}) > 1 AND suffix({s}, 'C')")]),
        _cases([("alli", "al", m0)]),
        _cases([*[(a, b, m0) for a, b in _pairs(SECOND_STEP)],
                ("logi", "log", lambda w, s: f"{_m(_cut('s', 3))} > 0")]),
        _cases([(a, b, m0) for a, b in _pairs(THIRD_STEP)]),
        _cases([(a, "", (lambda w, s: f"{_m(s)} > 1 AND regexp_matches({w}, '[st]$')")
                 if a == "ion" else m1) for a in FOURTH_STEP.split()]),
        _cases([("e", "", lambda w, s: f"({_m(s)} > 1 OR ({_m(s)} = 1 AND NOT {_cvc(w, s)}))")]),
        f"CASE WHEN suffix(w, 'll') AND {_m(_cut('s', 1))} > 1 THEN {_cut('w', 1)} ELSE w END",
    ]
    ctes = [f"s0 AS (SELECT term, term AS w FROM {terms})"]
    for i, step in enumerate(steps, 1):
        ctes.append(
            f"s{i} AS MATERIALIZED (SELECT term, {step} AS w "
            f"FROM (SELECT term, w, {_shape('w')} AS s FROM s{i - 1}))"
        )
    own = _values(_pairs(OWN_STEMS))
    ctes.append(
        f"""en_stems AS (SELECT s.term, coalesce(own.stem,
    CASE WHEN length(s.term) <= 2 THEN s.term ELSE s.w END) AS en_stem
  FROM s{len(steps)} s LEFT JOIN (VALUES {own}) own(term, stem) ON own.term = s.term)"""
    )
    return ",\n".join(ctes)


HYBRID = """CASE WHEN id_stem <> term THEN id_stem
    WHEN regexp_matches(term, '^[a-z]*(ing|ed|tion|s)$') THEN en_stem ELSE term END"""


def hybrid_ctes(terms: str) -> str:
    return f"""{indonesian_ctes(terms)},
{english_ctes(terms)},
stems AS (SELECT term, {HYBRID} AS stem, uses FROM id_stems JOIN en_stems USING (term))"""


def id_ctes(terms: str) -> str:
    return f"{indonesian_ctes(terms)},\nstems AS (SELECT term, id_stem AS stem, uses FROM id_stems)"


TERMS = "terms AS (SELECT term, count(*) AS uses FROM {rows} GROUP BY term)"
ALL_TERMS = f"{WORDS}, {TERMS.format(rows='words')}"


def profile_sql(start: str, hybrid: bool) -> str:
    """``start`` defines ``kept (theme, doc_id, tokens)``, the tokens before stemming."""
    after = f"WHERE stem NOT IN {listed(Q.STOP_LIST)} AND {not_noise('stem')}" if hybrid else ""
    return f"""WITH {start},
words AS (SELECT theme, doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM kept),
{TERMS.format(rows='words')},
{(hybrid_ctes if hybrid else id_ctes)('terms')},
stemmed AS (SELECT theme, doc_id, string_agg(stem, ' ' ORDER BY pos) AS tokens
  FROM words JOIN stems USING (term) {after} GROUP BY ALL)
SELECT theme, doc_id, coalesce(stemmed.tokens, '') AS tokens
FROM docs LEFT JOIN stemmed USING (theme, doc_id)"""


def kept(tokens: str) -> str:
    return f"{DOCS}, kept AS (SELECT theme, doc_id, {tokens} AS tokens FROM docs)"


THESIS_TOKENS = denoised(without(split_sql(quoted_sql("text")), Q.STOP_LIST))
# Of a doubled text only the words of odd length stay, each followed by its longer form.
UNDOUBLED = (
    f"flatten(list_transform(list_filter({split_sql(plain_sql('text'))}, lambda x: length(x) % 2 = 1),"
    " lambda x: [x, x || 'an']))"
)

# --- full text -----------------------------------------------------------------------------

INDEXED = f"length(x) >= 2 AND x NOT IN {listed(ENGLISH_STOP_WORDS)}"
TEXT = f"""{TOKS}, ftoks AS (SELECT theme, doc_id, list_filter(tokens, lambda x: {INDEXED}) AS tokens FROM toks),
fwords AS (SELECT theme, doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos FROM ftoks),
lengths AS (SELECT theme, doc_id, len(tokens) AS dl FROM ftoks),
post AS (SELECT theme, term, doc_id, count(*) AS tf FROM fwords GROUP BY ALL),
fvocab AS (SELECT theme, term, count(*) AS df, sum(tf) AS cf FROM post GROUP BY ALL),
corpus AS (SELECT theme, count(*) AS n_docs, avg(dl) AS avg_dl FROM lengths GROUP BY theme),
weighted AS (SELECT theme, doc_id, term,
    (ln(n_docs / (df + 1)) + 1) * tf * 2.2::DOUBLE
      / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_dl)) AS bm25
  FROM post JOIN lengths USING (theme, doc_id) JOIN fvocab USING (theme, term)
  JOIN corpus USING (theme))"""
WORD_OF_QUERY = rf"[\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]+(?:\.?[\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]+)*"


def query_words_sql(text: str) -> str:
    found = f"regexp_extract_all(lower({text}), '{WORD_OF_QUERY}')"
    return f"list_filter({found}, lambda x: {INDEXED})"


TEXT_QUERIES = f"""qterms AS (SELECT query_id, unnest(list_distinct({query_words_sql('text')})) AS term
  FROM ({BENCHMARK}))"""


def top_hits(limit: int = 10) -> str:
    return f"""SELECT query_id, theme || '_' || doc_id AS id, round(score, 6) AS score,
    row_number() OVER (PARTITION BY query_id, theme
      ORDER BY round(score, 9) DESC, doc_id)::BIGINT AS rank
  FROM hits QUALIFY rank <= {limit}"""


def bm25_sql(required: bool, where: str = "true") -> str:
    all_of = "HAVING count(*) = any_value(needed)" if required else ""
    return f"""WITH {TEXT}, {TEXT_QUERIES},
needs AS (SELECT query_id, count(*) AS needed FROM qterms GROUP BY ALL),
hits AS (SELECT query_id, theme, doc_id, sum(bm25) AS score
  FROM weighted JOIN qterms USING (term) JOIN needs USING (query_id) WHERE {where}
  GROUP BY query_id, theme, doc_id {all_of})
{top_hits()}"""


def _analysed(value: str) -> list[str]:
    return [w for w in value.lower().split() if len(w) > 1 and w not in ENGLISH_STOP_WORDS]


def _leaf_sql(row: dict) -> str | None:
    """Theme, document and score of what one clause matches; nothing for an ignored one."""
    kind, value = row.get("kind", "term"), row.get("value")
    boost = float(row.get("boost", 1.0))
    words = _analysed(value) if kind in ("term", "phrase") else None
    if words == []:
        return None
    if kind == "every":
        return f"SELECT theme, doc_id, {boost}::DOUBLE AS score FROM docs"
    if kind == "term":
        return (
            f"SELECT theme, doc_id, {boost}::DOUBLE * sum(bm25) AS score FROM weighted "
            f"WHERE term IN {listed(words)} GROUP BY theme, doc_id HAVING count(*) = {len(set(words))}"
        )
    if kind == "phrase":
        slop, last = row.get("slop", 0), len(words) - 1
        near = "w{i}.pos > w{before}.pos" if slop else "w{i}.pos = w0.pos + {i}"
        joins = " ".join(
            f"JOIN fwords w{i} ON w{i}.theme = w0.theme AND w{i}.doc_id = w0.doc_id "
            f"AND {near.format(i=i, before=i - 1)} AND w{i}.pos <= w0.pos + {slop + i} AND w{i}.term = '{w}'"
            for i, w in enumerate(words) if i
        )
        score = " + ".join(
            f"(SELECT bm25 FROM weighted b WHERE b.theme = d.theme AND b.doc_id = d.doc_id "
            f"AND b.term = '{w}')" for w in words
        )
        return (
            f"SELECT theme, doc_id, {boost}::DOUBLE * ({score}) AS score FROM (SELECT DISTINCT "
            f"w0.theme, w0.doc_id FROM fwords w0 {joins} WHERE w0.term = '{words[0]}' "
            f"AND w{last}.pos - w0.pos - {last} <= {slop}) d"
        )
    if kind == "id":
        theme, doc_id = value.rsplit("_", 1)
        return (
            f"SELECT theme, doc_id, {boost}::DOUBLE AS score FROM docs "
            f"WHERE theme = '{theme}' AND doc_id = {doc_id}"
        )
    low, high = value and value.lower(), (row.get("upper") or "").lower()
    if kind == "range":
        over, under = (">" if row.get("exclude_value") else ">="), ("<" if row.get("exclude_upper") else "<=")
        test = " AND ".join([f"term {over} '{low}'"] * bool(low) + [f"term {under} '{high}'"] * bool(high))
    elif kind == "prefix":
        test = f"term LIKE '{low}%'"
    else:
        test = "term LIKE '" + low.replace("*", "%").replace("?", "_") + "'"
    return f"SELECT DISTINCT theme, doc_id, {boost}::DOUBLE AS score FROM post WHERE {test}"


def clause_sql(name: str) -> str:
    """Every document of the corpus against the clauses of every query, groups as what they say: all of
    the must, one of the should if there is no must, none of the must_not. A group of neither must
    nor should is a restriction unless it is a should itself."""
    leaves, queries = {}, []
    rows = Q.CLAUSE_QUERIES[name]

    def judged(query: int, parent: int | None) -> tuple[str, str, bool] | None:
        """Whether a group holds, its score, and whether it has a positive clause."""
        must, should, banned, limits, score = [], [], [], [], []
        for row in rows:
            if row["query_id"] != query or row.get("parent") != parent:
                continue
            occur = row.get("occur", "must")
            if row.get("kind") == "group":
                inner = judged(query, row["clause_id"])
                if inner is None:
                    continue
                holds, own, positive = inner
                if not positive and occur != "should":
                    limits.append(f"({holds})" if occur == "must" else f"NOT ({holds})")
                    continue
                own = f"{float(row.get('boost', 1.0))}::DOUBLE * ({own})"
            else:
                body = _leaf_sql(row)
                if body is None:
                    continue
                leaf = f"l{query}_{row['clause_id']}"
                leaves[leaf] = body
                holds, own = f"{leaf}.doc_id IS NOT NULL", f"{leaf}.score"
            {"must": must, "should": should, "must_not": banned}[occur].append(f"({holds})")
            if occur != "must_not":
                score.append(f"CASE WHEN {holds} THEN {own} ELSE 0.0 END")
        if not (must or should or banned or limits):
            return None
        tests = must + [f"NOT {b}" for b in banned] + limits
        if should and not must:
            tests.append(f"({' OR '.join(should)})")
        return " AND ".join(tests), " + ".join(score) if score else "1.0::DOUBLE", bool(score)

    for query in sorted({r["query_id"] for r in rows}):
        if (top := judged(query, None)) is not None:
            joins = " ".join(
                f"LEFT JOIN {leaf} ON {leaf}.theme = d.theme AND {leaf}.doc_id = d.doc_id"
                for leaf in leaves if leaf.startswith(f"l{query}_")
            )
            queries.append(
                f"SELECT {query}::BIGINT AS query_id, d.theme, d.doc_id, {top[1]} AS score FROM docs d {joins} WHERE {top[0]}"
            )
    ctes = ", ".join(f"{leaf} AS ({body})" for leaf, body in leaves.items())
    return f"""WITH {TEXT}, {ctes},
hits AS ({' UNION ALL '.join(queries)})
{top_hits()}"""


def _form(expression: str) -> str:
    return f"SELECT source AS theme, doc_id, {expression} AS normalized FROM documents"


def _tokens(expression: str) -> str:
    return f"SELECT source AS theme, doc_id, {joined(expression)} AS tokens FROM documents"


ALL_BREAKS = r"\r\n|[\n\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def all_oracles() -> dict[str, str]:
    flattened = sub("text", ALL_BREAKS)
    picked = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS text_column, count(*) AS n_rows, "
        f"sum(length({column}))::BIGINT AS n_chars FROM {table}"
        for table, column in (
            ("documents", "text"), ("pages", "url"), ("benchmark", "text"), ("conversations", "text"),
        )
    )
    content = f"""{ranked(BENCHMARK, 5)}
SELECT query_id, rank::BIGINT AS rank, theme, doc_id"""
    headed_tokens = split_sql(headed_sql(HEADED_TEXT))
    return {
        "corpus_csv_roundtrip": "SELECT source AS theme, doc_id, nullif(text, '') AS text FROM documents",
        "corpus_csv_repair": f"SELECT source AS theme, doc_id, nullif({flattened}, '') AS text FROM documents",
        "token_literals": f"""WITH {TOKS} SELECT theme, doc_id, '[' || coalesce(array_to_string(
            list_transform(tokens, lambda x: '''' || x || ''''), ', '), '') || ']' AS clean_tokens FROM toks""",
        "token_literal_roundtrip": f"""WITH {TOKS} SELECT 'all' AS theme,
            row_number() OVER (ORDER BY doc_id) - 1 AS doc_id, {joined('tokens')} AS tokens FROM toks""",
        "pick_text_column": picked,
        "document_keys": "SELECT source || '_' || doc_id AS id, length(text) AS n_chars FROM documents",
        "extra_stopwords": f"""SELECT unnest({split_sql(plain_sql('text'))}) AS term FROM benchmark
            UNION SELECT unnest([{', '.join(f"'{w}'" for w in Q.STOP_LIST)}])""",
        "load_report": """SELECT 'stored' AS theme, 0::BIGINT AS ordinal, 1::BIGINT AS loaded,
            1::BIGINT AS searchable, count(*) AS n_docs, 0::BIGINT AS failed FROM documents
            UNION ALL SELECT 'listed', 1, 1, 0, count(*), 0 FROM documents
            UNION ALL SELECT 'missing', 2, 0, 0, 0, 1""",
        "cleaning_job": profile_sql(
            "docs AS (SELECT 'all' AS theme, doc_id, text FROM documents), kept AS (SELECT theme, doc_id, "
            f"{THESIS_TOKENS} AS tokens FROM docs)", hybrid=False),
        "normalize_plain": _form(plain_sql("text")),
        "normalize_quoted": _form(quoted_sql("text")),
        "normalize_query": _form(squeeze_sql(query_letters_sql("text"))),
        "normalize_headed": _form(headed_sql(HEADED_TEXT)),
        "normalize_redup": _form(joined(UNDOUBLED)),
        "normalize_pages": f"SELECT page_id, {plain_sql('html')} AS normalized, {plain_sql('url')} AS place FROM pages",
        "tokenize": f"WITH {TOKS} SELECT theme, doc_id, len(tokens) AS n_tokens, {joined('tokens')} AS tokens FROM toks",
        "stopword_filter": _tokens(without(split_sql(plain_sql("text")), Q.STOP_LIST)),
        "keyword_filter": _tokens(without(headed_tokens, HEADER_WORDS)),
        "noise_filter": _tokens(denoised(split_sql(plain_sql("text")))),
        "query_analysis": f"WITH {query_ctes(BENCHMARK)} SELECT query_id, {joined('tokens')} AS query FROM qtoks",
        "stem_map": f"WITH {ALL_TERMS}, {id_ctes('terms')} SELECT term, stem, uses FROM stems",
        "stem_map_hybrid": f"WITH {ALL_TERMS}, {hybrid_ctes('terms')} SELECT term, stem, uses FROM stems",
        "stem_rules": stem_rules_sql(),
        "stem_many_roots": stem_rules_sql(),
        "stem_english": f"WITH {ALL_TERMS}, {english_ctes('terms')} SELECT term, en_stem AS stem FROM en_stems",
        "stem_tokens": f"""WITH {ALL_TERMS}, {hybrid_ctes('terms')},
            stemmed AS (SELECT theme, doc_id, string_agg(stem, ' ' ORDER BY pos) AS tokens
              FROM words JOIN stems USING (term) GROUP BY ALL)
            SELECT theme, doc_id, coalesce(stemmed.tokens, '') AS tokens
            FROM docs LEFT JOIN stemmed USING (theme, doc_id)""",
        "stemmed_queries": f"""WITH {query_ctes(BENCHMARK).replace(listed(STOPPED), listed(Q.STOP_LIST))},
            words AS (SELECT query_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM qtoks),
            {TERMS.format(rows='words')}, {id_ctes('terms')},
            stemmed AS (SELECT query_id, string_agg(stem, ' ' ORDER BY pos) AS query
              FROM words JOIN stems USING (term) GROUP BY ALL)
            SELECT query_id, coalesce(query, '') AS query FROM qtoks LEFT JOIN stemmed USING (query_id)""",
        "profile_thesis": profile_sql(kept(THESIS_TOKENS), hybrid=False),
        "profile_headed": profile_sql(
            kept(denoised(without(headed_tokens, [*Q.STOP_LIST, *HEADER_WORDS]))), hybrid=False),
        "profile_news": profile_sql(kept(without(split_sql(plain_sql("text")), Q.STOP_LIST)), hybrid=True),
        "profile_essay": profile_sql(kept(without(UNDOUBLED, Q.STOP_LIST)), hybrid=True),
        "term_frequencies": f"WITH {TF} SELECT theme, doc_id, term, tf FROM tf",
        "vocabulary": f"WITH {VOCAB} SELECT theme, term, term_id, df, cf::BIGINT AS cf FROM vocab",
        "doc_norms": f"""WITH {TF} SELECT theme, doc_id, coalesce(sum(tf), 0)::BIGINT AS dl,
            round(sqrt(coalesce(sum(tf * tf), 0)::DOUBLE), 6) AS norm
            FROM docs LEFT JOIN tf USING (theme, doc_id) GROUP BY ALL""",
        "bow_vectors": f"""WITH {VOCAB} SELECT theme, doc_id,
            string_agg(term_id || ':' || tf, ' ' ORDER BY term_id) AS vector
            FROM tf JOIN vocab USING (theme, term) GROUP BY ALL""",
        "query_vectors": f"""WITH {cosine_ctes(BENCHMARK)} SELECT query_id, theme, term, qtf,
            round(sqrt(q_norm_sq::DOUBLE), 6) AS query_norm FROM known JOIN qnorm USING (query_id, theme)""",
        "cosine_single": per_theme_sql(f"theme = '{Q.ONE_THEME}'", 5),
        "cosine_each": per_theme_sql("true", 3),
        "cosine_all": cosine_sql(BENCHMARK, 5),
        "cosine_batch": cosine_sql(SPOKEN, 10),
        "cosine_stored": cosine_sql(BENCHMARK, 5, "theme DESC"),
        "cosine_with_content": f"WITH {content}, {joined('tokens')} AS content FROM hits JOIN toks USING (theme, doc_id)",
        "result_preview": f"""WITH {content}, theme || '_' || doc_id AS document,
            round(similarity_score, 4) AS score, left({joined('tokens')}, 200) AS preview
            FROM hits JOIN toks USING (theme, doc_id)""",
        "result_counts": f"""WITH {ranked(BENCHMARK, 5)} SELECT query_id, count(*) AS n_results
            FROM per_theme WHERE theme_rank <= 5 GROUP BY query_id""",
        "postings": f"""WITH {TEXT} SELECT theme, term, doc_id, count(*) AS tf,
            string_agg(pos, ' ' ORDER BY pos) AS positions, any_value(dl)::BIGINT AS dl
            FROM fwords JOIN lengths USING (theme, doc_id) GROUP BY theme, term, doc_id""",
        "term_stats": f"""WITH {TEXT} SELECT theme, term, df, cf::BIGINT AS cf, n_docs,
            round(avg_dl, 6) AS avg_dl FROM fvocab JOIN corpus USING (theme)""",
        "bm25_and": bm25_sql(required=True),
        "bm25_or": bm25_sql(required=False),
        "bm25_stored": bm25_sql(required=False),
        **{name: clause_sql(name) for name in Q.CLAUSE_QUERIES},
        "corpus_stats": """SELECT source AS theme, count(*) AS n_docs, grouping(source)::BIGINT AS is_total
            FROM documents GROUP BY ROLLUP (source)""",
        "cleaning_report": """SELECT 'all' AS theme, count(*) AS rows_read, count(*) AS rows_written
            FROM documents""",
        "column_check": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {found}::BIGINT AS found, count(*) AS n_rows FROM {t}"
            for t, found in (("documents", 1), ("pages", 0), ("benchmark", 1), ("labels", 0))),
        "blank_and_null": f"""SELECT 3 * doc_id + kind AS query_id,
            CASE WHEN kind = 0 THEN len({split_sql(plain_sql('text'))}) ELSE 0 END AS n_tokens,
            (kind = 0 AND {squeeze_sql('text')} <> '')::BIGINT AS asked
            FROM documents, (SELECT unnest([0, 1, 2])::BIGINT AS kind)""",
        "stored_tokens": f"WITH {TOKS} SELECT theme, doc_id, {joined('tokens')} AS tokens FROM toks",
        "searchable_report": """SELECT theme, loaded::BIGINT AS loaded, searchable::BIGINT AS searchable,
            loaded * n AS n_docs FROM (VALUES ('indexed', 1, 1), ('unindexed', 1, 0), ('empty', 1, 0),
            ('missing', 0, 0)) t(theme, loaded, searchable), (SELECT count(*) AS n FROM documents)""",
        "profile_large_terms": profile_sql(kept(THESIS_TOKENS), hybrid=False),
        "cosine_large_batch": per_theme_sql("true", 3),
        "bm25_large_batch": bm25_sql(required=False),
        "cosine_pruned": per_theme_sql("true", 3),
        "bm25_pruned": bm25_sql(required=False),
        "stats_ordered": """SELECT source AS theme, count(*) AS n_docs,
            row_number() OVER (ORDER BY source DESC) - 1 AS ordinal FROM documents GROUP BY source""",
        "loaded_themes": """SELECT count(DISTINCT source) AS n_themes, count(*) AS n_docs FROM documents""",
    }
