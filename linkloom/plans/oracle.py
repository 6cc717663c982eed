"""The same operators in DuckDB SQL, from the same rule tables."""

from __future__ import annotations

from linkloom.functions import fold, rules
from linkloom.functions.text import PUNCTUATION


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _map(pairs: dict[str, str], key: str) -> str:
    return f"coalesce(map_extract(MAP {{{', '.join(f'{quoted(a)}: {quoted(b)}' for a, b in pairs.items())}}}, {key})[1], {key})"


def clean(x: str) -> str:
    old, new = fold.latin_table()
    out = f"translate(coalesce({x}, ''), {quoted(old)}, {quoted(new)})"
    for a, b in fold.several().items():
        out = f"replace({out}, {quoted(a)}, {quoted(b)})"
    out = f"lower(regexp_replace({out}, '[^\\x00-\\x7F]', ' ', 'g'))"
    return f"trim(regexp_replace(translate({out}, {quoted(PUNCTUATION)}, {quoted(' ' * len(PUNCTUATION))}), '[\\t-\\r \\x1c-\\x1f]+', ' ', 'g'))"


def by_country(make) -> str:
    cases = " ".join(f"WHEN {quoted(code)} THEN {make(rules.rules_for(code))}" for code in rules.locales())
    return f"CASE country_norm {cases} ELSE {make(rules.rules_for(''))} END"


def name_words(r: rules.Locale) -> str:
    out = f"list_aggregate(list_transform(string_split(cname, ' '), lambda t: {_map(r.name, 't')}), 'string_agg', ' ')"
    if r.phrases:
        out = f"concat(' ', replace({out}, ' ', '  '), ' ')"
        for a, b in sorted(r.phrases.items(), key=lambda p: -len(p[0].split())):
            out = f"replace({out}, {quoted(' ' + a.replace(' ', '  ') + ' ')}, {quoted(' ' + b.replace(' ', '  ') + ' ')})"
        out = f"trim(regexp_replace({out}, ' +', ' ', 'g'))"
    return out


def address_words(r: rules.Locale) -> str:
    return f"list_filter(list_transform(string_split(caddress, ' '), lambda t: {_map(r.address, 't')}), lambda t: t <> '')"


def country_code(x: str) -> str:
    return f"CASE WHEN trim(coalesce({x}, '')) = '' THEN 'UNKNOWN' ELSE {_map(rules.COUNTRIES, f'upper(trim({x}))')} END"


DOCUMENTS = r"""
src AS (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, (doc_id % 3 + 1)::INTEGER AS source,
        regexp_extract(text, '^[^.\n,]*', 0) AS business_name,
        n_chars || ' ' || regexp_extract(text, '^[^.\n,]*[.\n,][ ]*([^.\n,]*)', 1) AS business_address, upper(lang) AS country FROM documents)"""

TRADERS = """
src AS (SELECT 'S' || x.source || '-' || x.k AS entity_id, x.source, x.business_name, (x.k % 1000) || ' harbour road' AS business_address, n_name AS country
        FROM (SELECT 1 AS source, c_custkey AS k, c_name AS business_name, c_nationkey AS n FROM customer
              UNION ALL SELECT 2, s_suppkey, s_name, s_nationkey FROM supplier) x JOIN nation ON x.n = n_nationkey)"""


def normalized(source: str = DOCUMENTS) -> str:
    """WITH-parts up to s1 and ot, normalised."""
    country = country_code("country")
    return f"""{source},
n1 AS (SELECT *, {country} AS country_norm, {clean("business_name")} AS cname, {clean("business_address")} AS caddress FROM src),
n2 AS (SELECT *, {by_country(name_words)} AS norm_name, {by_country(address_words)} AS toks FROM n1),
n3 AS (SELECT *, list_filter(toks, lambda t: regexp_matches(t, '^[0-9]+[a-z]?$'))[1] AS street_number FROM n2),
n4 AS (SELECT *, list_position(toks, street_number) AS pos FROM n3),
norm AS (SELECT entity_id, source, business_name, business_address, country, country_norm, norm_name, street_number,
   CASE WHEN street_number IS NULL THEN coalesce(array_to_string(toks, ' '), '')
        ELSE trim(concat(street_number, ' ', coalesce(array_to_string(list_concat(toks[1:pos - 1], toks[pos + 1:]), ' '), ''))) END AS norm_address,
   (street_number IS NULL)::INTEGER AS is_landmark FROM n4),
s1 AS (SELECT * FROM norm WHERE source = 1),
ot AS (SELECT *, 'source' || source AS source_tag FROM norm WHERE source > 1)"""


def key_pairs(key: str, least: int = 2) -> str:
    k = lambda a: key.format(a=a)
    return f"""SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS other_entity_id, b.source_tag, 0::INTEGER AS in_rank
FROM s1 a JOIN ot b ON a.country_norm = b.country_norm AND {k("a")} = {k("b")} WHERE length({k("a")}) >= {least} AND length({k("b")}) >= {least}"""


KEYS = {
    "name_prefix": key_pairs("left({a}.norm_name, 5)"),
    "name_suffix": key_pairs("right({a}.norm_name, 5)"),
    "address_number": key_pairs("{a}.street_number"),
    "address_prefix": key_pairs("left({a}.norm_address, 6)"),
}
NUMBERS = r"list_distinct(regexp_extract_all(concat_ws(' ', norm_name, norm_address), '\b\d+\b'))"
RARE_PARTS = f"""
ta AS (SELECT entity_id, country_norm, unnest({NUMBERS}) AS key FROM s1), tb AS (SELECT entity_id, country_norm, source_tag, unnest({NUMBERS}) AS key FROM ot),
rare AS (SELECT country_norm, key FROM ta WHERE length(key) >= 2 GROUP BY ALL HAVING count(DISTINCT entity_id) <= 50)"""
RARE = """SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS other_entity_id, b.source_tag, 0::INTEGER AS in_rank
FROM ta a JOIN rare USING (country_norm, key) JOIN tb b USING (country_norm, key)"""

TRUTH = """
d0 AS (SELECT doc_id, lang, md5(text) AS digest, doc_id % 3 + 1 AS source FROM documents),
truth AS (SELECT 'S1-' || a.doc_id AS source1_entity_id, 'S' || b.source || '-' || b.doc_id AS source_id, 'source' || b.source AS source_tag
          FROM d0 a JOIN d0 b ON a.digest = b.digest AND a.lang = b.lang WHERE a.source = 1 AND b.source > 1)"""

UNION = "pairs AS (" + " UNION ALL ".join(f"SELECT *, '{n}' AS strategy_name, {i} AS strategy_rank FROM ({q})" for i, (n, q) in enumerate([*KEYS.items(), ("rare_numeric_token", RARE)])) + ")"
FIRST = """
first AS (SELECT source1_entity_id, other_entity_id, source_tag, min(strategy_rank)::INTEGER AS strategy_rank, arg_min(strategy_name, strategy_rank) AS strategy_name, 0::INTEGER AS in_rank FROM pairs GROUP BY ALL)"""
CAP = """
capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_tag, source1_entity_id ORDER BY strategy_rank, in_rank, other_entity_id) AS n FROM first) WHERE n <= {cap})"""

JACCARD = """CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"""


def tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))"


def features_sql() -> dict[str, str]:
    """The features that both engines compute without Python, of rows with a_* and b_*."""
    na, nb, aa, ab = "a.norm_name", "b.norm_name", "a.norm_address", "b.norm_address"
    most = lambda x, y: f"greatest(length({x}), length({y}))"
    ratio = lambda x, y: f"CASE WHEN {most(x, y)} = 0 THEN 1.0::DOUBLE ELSE least(length({x}), length({y}))::DOUBLE / {most(x, y)} END"
    prefix = f"CASE WHEN {most(na, nb)} = 0 THEN 1.0::DOUBLE ELSE list_max(list_filter(range(0, least(length({na}), length({nb})) + 1), lambda i: left({na}, i) = left({nb}, i)))::DOUBLE / {most(na, nb)} END"
    exact = lambda x, y: f"(trim({x}) = trim({y}))::INTEGER::DOUBLE"
    missing = lambda x, y: f"(trim({x}) = '' OR trim({y}) = '')::INTEGER::DOUBLE"
    return {
        "name_exact_match": exact(na, nb),
        "name_token_jaccard": JACCARD.format(a=tokens(na), b=tokens(nb)),
        "name_common_prefix_len": prefix,
        "name_len_ratio": ratio(na, nb),
        "address_exact_match": exact(aa, ab),
        "address_token_overlap": JACCARD.format(a=tokens(aa), b=tokens(ab)),
        "street_number_match": "CASE WHEN coalesce(a.street_number, '') = '' OR coalesce(b.street_number, '') = '' THEN 0.5::DOUBLE WHEN a.street_number = b.street_number THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
        "address_len_ratio": ratio(aa, ab),
        "is_landmark_s1": "a.is_landmark::DOUBLE",
        "is_landmark_other": "b.is_landmark::DOUBLE",
        "country_agree": "(a.country_norm = b.country_norm)::INTEGER::DOUBLE",
        "name_missing": missing(na, nb),
        "address_missing": missing(aa, ab),
    }


def lcs(pairs: str, names: list[tuple[str, str]]) -> str:
    """Recursive parts that compute, for the string columns of ``pairs`` (under 60 characters), LCS bit by bit."""
    parts = []
    for i, (a, b) in enumerate(names):
        masks = f"list_sum(list_transform(range(0, length(x)), lambda p: CASE WHEN substr(x, p + 1, 1) = substr(y, i + 1, 1) THEN 1::BIGINT << p::INTEGER ELSE 0::BIGINT END))::BIGINT"
        parts.append(f"""
l{i}s(x, y, i, r) AS (SELECT DISTINCT {a}, {b}, 0, (1::BIGINT << length({a})::INTEGER) - 1 FROM {pairs} WHERE length({a}) > 0
  UNION ALL SELECT x, y, i + 1, (((r + m) | (r - m)) & ((1::BIGINT << length(x)::INTEGER) - 1)) FROM (SELECT *, r & {masks} AS m FROM l{i}s WHERE i < length(y))),
l{i} AS (SELECT x, y, length(x) - bit_count(r)::BIGINT AS lcs FROM l{i}s WHERE i = length(y))""")
    return ",".join(parts)
