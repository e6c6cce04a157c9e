"""The SQL of the core queries, for an engine that reads the same tables as views."""

from __future__ import annotations

# Fixed values, written out so that the SQL doesn't share those of the code under test.
ACCENTS = ("àâäáãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
NAME_WORDS = {"pvt": "private", "ltd": "limited", "corp": "corporation", "co": "company", "inc": "incorporated"}
ADDRESS_WORDS = {"rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "apt": "apartment", "fl": "floor", "sec": "sector", "nr": "near"}
STOPWORDS = ["private", "limited", "company", "corporation", "incorporated", "and", "the", "of", "pvt", "ltd", "co", "inc"]
KEYS = {
    "exact_name": (("name_norm",), 1000), "exact_address": (("addr_norm",), 2000), "postal": (("postal",), 5000), "first2": (("name_first2",), 1000),
    "name_postal": (("name_norm", "postal"), 3000), "addr_postal": (("addr_norm", "postal"), 3000),
}
TOKEN_FIELDS = {"name_token": ("name_norm", 2), "address_token": ("addr_norm", 1)}
STRENGTH = {"exact_name": 100, "exact_address": 95, "name_postal": 90, "addr_postal": 85, "postal": 70, "name_token": 65, "address_token": 60, "first2": 40}
BONUS = 20
FLAGS = ["exact_name", "exact_address", "postal", "first2", "name_postal", "addr_postal", "name_token", "address_token"]
TEST_ORDER = ["exact_name", "exact_address", "postal", "name_token", "address_token", "first2"]
BLOCK_FEATURES = ["exact_name", "exact_address", "postal", "name_token", "address_token", "first2", "name_postal", "addr_postal"]
ABSENT = ["none", "null", "nil", "nan", "na", "no match", "no matches", "no-match", "nomatch", "not found", "not matched", "unmatched", "empty", "nothing"]


def _norm(x: str, words: dict[str, str], expand: bool = True, folded: bool = False) -> str:
    x = f"lower(trim(coalesce({x}, '')))"
    if folded:
        x = f"translate({x}, '{ACCENTS[0]}', '{ACCENTS[1]}')"
    x = f"trim(regexp_replace({x}, '[^a-z0-9]+', ' ', 'g'))"
    if expand:
        for a, b in words.items():
            x = f"regexp_replace({x}, '\\b{a}\\b', '{b}', 'g')"
    return x


_SRC = "src AS (SELECT *, 'S1' AS source FROM train_source1 UNION ALL BY NAME SELECT *, 'S2' AS source FROM train_source2 UNION ALL BY NAME SELECT *, 'S3' AS source FROM train_source3)"
_FIRST2 = lambda x: f"array_to_string(string_split({x}, ' ')[1:2], ' ')"
_NORM = f"""{_SRC}, nn AS (SELECT entity_id, {_norm('business_name', NAME_WORDS)} AS name_norm, {_norm('business_address', ADDRESS_WORDS)} AS addr_norm,
  regexp_extract(coalesce(business_address, ''), '([0-9]{{5,6}})', 1) AS postal FROM src),
nz AS (SELECT entity_id, name_norm, regexp_replace(name_norm, '[^a-z0-9]', '', 'g') AS name_alnum, addr_norm, postal, split_part(name_norm, ' ', 1) AS name_first, {_FIRST2('name_norm')} AS name_first2,
  split_part(addr_norm, ' ', 1) AS addr_first, {_FIRST2('addr_norm')} AS addr_first2 FROM nn)"""

_E = """e AS (SELECT entity_id, substr(entity_id, 1, 2) AS source, min(name_norm) AS name_norm, min(addr_norm) AS addr_norm, min(postal) AS postal, min(name_first2) AS name_first2, min(addr_first2) AS addr_first2,
  min(lower(trim(coalesce(country, '')))) AS ckey FROM normalized_entity GROUP BY entity_id),
s AS (SELECT * FROM e WHERE source = 'S1'), o AS (SELECT * FROM e WHERE source <> 'S1')"""
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def _tok(rel: str, col: str, distinct: bool = False) -> str:
    return f"SELECT {'DISTINCT' if distinct else ''} entity_id, source, ckey, token FROM (SELECT entity_id, source, ckey, unnest(string_split({col}, ' ')) AS token FROM {rel}) WHERE length(token) >= 3 AND token NOT IN ({_STOP})"


def _key_block(b: str, capped: bool = True, per_block: int | None = 40, country: bool = True) -> str:
    cols, cap = KEYS[b]
    same = " AND ".join(f"s.{c} = o.{c} AND s.{c} <> ''" for c in cols) + (" AND s.ckey = o.ckey" if country else "")
    having = f"HAVING count(*) <= {cap}" if capped else ""
    few = f"SELECT source, {', '.join(cols)} FROM o WHERE {' AND '.join(f'{c} <> {chr(39) * 2}' for c in cols)} GROUP BY ALL {having}"
    on = " AND ".join(f"f.{c} = o.{c}" for c in cols)
    cut = f"WHERE rn <= {per_block}" if per_block else ""
    return f"SELECT s1_id, other_id, source FROM (SELECT s.entity_id AS s1_id, o.entity_id AS other_id, o.source, row_number() OVER (PARTITION BY s.entity_id, o.source ORDER BY o.entity_id) AS rn FROM s JOIN o ON {same} JOIN ({few}) f ON f.source = o.source AND {on}) {cut}"


def _token_block(b: str, cap: str = "<= 500", least: int | None = None, per_block: int | None = 40, distinct: bool = False) -> str:
    col, n = TOKEN_FIELDS[b]
    least = least or n
    cut = f"WHERE rn <= {per_block}" if per_block else ""
    return f"""SELECT s1_id, other_id, source FROM (SELECT s1_id, other_id, source, row_number() OVER (PARTITION BY s1_id, source ORDER BY shared DESC, other_id) AS rn FROM (
      SELECT a.entity_id AS s1_id, b.entity_id AS other_id, b.source, count(*) AS shared FROM ({_tok('s', col, distinct)}) a JOIN ({_tok('o', col, distinct)}) b ON a.token = b.token AND a.ckey = b.ckey
      JOIN (SELECT source, token FROM ({_tok('o', col, distinct)}) t GROUP BY source, token HAVING count(*) {cap}) f ON f.source = b.source AND f.token = b.token
      GROUP BY ALL HAVING count(*) >= {least})) {cut}"""


_STRENGTH = "CAST(" + " + ".join(f"{w} * {c}" for c, w in STRENGTH.items()) + f" + {BONUS} * greatest(" + " + ".join(FLAGS) + " - 1, 0) AS INTEGER)"
_FOLD = ", ".join(f"max(coalesce({f}, 0)) AS {f}" for f in FLAGS)
_P = f"p AS (SELECT s1_id, other_id, source, {_FOLD} FROM candidates WHERE other_id IS NOT NULL GROUP BY s1_id, other_id, source)"


def _candidates(blocks: dict[str, str], final: int, order: str) -> str:
    hits = " UNION ALL ".join(f"SELECT *, {', '.join(f'{int(f == b)} AS {f}' for f in FLAGS)} FROM ({sql})" for b, sql in blocks.items())
    return f"""WITH {_E}, h AS ({hits}), c AS (SELECT s1_id, other_id, source, {', '.join(f'CAST(max({f}) AS INTEGER) AS {f}' for f in FLAGS)} FROM h GROUP BY s1_id, other_id, source),
    g AS (SELECT *, {_STRENGTH} AS strength FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY {order}, other_id) AS rn FROM g)"""


_TRAIN = {b: _key_block(b) for b in KEYS} | {b: _token_block(b) for b in TOKEN_FIELDS}
_TEST = {b: _key_block(b, False, None) for b in ("exact_name", "exact_address", "postal", "first2")}


def _test_token(b: str) -> str:
    col = TOKEN_FIELDS[b][0]
    return f"""SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS other_id, b.source FROM ({_tok('s', col)}) a JOIN ({_tok('o', col)}) b ON a.token = b.token AND a.ckey = b.ckey
      JOIN (SELECT t.source, token FROM ({_tok('o', col)}) t JOIN (SELECT source, count(*) * 0.0015 AS most FROM o GROUP BY source) z ON z.source = t.source GROUP BY t.source, token, most HAVING count(*) <= most) f ON f.source = b.source AND f.token = b.token"""


_TEST |= {b: _test_token(b) for b in TOKEN_FIELDS}

# the values of a packed list: phrases for "no match", quoted values with doubled quotes, runs of letters, digits, hyphens and colons
_CELL = r"""regexp_extract_all(regexp_replace(coalesce(matched_entity_ids, ''), '(?i)\b(n/a|n\.a\.?)', '', 'g'), '(?i:no match(?:es)?|not found|not matched)|"(?:[^"]|"")*"|''(?:[^'']|'''')*''|[\pL\pN:-]+')"""
_BARE = """CASE WHEN x[1] = '"' THEN trim(replace(substr(x, 2, length(x) - 2), '""', '"')) WHEN x[1] = '''' THEN trim(replace(substr(x, 2, length(x) - 2), '''''', '''')) ELSE x END"""
_VALUES = rf"""vals AS (SELECT k, [y for y in [{_BARE} for x in cell] if regexp_matches(y, '[\pL\pN]') AND lower(y) NOT IN ({', '.join(f"'{w}'" for w in ABSENT)})] AS v
  FROM (SELECT DISTINCT source1_entity_id AS k, {_CELL} AS cell FROM train_matches))"""
_LINKS = f"{_VALUES}, l AS (SELECT DISTINCT s1_id, other_id FROM (SELECT k AS s1_id, unnest(v) AS other_id FROM vals))"
_CARD = f"WITH {_LINKS}, c AS (SELECT g.s1_id, count(l.other_id) AS n_matches FROM (SELECT DISTINCT source1_entity_id AS s1_id FROM train_matches) g LEFT JOIN l ON l.s1_id = g.s1_id GROUP BY g.s1_id)"

_X = f"""WITH {_E}, {_P}, x AS (SELECT p.s1_id, p.other_id, p.source, {', '.join(f'p.{f} AS blk_{f}' for f in FLAGS)}, a.name_norm AS n1, b.name_norm AS n2, a.addr_norm AS a1, b.addr_norm AS a2, a.postal AS p1, b.postal AS p2,
  a.name_first2 AS nf1, b.name_first2 AS nf2, a.addr_first2 AS af1, b.addr_first2 AS af2, a.ckey AS c1, b.ckey AS c2 FROM p JOIN e a ON a.entity_id = p.s1_id JOIN e b ON b.entity_id = p.other_id)"""
_SET = lambda x: f"CASE WHEN {x} = '' THEN [] ELSE list_distinct(string_split({x}, ' ')) END"
_GRAMS = lambda x, n: f"CASE WHEN {x} = '' THEN [] WHEN length({x}) < {n} THEN [{x}] ELSE list_distinct([substr({x}, i, {n}) for i in range(1, length({x}) - {n} + 2)]) END"
_INTER = lambda a, b: f"len(list_intersect({a}, {b}))"


def _jac(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE {_INTER(a, b)}::DOUBLE / (len({a}) + len({b}) - {_INTER(a, b)}) END"


def _ov(a: str, b: str) -> str:
    return f"CASE WHEN least(len({a}), len({b})) = 0 THEN 0.0::DOUBLE ELSE {_INTER(a, b)}::DOUBLE / least(len({a}), len({b})) END"


_Y = _X + f", y AS (SELECT *, {_SET('n1')} AS nw1, {_SET('n2')} AS nw2, {_SET('a1')} AS aw1, {_SET('a2')} AS aw2 FROM x)"
_SAME = lambda a, b: f"CAST({a} <> '' AND {a} = {b} AS INTEGER)::DOUBLE"
_DIGITS = lambda x: f"[w for w in {x} if regexp_full_match(w, '[0-9]+')]"

# edit similarities: the longest common subsequence, a row of the table at a time in the bits of one number of up to 126 bits
def _lcs(a: str, b: str) -> str:
    s, t = f"CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END", f"CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END"
    full = f"((1::HUGEINT << length({s})::INTEGER) - 1)"
    mask = f"coalesce(list_sum([(1::HUGEINT << (i - 1)::INTEGER) for i in range(1, length({s}) + 1) if substr({s}, i, 1) = c]), 0)::HUGEINT"
    masks = f"[{mask} for c in string_split({t}, '')]"
    row = f"list_reduce(list_prepend({full}, {masks}), lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full})"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE length({s}) - bit_count({row}) END"


def _ratio(n: str, a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 1.0::DOUBLE ELSE 2 * {n}::DOUBLE / (length({a}) + length({b})) END"


def _edits(short: str, a: str, b: str) -> str:
    """Relations with the similarities of every distinct pair of texts, the last one {short}e (a, b, lev, sort, set_)."""
    words = lambda x: f"list_sort([w for w in string_split({x}, ' ') if w <> ''])"
    join = lambda x: f"coalesce(array_to_string({x}, ' '), '')"
    return f"""{short}1 AS (SELECT DISTINCT {a} AS a, {b} AS b FROM x), {short}2 AS (SELECT a, b, {join(words('a'))} AS sa, {join(words('b'))} AS sb, list_sort(list_distinct({words('a')})) AS wa, list_sort(list_distinct({words('b')})) AS wb FROM {short}1),
    {short}3 AS (SELECT *, {join('[w for w in wa if list_contains(wb, w)]')} AS common, {join('[w for w in wa if NOT list_contains(wb, w)]')} AS da, {join('[w for w in wb if NOT list_contains(wa, w)]')} AS db FROM {short}2),
    {short}4 AS (SELECT *, {_lcs('a', 'b')} AS l1, {_lcs('sa', 'sb')} AS l2, {_lcs('da', 'db')} AS l3, length(common) + CAST(common <> '' AS INTEGER) AS c1 FROM {short}3),
    {short}e AS (SELECT a, b, {_ratio('l1', 'a', 'b')} AS lev, {_ratio('l2', 'sa', 'sb')} AS sort_, CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0.0::DOUBLE WHEN common <> '' AND (da = '' OR db = '') THEN 1.0::DOUBLE
      ELSE greatest(1 - (length(da) + length(db) - 2 * l3)::DOUBLE / (2 * c1 + length(da) + length(db)), CASE WHEN common = '' THEN 0.0::DOUBLE
        ELSE greatest(1 - (1 + length(da))::DOUBLE / (length(common) + c1 + length(da)), 1 - (1 + length(db))::DOUBLE / (length(common) + c1 + length(db))) END) END AS set_ FROM {short}4)"""


_Z = f"{_X}, {_edits('n', 'n1', 'n2')}, {_edits('d', 'a1', 'a2')}, z AS (SELECT x.s1_id, x.other_id, x.source, ne.lev AS nl, ne.sort_ AS ns, ne.set_ AS nt, de.lev AS al, de.sort_ AS ds, de.set_ AS dt FROM x JOIN ne ON ne.a = x.n1 AND ne.b = x.n2 JOIN de ON de.a = x.a1 AND de.b = x.a2)"

_L = f"""{_Y}, {_LINKS}, f AS (SELECT y.s1_id, y.other_id, y.source, {_SAME('n1', 'n2')} AS name_exact, {_SAME('a1', 'a2')} AS addr_exact, {_SAME('p1', 'p2')} AS postal_match, {_jac('nw1', 'nw2')} AS name_jaccard, {_jac('aw1', 'aw2')} AS addr_jaccard,
  CAST(l.s1_id IS NOT NULL AS INTEGER) AS label FROM y LEFT JOIN l ON l.s1_id = y.s1_id AND l.other_id = y.other_id WHERE y.s1_id IN (SELECT source1_entity_id FROM train_matches)),
q AS (SELECT *, round(100 * name_exact + 90 * addr_exact + 80 * postal_match + 30 * name_jaccard + 20 * addr_jaccard, 6) AS hard,
  round((100 * name_exact + 90 * addr_exact + 80 * postal_match + 30 * name_jaccard + 20 * addr_jaccard) / 320, 6) AS proba FROM f),
neg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY hard DESC, other_id) AS rn FROM q WHERE label = 0) WHERE rn <= 6),
ids AS (SELECT DISTINCT source1_entity_id AS s1_id FROM train_matches), nt AS (SELECT s1_id, count(*) AS n_true FROM l GROUP BY s1_id)"""
_F05 = "CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) END"
_FE = f"""{_L}, fe AS (SELECT s1_id, n_true, n_pred, tp, round({_F05}, 9) AS f05 FROM (SELECT ids.s1_id, coalesce(any_value(n_true), 0) AS n_true, count(q.other_id) AS n_pred, CAST(coalesce(sum(label), 0) AS BIGINT) AS tp
  FROM ids LEFT JOIN nt ON nt.s1_id = ids.s1_id LEFT JOIN q ON q.s1_id = ids.s1_id AND q.proba >= 0.5 GROUP BY ids.s1_id))"""
_CURVE = f"""{_L}, grid AS (SELECT unnest(range(30, 99, 2)) / 100.0::DOUBLE AS threshold),
t AS (SELECT threshold, ids.s1_id, coalesce(any_value(n_true), 0) AS n_true, count(q.other_id) AS n_pred, coalesce(sum(label), 0) AS tp FROM grid CROSS JOIN ids LEFT JOIN nt ON nt.s1_id = ids.s1_id LEFT JOIN q ON q.s1_id = ids.s1_id AND q.proba >= threshold GROUP BY threshold, ids.s1_id),
cv AS (SELECT threshold, round(avg({_F05}), 6) AS macro_f05 FROM t GROUP BY threshold)"""
_RES = f"{_L}, res AS (SELECT ids.s1_id AS source1_entity_id, coalesce(string_agg(DISTINCT q.other_id, ',' ORDER BY q.other_id), '') AS matched_entity_ids FROM ids LEFT JOIN q ON q.s1_id = ids.s1_id AND q.proba >= 0.5 GROUP BY ids.s1_id)"

_P1 = """
WITH f AS (SELECT 'postal' AS key_field, postal AS key_value, entity_id FROM normalized_entity
  UNION ALL SELECT 'name_first2', name_first2, entity_id FROM normalized_entity
  UNION ALL SELECT 'token', token, entity_id FROM tokens),
n AS (SELECT key_field, count(*) AS n FROM f GROUP BY key_field),
s AS (SELECT key_field, key_value, count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities FROM f GROUP BY key_field, key_value)
"""
_SPLIT = "i AS (SELECT entity_id, row_number() OVER (ORDER BY md5(entity_id), entity_id) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT entity_id FROM train_source1)), sp AS (SELECT entity_id, CASE WHEN rn <= greatest(1, floor(n * 0.2)) THEN 'val' ELSE 'train' END AS split FROM i)"


def _tfidf(col: str, fitted: str = "true") -> str:
    return f"""WITH {_E}, {_P}, {_SPLIT}, x AS (SELECT entity_id, unnest(CASE WHEN length({col}) < 3 THEN [{col}] ELSE [substr({col}, i, 3) for i in range(1, length({col}) - 1)] END) AS g FROM e WHERE {col} <> ''),
      tf AS (SELECT entity_id, g, count(*) AS tf FROM x GROUP BY ALL), df AS (SELECT g, count(*) AS df FROM tf WHERE {fitted} GROUP BY g), n AS (SELECT count(*) AS n FROM e WHERE {col} <> '' AND {fitted}),
      w AS (SELECT entity_id, tf.g, tf * (ln((n + 1) / (coalesce(df, 0) + 1)) + 1) AS w FROM tf LEFT JOIN df ON df.g = tf.g CROSS JOIN n), v AS (SELECT entity_id, g, w / sqrt(sum(w * w) OVER (PARTITION BY entity_id)) AS w FROM w),
      d AS (SELECT p.s1_id, p.other_id, sum(a.w * b.w) AS c FROM p JOIN v a ON a.entity_id = p.s1_id JOIN v b ON b.entity_id = p.other_id AND b.g = a.g GROUP BY ALL)
      SELECT p.s1_id, p.other_id, p.source, round(coalesce(c, 0.0), 6) AS cosine FROM p LEFT JOIN d ON d.s1_id = p.s1_id AND d.other_id = p.other_id"""


_FREQ = f"WITH {_E}, t AS ({_tok('o', 'name_norm')}), fr AS (SELECT source, token, count(*) AS postings, count(DISTINCT entity_id) AS n_entities FROM t GROUP BY source, token)"

ORACLE: dict[str, str] = {
    "normalize_entities": f"WITH {_NORM} SELECT * FROM nz",
    "normalize_name": f"WITH {_NORM} SELECT entity_id, name_norm, name_alnum FROM nz",
    "normalize_address": f"WITH {_NORM} SELECT entity_id, addr_norm FROM nz",
    "normalize_raw_variant": f"WITH {_SRC} SELECT entity_id, {_norm('business_name', {}, False)} AS name_norm, {_norm('business_address', {}, False)} AS addr_norm FROM src",
    "normalize_folded": f"WITH {_SRC} SELECT entity_id, {_norm('business_name', NAME_WORDS, True, True)} AS name_folded FROM src",
    "postal_extract": f"WITH {_NORM} SELECT entity_id, postal FROM nz",
    "first_tokens": f"WITH {_NORM} SELECT entity_id, name_first, name_first2, addr_first, addr_first2 FROM nz",
    "tokens_name": f"WITH {_E} SELECT entity_id, token, count(*) AS tf FROM ({_tok('e', 'name_norm')}) GROUP BY ALL",
    "tokens_addr": f"WITH {_E} SELECT entity_id, token, count(*) AS tf FROM ({_tok('e', 'addr_norm')}) GROUP BY ALL",
    "token_freq": _FREQ + " SELECT * FROM fr",
    "rare_tokens_cap": _FREQ + " SELECT source, token, postings FROM fr WHERE postings <= 500",
    "rare_tokens_df": _FREQ + " SELECT fr.source, token, postings FROM fr JOIN (SELECT source, count(*) * 0.0015 AS most FROM o GROUP BY source) z ON z.source = fr.source WHERE postings <= most",
    "audit_sources": f"WITH {_SRC} SELECT source, count(*) AS n_rows, count(DISTINCT entity_id) AS n_ids, count(*) - count(DISTINCT entity_id) AS n_repeated, count(*) FILTER (WHERE trim(coalesce(country, '')) = '') AS blank_country, count(DISTINCT country) FILTER (WHERE trim(coalesce(country, '')) <> '') AS n_countries FROM src GROUP BY source",
    "audit_countries": f"WITH {_SRC} SELECT source, lower(trim(coalesce(country, ''))) AS ckey, count(*) AS n_rows FROM src GROUP BY ALL",
    "audit_missing": f"WITH {_SRC} " + " UNION ALL ".join(f"SELECT source, '{c}' AS field, count(*) FILTER (WHERE trim(coalesce({c}, '')) = '') AS missing FROM src GROUP BY source" for c in ("business_name", "business_address", "country")),
    "audit_dup_ids": f"WITH {_SRC} SELECT source, entity_id, count(*) AS n_rows FROM src GROUP BY ALL HAVING count(*) > 1",
    "gt_cardinality": _CARD + " SELECT n_matches, count(*) AS n_entities FROM c GROUP BY n_matches",
    "gt_summary": _CARD + " SELECT (SELECT count(*) FROM train_matches) AS n_rows, (SELECT count(DISTINCT source1_entity_id) FROM train_matches) AS n_ids, (SELECT count(*) - count(DISTINCT source1_entity_id) FROM train_matches) AS n_repeated, CAST(sum(n_matches) AS BIGINT) AS links, max(n_matches) AS most, count(*) FILTER (WHERE n_matches = 0) AS without, count(*) FILTER (WHERE n_matches > 0) AS with_match FROM c",
    "gt_source_split": f"WITH {_LINKS} SELECT CASE WHEN starts_with(other_id, 'S2-') THEN 'S2' WHEN starts_with(other_id, 'S3-') THEN 'S3' ELSE 'other' END AS part, count(*) AS links, count(DISTINCT s1_id) AS n_entities FROM l GROUP BY ALL",
    "split_workset": "SELECT entity_id, split FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5(entity_id), entity_id) AS rn FROM (SELECT entity_id, CASE WHEN ('0x' || substr(md5(entity_id), 1, 8))::BIGINT % 100 < 20 THEN 'val' ELSE 'train' END AS split FROM (SELECT DISTINCT entity_id FROM train_source1))) WHERE rn <= CASE WHEN split = 'val' THEN 10000 ELSE 30000 END",
    "entity_split": "WITH i AS (SELECT entity_id, row_number() OVER (ORDER BY md5(entity_id), entity_id) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT entity_id FROM train_source1)) SELECT entity_id, CASE WHEN rn <= greatest(1, floor(n * 0.2)) THEN 'val' ELSE 'train' END AS split FROM i",
    **{f"block_{b}": f"WITH {_E} {sql}" for b, sql in _TRAIN.items()},
    "block_any_country": f"WITH {_E} {_key_block('exact_name', country=False)}",
    "block_distinct_tokens": f"WITH {_E} {_token_block('name_token', distinct=True)}",
    "candidates_consolidated": f"WITH {_P} SELECT * FROM p",
    "candidates_strength": f"WITH {_P} SELECT s1_id, other_id, source, {_STRENGTH} AS strength FROM p",
    "candidates_bounded": f"WITH {_P}, g AS (SELECT *, {_STRENGTH} AS strength FROM p) SELECT s1_id, other_id, source, strength FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY strength DESC, other_id) AS rn FROM g) WHERE rn <= 20",
    "candidates_final": _candidates(_TRAIN, 150, "strength DESC") + f" SELECT s1_id, other_id, source, {', '.join(FLAGS)}, strength FROM r WHERE rn <= 150",
    "candidates_test_mode": _candidates(_TEST, 150, ", ".join(f"{f} DESC" for f in TEST_ORDER)) + f" SELECT s1_id, other_id, source, {', '.join(TEST_ORDER)} FROM r WHERE rn <= 150",
    "candidates_no_extended": _candidates({b: _TRAIN[b] for b in KEYS}, 150, "strength DESC") + " SELECT s1_id, other_id, source, strength FROM r WHERE rn <= 150",
    "candidate_stats": f"WITH {_P} SELECT source, count(*) AS pairs, count(DISTINCT s1_id) AS n_entities FROM p GROUP BY source",
    "truth_links": f"WITH {_LINKS} SELECT * FROM l",
    "truth_attribution": f"WITH {_E}, {_LINKS} SELECT l.s1_id, l.other_id, coalesce(o.source, 'UNK') AS src FROM l LEFT JOIN o ON o.entity_id = l.other_id",
    "candidate_recall": f"""WITH {_E}, {_LINKS}, {_P}, a AS (SELECT l.s1_id, coalesce(o.source, 'UNK') AS part, CAST(p.s1_id IS NOT NULL AS INTEGER) AS hit FROM l LEFT JOIN o ON o.entity_id = l.other_id LEFT JOIN (SELECT DISTINCT s1_id, other_id FROM p) p ON p.s1_id = l.s1_id AND p.other_id = l.other_id),
      b AS (SELECT part, hit FROM a UNION ALL SELECT 'ALL', hit FROM a) SELECT part, CAST(sum(hit) AS BIGINT) AS hits, count(*) AS total, round(sum(hit) / count(*), 9) AS recall FROM b GROUP BY part""",
    "recall_by_block": f"WITH {_LINKS}, {_P}, h AS (SELECT p.* FROM p JOIN l ON l.s1_id = p.s1_id AND l.other_id = p.other_id) " + " UNION ALL ".join(f"SELECT '{f}' AS block, CAST(sum({f}) AS BIGINT) AS hits, count(*) AS found FROM h HAVING count(*) > 0" for f in FLAGS),
    "feat_jaccard": f"{_Y} SELECT s1_id, other_id, source, {_jac('nw1', 'nw2')} AS name_jaccard, {_jac('aw1', 'aw2')} AS addr_jaccard FROM y",
    "feat_overlap": f"{_Y} SELECT s1_id, other_id, source, {_ov('nw1', 'nw2')} AS name_overlap, {_ov('aw1', 'aw2')} AS addr_overlap FROM y",
    "feat_ngrams": f"{_X}, y AS (SELECT *, {_GRAMS('n1', 3)} AS g31, {_GRAMS('n2', 3)} AS g32, {_GRAMS('n1', 4)} AS g41, {_GRAMS('n2', 4)} AS g42 FROM x) SELECT s1_id, other_id, source, {_jac('g31', 'g32')} AS name_char3_jaccard, {_jac('g41', 'g42')} AS name_char4_jaccard FROM y",
    "feat_exact": f"{_X} SELECT s1_id, other_id, source, {_SAME('n1', 'n2')} AS name_exact, {_SAME('a1', 'a2')} AS addr_exact, {_SAME('p1', 'p2')} AS postal_match, CAST(n1 <> '' AND split_part(n1, ' ', 1) = split_part(n2, ' ', 1) AS INTEGER)::DOUBLE AS name_first_token, {_SAME('nf1', 'nf2')} AS same_name_first2, {_SAME('af1', 'af2')} AS same_address_first2, CAST(c1 = c2 AS INTEGER)::DOUBLE AS same_country FROM x",
    "feat_house": f"{_Y}, z AS (SELECT *, {_DIGITS('aw1')} AS d1, {_DIGITS('aw2')} AS d2 FROM y) SELECT s1_id, other_id, source, {_jac('d1', 'd2')} AS house_overlap FROM z",
    "feat_flags": f"{_X} SELECT s1_id, other_id, source, {', '.join(f'blk_{b}::DOUBLE AS block_{b}' for b in BLOCK_FEATURES)} FROM x",
    "feat_indel": f"{_Z} SELECT s1_id, other_id, source, round(nl, 6) AS name_lev, round(al, 6) AS addr_lev FROM z",
    "feat_token_sort": f"{_Z} SELECT s1_id, other_id, source, round(ns, 6) AS name_token_sort, round(ds, 6) AS addr_token_sort FROM z",
    "feat_token_set": f"{_Z} SELECT s1_id, other_id, source, round(nt, 6) AS name_token_set, round(dt, 6) AS addr_token_set FROM z",
    "feat_cross": f"{_Z} SELECT s1_id, other_id, source, round(nl * al, 6) AS name_addr_product, round((nl + al) / 2, 6) AS name_addr_mean, round(abs(nl - al), 6) AS name_addr_gap FROM z",
    "feat_sorted_words": f"WITH {_E} SELECT entity_id, coalesce(array_to_string(list_sort([w for w in string_split(name_norm, ' ') if w <> '']), ' '), '') AS name_sorted, coalesce(array_to_string(list_sort([w for w in string_split(addr_norm, ' ') if w <> '']), ' '), '') AS addr_sorted FROM e",
    "feat_tfidf_cosine": _tfidf("name_norm"),
    "feat_tfidf_address": _tfidf("addr_norm"),
    "feat_tfidf_train": _tfidf("name_norm", "entity_id IN (SELECT entity_id FROM sp WHERE split = 'train')"),
    "tsv_round_trip": f"WITH {_SRC} SELECT entity_id, nullif(business_name, '') AS business_name, nullif(business_address, '') AS business_address, nullif(country, '') AS country FROM src",
    "tsv_results": f"{_RES} SELECT * FROM res",
    "stored_entities": f"WITH {_E} SELECT source, count(*) AS n, count(DISTINCT ckey) AS n_countries FROM e GROUP BY source",
    "incremental_links": f"""WITH {_E}, {_NORM}, f AS (SELECT name_norm FROM s WHERE name_norm <> '' GROUP BY name_norm HAVING count(*) <= 1000)
      SELECT nz.entity_id, s.entity_id AS s1_id, 'exact_name' AS block FROM nz JOIN (SELECT entity_id, lower(trim(coalesce(country, ''))) AS ckey FROM train_source2) c USING (entity_id) JOIN s ON s.name_norm = nz.name_norm AND s.ckey = c.ckey JOIN f ON f.name_norm = nz.name_norm""",
    "labels": f"{_L} SELECT s1_id, other_id, source, label FROM q",
    "hard_negatives": f"{_L} SELECT s1_id, other_id, source, hard FROM neg",
    "train_sample": f"{_L} SELECT s1_id, other_id, source, label, hard FROM q WHERE label = 1 UNION ALL SELECT s1_id, other_id, source, label, hard FROM neg",
    "mined_negatives": f"{_L} SELECT s1_id, other_id FROM q WHERE label = 0 AND proba >= 0.5",
    "sample_weights": f"{_L} SELECT s1_id, other_id, source, CASE WHEN label = 0 AND proba >= 0.5 THEN 5.0::DOUBLE WHEN label = 0 AND name_jaccard >= 0.75 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM q",
    "plain_scores": f"{_L} SELECT s1_id, other_id, source, proba FROM q",
    "f05_entity": f"{_FE} SELECT * FROM fe",
    "f05_macro": f"{_FE} SELECT round(avg(f05), 6) AS macro_f05, count(*) AS n_entities FROM fe",
    "threshold_curve": f"{_CURVE} SELECT * FROM cv",
    "best_threshold": f"{_CURVE} SELECT * FROM cv ORDER BY macro_f05 DESC, threshold LIMIT 1",
    "matching_results": f"{_RES} SELECT * FROM res",
    "candidate_pairs": f"WITH {_E}, {_P} SELECT s.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT p.other_id, ',' ORDER BY p.other_id), '') AS candidate_entity_ids FROM s LEFT JOIN p ON p.s1_id = s.entity_id GROUP BY s.entity_id",
    "validate_outputs": f"""{_RES} SELECT 'missing' AS "check", (SELECT count(*) FROM ids WHERE s1_id NOT IN (SELECT source1_entity_id FROM res)) AS bad UNION ALL SELECT 'repeated', (SELECT count(*) FROM (SELECT source1_entity_id FROM res GROUP BY ALL HAVING count(*) > 1))
      UNION ALL SELECT 'unknown', (SELECT count(*) FROM res WHERE source1_entity_id NOT IN (SELECT s1_id FROM ids)) UNION ALL SELECT 'not_candidates', (SELECT count(*) FROM (SELECT DISTINCT s1_id, other_id FROM q WHERE proba >= 0.5) z WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.s1_id = z.s1_id AND p.other_id = z.other_id))""",
    "p7_found": f"WITH {_VALUES} SELECT DISTINCT k AS source1_entity_id, CAST(unnest(range(1, len(v) + 1)) AS INTEGER) AS pos, unnest(v) AS matched_id FROM vals",
    "p1_key_stats": _P1 + "SELECT key_field, key_value, n_rows, n_entities FROM s",
    "p1_found": _P1 + "SELECT s.key_field, key_value FROM s JOIN n ON n.key_field = s.key_field WHERE key_value <> '' AND n_rows >= 0.02 * n",
    "p1_join": """WITH s AS (SELECT token, count(*) AS token_rows FROM tokens WHERE token IS NOT NULL GROUP BY token HAVING count(DISTINCT entity_id) > 1)
      SELECT entity_id, count(*) AS n_tokens, max(token_rows) AS most, min(token_rows) AS least FROM tokens JOIN s USING (token) GROUP BY entity_id""",
}
