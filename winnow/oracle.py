"""DuckDB SQL for the registered queries, on the same tables."""

from __future__ import annotations

from winnow.plans.bindings import EMAIL, EXTRA_SYMBOLS, HINTS
from winnow.operators.tokens import ACTIONS, COMMON


def _word(column: str, word: str) -> str:
    return rf"regexp_matches({column}, '(?i)(^|[^\pL\pN_]){word}([^\pL\pN_]|$)')"


def _texts(test) -> str:
    return f"({test('subject')} OR {test('body')})"


_LICENSE = [lambda c: _word(c, "license"), lambda c: _word(c, "mit"), lambda c: _word(c, "apache"), lambda c: rf"regexp_matches({c}, '(^|[^\pL\pN_])GNU([^\pL\pN_]|$)')", lambda c: f"contains(lower({c}), 'public license')"]
_ABUSE = [lambda c, w=w: _word(c, w) for w in ("idiot", "stupid", "worthless")]
_SECRET = [lambda c: _word(c, "token"), lambda c: f"regexp_matches({c}, '{EMAIL}')"]


def _any(tests) -> str:
    return "(" + " OR ".join(_texts(t) for t in tests) + ")"


DOCS = f"""d AS (
  SELECT sha256(CAST(doc_id AS VARCHAR)) AS record_id, doc_id AS seq, split_part(coalesce(text, ''), chr(10), 1) AS subject,
         coalesce(text, '') AS body, source AS author_name, source || '/' || lang || '/doc.txt' AS f
  FROM documents),
h AS (
  SELECT *, {_any(_LICENSE)} AS license_hit,
         (starts_with(f, 'src1/') OR starts_with(f, 'src2/en/')) AS source_hit,
         {_any(_ABUSE)} AS abuse_hit,
         ({_any(_SECRET)} OR record_id = sha256('12')) AS secret_hit,
         ({_texts(lambda c: _word(c, "apache"))} OR starts_with(f, 'src3/') OR record_id = sha256('11')) AS deny_full,
         ({_texts(lambda c: _word(c, "apache"))} OR starts_with(f, 'src3/') OR record_id = sha256('11')) AS deny
  FROM d),
raw AS (
  SELECT record_id, seq, subject, author_name, f, 'legal' AS profile, 0 AS ord, false AS blocked, license_hit::INT * 60 + source_hit::INT * 25 AS raw_total, 1.0::DOUBLE AS multiplier, license_hit OR source_hit AS any_hit FROM h
  UNION ALL SELECT record_id, seq, subject, author_name, f, 'safety', 1, deny, abuse_hit::INT * 55 + secret_hit::INT * 30 + source_hit::INT * 25, 0.29::DOUBLE, abuse_hit OR secret_hit OR source_hit FROM h
  UNION ALL SELECT record_id, seq, subject, author_name, f, 'broad', 2, deny, license_hit::INT * 80 + abuse_hit::INT * 50 + secret_hit::INT * 30, 0.7::DOUBLE, license_hit OR abuse_hit OR secret_hit FROM h),
ps AS (
  SELECT *, least(raw_total, 100) AS capped, CASE WHEN blocked THEN 0 ELSE CAST(trunc(least(raw_total, 100) * multiplier) AS INTEGER) END AS final_score FROM raw),
t AS (
  SELECT record_id, any_value(seq) AS seq, any_value(subject) AS subject, any_value(author_name) AS author_name, CAST(sum(final_score) AS INTEGER) AS score,
         coalesce(string_agg(CASE WHEN final_score > 0 OR blocked OR any_hit THEN profile END, '; ' ORDER BY ord), '') AS matched
  FROM ps GROUP BY record_id)"""

RULES = """rules(profile, rule, weight, hit) AS (
  SELECT 'legal', 'license_terms', 60, 'license_hit' UNION ALL SELECT 'legal', 'source_paths', 25, 'source_hit'
  UNION ALL SELECT 'safety', 'abuse_words', 55, 'abuse_hit' UNION ALL SELECT 'safety', 'secrets', 30, 'secret_hit' UNION ALL SELECT 'safety', 'source_paths', 25, 'source_hit'
  UNION ALL SELECT 'broad', 'license_terms', 80, 'license_hit' UNION ALL SELECT 'broad', 'abuse_words', 50, 'abuse_hit' UNION ALL SELECT 'broad', 'secrets', 30, 'secret_hit'),
rh AS (
  SELECT record_id, profile, rule, weight, CASE hit WHEN 'license_hit' THEN license_hit WHEN 'source_hit' THEN source_hit WHEN 'abuse_hit' THEN abuse_hit ELSE secret_hit END AS matched,
         profile <> 'legal' AND deny AS blocked
  FROM h CROSS JOIN rules),
rl AS (SELECT *, CASE WHEN blocked THEN 'blocked' WHEN matched THEN 'matched' ELSE 'no-match' END AS matched_level FROM rh)"""


def _pattern_rows() -> str:
    rows = []

    def add(rule: str, kind: str, ord_: int, pattern: str, value: str, test: str, vord: int) -> None:
        quoted = pattern.replace("'", "''")
        rows.append(f"SELECT record_id, '{rule}' AS rule, '{kind}_whitelist' AS kind, {ord_} AS pord, '{quoted}' AS pattern, {value} AS value, {vord} AS vord FROM d WHERE {test}")

    lists = [("license_terms", ["license", "mit", "apache", r"re:\bGNU\b", "*public license*"], _LICENSE), ("abuse_words", ["idiot", "stupid", "worthless"], _ABUSE), ("secrets", ["token", f"re:{EMAIL}"], _SECRET)]
    for rule, patterns, tests in lists:
        for i, (p, t) in enumerate(zip(patterns, tests, strict=True)):
            add(rule, "keywords", i, p, "subject", t("subject"), 0)
            add(rule, "keywords", i, p, "body", f"{t('body')} AND body <> subject", 1)
    add("source_paths", "path", 0, "src1/*", "f", "starts_with(f, 'src1/')", 0)
    add("source_paths", "path", 1, "src2/en/*", "f", "starts_with(f, 'src2/en/')", 0)
    rows.append("SELECT record_id, 'secrets', 'commit_whitelist', 0, sha256('12'), record_id, 0 FROM d WHERE record_id = sha256('12')")
    return "ph AS (" + " UNION ALL ".join(rows) + ")"


PATTERN_HITS = _pattern_rows()

ORDERS = r"""pp AS (
  SELECT p_partkey, CAST(regexp_extract(p_brand, '(\d+)$', 1) AS INTEGER) AS b, p_size, p_type, p_name, p_brand,
         lower(p_type) || '/brand_' || regexp_extract(p_brand, '(\d+)$', 1) || '/' || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) || '.c' AS path,
         lower(p_type) || '/brand_' || regexp_extract(p_brand, '(\d+)$', 1) AS dir,
         replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) AS base_stem
  FROM part),
fl AS (SELECT DISTINCT l_orderkey AS k, path, dir, base_stem FROM lineitem JOIN pp ON l_partkey = p_partkey),
r AS (
  SELECT o_orderkey AS k, sha256(CAST(o_orderkey AS VARCHAR)) AS record_id, o_orderkey AS seq, o_orderpriority AS subject,
         'status ' || o_orderstatus || ' priority ' || o_orderpriority AS body, c_name AS author_name, CAST(epoch(o_orderdate) AS BIGINT) AS author_time
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
s_file AS (SELECT DISTINCT path FROM pp WHERE b <= 8),
s_dir AS (SELECT DISTINCT dir FROM pp WHERE b <= 8),
s_art AS (SELECT DISTINCT path FROM pp WHERE p_size > 45),
s_log AS (SELECT DISTINCT base_stem FROM pp WHERE p_partkey % 37 = 0),
ff AS (
  SELECT k, coalesce(bool_or(path IN (SELECT path FROM s_art) OR base_stem IN (SELECT base_stem FROM s_log)), false) AS has_artifact,
         coalesce(bool_or(path IN (SELECT path FROM s_file) OR dir IN (SELECT dir FROM s_dir)), false) AS covered,
         coalesce(bool_and(starts_with(path, 'economy/')), false) AS all_denied, coalesce(bool_or(starts_with(path, 'economy/')), false) AS any_denied,
         coalesce(bool_or(starts_with(path, 'promo/brand_1/')), false) AS allowed
  FROM (SELECT o_orderkey AS k FROM orders) LEFT JOIN fl USING (k) GROUP BY k),
dec AS (
  SELECT r.*, CASE
    WHEN k IN (3, 5) THEN 'commit_whitelist' WHEN k IN (6, 7) THEN 'commit_blacklist' WHEN all_denied THEN 'path_blacklist_all'
    WHEN allowed THEN 'path_whitelist' WHEN has_artifact THEN 'build_artifact' WHEN NOT covered AND subject <> '1-URGENT' THEN 'no_kconfig_coverage'
    WHEN subject = '1-URGENT' THEN 'keywords_whitelist' WHEN body LIKE 'status P %' THEN 'keywords_blacklist' ELSE 'default' END AS reason
  FROM r JOIN ff USING (k)),
dk AS (SELECT *, CASE WHEN reason IN ('commit_blacklist', 'path_blacklist_all', 'no_kconfig_coverage', 'keywords_blacklist') THEN 'drop' ELSE 'keep' END AS action FROM dec),
hint(keyword, prefix) AS (VALUES """ + ", ".join(f"('{k}', '{p}')" for k, p in HINTS) + r"""),
guess AS (SELECT DISTINCT record_id, prefix FROM r JOIN hint ON contains(lower(subject), keyword)),
sym(symbol) AS (SELECT DISTINCT 'BRAND_' || b FROM pp WHERE b <= 8 UNION """ + " UNION ".join(f"SELECT '{s[0].removeprefix('CONFIG_').split('=')[0]}'" for s in EXTRA_SYMBOLS) + r"""),
ev_map AS (
  SELECT DISTINCT r.record_id, 'config_map:CONFIG_BRAND_' || m.b AS tag FROM r JOIN fl USING (k) JOIN (SELECT DISTINCT b, dir FROM pp) m ON fl.path LIKE m.dir || '/%'),
ev_dir AS (
  SELECT DISTINCT record_id, 'config_dir:' || dir AS tag FROM guess JOIN (
    SELECT prefix, min(x.dir || '/') AS dir FROM (SELECT DISTINCT prefix FROM hint) g JOIN (SELECT DISTINCT dir FROM pp) x ON starts_with(prefix, x.dir) OR starts_with(x.dir || '/', prefix) GROUP BY prefix) USING (prefix)),
ev_log AS (
  SELECT DISTINCT record_id, 'build_log:' || base AS tag FROM (SELECT *, regexp_extract(prefix, '([^/]+)/*$', 1) AS base FROM guess) WHERE base IN (
    SELECT base FROM (SELECT DISTINCT regexp_extract(prefix, '([^/]+)/*$', 1) AS base FROM hint) JOIN s_log ON contains(base_stem || '.o', base))),
ev_art AS (
  SELECT DISTINCT record_id, 'artifact:' || base AS tag FROM (SELECT *, regexp_extract(prefix, '([^/]+)/*$', 1) AS base FROM guess) WHERE base IN (
    SELECT base FROM (SELECT DISTINCT regexp_extract(prefix, '([^/]+)/*$', 1) AS base FROM hint) JOIN s_art ON contains(replace(path, '.c', '.o'), base))),
ev_text AS (SELECT DISTINCT record_id, 'config_text:CONFIG_' || symbol AS tag FROM r JOIN sym ON contains(lower(subject || chr(10) || body), lower(symbol))),
ev AS (SELECT * FROM ev_map UNION SELECT * FROM ev_dir UNION SELECT * FROM ev_log UNION SELECT * FROM ev_art UNION SELECT * FROM ev_text),
sc AS (
  SELECT dk.*, CASE WHEN any_denied OR body LIKE 'status P %' OR k IN (6, 7) THEN true ELSE false END AS blocked,
         least(100, allowed::INT * 40 + (subject = '1-URGENT')::INT * 50 + (k IN (3, 5))::INT * 30) AS capped
  FROM dk JOIN ff USING (k) WHERE action = 'keep'),
so AS (SELECT *, CAST(CASE WHEN blocked THEN 0 ELSE capped END AS INTEGER) AS score FROM sc),
low AS (SELECT *, CASE WHEN score < 50 THEN 'score_below_threshold (50.0)' END AS filter_reason FROM so)"""

PARTS = r"""pp AS (SELECT *, CAST(regexp_extract(p_brand, '(\d+)$', 1) AS INTEGER) AS b FROM part),
pat AS (
  SELECT p_brand AS rule, CASE WHEN p_partkey % 3 = 0 THEN 'path_whitelist' ELSE 'keywords_whitelist' END AS kind, CAST(p_partkey AS INTEGER) AS ord,
         CASE WHEN p_partkey % 3 = 0 THEN lower(p_type) || '/brand_' || b || '/*' WHEN p_partkey % 5 = 0 THEN 're:^' || p_name WHEN p_partkey % 7 = 0 THEN p_name || '\*' ELSE p_name END AS pattern
  FROM pp),
pr AS (SELECT p_type AS profile, p_brand AS rule, CAST(sum(p_size) % 101 AS INTEGER) AS weight, CAST(min(p_partkey) AS INTEGER) AS ord FROM pp GROUP BY 1, 2),
pf AS (SELECT p_type AS profile, CAST(15 * length(p_type) AS DOUBLE) AS weight, CAST(min(p_partkey) AS INTEGER) AS ord FROM pp GROUP BY 1)"""

_STOP = ", ".join(f"'{w}'" for w in (*ACTIONS, *COMMON))
TOKENS = rf"""tok AS (
  SELECT lower(regexp_replace(u, '^[.,]+|[.,]+$', '', 'g')) AS token FROM (
    SELECT unnest(regexp_extract_all(regexp_replace(coalesce(text, ''), '([\s:])', '\1\1', 'g'), '(?:^|[^A-Za-z0-9_./-])([A-Za-z][A-Za-z0-9_+.-]{{1,40}})[\s:]', 1)) AS u FROM documents)),
tc AS (SELECT token, count(*) AS n FROM tok WHERE length(token) >= 2 AND token NOT IN ({_STOP}) AND NOT regexp_matches(token, '^v?\d+([.-]\d+)*$') GROUP BY token)"""

#: Sources of the makefiles: beside them, and through other folders.
MAKEFILES = r"""mk AS (SELECT DISTINCT 'CONFIG_BRAND_' || b AS symbol, 'brand_' || b || '/' || replace(p_name, ' ', '_') || '_' || p_partkey || '.c' AS path FROM pp
  UNION SELECT 'CONFIG_BRAND_' || b, unnest(['dotted.d/x' || p_partkey || '.c', 'brand_' || b || '/y' || p_partkey || '.c', '../above' || p_partkey || '.c']) FROM pp WHERE p_partkey % 11 = 0)"""

PHRASES = rf"""bw AS (SELECT item_id, w, unnest(range(1, len(w))) AS i FROM (SELECT item_id, string_split_regex(text, '\s+') AS w FROM benchmark)),
bp AS (SELECT DISTINCT 'item ' || item_id AS rule, (i - 1) % 3 AS k, w[i] || ' ' || w[i + 1] AS x FROM bw WHERE regexp_full_match(w[i], '[A-Za-z]{{2,}}') AND regexp_full_match(w[i + 1], '[A-Za-z]{{2,}}')),
ht AS (SELECT d.record_id, rule, CASE k WHEN 0 THEN x WHEN 1 THEN '*' || x || '*' ELSE 're:' || x END AS pattern,
  CASE WHEN k = 1 THEN true WHEN k = 2 THEN contains(body, x) ELSE regexp_matches(body, '(?i)(^|[^\pL\pN_])' || x || '([^\pL\pN_]|$)') END AS hit
  FROM (SELECT sha256(CAST(doc_id AS VARCHAR)) AS record_id, coalesce(text, '') AS body, lower(coalesce(text, '')) AS low FROM documents) d JOIN bp ON contains(low, lower(x)))"""
