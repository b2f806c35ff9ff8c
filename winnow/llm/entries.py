"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from winnow.llm import bpe, chat, fingerprint, merkle, minhash, mixing, quality, rules, search, sharding, suffixes, unigram, vectors
from winnow.llm.common import table
from winnow.sources.stages import new_path


def op1_itq_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


def op4_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.planted(table(spark, sf_dir, "conversations")))


def op5_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(table(spark, sf_dir, "documents"))


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=40, store=new_path(spark, "slot-map"))


def op9_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


def op13_bitsliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_itq_hamming, op2_pfair_mix, op3_induced_suffixes, op4_chat_tokens, op5_iblt_fingerprints, op6_viterbi_counts, op7_lsh_forest, op8_slot_shards, op9_zstd_quality,
        op10_bpe_tree, op11_merkle_manifest, op12_quality_rules, op13_bitsliced_search,
    )
    return {f.__name__: f for f in every}


_REACH = """reach(x, y) AS (SELECT id, id FROM ids UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x), c AS (SELECT x AS id, min(y) AS component_id FROM reach GROUP BY x)"""

_VECTORS = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
ids AS (SELECT vec_id AS id FROM embeddings), {_REACH},
n AS (SELECT x AS id, count(*) AS n FROM l GROUP BY x)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM c LEFT JOIN n USING (id)"""

_DOCUMENTS = rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id AS id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
i AS (SELECT a.id AS x, b.id AS y, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.id < b.id GROUP BY 1, 2),
p AS (SELECT x, y FROM i JOIN n a ON a.id = x JOIN n b ON b.id = y WHERE 100 * i >= 75 * (a.n + b.n - i)),
l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
ids AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept FROM c LEFT JOIN n USING (id)"""

_REPEATS = """WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM b)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
g AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS new FROM w JOIN f USING (s) WHERE least < doc_id),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
k AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
m AS (SELECT doc_id, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS kept FROM k JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM b LEFT JOIN m USING (doc_id)"""


#: The checksum of an id's digits, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END), 4294967295::BIGINT)"""


def _leaf(n_chars: str) -> str:
    parts = (f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256({' || '.join(parts)})"


def _risen(name: str, start: str) -> str:
    return f"""{name}(g, lvl, pos, node, n) AS (SELECT g, 0, pos, node, n FROM {start} UNION ALL
  SELECT g, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY g, lvl, pos // 2, n)"""


def _walk(name: str, of: str) -> str:
    """The siblings of every lowest node: L or R for its side, or N where there is none."""
    return f"""{name} AS (SELECT s.g, s.pos, list(CASE WHEN b.node IS NULL THEN 'N' WHEN a.pos % 2 = 1 THEN 'L' || b.node ELSE 'R' || b.node END ORDER BY a.lvl) FILTER (a.n > 1) AS path
  FROM (SELECT * FROM {of} WHERE lvl = 0) s JOIN {of} a ON a.g = s.g AND a.pos = s.pos >> a.lvl LEFT JOIN {of} b ON b.g = a.g AND b.lvl = a.lvl AND b.pos = xor(a.pos, 1) GROUP BY s.g, s.pos)"""


_MANIFEST = f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("n_chars")} AS leaf, {_leaf("CAST(n_chars + 1 AS BIGINT)")} AS other, {_CRC} % 7 = 0 AS hit, n_chars FROM documents),
p AS (SELECT *, leaf AS node, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
{_risen("t", "p")},
s AS (SELECT '' AS g, g AS lang, node, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
{_risen("u", "s")}, {_walk("low", "t")}, {_walk("high", "u")},
x AS (SELECT p.doc_id, p.leaf, CASE WHEN hit AND n_chars IS NOT NULL THEN other ELSE p.leaf END AS claimed, s.node AS subroot, (SELECT node FROM u WHERE n = 1) AS root, list_concat(coalesce(low.path, []), coalesce(high.path, [])) AS path
  FROM p JOIN low USING (g, pos) JOIN s ON s.lang = p.g JOIN high ON high.pos = s.pos),
f AS (SELECT *, list_reduce(list_prepend(claimed, path), lambda a, y: CASE y[1] WHEN 'L' THEN sha256(y[2:] || a) WHEN 'R' THEN sha256(a || y[2:]) ELSE sha256(a) END) AS folded_root FROM x)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda y: y[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM f"""

_SPACE = r"[^\x20\x09-\x0D]"
_STOP = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)


def _rule(r: rules.Rule) -> str:
    sides = [f"1000 * {r.part} {op} {bound} * {r.whole or 1}" for op, bound in (("<", r.least), (">", r.most)) if bound is not None]
    return f"CASE WHEN ({' OR '.join(sides)}) AND n_words >= {r.from_words} THEN '{r.name}' END"


_RULES = rf"""WITH b AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '{_SPACE}+') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACE}')) AS l FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM b)),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM v JOIN (SELECT doc_id, s FROM v GROUP BY ALL HAVING count(*) > 1) USING (doc_id, s)) GROUP BY doc_id),
m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(x, '[^!]', '', 'g')) AS n_exclaims,
  len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
  len(list_filter(l, lambda x: regexp_matches(x, '^ *[-*\x{{2022}}]'))) AS n_list_lines, len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS n_open_lines FROM b LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed, list_filter([{', '.join(map(_rule, rules.RULES))}], lambda x: x IS NOT NULL) AS failures FROM m)
SELECT * EXCLUDE (failures), NOT base_failed AND len(failures) = 0 AS kept, array_to_string(failures, '; ') AS failed FROM f"""

_SEARCH = r"""WITH k AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM k WHERE len(w) > 0),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
tf AS (SELECT doc_id, m, t, count(*) AS tf FROM (SELECT doc_id, 75 + (25 * len(w) * n) // l AS m, unnest(w) AS t FROM k, g) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
df AS (SELECT t, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, g GROUP BY t),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN df USING (t) JOIN tf USING (t) GROUP BY ALL HAVING score > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s QUALIFY rank <= 20"""


def oracle_sql() -> dict[str, str]:
    """The whole of six operators in plain SQL; digests of tokens, sketches and compressed sizes are beyond it."""
    return {"op1_itq_hamming": _VECTORS, "op3_induced_suffixes": _REPEATS, "op7_lsh_forest": _DOCUMENTS, "op11_merkle_manifest": _MANIFEST, "op12_quality_rules": _RULES, "op13_bitsliced_search": _SEARCH}
