"""The corpus operators over the given tables, with production parameters and the result columns of their checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orewright.llm.base import prepared, table
from orewright.llm.decontamination import contaminated
from orewright.llm.embedding_pairs import embedding_links
from orewright.llm.language_model import language_scores
from orewright.llm.mixing import mixed_sources
from orewright.llm.ngram_join import ngram_jaccard_join
from orewright.llm.personal_data import KINDS, personal_data, span_text
from orewright.llm.preferences import clean_turns, pairs_by_first_turn, preference_examples
from orewright.llm.prefix_trie import conversation_paths, prefix_trie, regrown_paths
from orewright.llm.quality import quality
from orewright.llm.spelling import spelling_groups, with_slips, word_counts
from orewright.llm.token_files import read_token_files, write_token_files
from orewright.llm.toxicity import toxicity
from orewright.llm.url_verdicts import url_verdicts
from orewright.session import work_folder

# Host, path and verdict of the url rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(prepared(spark), folder)
    return build


@query
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, folder, "documents"))


@query
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "tokens")
    write_token_files(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path)


@query
def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixed_sources(table(spark, folder, "documents"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "n_words")


@query
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["strict"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )


@query
def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links(table(spark, folder, "embeddings"))


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_language_scores(spark: SparkSession, folder: str) -> DataFrame:
    return language_scores(table(spark, folder, "documents"))


@query
def op2_preference_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = clean_turns(table(spark, folder, "conversations"))
    ids = turns.select("conv_id").distinct()
    even = ids.filter("conv_id % 2 = 0").select(F.col("conv_id").alias("chosen_id"), (F.col("conv_id") + 1).alias("rejected_id"))
    neighbours = even.join(ids.withColumnRenamed("conv_id", "rejected_id"), "rejected_id", "left_semi")
    return preference_examples(turns, pairs_by_first_turn(turns).unionByName(neighbours))


@query
def op11_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(table(spark, folder, "pages"), URL_RULES)


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(regrown_paths(conversation_paths(table(spark, folder, "conversations"))))


@query
def op13_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    words = word_counts(table(spark, folder, "documents"), with_slips(F.col("doc_id"), F.col("run")))
    return spelling_groups(words)


SQL["op2_preference_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, max(ROW(coalesce(role, 'user'), coalesce(text, ''))) AS said
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn
), first AS (
  SELECT conv_id, arg_min(said, turn) AS said FROM t GROUP BY conv_id
), pairs AS (
  SELECT * FROM (SELECT min(conv_id) OVER (PARTITION BY said) AS chosen_id, conv_id AS rejected_id FROM first)
  WHERE chosen_id <> rejected_id
  UNION SELECT a.conv_id, b.conv_id FROM first a JOIN first b ON b.conv_id = a.conv_id + 1 WHERE a.conv_id % 2 = 0
), numbered AS (
  SELECT p.chosen_id, p.rejected_id, coalesce(c.turn, r.turn) AS turn, c.said AS c, r.said AS r
  FROM pairs p
  JOIN (
    SELECT p2.chosen_id, p2.rejected_id, t2.turn FROM pairs p2 JOIN t t2 ON t2.conv_id = p2.chosen_id
    UNION SELECT p3.chosen_id, p3.rejected_id, t3.turn FROM pairs p3 JOIN t t3 ON t3.conv_id = p3.rejected_id
  ) u ON u.chosen_id = p.chosen_id AND u.rejected_id = p.rejected_id
  LEFT JOIN t c ON c.conv_id = p.chosen_id AND c.turn = u.turn
  LEFT JOIN t r ON r.conv_id = p.rejected_id AND r.turn = u.turn
), cut AS (
  SELECT chosen_id, rejected_id, min(CASE WHEN c IS DISTINCT FROM r THEN turn END) AS cut FROM numbered GROUP BY ALL
), shown AS (
  SELECT n.*, k.cut, k.cut IS NULL OR n.turn < k.cut AS shared FROM numbered n JOIN cut k USING (chosen_id, rejected_id)
), pieces AS (
  SELECT chosen_id, rejected_id, turn, cut, 'p' AS part, c AS said FROM shown WHERE shared
  UNION ALL SELECT chosen_id, rejected_id, turn, cut, 'c', c FROM shown WHERE NOT shared AND c IS NOT NULL
  UNION ALL SELECT chosen_id, rejected_id, turn, cut, 'r', r FROM shown WHERE NOT shared AND r IS NOT NULL
), text AS (
  SELECT *, '<|im_start|>' || struct_extract_at(said, 1) || chr(10) || struct_extract_at(said, 2) || '<|im_end|>' || chr(10) AS piece FROM pieces
), placed AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY chosen_id, rejected_id, part ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 13 + length(struct_extract_at(said, 1)) AS begin FROM text
), masked AS (
  SELECT *, CASE WHEN struct_extract_at(said, 1) = 'assistant'
    THEN CAST(begin AS BIGINT) || ':' || CAST(begin + length(struct_extract_at(said, 2)) + 10 AS BIGINT) END AS span FROM placed
)
SELECT chosen_id, rejected_id,
  count(*) FILTER (part = 'p') AS n_prompt_turns, max(cut) IS NULL AS tied,
  coalesce(string_agg(piece, '' ORDER BY turn) FILTER (part = 'p'), '') AS prompt,
  coalesce(string_agg(piece, '' ORDER BY turn) FILTER (part = 'c'), '') AS chosen,
  coalesce(string_agg(span, ',' ORDER BY turn) FILTER (part = 'c'), '') AS chosen_mask,
  coalesce(string_agg(piece, '' ORDER BY turn) FILTER (part = 'r'), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY turn) FILTER (part = 'r'), '') AS rejected_mask
FROM masked GROUP BY chosen_id, rejected_id
"""


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op1_ngram_jaccard_join"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), n AS (
  SELECT w.doc_id, count(s.s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS m FROM n UNION SELECT e.b, r.m FROM reach r JOIN edges e ON e.a = r.doc_id
)
SELECT n.doc_id, any_value(n.n) AS n_shingles, min(m) AS component_id FROM n JOIN reach r ON r.doc_id = n.doc_id GROUP BY n.doc_id
"""

SQL["op5_embedding_near_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), edges AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id, vec_id AS m FROM v UNION SELECT e.b, r.m FROM reach r JOIN edges e ON e.a = r.vec_id
), comp AS (
  SELECT vec_id, min(m) AS component_id FROM reach GROUP BY vec_id
)
SELECT c.vec_id, (SELECT count(*) FROM edges e WHERE e.a = c.vec_id) AS n_links, component_id, c.vec_id = component_id AS kept FROM comp c
"""

# Over items of at least a window's words, as all given ones are. An item is laid wherever it shares two neighbouring words; a place
# counts if one of the three patterns of equal words lies there.
SQL["op6_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, list_filter(list_transform(regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+'),
    lambda x: regexp_replace(x, '^[!-/:-@\[-`{{-~]+|[!-/:-@\[-`{{-~]+$', '', 'g')), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL
), i AS (
  SELECT DISTINCT item_id, list_filter(list_transform(regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+'),
    lambda x: regexp_replace(x, '^[!-/:-@\[-`{{-~]+|[!-/:-@\[-`{{-~]+$', '', 'g')), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL
), dp AS (
  SELECT doc_id, pos, w[pos] AS x, w[pos + 1] AS y FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS pos FROM d)
), ip AS (
  SELECT item_id, pos, w[pos] AS x, w[pos + 1] AS y FROM (SELECT item_id, w, unnest(range(1, len(w))) AS pos FROM i)
), laid AS (
  SELECT DISTINCT doc_id, item_id, dp.pos - ip.pos AS shift FROM dp JOIN ip ON dp.x = ip.x AND dp.y = ip.y
), agreed AS (
  SELECT doc_id, item_id, shift, len(i.w) AS n, list_transform(range(1, len(i.w) + 1),
    lambda k: CASE WHEN shift + k BETWEEN 1 AND len(d.w) THEN d.w[shift + k] = i.w[k] ELSE false END) AS a
  FROM laid JOIN d USING (doc_id) JOIN i USING (item_id)
), counted AS (
  SELECT *, len(list_filter(a, lambda x: x)) AS matched FROM agreed WHERE len(list_filter(range(1, n), lambda k: a[k] AND a[k + 1]
    AND (coalesce(a[k + 2] AND a[k + 4], false) OR coalesce(a[k + 3] AND a[k + 6], false) OR coalesce(a[k + 2] AND a[k + 5], false)))) > 0
), best AS (
  SELECT doc_id, item_id, n, max(matched) AS matched, bool_or(len(list_filter(range(1, n - 11),
    lambda s: len(list_filter(a[s:s + 12], lambda x: x)) >= 10)) > 0) AS dense FROM counted GROUP BY ALL
), places AS (
  SELECT doc_id, item_id, n, around, unnest(list_filter(range(1, n + 1), lambda k: a[k])) AS place FROM (
    SELECT *, unnest([floor(CAST(shift AS DOUBLE) / n) * 2, floor(CAST(shift AS DOUBLE) / n + 0.5) * 2 + 1]) AS around FROM counted)
), joined AS (
  SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, item_id, n, around, count(DISTINCT place) AS c FROM places GROUP BY ALL)
  WHERE c >= ceil(CAST(0.7 AS DOUBLE) * n)
)
SELECT doc_id, item_id, CAST(matched AS INTEGER) AS matched, CAST(n AS INTEGER) AS n_words FROM best
WHERE matched >= ceil(CAST(0.7 AS DOUBLE) * n) OR dense OR (doc_id, item_id) IN (SELECT (doc_id, item_id) FROM joined)
"""

# CRC-32 of a list of bytes by its table of 256 remainders.
_CRC_TABLE = """crcs AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY b) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b)
)"""
_CRC = "xor(list_reduce(list_prepend(4294967295, {}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_HOST = f"translate(coalesce(regexp_extract({{0}}, '{_PARTS}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = f"coalesce(regexp_extract({{0}}, '{_PARTS}', 2), '')"


def _attribute(name: str) -> str:
    at = rf"""(?is)[\s"'']{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    return "replace(" + " || ".join(f"regexp_extract(tag, '{at}', {k})" for k in (1, 2, 3)) + ", '&amp;', '&')"


def _url_rule(value: str) -> str:
    rules = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
    shown = {"rule": lambda r: r[0] + r[1], "verdict": lambda r: r[2]}[value]
    return "CASE " + " ".join(
        f"WHEN (host = '{r[0]}' OR host LIKE '%.{r[0]}') AND starts_with(path, '{r[1]}') THEN '{shown(r)}'" for r in rules
    ) + " END"


SQL["op11_url_verdicts"] = rf"""
WITH RECURSIVE tags AS (
  SELECT DISTINCT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>', '', 'g'), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM pages WHERE regexp_matches(html, '(?i)canonical|refresh|og:url')
), aimed AS (
  SELECT url, trim(CASE
    WHEN tag ILIKE '<link%' AND list_contains(regexp_split_to_array(lower({_attribute("rel")}), '\s+'), 'canonical') THEN {_attribute("href")}
    WHEN tag ILIKE '<meta%' AND lower({_attribute("http-equiv")}) = 'refresh'
      THEN regexp_extract({_attribute("content")}, '(?is)^\s*[0-9.]*\s*[;,]\s*(?:url\s*=\s*)?["'']?([^"'']*)', 1)
    WHEN tag ILIKE '<meta%' AND lower({_attribute("property")}) = 'og:url' THEN {_attribute("content")} ELSE '' END) AS aim,
    regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme, regexp_extract(url, '{_PARTS}', 1) AS site, {_PATH.format("url")} AS path
  FROM tags WHERE url IS NOT NULL
), edges AS (
  SELECT url, CASE WHEN regexp_matches(aim, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN aim
    WHEN aim LIKE '//%' THEN scheme || ':' || aim WHEN aim LIKE '/%' THEN scheme || '://' || site || aim
    WHEN aim LIKE '?%' THEN scheme || '://' || site || path || aim
    ELSE scheme || '://' || site || coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') || aim END AS target
  FROM aimed WHERE aim <> '' AND aim NOT LIKE '#%' AND site <> ''
    AND (regexp_matches(aim, '^[A-Za-z][A-Za-z0-9+.-]*://') OR NOT regexp_matches(aim, '^[A-Za-z][A-Za-z0-9+.-]*:'))
), urls AS (
  SELECT url, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path, regexp_extract(url, '{_PARTS}', 3)[2:] AS asked
  FROM (SELECT url FROM pages UNION SELECT target FROM edges) WHERE url IS NOT NULL
), forms AS (
  SELECT url, {_url_rule("verdict")} AS verdict, CASE WHEN bare <> '' THEN bare
    || regexp_replace(regexp_replace(path, '/index\.html?$', '/'), '/+$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS form
  FROM (SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') AS bare,
    array_to_string(list_filter(string_split(asked, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|gclid|fbclid)(=|$)')), '&') AS kept FROM urls)
), pairs AS (
  SELECT a.form AS a, b.form AS b FROM edges JOIN forms a ON a.url = edges.url JOIN forms b ON b.url = edges.target
), both_ways AS (
  SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reach AS (
  SELECT DISTINCT form, form AS m FROM forms WHERE form IS NOT NULL
  UNION SELECT e.b, r.m FROM reach r JOIN both_ways e ON e.a = r.form
), decided AS (
  SELECT r.form, bool_or(f.verdict = 'allow') AS allowed, bool_or(f.verdict = 'block') AS blocked FROM reach r JOIN forms f ON f.form = r.m GROUP BY r.form
), judged AS (
  SELECT page_id, url, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path FROM pages
)
SELECT page_id, host, path, {_url_rule("rule")} AS rule,
  coalesce({_url_rule("verdict")}, CASE WHEN coalesce(d.blocked, false) AND NOT coalesce(d.allowed, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN forms USING (url) LEFT JOIN decided d ON d.form = forms.form
""".replace("judged LEFT JOIN forms USING (url)", "judged LEFT JOIN (SELECT url, form FROM forms) forms USING (url)")

SQL["op12_prefix_trie"] = rf"""
WITH {_CRC_TABLE}, own AS (
  SELECT conv_id, list(ROW(coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''),
    md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), drawn AS (
  SELECT own.*, {_CRC.format("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))")} % 6 AS h FROM own, crcs
), regrown AS (
  SELECT d.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(d.turns, h + 1, len(d.turns))) AS turns
  FROM drawn d LEFT JOIN own b ON b.conv_id = d.conv_id - d.conv_id % 100
), prefixes AS (
  SELECT conv_id, d AS depth, list_slice(turns, 1, d) AS path, list_slice(turns, 1, d - 1) AS above, len(turns) = d AS ended
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM regrown)
), nodes AS (
  SELECT path, any_value(above) AS above, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth > 0 THEN (count(*) - 1) * length(struct_extract_at(path[depth], 2)) ELSE 0 END AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM prefixes GROUP BY path, depth
), kids AS (
  SELECT above AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), sums AS (
  SELECT up AS depth, list_slice(n.path, 1, up) AS path, sum(saved) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes) n LEFT JOIN kids k ON k.path = n.path AND k.depth = n.depth GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
  s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.path = n.path AND s.depth = n.depth LEFT JOIN kids k ON k.path = n.path AND k.depth = n.depth
LEFT JOIN nodes p ON p.path = n.above AND p.depth = n.depth - 1
"""

_BYTES = """flatten(list_transform(string_split({}, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)]
  ELSE [192 | (CAST(ord(x) AS BIGINT) >> 6), 128 | (CAST(ord(x) AS BIGINT) & 63)] END))"""

# Near words share what a lost letter leaves: at the same place if one was replaced, the shorter word itself if one was inserted.
SQL["op13_spelling_groups"] = rf"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), hashed AS (
  SELECT run, {_CRC.format(_BYTES.format("id || ':' || run"))} AS h FROM (SELECT * FROM runs WHERE length(run) >= 6), crcs
), words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5
), lost AS (
  SELECT word, n, k, word[:k - 1] || word[k + 1:] AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM lost a JOIN lost b ON a.k = b.k AND a.rest = b.rest AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM lost a JOIN words w ON w.word = a.rest
  UNION SELECT w.word, w.n, a.word, a.n FROM lost a JOIN words w ON w.word = a.rest
), best AS (
  SELECT word, any_value(n) AS n, count(*) AS n_near, min(ROW(-other_n, other)) AS b FROM near GROUP BY word
), forms AS (
  SELECT word, n_near, CASE WHEN -struct_extract_at(b, 1) >= 5 * n THEN struct_extract_at(b, 2) END AS form,
    CASE WHEN -struct_extract_at(b, 1) >= 5 * n THEN -struct_extract_at(b, 1) END AS form_n FROM best
), chain AS (
  SELECT word, word AS root, 0 AS step FROM words
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT w.word, f.form, r.root, w.n, coalesce(f.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN forms f USING (word) JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) r USING (word)
"""
