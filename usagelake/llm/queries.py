"""The dealt operators' queries over the test tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelake.llm import bpe, collocations, decontam, line_runs, near, quality, recipes, repair, sharding, simhash, substrings, toxicity, urls
from usagelake.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return build(lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return build

    return register


@query("op3_chunk_recipes", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op3_chunk_recipes(table) -> DataFrame:
    return recipes.exact_groups(table("documents")).drop("n_chunks")


@query("op2_prob_min_hash")
def op2_prob_min_hash(table) -> DataFrame:
    return near.near_classes(table("documents")).drop("sha")


@query("op10_spaced_seeds")
def op10_spaced_seeds(table) -> DataFrame:
    return decontam.contaminated(table("documents"), table("benchmark"))


@query("op8_lexicon_automaton")
def op8_lexicon_automaton(table) -> DataFrame:
    docs = table("documents")
    return toxicity.score(docs, toxicity.fit(docs, table("labels")))


def tokens(docs: DataFrame) -> DataFrame:
    pieces, pattern = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(docs, pieces, pattern), pieces))


@query("op1_byte_bpe")
def op1_byte_bpe(table) -> DataFrame:
    return tokens(table("documents"))


@query("op9_hashed_ngrams")
def op9_hashed_ngrams(table) -> DataFrame:
    docs = table("documents")
    return quality.score(docs, quality.fit(docs, table("labels")))


@query("op4_doubling_windows", r"""
WITH texts AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i : i + 49], ' ') AS run FROM texts, unnest(range(1, len(words) - 48)) AS t(i)),
heads AS (SELECT run, min(doc_id) AS head FROM windows GROUP BY run),
gone AS (SELECT DISTINCT doc_id, i + j AS n FROM windows JOIN heads USING (run), range(0, 50) AS k(j) WHERE doc_id > head),
words AS (SELECT doc_id, w, n FROM texts, unnest(words) WITH ORDINALITY AS t(w, n)),
judged AS (SELECT w.*, g.n IS NOT NULL AS removed FROM words w LEFT JOIN gone g USING (doc_id, n)),
cut AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
        string_agg(w, ' ' ORDER BY n) FILTER (WHERE NOT removed) AS kept FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
""")
def op4_doubling_windows(table) -> DataFrame:
    cut = substrings.cut_repeats(table("documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_karmarkar_karp")
def op5_karmarkar_karp(table) -> DataFrame:
    return sharding.shards_by_bytes(table("documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Fixed values of the query's contract.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@query("op6_redirect_classes", r"""
WITH rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
       ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, rest,
       translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
       coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
       regexp_replace(regexp_replace(regexp_replace(coalesce(regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1), ''),
         '([?&])((utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&#]*(&|$))+', '', 'g'), '[?&]$', ''), '^$', '') AS query
       FROM cut),
ruled AS (SELECT p.*, CASE WHEN rest IS NOT NULL THEN p.host || regexp_replace(p.path, '/+$', '') || query END AS form,
       (SELECT max({'n': length(r.host || r.path), 'rule': r.host || r.path, 'verdict': r.verdict}) FROM rules r
        WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS own
       FROM parts p),
classes AS (SELECT form, bool_or(own.verdict = 'allow') AS allows, bool_or(own.verdict = 'block') AS blocks
       FROM ruled WHERE own IS NOT NULL AND form IS NOT NULL GROUP BY form)
SELECT page_id, host, path, own.rule AS rule,
       coalesce(own.verdict, CASE WHEN allows THEN 'allow' WHEN blocks THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN classes USING (form)
""")
def op6_redirect_classes(table) -> DataFrame:
    return urls.judge(table("pages"), URL_RULES)


@query("op7_line_suffixes", r"""
WITH lines AS (SELECT doc_id, line, i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
       unnest(all_lines) WITH ORDINALITY AS t(line, i)),
full_lines AS (SELECT *, row_number() OVER own AS n, lead(line) OVER own AS next FROM lines WHERE trim(line) <> ''
       WINDOW own AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, n, min({'d': doc_id, 'n': n}) OVER (PARTITION BY line, next) AS head FROM full_lines WHERE next IS NOT NULL),
later AS (SELECT doc_id, n FROM runs WHERE {'d': doc_id, 'n': n} <> head),
gone AS (SELECT doc_id, n FROM later UNION SELECT doc_id, n + 1 FROM later),
judged AS (SELECT l.doc_id, l.line, l.i, g.n IS NOT NULL AS removed FROM lines l LEFT JOIN full_lines f USING (doc_id, i)
       LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.n = f.n)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""")
def op7_line_suffixes(table) -> DataFrame:
    cut = line_runs.cut_runs(table("documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_pigeonhole_blocks")
def op11_pigeonhole_blocks(table) -> DataFrame:
    return simhash.near_components(table("documents"))


@query("op12_tiled_collocations", r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
spoken AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM spoken GROUP BY lang),
known AS (SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS a
       FROM spoken, unnest(range(1, len(words) + 1)) AS t(i), (VALUES (1), (2), (3), (4)) AS s(k) WHERE i + k - 1 <= len(words)
       GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM known WHERE k > 1),
parts AS (SELECT lang, phrase, a, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 : k], ' ') AS tail
       FROM candidates, unnest(range(1, k)) AS t(j)),
cuts AS (SELECT p.*, x.a AS l, y.a AS r, (2000000::HUGEINT * p.a) // (x.a + y.a) AS score
       FROM parts p JOIN known x ON x.lang = p.lang AND x.phrase = p.head JOIN known y ON y.lang = p.lang AND y.phrase = p.tail),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS most
       FROM candidates, unnest(range(1, k)) AS t(i), unnest(range(2, k)) AS u(m) WHERE i + m - 1 <= k GROUP BY ALL),
ranked AS (SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s.phrase) AS rank
       FROM scored s LEFT JOIN longer b USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""")
def op12_tiled_collocations(table) -> DataFrame:
    return collocations.collocations(table("documents"))


def _repair_sql() -> str:
    """A row at a time through four columns, one for each state of the role grammar, each the least (cost, audit)."""
    def add(state: str, cost: str, letter: str, line: str = "''") -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}} END"

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    stays = "fault NOT IN ('b', 'd')"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def kept(state: str, initial: str) -> str:
        return f"CASE WHEN {stays} AND i = '{initial}' THEN {add(state, 'more', 'K', 'line')} END"

    def made(state: str, role: str) -> str:
        return f"CASE WHEN {stays} THEN {add(state, '3 + more', 'R', role + ' || text')} END"

    asked = least("q", *[add(s, "4", "I", user) for s in ("z", "s", "w")])
    return rf"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS tag FROM conversations),
hashed AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(tag) + 1), lambda j: ascii(tag[j])::BIGINT)),
       lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
       4294967295) % 20 AS damage FROM raw),
damaged AS (SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
       CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
       unnest(range(CASE WHEN damage = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE damage <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n FROM damaged),
judged AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role || ' ', 1) AS i,
       row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
       lag(left(role || ' ', 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role || ' ', 1) AS roles FROM ordered),
faults AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) IN ('.', '!', '?') THEN '-' ELSE 't' END AS fault FROM judged),
marks AS (SELECT conv_id, n, i, fault, text, chr(10) || role || ':' || text AS line, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS more FROM faults),
counts AS (SELECT conv_id, count(*) AS rows_left, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
       count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
       count(*) FILTER (WHERE roles NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS z, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s,
         NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS q, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS w FROM counts
  UNION ALL
  SELECT conv_id, n, {add('z', '4', 'D')}, {least(add('s', '4', 'D'), kept('z', 's'))},
         {least(add('q', '4', 'D'), *[f(x, r) for x in 'zsw' for f, r in ((kept, 'u'), (made, user))])},
         {least(add('w', '4', 'D'), kept('q', 'a'), made('q', assistant))}
  FROM (SELECT conv_id, n, i, fault, text, line, more, z, s, q, {least('w', add('q', '4', 'I', assistant))} AS w FROM (
        SELECT walk.conv_id, m.n, m.i, m.fault, m.text, m.line, m.more, z, s, w, {asked} AS q
        FROM walk JOIN marks m ON m.conv_id IS NOT DISTINCT FROM walk.conv_id AND m.n = walk.n + 1))),
ends AS (SELECT conv_id, {least('z', 'w', add('q', '4', 'I', assistant), add(f"({add('s', '4', 'I', user)})", '4', 'I', assistant))} AS e
       FROM walk JOIN counts USING (conv_id) WHERE n = rows_left)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(e.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op13_lightest_repair", _repair_sql())
def op13_lightest_repair(table) -> DataFrame:
    return repair.repair(table("conversations"))
