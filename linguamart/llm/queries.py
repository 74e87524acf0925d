"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from pyspark.sql import functions as F

from . import jumpshards, leaks, lexsearch, lzprint, mainblocks, maxent, neardup, packing, ranking, repeats, urlrules, variants, warczip
from .common import table

QUERIES, ORACLES = {}, {}
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_maxent")
def op1(spark, sf_dir):
    return maxent.score_documents(table(spark, sf_dir, "documents"))


@query("op2_lz_fingerprint")
def op2(spark, sf_dir):
    return lzprint.fingerprints(table(spark, sf_dir, "documents"))


@query("op3_quality_ranking")
def op3(spark, sf_dir):
    return ranking.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_substring_dedup", """
WITH words AS (
  SELECT doc_id, [w FOR w IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS w FROM documents
), starts AS (
  SELECT doc_id, s, w[s:s + 34] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM words)
), repeated AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY win) AS n FROM starts) WHERE n > 1
), gone AS (
  SELECT doc_id, list(DISTINCT spot) AS gone FROM (SELECT doc_id, unnest(range(s, s + 35)) AS spot FROM repeated) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
         ELSE array_to_string([x FOR x, i IN w IF NOT list_contains(gone, i)], ' ') END) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)""")
def op4(spark, sf_dir):
    done = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_spaced_seeds")
def op5(spark, sf_dir):
    found = leaks.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_overlap", "n_equal")


@query("op6_line_blocks")
def op6(spark, sf_dir):
    return mainblocks.extract(table(spark, sf_dir, "pages"))


@query("op7_best_fit_packing")
def op7(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), special=True)




_RULE = "CASE WHEN {h} = '{host}' OR ends_with({h}, '.{host}') THEN CASE WHEN starts_with({p}, '{path}') THEN '{rule}' END END"


def _sql_rule(host, path):
    """The longest rule that fits a host and a path."""
    fitting = [
        _RULE.format(h=host, p=path, host=r.split("/", 1)[0], path="/" + r.split("/", 1)[1], rule=r)
        for _, r in sorted(URL_RULES, key=lambda x: -len(x[1]))
    ]
    return f"coalesce({', '.join(fitting)})"


def _sql_host(url):
    return f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{urlrules.ABC}', '{urlrules.LOWER}')"


def _sql_verdict(rule):
    return f"CASE {rule} " + " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in URL_RULES) + " END"


# The edges are those of canonical links and refreshes to absolute addresses, the only ones that the pages may hold.
@query("op8_url_equivalence", rf"""
WITH RECURSIVE found AS (
  SELECT url, unnest([
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0), '(?is)\burl\s*=\s*[''"]?([^"''\s>]+)', 1)
  ]) AS link FROM pages
), named AS (
  SELECT {_sql_host('url')} || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS a, {_sql_host('link')} || regexp_extract(link, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b
  FROM found WHERE contains(url, '://') AND contains(link, '://')
), edges AS (SELECT a, b FROM named UNION SELECT b, a FROM named),
reach AS (SELECT a, a AS b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
passed AS (
  SELECT a AS name, min({_sql_verdict(_sql_rule("regexp_extract(b, '^[^/?]*', 0)", "regexp_extract(b, '(?s)^[^/?]*([^?]*)', 1)"))}) AS passed_on FROM reach GROUP BY a
), urls AS (
  SELECT page_id, coalesce({_sql_host('url')}, '') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    {_sql_host('url')} || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS name FROM pages
), ruled AS (SELECT *, {_sql_rule('host', 'path')} AS rule FROM urls)
SELECT page_id, host, path, rule, coalesce({_sql_verdict('rule')}, passed_on, 'allow') AS verdict FROM ruled LEFT JOIN passed USING (name)""")
def op8(spark, sf_dir):
    return urlrules.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op9_minhash_near_dedup", f"""
WITH RECURSIVE words AS (
  SELECT doc_id, [w FOR w IN string_split_regex(translate(coalesce(text, ''), '{urlrules.ABC}', '{urlrules.LOWER}'), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
), single AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (SELECT a, a AS b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM sets LEFT JOIN least USING (doc_id)""")
def op9(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op10_jump_sharding")
def op10(spark, sf_dir):
    return jumpshards.shard_documents(table(spark, sf_dir, "documents"))


@query("op11_zip_warc", """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
sized AS (SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM payloads),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM sized)
SELECT page_id, payload_bytes, payload_digest, url AS target_uri,
  CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
FROM firsts JOIN pages USING (page_id)""")
def op11(spark, sf_dir):
    return warczip.archive_pages(table(spark, sf_dir, "pages"))


_TERMS = f"""unnest([t FOR t IN string_split_regex(translate(coalesce(text, ''), '{urlrules.ABC}', '{urlrules.LOWER}'), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') IF t <> '']) AS term"""


@query("op12_hybrid_search", f"""
WITH words AS (SELECT doc_id, {_TERMS} FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
worth AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
), asked AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN worth USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""")
def op12(spark, sf_dir):
    return lexsearch.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The crc32 of a text goes byte by byte through a table of 256 values, itself worked out bit by bit.
@query("op13_sorted_variants", f"""
WITH RECURSIVE bits AS (
  SELECT range AS i, range AS v, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
texts AS (SELECT doc_id, translate(coalesce(text, ''), '{urlrules.ABC}', '{urlrules.LOWER}') AS text FROM documents),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM texts)
  WHERE length(run) >= 7 GROUP BY ALL
), coded AS (SELECT run, n, hex(encode(doc_id || ':' || run)) AS code FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(
    list_transform(range(0, length(code) // 2), lambda i: ('0x' || substr(code, 2 * i::INT + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM coded, tab
), cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed
), words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorn AS (SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorn a JOIN shorn b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorn a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorn a JOIN words b ON a.rest = b.word
), best AS (SELECT word, count(*) AS n_near, max(near_n) AS form_n, arg_min(near, (-near_n, near)) AS form FROM pairs GROUP BY word),
forms AS (
  SELECT word, CASE WHEN form_n >= 10 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), steps AS (
  SELECT word, word AS root, 0 AS k FROM forms
  UNION ALL SELECT s.word, f.form, k + 1 FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(root, k) AS root FROM steps GROUP BY word) USING (word)""")
def op13(spark, sf_dir):
    return variants.spelling_groups(table(spark, sf_dir, "documents"))
