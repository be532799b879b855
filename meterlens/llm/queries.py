"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

from meterlens.llm.best_fit_packing import pack_documents
from meterlens.llm.common import table
from meterlens.llm.decontamination import contamination
from meterlens.llm.html_template import extract_main_text
from meterlens.llm.line_dedup import line_dedup
from meterlens.llm.passage_chains import passage_members, repeated_passages
from meterlens.llm.periodic_runs import periodic_runs
from meterlens.llm.phrase_mining import collocations
from meterlens.llm.quality_rules import quality_verdicts
from meterlens.llm.secret_scan import secret_spans
from meterlens.llm.sentence_pieces import encode_pieces, load_model
from meterlens.llm.simhash_neardup import simhash_components
from meterlens.llm.token_files import token_files, token_index
from meterlens.llm.url_lists import evaluate_captures

PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"
BYTE_MODEL = "byte_bpe_50k.json"


def op1_secret_scan(spark, sf_dir):
    return secret_spans(table(spark, sf_dir, "documents"))


def op2_html_template(spark, sf_dir):
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_passage_chains(spark, sf_dir):
    return passage_members(repeated_passages(table(spark, sf_dir, "documents")))


def op4_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    ids = F.array_sort("item_ids")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def captures(spark, sf_dir):
    """The pages as captures: fetched on a day of 2024 that follows from the id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(366)).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetched"))


def dated_entries(pages):
    """Dated list entries that follow from the hosts of the pages by one rule.

    A third of the hosts is blocked for a while, hosts with spam names by domain
    for good, every fourth host's /de pages by prefix; every fifth host's /en pages are
    allowed by prefix from some day on.
    """
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    hosts = pages.select(host.alias("host")).filter("host <> ''").distinct()

    def digits(at):
        return F.conv(F.substring(F.md5("host"), at, 4), 16, 10).cast("int")

    day = F.lit("2024-01-01").cast("date")
    start = F.date_add(day, F.pmod(digits(1), F.lit(200)))
    entry = "list_name string, allows boolean, kind string, pattern string, action string, entry_date date"

    def row(name, allows, kind, pattern, action, date):
        values = (F.lit(name), F.lit(allows), F.lit(kind), pattern, F.lit(action), date)
        return F.struct(*(v.alias(f.split()[0]) for v, f in zip(values, entry.split(", "), strict=True)))

    h = F.col("host")
    end = F.date_add(start, 1 + F.pmod(digits(5), F.lit(100)))
    domain = F.regexp_replace(h, r"^(www|m|blog)\.", "")
    rules = F.array(
        F.when(digits(9) % 3 == 0, row("abuse", False, "host", h, "add", start)),
        F.when(digits(9) % 3 == 0, row("abuse", False, "host", h, "remove", end)),
        F.when((digits(9) % 3 == 0) & (digits(13) % 2 == 0),
               row("abuse", False, "host", h, "add", F.date_add(end, 30))),
        F.when(h.rlike("ads-track|casino-win|spam-farm|cheap-pills|adult-x|free-bets"),
               row("spam", False, "domain", domain, "add", F.date_add(day, 30))),
        F.when(digits(17) % 4 == 0, row("policy", False, "prefix", F.concat(h, F.lit("/de")), "add", start)),
        F.when(digits(21) % 5 == 0, row("trusted", True, "prefix", F.concat(h, F.lit("/en/")), "add", end)),
    )
    return hosts.select(F.inline(F.filter(rules, lambda r: r.isNotNull())))


def op5_url_lists(spark, sf_dir):
    return evaluate_captures(captures(spark, sf_dir), dated_entries(table(spark, sf_dir, "pages")))


def op6_simhash_neardup(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return quality_verdicts(table(spark, sf_dir, "documents")).drop("row_key")


def op8_token_files(spark, sf_dir):
    spec = Path(public_tokenizers.path(WORD_MODEL)).read_text(encoding="utf-8")
    return token_index(token_files(spark, table(spark, sf_dir, "documents"), spec))


def op9_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op10_sentence_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = load_model(public_tokenizers.path(PIECE_MODEL))
    return encode_pieces(docs, model, decoded_col="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_waves(docs):
    """Texts made periodic by rule: in every tenth document (by CRC-32 of its id), the
    words from some place on repeat a first stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w"))
    n = F.when(F.size("w") > 0, F.size("w"))
    docs = docs.select("*", n.alias("n"), (F.col("g") % n).cast("int").alias("a"))
    left = F.col("n") - F.col("a")
    period = (F.floor(left / (3 + F.col("g") % 8)) + 1).cast("int")
    docs = docs.select("*", left.alias("left"), period.alias("p"))
    wave = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil(F.col("left") / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(wave, times)), F.lit(1), F.col("left"))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return docs.select("doc_id", F.coalesce(planted, "text").alias("text"))


def op11_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(with_waves(docs))
    # runs come by start, then period: of equal exponents the first one stays
    def steeper(a, r):
        return F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a)

    def line(r):
        return F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))

    best = F.aggregate("runs", F.try_element_at("runs", F.lit(1)), steeper)
    picked = found.select("doc_id", "runs", best.alias("best"), "collapsed")
    return picked.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_phrase_mining(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark, sf_dir):
    spec = Path(public_tokenizers.path(BYTE_MODEL)).read_text(encoding="utf-8")
    return pack_documents(table(spark, sf_dir, "documents"), spec)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_html_template": op2_html_template,
    "op3_passage_chains": op3_passage_chains,
    "op4_decontamination": op4_decontamination,
    "op5_url_lists": op5_url_lists,
    "op6_simhash_neardup": op6_simhash_neardup,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_files": op8_token_files,
    "op9_line_dedup": op9_line_dedup,
    "op10_sentence_pieces": op10_sentence_pieces,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_best_fit_packing": op13_best_fit_packing,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE: dict[str, str] = {
    "op4_decontamination": f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '{WORDS}') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '{WORDS}') AS w
  FROM benchmark
),
starts AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p
  FROM items WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS phrase
  FROM starts
),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
  FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
),
phrases AS (
  SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS phrase FROM places
),
found AS (SELECT doc_id, item_id, n, p FROM phrases JOIN windows USING (n, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named i USING (doc_id)""",
    "op12_phrase_mining": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM worded),
sized AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
lengths AS (SELECT unnest(range(1, 6)) AS size),
found AS (
  SELECT lang, size, array_to_string(list_slice(w, p, p + size - 1), ' ') AS phrase
  FROM places, lengths WHERE p + size - 1 <= len(w)
),
f AS (SELECT lang, size, phrase, count(*) AS n FROM found GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
cuts AS (
  SELECT lang, phrase, n AS a, k, array_to_string(list_slice(w, 1, k), ' ') AS first,
         array_to_string(list_slice(w, k + 1, size), ' ') AS rest
  FROM candidates, (SELECT unnest(range(1, 5)) AS k) WHERE k < size
),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.n AS l, y.n AS r, s.n AS n,
         CAST((1000::HUGEINT * c.a * s.n) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first
  JOIN f y ON y.lang = c.lang AND y.phrase = c.rest JOIN sized s ON s.lang = c.lang
),
worst AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
  SELECT c.lang, array_to_string(list_slice(w, p, p + m - 1), ' ') AS phrase, max(c.n) AS longer
  FROM candidates c, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS p)
  WHERE m < size AND p + m - 1 <= size GROUP BY ALL
),
kept AS (
  SELECT w.* FROM worst w LEFT JOIN inside i USING (lang, phrase)
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * w.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000""",
    "op9_line_dedup": f"""
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{UPPER}', '{LOWER}') AS key
  FROM lines
),
repeated AS (
  SELECT key, max(doc_id) AS keep_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keep_doc AS dropped
  FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op5_url_lists": r"""
WITH caps AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS DATE) AS fetched,
         lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)) AS host,
         lower(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1)) AS path
  FROM pages
),
hosts AS (
  SELECT DISTINCT host, md5(host) AS m FROM caps WHERE host <> ''
),
n AS (
  SELECT host,
         CAST('0x' || substr(m, 9, 4) AS INTEGER) AS d9, CAST('0x' || substr(m, 13, 4) AS INTEGER) AS d13,
         CAST('0x' || substr(m, 17, 4) AS INTEGER) AS d17, CAST('0x' || substr(m, 21, 4) AS INTEGER) AS d21,
         DATE '2024-01-01' + CAST('0x' || substr(m, 1, 4) AS INTEGER) % 200 AS a,
         DATE '2024-01-01' + CAST('0x' || substr(m, 1, 4) AS INTEGER) % 200
           + 1 + CAST('0x' || substr(m, 5, 4) AS INTEGER) % 100 AS b
  FROM hosts
),
intervals AS (
  SELECT 'abuse' AS list_name, false AS allows, 'host' AS kind, host AS pattern, a AS f, b AS t
  FROM n WHERE d9 % 3 = 0
  UNION ALL SELECT 'abuse', false, 'host', host, b + 30, NULL FROM n WHERE d9 % 3 = 0 AND d13 % 2 = 0
  UNION ALL SELECT DISTINCT 'spam', false, 'domain', regexp_replace(host, '^(www|m|blog)\.', ''),
                   DATE '2024-01-31', NULL
  FROM n WHERE regexp_matches(host, 'ads-track|casino-win|spam-farm|cheap-pills|adult-x|free-bets')
  UNION ALL SELECT 'policy', false, 'prefix', host || '/de', a, NULL FROM n WHERE d17 % 4 = 0
  UNION ALL SELECT 'trusted', true, 'prefix', host || '/en', b, NULL FROM n WHERE d21 % 5 = 0
),
found AS (
  SELECT c.page_id, i.list_name, i.allows, length(i.pattern) AS w
  FROM caps c JOIN intervals i
    ON c.fetched >= i.f AND (i.t IS NULL OR c.fetched < i.t)
   AND CASE i.kind WHEN 'host' THEN c.host = i.pattern
            WHEN 'domain' THEN c.host = i.pattern OR c.host LIKE '%.' || i.pattern
            ELSE starts_with(rtrim(c.host || c.path, '/') || '/', i.pattern || '/') END
),
verdict AS (
  SELECT page_id, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS lists, count(*) AS n_entries,
         max(w) FILTER (WHERE NOT allows) AS block, max(w) FILTER (WHERE allows) AS allow
  FROM found GROUP BY page_id
)
SELECT c.page_id, c.url, c.fetched, coalesce(v.lists, '') AS lists, coalesce(v.n_entries, 0) AS n_entries,
       coalesce(v.block > coalesce(v.allow, -1), false) AS blocked
FROM caps c LEFT JOIN verdict v USING (page_id)""",
}
