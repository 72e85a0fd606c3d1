"""The queries of this subpackage over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (automaton, chat, decontaminate, divergence, hosts, jaccard, lines, negatives, neighbours, pieces,
               substrings, surrogates, tokens)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``fn(read)`` under its name; ``read("documents")`` reads a table."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def jaccard_sql(source: str, n: int, percent: int) -> str:
    """CTEs ending in ``linked(doc_id, n_shingles, component_id)`` over the documents of ``source``."""
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""
    words AS (SELECT doc_id, [x for x in regexp_split_to_array({LOWERED}, '[\\x20\\x09-\\x0D]+') if x <> ''] AS w
      FROM {source}),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
      ELSE list_distinct([{gram} for i in range(1, len(w) - {n - 2})]) END AS s FROM words),
    grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    links AS (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n + b.n) AS n
        FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2)
      WHERE 100 * c >= {percent} * (n - c)),
    reach AS (SELECT doc_id, doc_id AS c FROM sets UNION SELECT y, c FROM reach JOIN links ON doc_id = x),
    linked AS (SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.c AS component_id FROM sets s
      JOIN (SELECT doc_id, min(c) AS c FROM reach GROUP BY 1) m USING (doc_id))"""


@query(f"WITH RECURSIVE {jaccard_sql('documents', 3, 90)} SELECT * FROM linked")
def op8_ngram_jaccard_join(read) -> DataFrame:
    """Documents grouped by links of Jaccard similarity 0.9 or more over three-word shingles."""
    return jaccard.jaccard_groups(read("documents"), n=3, percent=90)


@query()
def op10_quality_classifier(read) -> DataFrame:
    """Quality of every document by the line model, fitted outside the held-out quarter."""
    docs = read("documents")
    model = lines.train(docs, read("labels"))
    return lines.scored(docs, model).select(
        "doc_id", lines.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "n_lines", "n_bad_lines")


def decontaminate_sql(source: str, size: int = 10) -> str:
    """CTEs ending in ``judged`` with the columns of the decontamination query."""
    split = f"[x for x in regexp_split_to_array({LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> '']"
    return f"""
    spoken AS (SELECT doc_id, {split} AS w FROM {source}),
    asked AS (SELECT item_id, {split} AS w FROM benchmark),
    wins AS (SELECT DISTINCT item_id, least(len(w), {size}) AS k, unnest([array_to_string(w[i:i + {size} - 1], ' ')
        for i in range(1, greatest(len(w) - {size - 1}, 1) + 1)]) AS t FROM asked WHERE len(w) > 0),
    runs AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i,
        unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) AS t
      FROM spoken, (SELECT DISTINCT k FROM wins) WHERE len(w) >= k),
    found AS (SELECT doc_id, i, r.k, item_id FROM runs r JOIN wins v ON r.t = v.t AND r.k = v.k),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY 1),
    named AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY 1),
    judged AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
        coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
      FROM spoken LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id))"""


@query(f"WITH {decontaminate_sql('documents')} SELECT * FROM judged")
def op9_benchmark_decontamination(read) -> DataFrame:
    """Words of every document that lie in a ten-word window of a benchmark item."""
    return decontaminate.contaminated(read("documents"), read("benchmark"))


#: where the public vocabulary files lie, and the key of the surrogates
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SURROGATE_KEY = b"replace this key by a secret one"


@query()
def op4_sentencepiece_codec(read) -> DataFrame:
    """Ids of every whole document, as a digest, and whether they decode to the same text."""
    return pieces.round_trips(read("documents"), pieces.load(VOCABULARY))


@query()
def op5_pii_surrogates(read) -> DataFrame:
    """Every document with its entities replaced, and the number of them."""
    return surrogates.surrogate_spans(read("documents"), SURROGATE_KEY).select("doc_id", "n_entities", "text")


@query("""
    WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM bytes)),
    first AS (SELECT s, min(doc_id) AS d FROM strings GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
    starts AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p
      FROM strings JOIN first USING (s) WHERE doc_id > d),
    runs AS (SELECT doc_id, r, min(i) AS a, max(i) + 50 AS b FROM
      (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS r
       FROM starts) GROUP BY 1, 2),
    edges AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER w AS from_, row_number() OVER w AS k, count(*) OVER (PARTITION BY doc_id) AS n
      FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
    kept AS (SELECT doc_id, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a)
        || max(substr(h, 2 * b + 1)) FILTER (WHERE k = n) AS h, any_value(n) AS n FROM edges JOIN bytes USING (doc_id) GROUP BY 1)
    SELECT doc_id, (len(b.h) // 2)::BIGINT AS n_bytes, ((len(b.h) - coalesce(len(k.h), len(b.h))) // 2)::BIGINT AS n_removed,
      coalesce(k.n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, b.h))) AS kept_sha256
    FROM bytes b LEFT JOIN kept k USING (doc_id)""")
def op2_suffix_array_dedup(read) -> DataFrame:
    """Documents without the 50-byte strings that a document with a smaller id holds too."""
    return substrings.without_repeats(read("documents")).drop("kept")


#: fixed values: the rules of the query
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _level_sql(level: str, parent: str) -> str:
    """CTEs that shrink the rates of one level towards those of the level above it."""
    return f"""
    {level}_in AS (SELECT {level}, sum(c.n) AS n, sum(c.b) AS b, any_value(p.mu) AS mu, any_value(p.var) AS var,
        any_value(p.n) AS near, any_value(p.mu) * (1 - any_value(p.mu)) AS spread
      FROM named c JOIN {parent}_out p USING ({parent}) GROUP BY {level}),
    {level}_size AS (SELECT CASE WHEN coalesce(sum(n * (n - 1)), 0) = 0 THEN 10.0
        WHEN (sum(power(b - n * mu, 2) / (mu * (1 - mu))) - sum(n)) / sum(n * (n - 1)) <= 1.0 / 1001 THEN 1000.0
        ELSE greatest(1.0, sum(n * (n - 1)) / (sum(power(b - n * mu, 2) / (mu * (1 - mu))) - sum(n)) - 1) END AS m
      FROM {level}_in WHERE n > 0),
    {level}_prior AS (SELECT *, greatest(spread / (spread / (m + 1) + var) - 1, 0.01) AS size FROM {level}_in, {level}_size),
    {level}_mean AS (SELECT *, (b + size * mu) / (n + size) AS rate FROM {level}_prior),
    {level}_out AS (SELECT {level}, n, near, rate AS mu, rate * (1 - rate) / (n + size + 1) AS var FROM {level}_mean)"""


_FITS = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{d} {h}{p}'"
                 for d, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))


@query(f"""
    WITH rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
    split AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    fit AS (SELECT *, CASE {_FITS} END AS f FROM split),
    judged AS (SELECT page_id, host, path, split_part(f, ' ', 2) AS rule, split_part(f, ' ', 1) AS decision FROM fit),
    plain AS (SELECT host, count(*) FILTER (WHERE decision <> '') AS n, count(*) FILTER (WHERE decision = 'block') AS b,
        string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS w FROM judged GROUP BY host),
    marked AS (SELECT *, array_to_string(w, '.') AS name, CASE WHEN list_contains({list(hosts.TWO_LABELS)}, array_to_string(w[-2:], '.'))
        THEN 2 ELSE 1 END AS k, regexp_matches(array_to_string(w, '.'), '^[0-9]+(\\.[0-9]+){{3}}$') OR len(w) < 2 AS alone FROM plain),
    named AS (SELECT host, n, b, CASE WHEN alone THEN name ELSE array_to_string(w[-k:], '.') END AS suffix,
        CASE WHEN alone THEN name ELSE array_to_string(w[-least(len(w), k + 1):], '.') END AS domain, 0 AS root FROM marked),
    root_out AS (SELECT 0 AS root, n, mu, mu * (1 - mu) / (n + 2) AS var
      FROM (SELECT sum(n) AS n, (sum(b) + 0.5) / (sum(n) + 1) AS mu FROM named)),
    {_level_sql('suffix', 'root')}, {_level_sql('domain', 'suffix')}, {_level_sql('host', 'domain')}
    SELECT page_id, host, path, nullif(rule, '') AS rule, CASE WHEN decision <> '' THEN decision
      WHEN near > 0 AND mu - 1.645 * sqrt(var) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
    FROM judged LEFT JOIN host_out USING (host)""")
def op6_url_filters(read) -> DataFrame:
    """Verdict on every page's url, by rule or by its host's reputation."""
    return hosts.filtered(read("pages"), RULES)


@query()
def op7_nearest_neighbours(read) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    return neighbours.nearest(read("embeddings"), lambda key: key % 100 == 0)


#: a byte-level vocabulary in rank format
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@query()
def op1_token_counts(read) -> DataFrame:
    """Tokens of every line of every document, from one encoding of the whole document."""
    return tokens.attributed(read("documents"), tokens.load(RANKS)).select(
        "doc_id", F.col("section").cast("long").alias("line"), "n_bytes", F.col("n_tokens").cast("long").alias("n_tokens"),
        "n_crossing")


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as people paste them: each in one of five marker styles, every fifth marker missing."""
    style = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(5))
    there = F.pmod(F.crc32(F.concat_ws("-", "conv_id", "turn").cast("binary")), F.lit(5)) > 0
    name, text = F.initcap("role"), F.coalesce("text", F.lit(""))
    short = F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise(name)
    marked = (F.when(style == 0, F.concat(name, F.lit(": "), text)).when(style == 1, F.concat(F.lit("### "), name, F.lit(":\n"), text))
              .when(style == 2, F.concat(F.lit("["), F.upper("role"), F.lit("] "), text))
              .when(style == 3, F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), text, F.lit("\n<|im_end|>")))
              .otherwise(F.concat(short, F.lit(": "), text)))
    return conversations.withColumn("raw", F.concat(F.when(there, marked).otherwise(text), F.lit("\n")))


@query()
def op3_chat_formatting(read) -> DataFrame:
    """Canonical turns of the conversations' raw transcripts; the model counts three quarters of them."""
    rows = raw_transcripts(read("conversations"))
    model = chat.fit(rows.where(~lines.held_out("conv_id")), "conv_id", [F.col("turn")], "raw")
    return chat.parsed(rows, model, "conv_id", [F.col("turn")], "raw")


@query(f"""
    WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({LOWERED}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    used AS (SELECT lang, source, d, unnest(w) AS term FROM docs),
    kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM used GROUP BY ALL HAVING count(DISTINCT d) >= 30),
    langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM used JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM docs) g
      LEFT JOIN counts USING (lang, source) GROUP BY ALL),
    shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * v) AS p,
        1 + (1000000000 * (k.n + 5)) // (l.total + 5 * v) AS q
      FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
    apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a
      JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    listed AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a
        JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""")
def op13_source_divergence(read) -> DataFrame:
    """Differences between the sources of every language, and the terms that set each source apart."""
    return divergence.audit(read("documents"))


@query("""
    WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    scores AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
        list_dot_product(a.v, b.v)::BIGINT AS s FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    first AS (SELECT a, b, s FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
    SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER w)::INTEGER AS rank, n.b AS negative_id,
      p.s AS positive_score, n.s AS negative_score
    FROM first p JOIN scores n ON n.a = p.a AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
    WINDOW w AS (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) QUALIFY row_number() OVER w <= 10""")
def op12_hard_negatives(read) -> DataFrame:
    """Rows of other labels that come close to each anchor's positives, every seventh label moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read("embeddings").withColumn("label", moved), lambda key: key % 100 == 0)


#: weight of the shorter context in the language model
MASS = 1000.0


@query(f"""
    WITH named AS (SELECT doc_id, row_number() OVER () AS d, [chr(10)] || [x for x in regexp_split_to_array({LOWERED},
        '[\\x20\\x09-\\x0D]+') if x <> ''] || [chr(9)] AS w, doc_id::VARCHAR AS id FROM documents),
    -- the remainder of CRC-32, bit by bit
    held AS (SELECT doc_id, d, w, coalesce(xor(list_reduce([4294967295] || flatten([[(ascii(id[k]) >> j) & 1 for j in range(8)]
        for k in range(1, len(id) + 1)]), lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295) % 7 = 2, true)
        AS held_out FROM named),
    placed AS (SELECT d, held_out, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS t FROM held),
    seen AS (SELECT d, held_out, i, t AS g1, lag(t) OVER p || ' ' || t AS g2, lag(t, 2) OVER p || ' ' || lag(t) OVER p || ' ' || t AS g3
      FROM placed WINDOW p AS (PARTITION BY d ORDER BY i)),
    c1 AS (SELECT g1 AS g, count(*) AS c FROM seen WHERE NOT held_out GROUP BY 1),
    c2 AS (SELECT g2 AS g, count(*) AS c FROM seen WHERE NOT held_out AND i > 1 GROUP BY 1),
    c3 AS (SELECT g3 AS g, count(*) AS c FROM seen WHERE NOT held_out AND i > 2 GROUP BY 1),
    total AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM c1 WHERE g <> chr(10)),
    counted AS (SELECT d, i, coalesce(c1.c, 0) AS c1, coalesce(c2.c, 0) AS c2, coalesce(c3.c, 0) AS c3 FROM seen
      LEFT JOIN c1 ON c1.g = g1 LEFT JOIN c2 ON c2.g = g2 LEFT JOIN c3 ON c3.g = g3),
    ahead AS (SELECT *, lag(c1) OVER p AS h1, lag(c2) OVER p AS h2 FROM counted WINDOW p AS (PARTITION BY d ORDER BY i)),
    one AS (SELECT d, i, c1, c2, c3, h1, h2, n, (c1 + 1) / (n + v + 1) AS p1 FROM ahead, total WHERE i > 1),
    two AS (SELECT *, (c2 + {MASS} * p1) / (h1 + {MASS}) AS p2 FROM one),
    three AS (SELECT *, CASE WHEN i > 2 THEN (c3 + {MASS} * p2) / (h2 + {MASS}) ELSE p2 END AS p3 FROM two),
    summed AS (SELECT d, count(*) AS n_tokens, count(*) FILTER (WHERE c1 > 0) AS n_known, any_value(n) AS train_tokens,
        sum(log10(p1)) AS base_score, sum(log10(p3)) AS score FROM three GROUP BY d)
    SELECT doc_id, held_out, n_tokens, n_known, train_tokens, round(base_score, 6) AS base_score, round(score, 6) AS score
    FROM held JOIN summed USING (d)""")
def op11_lm_scores(read) -> DataFrame:
    """Log-probability of every document by a backoff automaton learned outside every seventh document."""
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(True))
    return automaton.scored(read("documents"), ~out, mass=MASS).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"),
        F.round("score", 6).alias("score"))
