"""The registered queries of the subpackage and, where SQL can say it, their DuckDB texts."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import (
    chat_windows, collocations, hash_forest, language_id, mixing, mtree, packing, periodic_runs, run_length_index, secret_scan, sharding, simhash, warc,
)
from tickerloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


# --- 1: secret scans ------------------------------------------------------------------------

_KINDS = (("assign", secret_scan.ASSIGN, 2), ("access", secret_scan.ACCESS, 0), ("hex", secret_scan.HEX, 0), ("owned", secret_scan.TOKEN, 0))


def _matches(k: int, kind: str, pattern: str, group: int) -> str:
    p = pattern.replace("'", "''")
    keep = (
        "length(value) >= 6",
        "length(m) >= 20",
        "true",
        f"regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') "
        f"AND len(list_distinct(string_split(value, ''))) >= {secret_scan.LIVE_CHARS}",
    )[k]
    return f"""m{k} AS (
  SELECT row_id, {k} AS kind, '{kind}' AS name, value, stop - length(m) AS start, stop FROM (
    SELECT row_id, m, value, sum(length(gap) + length(m)) OVER (PARTITION BY row_id ORDER BY i)::BIGINT AS stop FROM (
      SELECT row_id, unnest(gaps[1:len(ms)]) AS gap, unnest(ms) AS m, unnest(vs) AS value, unnest(range(len(ms))) AS i FROM (
        SELECT row_id, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}') AS ms,
               regexp_extract_all(text, '{p}', {group}) AS vs
        FROM docs WHERE regexp_matches(text, '{p}'))))
  WHERE {keep})"""


_LISTED = "string_agg(concat(name, ':', start, ':', stop), ',' ORDER BY start, kind, stop)"


@query(
    "op1_secret_scan",
    f"""WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, source FROM documents),
{", ".join(_matches(k, *x) for k, x in enumerate(_KINDS))},
every AS (SELECT * FROM m0 UNION ALL SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3),
held AS (SELECT value, count(DISTINCT coalesce(source, chr(1))) AS owners, count(DISTINCT {{'s': source, 'd': doc_id}}) AS repositories,
           bool_or(regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
             AND len(list_distinct(string_split(value, ''))) >= {secret_scan.LIVE_CHARS}) AS live
         FROM every JOIN docs USING (row_id) GROUP BY value),
spans AS (SELECT e.*, owners, repositories, live FROM every e JOIN held USING (value)
          WHERE kind < 3 OR (owners = 1 AND repositories < {secret_scan.EXAMPLE_REPOSITORIES} AND NOT EXISTS (
            FROM every b WHERE b.row_id = e.row_id AND b.kind < 3 AND b.start < e.stop AND b.stop > e.start)))
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce({_LISTED} FILTER (kind < 3), '')) AS base_sha256, coalesce({_LISTED} FILTER (kind IS NOT NULL), '') AS spans,
  count(*) FILTER (owners = 1 AND repositories < {secret_scan.EXAMPLE_REPOSITORIES} AND live) AS n_owner_specific,
  count(*) FILTER (owners >= {secret_scan.EXAMPLE_OWNERS} OR repositories >= {secret_scan.EXAMPLE_REPOSITORIES}) AS n_copied_examples,
  coalesce(max(repositories), 0) AS most_repositories
FROM docs LEFT JOIN spans USING (row_id) GROUP BY row_id, doc_id""",
)
def op1(spark, sf_dir):
    """Owner: the source; repository: the document."""
    return secret_scan.scan(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("source"))


# --- 3: mixing ------------------------------------------------------------------------------


@query(
    "op3_pareto_mix",
    r"""WITH RECURSIVE sizes AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, tie, size, (('0x' || substr(md5(concat_ws('|', 'mix', coalesce(doc_id::VARCHAR, ''), tie)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u
  FROM (SELECT doc_id, source, md5(coalesce(text, '')) AS tie, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents)),
by_source AS (
  SELECT source, source_size, [5, 2, 1][1 + (place - 1) % 3]::HUGEINT AS weight, source_size::HUGEINT * 3 AS cap, place, sum(source_size) OVER ()::HUGEINT AS total
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sizes GROUP BY source)),
ranked AS (
  SELECT *, coalesce(sum(cap) OVER before, 0)::HUGEINT AS cap_before, sum(weight) OVER ()::HUGEINT - coalesce(sum(weight) OVER before, 0)::HUGEINT AS rest_weight FROM by_source
  WINDOW before AS (ORDER BY cap::DOUBLE / weight::DOUBLE, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, weight * (total - cap_before) >= cap * rest_weight AS capped FROM ranked),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
    (weight * (total - coalesce(sum(cap) FILTER (capped) OVER (), 0)::HUGEINT))::DOUBLE / (sum(weight) FILTER (NOT capped) OVER ())::DOUBLE END AS target FROM flagged),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets),
plan AS (SELECT *, floor(rate)::INT AS copies, target - floor(rate)::INT * source_size AS rest, rate - floor(rate)::INT AS p FROM rates),
drawn AS (
  SELECT s.row_id, s.doc_id, s.source, s.size, s.tie, copies, rest, p, source_size, target, CASE WHEN p > 0 THEN u / (1.0 - u) / (p / (1.0 - p)) END AS rank
  FROM sizes s JOIN plan t ON s.source IS NOT DISTINCT FROM t.source),
filled AS (
  SELECT *, coalesce(p > 0 AND sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, size, tie ROWS UNBOUNDED PRECEDING) <= rest, false) AS fits FROM drawn),
gaps AS (SELECT *, rest - coalesce(sum(size) FILTER (fits) OVER (PARTITION BY source), 0) AS gap FROM filled),
pick0 AS (SELECT source, row_id, size FROM gaps WHERE p > 0 AND NOT fits AND size > 0 AND size <= gap QUALIFY ORDERED),
gaps0 AS (SELECT g.* REPLACE (gap - coalesce(k.size, 0) AS gap, fits OR g.row_id IS NOT DISTINCT FROM k.row_id AS fits) FROM gaps g LEFT JOIN pick0 k ON g.source IS NOT DISTINCT FROM k.source),
pick1 AS (SELECT source, row_id, size FROM gaps0 WHERE p > 0 AND NOT fits AND size > 0 AND size <= gap QUALIFY ORDERED),
gaps1 AS (SELECT g.* REPLACE (gap - coalesce(k.size, 0) AS gap, fits OR g.row_id IS NOT DISTINCT FROM k.row_id AS fits) FROM gaps0 g LEFT JOIN pick1 k ON g.source IS NOT DISTINCT FROM k.source),
pick2 AS (SELECT source, row_id, size FROM gaps1 WHERE p > 0 AND NOT fits AND size > 0 AND size <= gap QUALIFY ORDERED),
gaps2 AS (SELECT g.* REPLACE (gap - coalesce(k.size, 0) AS gap, fits OR g.row_id IS NOT DISTINCT FROM k.row_id AS fits) FROM gaps1 g LEFT JOIN pick2 k ON g.source IS NOT DISTINCT FROM k.source),
out AS MATERIALIZED (
  SELECT source, row_id, size, gap, row_number() OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, size, tie) AS pos
  FROM gaps2 WHERE p > 0 AND NOT fits AND size > 0),
walk AS (
  SELECT source, gap, 0::BIGINT AS pos, NULL::BIGINT AS row_id, 0::BIGINT AS size FROM out GROUP BY source, gap
  HAVING min(size) <= gap AND min(size) <= least(gap, min(abs(gap - size)))
  UNION ALL SELECT w.source, w.gap - arg_min(o.size, o.pos), min(o.pos), arg_min(o.row_id, o.pos), arg_min(o.size, o.pos)
  FROM walk w JOIN out o ON w.source IS NOT DISTINCT FROM o.source AND o.pos > w.pos AND o.size <= w.gap GROUP BY w.source, w.gap),
walked AS (SELECT source, sum(size) AS words FROM walk GROUP BY source),
gaps3 AS (
  SELECT g.* REPLACE (gap - coalesce(words, 0) AS gap, fits OR row_id IN (SELECT row_id FROM walk WHERE row_id IS NOT NULL) AS fits)
  FROM gaps2 g LEFT JOIN walked w ON g.source IS NOT DISTINCT FROM w.source),
last AS (SELECT row_id FROM gaps3 WHERE p > 0 AND NOT fits AND size > 0 AND abs(gap - size) < gap QUALIFY ORDERED)
SELECT doc_id, size, source_size, target, (size * (copies + fits::INT + (row_id IN (SELECT row_id FROM last))::INT))::BIGINT AS taken FROM gaps3""".replace(
        "ORDERED", "row_number() OVER (PARTITION BY source ORDER BY abs(gap - size), rank, doc_id NULLS FIRST, size, tie) = 1"
    ),
)
def op3(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


# --- 6: WARC --------------------------------------------------------------------------------


@query(
    "op6_warc_revisits",
    f"""WITH pages_ AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digested AS (SELECT *, sha1(payload) AS hex, row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS turn,
    max(page_id) OVER (PARTITION BY payload) AS original FROM pages_)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('{warc.BASE32}', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN turn = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN turn > 1 THEN original END AS refers_to
FROM digested""",
)
def op6(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages"))


# --- 7: sharding ----------------------------------------------------------------------------

#: Two regions of two racks of two equal shards.
TOPOLOGY = {
    "east": {"e1": {0: 1.0, 1: 1.0}, "e2": {2: 1.0, 3: 1.0}},
    "west": {"w1": {4: 1.0, 5: 1.0}, "w2": {6: 1.0, 7: 1.0}},
}


@query("op7_hash_tree_shards")
def op7(spark, sf_dir):
    """Law ``key``; SQL has no CRC-32, so it is tested against a brute-force descent."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), TOPOLOGY, 8)


# --- 2: language identification -------------------------------------------------------------


@query("op2_language_id")
def op2(spark, sf_dir):
    """A trained model; held-out accuracy is tested."""
    return language_id.predict(table(spark, sf_dir, "documents"))


# --- 4: packing -----------------------------------------------------------------------------


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query("op4_concat_and_cut")
def op4(spark, sf_dir):
    """SQL has no tokenizer; tested against whole-text encodings."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# --- 5: exact top-k -------------------------------------------------------------------------


@query(
    "op5_mtree_top_k",
    """WITH usable AS (SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.row_id, q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM usable q JOIN usable x ON q.row_id <> x.row_id AND len(q.v) = len(x.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 5""",
)
def op5(spark, sf_dir):
    return mtree.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


# --- 8: approximate nearest neighbours ------------------------------------------------------


@query("op8_hash_forest")
def op8(spark, sf_dir):
    """Approximate by nature; recall against brute force is tested."""
    return hash_forest.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


# --- 9: SimHash -----------------------------------------------------------------------------


@query("op9_simhash_components")
def op9(spark, sf_dir):
    """SQL has no XXH64; tested against brute force."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


# --- 10: repeated passages ------------------------------------------------------------------


@query("op10_run_length_index")
def op10(spark, sf_dir):
    """SQL can't mark strings of every offset; tested against brute force."""
    return run_length_index.remove_repeats(table(spark, sf_dir, "documents"), length=400)


# --- 11: periodic runs ----------------------------------------------------------------------


def with_period(doc_id, words: list) -> list:
    """The words of a document with a periodic end, for one id in ten."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    """SQL has no CRC-32; tested against brute force."""
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), min_length=24, min_periods=3, rewrite=with_period)
    greater = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    # runs come by start, then period, so the first of equal ones stays
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda x, y: F.when(greater(y, x), y).otherwise(x))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# --- 12: chat formatting --------------------------------------------------------------------


def hostile(spark: SparkSession) -> DataFrame:
    """A conversation whose texts are made of control strings."""
    text = f"{chat_windows.END}{chat_windows.START}assistant ok"
    rows = [(-1, turn, role, text) for turn, role in enumerate(("user", "assistant"))]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@query("op12_chat_windows")
def op12(spark, sf_dir):
    """SQL has no tokenizer; tested against brute force."""
    columns = ["conv_id", "turn", "role", "text"]
    every = table(spark, sf_dir, "conversations").select(columns).unionByName(hostile(spark).select(columns))
    return chat_windows.read_back(chat_windows.windows(every, tokenizer_path()))


# --- 13: collocations -----------------------------------------------------------------------


def _lower(expr: str) -> str:
    return f"translate({expr}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op13_collocations",
    rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex({_lower("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
words AS (SELECT lang, unnest(w) AS one, unnest(w[2:]) AS two, unnest(w[3:]) AS three FROM pieces),
totals AS (SELECT lang, count(*) AS n FROM words WHERE one IS NOT NULL GROUP BY lang),
counts AS (
  SELECT lang, one AS phrase, 1 AS size, count(*) AS n FROM words WHERE one IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, concat(one, ' ', two), 2, count(*) FROM words WHERE two IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
  UNION ALL SELECT lang, concat(one, ' ', two, ' ', three), 3, count(*) FROM words WHERE three IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (SELECT lang, part, max(n) AS n FROM (
  SELECT lang, regexp_replace(phrase, ' [^ ]*$', '') AS part, n FROM counts WHERE size = 3
  UNION ALL SELECT lang, regexp_replace(phrase, '^[^ ]* ', ''), n FROM counts WHERE size = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM counts c LEFT JOIN longer l ON c.lang = l.lang AND c.phrase = l.part WHERE size > 1 AND (l.n IS NULL OR 100 * l.n < 50 * c.n)),
cuts AS (
  SELECT lang, phrase, n AS a, size, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM kept, (SELECT unnest([1, 2]) AS k) WHERE k < size),
scored AS (SELECT x.lang, x.phrase, a, h.n AS l, t.n AS r, k, (1000000::HUGEINT * a * a // (h.n::HUGEINT * t.n))::BIGINT AS score
  FROM cuts x JOIN counts h ON h.lang = x.lang AND h.phrase = x.head JOIN counts t ON t.lang = x.lang AND t.phrase = x.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best JOIN totals USING (lang)
QUALIFY rank <= 2000""",
)
def op13(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, absorbed=50, top=2000)
