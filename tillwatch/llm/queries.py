"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwatch.catalog.registry import query
from tillwatch.llm import (bpe, lexical_search, license_scan, lines, lm_scoring, manifest, mixing, quality, secret_scan,
                           simhash, token_counts, vector_dedup, vector_search)
from tillwatch.llm.common import table


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the split pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


_LM = lm_scoring.Bigrams()
_BLANK = "[\\t\\n\\x0b\\f\\r ]+"


def _model_sql(tokens: str, of: str) -> str:
    return f"""
{of}2 AS (SELECT v, w, count(*) AS n FROM {tokens} GROUP BY v, w),
{of}u AS (SELECT w, sum(n) AS n FROM {of}2 GROUP BY w), {of}v AS (SELECT v, sum(n) AS n FROM {of}2 GROUP BY v),
{of}p AS (SELECT word AS w, (coalesce(n, 0) + {_LM.add}) / ((SELECT coalesce(sum(n), 0) FROM {of}u) + {_LM.add} * (SELECT count(*) FROM kept)) AS p
          FROM kept LEFT JOIN {of}u ON word = w)"""


_LM_SQL = f"""
WITH raw AS (
  SELECT 'b' AS kind, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), item_id, text FROM benchmark),
split AS (SELECT kind, r, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANK}'), lambda x: x <> '') AS words FROM raw),
tok AS (SELECT kind, r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
counts AS (SELECT word, count(*) AS n FROM tok WHERE kind = 'b' GROUP BY word),
kept AS (SELECT word FROM counts UNION ALL SELECT '<unk> '),
known AS (SELECT kind, r, i, CASE WHEN word IN (SELECT word FROM kept) THEN word ELSE '<unk> ' END AS w FROM tok),
big AS (SELECT kind, r, coalesce(lag(w) OVER (PARTITION BY kind, r ORDER BY i), '<s> ') AS v, w FROM known),
bt AS (SELECT r, v, w FROM big WHERE kind = 'b'), tt AS (SELECT v, w FROM big WHERE kind = 't'),
{_model_sql('bt', 'b')}, {_model_sql('tt', 't')},
prob AS (
  SELECT x.v, x.w, -ln((coalesce(t2.n, 0) + {_LM.prior} * tp.p) / (coalesce(tv.n, 0) + {_LM.prior})) AS lt,
         -ln((x.n + {_LM.prior} * bp.p) / (coalesce(bv.n, 0) + {_LM.prior})) AS lb
  FROM b2 x JOIN tp ON x.w = tp.w JOIN bp ON x.w = bp.w
  LEFT JOIN t2 ON x.v = t2.v AND x.w = t2.w LEFT JOIN tv ON x.v = tv.v
  LEFT JOIN bv ON x.v = bv.v),
scored AS (SELECT r, count(*) AS n, avg(lt) AS lt, avg(lb) AS lb FROM bt JOIN prob ON bt.v = prob.v AND bt.w = prob.w GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_tokens, round(lt, 6) AS target_loss, round(lb, 6) AS background_loss,
       round(lt - lb, 6) AS score
FROM raw LEFT JOIN scored ON raw.r = scored.r WHERE kind = 'b'"""


@query(_LM_SQL)
def op1_cross_entropy_difference(spark, folder):
    scores = lm_scoring.cross_entropy_difference(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return scores.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")])


@query()
def op2_multiprobe_neighbours(spark, folder):
    return vector_search.nearest_neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op3_byte_bpe(spark, folder):
    path, pattern = tokenizer()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, path, pattern, decoded="decoded"))


@query()
def op4_quality_co_training(spark, folder):
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op5_license_scan(spark, folder):
    """All spans of each document, and the licences they stand for."""
    found = license_scan.scan_licenses(table(spark, folder, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("spans", lambda s: F.substring_index(s["template"], "#", 1))))
    return found.select("doc_id", F.size("spans").cast("bigint").alias("n_spans"), F.array_join(names, ",").alias("licenses"), "spans")


@query()
def op6_simhash_near_dedup(spark, folder):
    return simhash.simhash_groups(table(spark, folder, "documents"))


@query()
def op8_secret_scan(spark, folder):
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, folder, "documents")))


@query()
def op7_vector_near_dedup(spark, folder):
    return vector_dedup.near_vectors(table(spark, folder, "embeddings"))


_MIX_SQL = f"""
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n) AS all_n, sum(pow(n, {mixing.TEMPERATURE})) AS all_share FROM c),
r AS (SELECT source, pow(n, {mixing.TEMPERATURE}) / all_share * all_n / n AS rate FROM c, t),
p AS (SELECT source, rate, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
      FROM r, range(0, 400) g(k)),
cdfs AS (SELECT source, rate, list(cdf) AS cdf FROM p GROUP BY source, rate),
d AS (SELECT documents.*, rate, '42:' || coalesce(doc_id::VARCHAR, 'row:' || md5(concat_ws('|', text, lang, documents.source, n_chars::VARCHAR))) AS seeded, cdf
      FROM documents JOIN cdfs ON documents.source IS NOT DISTINCT FROM cdfs.source),
m AS (SELECT *, len(list_filter(cdf, lambda x: x <= ('0x' || substr(md5(seeded), 1, 13))::BIGINT / 4503599627370496.0)) AS times
      FROM d),
e AS (SELECT *, unnest(range(1, times + 1)) AS copy_l FROM m)
SELECT doc_id, text, lang, source, n_chars, copy_l::INTEGER AS copy, round(rate, 9) AS rate,
       md5(seeded || ':' || copy_l::VARCHAR) AS shuffle_key
FROM e"""


@query(_MIX_SQL)
def op9_poisson_mix(spark, folder):
    return mixing.mix(table(spark, folder, "documents")).withColumn("rate", F.round("rate", 9))


_BLANKS = "' ' || chr(9) || chr(13)"
_LINES_SQL = f"""
WITH pages AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS lines
               FROM documents),
hosts AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
l AS (SELECT DISTINCT r, source, trim(line, {_BLANKS}) AS line FROM (SELECT r, source, unnest(lines) AS line FROM pages)),
n AS (SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY source, line),
bad AS (SELECT n.source, list(line) AS bad FROM n JOIN hosts ON n.source IS NOT DISTINCT FROM hosts.source
        WHERE n > {lines.RATIO} * pages AND n >= {lines.MIN_PAGES} GROUP BY n.source),
kept AS (SELECT doc_id, text, lines, list_filter(lines, lambda x: bad IS NULL OR NOT list_contains(bad, trim(x, {_BLANKS}))) AS kept
         FROM pages LEFT JOIN bad ON pages.source IS NOT DISTINCT FROM bad.source)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
       len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped
FROM kept"""


@query(_LINES_SQL)
def op10_site_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs, counts=True).drop("source")


_MANIFEST = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf_sql(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen(({f})::VARCHAR)::VARCHAR || ':' || ({f})::VARCHAR, '-')" for f in fields) + ")"


def _levels_sql(name: str, nodes: str, key: str) -> str:
    """All levels of the trees over ``nodes`` (key, i, h), one per key."""
    return f"""{name}(g, level, i, h) AS (
  SELECT {key}, 0, i, h FROM {nodes} UNION ALL
  SELECT g, any_value(level) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM (
    SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}) WHERE n > 1 GROUP BY g, i // 2)"""


def _steps_sql(leaves: str, levels: str, g: str, i: str, name: str) -> str:
    """Each leaf's siblings from the bottom, with the side they stand on."""
    return f"""{name} AS (SELECT l.r, list(CASE WHEN s.h IS NULL THEN 'r' WHEN s.i < n.i THEN 'l' || s.h ELSE 'r' || s.h END ORDER BY n.level) AS steps
  FROM {leaves} l JOIN {levels} n ON n.g IS NOT DISTINCT FROM l.{g} AND n.i = l.{i} // (1::BIGINT << n.level)
  JOIN (SELECT g, max(level) AS top FROM {levels} GROUP BY g) t ON t.g IS NOT DISTINCT FROM l.{g} AND n.level < t.top
  LEFT JOIN {levels} s ON s.g IS NOT DISTINCT FROM n.g AND s.level = n.level AND s.i = xor(n.i, 1) GROUP BY l.r)"""


_CRC = """xor(4294967295, list_reduce(list_transform(range(length(doc_id::VARCHAR)), lambda k: ascii(substr(doc_id::VARCHAR, k + 1, 1))::UBIGINT),
  lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda a, z: xor(a >> 1, (a & 1) * 3988292384), xor(c, b)), 4294967295::UBIGINT))"""
_MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf_sql('n_chars')} AS h,
  CASE WHEN {_CRC} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} END AS tampered FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaves),
{_levels_sql('inner_levels', 'placed', 'lang')},
subroots AS MATERIALIZED (SELECT g, h, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS i FROM inner_levels n
  WHERE level = (SELECT max(level) FROM inner_levels m WHERE m.g IS NOT DISTINCT FROM n.g)),
{_levels_sql('outer_levels', 'subroots', '0')},
outer_leaves AS (SELECT i AS r, 0 AS z, i FROM subroots),
{_steps_sql('placed', 'inner_levels', 'lang', 'i', 'inner_steps')},
{_steps_sql('outer_leaves', 'outer_levels', 'z', 'i', 'outer_steps')},
proofs AS (SELECT p.*, s.h AS subroot, list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps,
  (SELECT h FROM outer_levels ORDER BY level DESC LIMIT 1) AS root
  FROM placed p JOIN subroots s ON s.g IS NOT DISTINCT FROM p.lang LEFT JOIN inner_steps a ON a.r = p.r LEFT JOIN outer_steps b ON b.r = s.i),
folded AS (SELECT *, list_reduce(steps, lambda h, s: sha256(CASE WHEN s[1] = 'l' THEN s[2:] || h ELSE h || s[2:] END), coalesce(tampered, h)) AS folded_root
  FROM proofs)
SELECT doc_id, h AS leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folded"""


@query(_MANIFEST_SQL)
def op11_merkle_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    changed = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in _MANIFEST]
    chosen = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    proofs = manifest.manifest(docs.withColumn("tampered", F.when(chosen, manifest.digest(changed))), _MANIFEST, carry=["tampered"])
    folded = manifest.fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return proofs.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("steps")).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms_sql(of: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, unnest(regexp_extract_all({lower}, '{_TERM}')) AS term FROM {of}"


_SEARCH_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents), words AS MATERIALIZED ({_terms_sql('d', 'r')}),
sizes AS (SELECT r, count(*) AS n FROM words GROUP BY r), counts AS (SELECT r, term, count(*) AS tf FROM words GROUP BY r, term),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS all_terms FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), whole),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // all_terms))))::BIGINT AS score
           FROM (SELECT DISTINCT * FROM ({_terms_sql('benchmark', 'item_id')})) JOIN counts USING (term) JOIN weights USING (term)
           JOIN sizes USING (r) JOIN d USING (r), whole GROUP BY item_id, r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50"""


@query(_SEARCH_SQL)
def op12_ranked_search(spark, folder):
    return lexical_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


#: Documents above so many tokens are marked.
TOKEN_LIMIT = 4096


@query()
def op13_token_counts(spark, folder):
    import public_tokenizers

    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    counts = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
