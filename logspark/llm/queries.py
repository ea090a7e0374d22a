"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from logspark.llm import bpe, decontaminate, htmltext, licenses, merkle, minhash, pii, quality, resample, secrets, substrings, syncmers, toxicity
from logspark.session import shared_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op3_decontaminate(spark, sf_dir):
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_html(spark, sf_dir):
    return htmltext.extract(table(spark, sf_dir, "pages"))


def html_templates(spark, sf_dir):
    """By host: pages, the subtrees cut from them because they recur, and the pages whose text these alone decided."""
    found = htmltext.extract(table(spark, sf_dir, "pages"))
    host = F.lower(F.regexp_extract("url", htmltext.HOST, 1)).alias("host")
    return found.groupBy(host).agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n_templates").alias("n_templates"), F.count_if("by_templates").alias("n_by_templates"))


def op5_licenses(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_pii(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_substrings(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op9_quality(spark, sf_dir):
    judged = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits")


def op10_secrets(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op11_syncmers(spark, sf_dir):
    return syncmers.compare_edited(table(spark, sf_dir, "documents"))


def op12_resample(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10)


def op13_merkle(spark, sf_dir):
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def quality_ablation(spark, sf_dir):
    """What each rule of two policies removes, from one stored ledger."""
    held = quality.write_ledger(table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    each = [quality.ablation(held, policy).select(F.lit(policy).alias("policy"), "rule", "n_failed", "n_only", "n_kept_without") for policy in ("v1", "v2")]
    return each[0].union(each[1])


QUERIES = {f.__name__: f for f in (op1_bpe, op2_minhash, op3_decontaminate, op4_html, op5_licenses, op6_pii, op7_toxicity, op8_substrings, op9_quality, op10_secrets, op11_syncmers, op12_resample, op13_merkle, quality_ablation, html_templates)}
LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _runs_of(table: str, key: str, k: int) -> str:
    """Every k consecutive words of a table (key, i, a) as one string, with its place."""
    return f"SELECT {key}, i, {k} AS k, s FROM (SELECT {key}, i, string_agg(a, ' ') OVER w AS s, count(*) OVER w AS n FROM {table} WINDOW w AS (PARTITION BY {key} ORDER BY i ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING)) WHERE n = {k}"


LEDGER = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
 x AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
 g AS (SELECT doc_id, i, a, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM x WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
 r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL) WHERE n > 1),
 v AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY 1),
 m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
  {", ".join(f"(length(t) - length(regexp_replace(t, '{c}', '', 'g')))::BIGINT AS {k}" for k, c in quality.CHARS.items())},
  len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_odd_words, len(list_filter(w, lambda x: length(x) > 30)) AS n_long_words, len(list_filter(w, lambda x: regexp_matches(x, '^(https?://|www\.)'))) AS n_links,
  len(regexp_extract_all(t, '[Ll]orem [Ii]psum')) AS n_placeholders, len(list_distinct(w)) AS n_distinct,
  {", ".join(f"len(list_filter(l, lambda x: regexp_matches(x, '{c}'))) AS {k}" for k, c in quality.LINES.items())} FROM d LEFT JOIN v USING (doc_id)),
 b AS (SELECT *, ({" + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(quality.RULES.values()))})::BIGINT AS failed_bits FROM m)"""

#: CRC-32 of a text, by the table of its bytes' remainders; the table is a row of one list, crc(of).
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of)"
CRC = "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen({0})), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(crc_of[(xor(c, b) & 255) + 1], c >> 8)))"
LEAF = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{0}", "text"))


def _tree(name: str, leaves: str) -> str:
    """All nodes of the binary trees over leaves (g, i, n, h): name(g, l, i, n, h)."""
    return f"{name} AS (SELECT g, 0 AS l, i, n, h FROM {leaves} UNION ALL SELECT g, l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY g, l, i // 2, n)"


def _sides(leaf: str, tree: str) -> str:
    """A row for each level above a leaf (g, i): its sibling with the side it stands on, 'L', 'R' or 'N' for none."""
    return f"SELECT {leaf}.g, {leaf}.i, a.l, CASE WHEN b.h IS NULL THEN 'N' WHEN b.i < a.i THEN 'L' ELSE 'R' END || coalesce(b.h, '') AS s FROM {leaf} JOIN {tree} a ON a.g = {leaf}.g AND a.i = {leaf}.i >> a.l AND a.n > 1 LEFT JOIN {tree} b ON b.g = a.g AND b.l = a.l AND b.i = xor(a.i, 1)"


#: The queries that SQL can express. Tokenizer ids, links between shingle sets, parsed markup, places of matches and
#: learned scores can't; their tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op3_decontaminate": f"""WITH d AS (SELECT doc_id, {ALNUM.format(LOWER.format("text"))} AS w FROM documents),
 x AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
 b AS (SELECT item_id, {ALNUM.format(LOWER.format("text"))} AS w FROM benchmark), y AS (SELECT item_id, unnest(w) AS a, generate_subscripts(w, 1) AS i, len(w) AS n FROM b),
 q AS ({_runs_of("y", "item_id", 13)} UNION ALL SELECT item_id, 1, n, string_agg(a, ' ' ORDER BY i) FROM y WHERE n < 13 GROUP BY item_id, n),
 g AS ({" UNION ALL ".join(_runs_of("x", "doc_id", k) for k in range(1, 14))}),
 h AS (SELECT DISTINCT doc_id, g.i, g.k, item_id FROM g JOIN q ON g.k = q.k AND g.s = q.s),
 c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY 1),
 m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
 SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
 FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op8_substrings": f"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents), x AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
 g AS ({_runs_of("x", "doc_id", 20)}), f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM g),
 c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM f WHERE r > 1),
 k AS (SELECT x.doc_id, count(c.i) AS n_removed, coalesce(string_agg(a, ' ' ORDER BY x.i) FILTER (c.i IS NULL), '') AS kept FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.i = c.i GROUP BY 1)
 SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op9_quality": rf"""{LEDGER}
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed, failed_bits & {quality.mask(quality.POLICIES["v2"])} = 0 AS kept, failed_bits FROM b""",
    "op12_resample": f"""WITH {CRC_TABLE}, d AS (SELECT doc_id, {ALNUM.format(LOWER.format("text"))} AS w FROM documents), x AS (SELECT doc_id, unnest(w) AS a FROM d),
 y AS (SELECT unnest({ALNUM.format(LOWER.format("text"))}) AS a FROM benchmark), v AS (SELECT a, {CRC.format("a")} % 10000 AS b FROM (SELECT a FROM x UNION SELECT a FROM y), crc),
 s AS (SELECT b, count(*) AS s FROM x JOIN v USING (a) GROUP BY 1), t AS (SELECT b, count(*) AS t FROM y JOIN v USING (a) GROUP BY 1), o AS (SELECT (SELECT sum(s) FROM s) + 10000 AS all_s, (SELECT sum(t) FROM t) + 10000 AS all_t),
 g AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1) * all_s / ((coalesce(s, 0) + 1) * all_t)))::BIGINT AS gain FROM s FULL JOIN t USING (b), o),
 q AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM x JOIN v USING (a) JOIN g USING (b) GROUP BY 1),
 r AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN q USING (doc_id)),
 k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM r WHERE n_features >= 20)
 SELECT r.*, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM r LEFT JOIN k USING (doc_id)""",
    "op13_merkle": f"""WITH RECURSIVE {CRC_TABLE}, d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({LEAF.format("n_chars")}) AS h, CASE WHEN {CRC.format("doc_id::VARCHAR")} % 7 = 0 THEN sha256({LEAF.format("(n_chars + 1)")}) END AS seen FROM documents, crc),
 f AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d), {_tree("a", "f")},
 u AS (SELECT '' AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n, h, g AS lang FROM a WHERE n = 1), {_tree("b", "u")}, root AS (SELECT h AS root FROM b WHERE n = 1),
 p AS ({_sides("f", "a")} UNION ALL SELECT f.g, f.i, 1000 + e.l, e.s FROM f JOIN u ON u.lang = f.g JOIN ({_sides("u", "b")}) e ON e.i = u.i),
 z AS (SELECT g, i, list(s ORDER BY l) AS s FROM p GROUP BY 1, 2),
 m AS (SELECT doc_id, f.h AS leaf, u.h AS subroot, root, sha256(coalesce(array_to_string(list_transform(z.s, lambda x: substr(x, 2)), ''), '')) AS proof_sha256,
  list_reduce(list_prepend(coalesce(seen, f.h), coalesce(z.s, [])), lambda x, y: sha256(CASE y[1] WHEN 'L' THEN substr(y, 2) || x WHEN 'R' THEN x || substr(y, 2) ELSE x END)) AS folded_root
  FROM f JOIN u ON u.lang = f.g LEFT JOIN z ON z.g = f.g AND z.i = f.i, root)
 SELECT *, folded_root = root AS verified FROM m""",
    "quality_ablation": LEDGER + ", " + " UNION ALL ".join(
        f"SELECT '{p}' AS policy, '{r}' AS rule, count(*) FILTER (failed_bits & {quality.mask((r,))} <> 0) AS n_failed, count(*) FILTER (failed_bits & {quality.mask(quality.POLICIES[p])} = {quality.mask((r,))}) AS n_only, count(*) FILTER (failed_bits & {quality.mask(quality.POLICIES[p]) & ~quality.mask((r,))} = 0) AS n_kept_without FROM b"
        for p in ("v1", "v2") for r in quality.POLICIES[p]
    ).replace("SELECT", "o AS (SELECT", 1) + ") SELECT * FROM o",
}
