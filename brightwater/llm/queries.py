"""One query for each operator, over its whole table."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.llm import bpe, digest, embeddings, exact, html, lines, merkle, minhash, mixing, periods, secrets, substrings
from brightwater.llm import quality as quality_operator
from brightwater.llm.registry import ORACLES, QUERIES, query, table

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"[^\x20\x09-\x0D]+"

# CRC-32 of a decimal id, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

__all__ = ["ORACLES", "QUERIES"]


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_operator.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@query(
    "op8_exact_dedup",
    """WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)""",
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    "op10_minhash",
    f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS k FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
          WHERE 100 * pairs.k >= 80 * (x.k + y.k - pairs.k)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT reach.id, sym.b FROM reach JOIN sym ON reach.r = sym.a),
c AS (SELECT id, min(r) AS m FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.k, 0) AS n_shingles, m AS component_id, d.doc_id = m AS kept
FROM documents d JOIN c ON d.doc_id = c.id LEFT JOIN n ON d.doc_id = n.doc_id""",
)
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(table(spark, sf_dir, "documents"), size=4, percent=80)


@query(
    "op2_mixing",
    f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w FROM d GROUP BY source),
c AS (SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS goal FROM s),
r AS (SELECT *, (goal - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, least(cap, w * max(CASE WHEN cap >= level * w THEN level END) OVER ()) AS target FROM r),
p AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d),
q AS (SELECT p.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS turns
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(turns * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - turns * source_size - start)) AS BIGINT) AS taken
FROM q""",
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, taken = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select(taken["id"].alias("doc_id"), "size", "source_size", "target", "taken")


@query("op4_html")
def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(documents, F.concat_ws("/", "source", "lang"), F.col("source"))
    base = F.filter("secrets", lambda s: s["rank"] < 3)

    def count(field: str, value: str):
        return F.size(F.filter("secrets", lambda s: s[field] == value)).cast("long").alias(f"n_{value}")

    return found.select(
        "doc_id",
        *(count("kind", k) for k in ("assign", "access", "hex")),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("secrets")).alias("spans"),
        count("verdict", "live"),
        count("verdict", "copied"),
    )


@query(
    "op6_embeddings",
    """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
sym AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y
        ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
reach AS (SELECT vec_id AS id, vec_id AS r FROM v UNION SELECT reach.id, sym.b FROM reach JOIN sym ON reach.r = sym.a),
c AS (SELECT id, min(r) AS m FROM reach GROUP BY id), n AS (SELECT a, count(*) AS k FROM sym GROUP BY a)
SELECT vec_id, coalesce(k, 0) AS n_links, m AS component_id, vec_id = m AS kept
FROM v JOIN c ON vec_id = c.id LEFT JOIN n ON vec_id = n.a""",
)
def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query(
    "op9_substrings",
    f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p, ws FROM w),
s AS (SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(ws[p:p + 19], ' ') ORDER BY doc_id, p) AS k FROM g),
cov AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM s WHERE k > 1),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS q FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS t FROM words ANTI JOIN cov USING (doc_id, q) GROUP BY doc_id),
gone AS (SELECT doc_id, count(*) AS k FROM cov GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(k, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id LEFT JOIN gone ON w.doc_id = gone.doc_id""",
)
def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), window=20)


@query(
    "op1_lines",
    """WITH w AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents),
e AS (SELECT doc_id, CASE WHEN len(ls) IN (1, 2) THEN list_resize(ls, 3) ELSE ls END AS ls FROM w),
g AS (SELECT doc_id, unnest(range(1, len(ls) - 1)) AS p, ls FROM e),
s AS (SELECT doc_id, p, row_number() OVER (PARTITION BY ls[p], ls[p + 1], ls[p + 2] ORDER BY doc_id, p) AS k FROM g),
cov AS (SELECT DISTINCT doc_id, unnest(range(p, p + 3)) AS q FROM s WHERE k > 1),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS q FROM w),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY q) AS t FROM lines ANTI JOIN cov USING (doc_id, q) GROUP BY doc_id),
gone AS (SELECT doc_id, count(*) AS k FROM lines SEMI JOIN cov USING (doc_id, q) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, coalesce(k, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id LEFT JOIN gone ON w.doc_id = gone.doc_id""",
)
def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated_lines(table(spark, sf_dir, "documents"), run=3)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _merkle_sql(levels: int, top_levels: int) -> str:
    """Each level of both storeys as a table, for trees of up to 16 ** levels nodes."""
    field = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    fields = [field.format(f) for f in ("doc_id", "source", "lang", "n_chars")]
    changed = field.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    leaf = f"sha256({' || '.join([*fields, field.format('text')])})"
    altered = f"CASE WHEN {CRC32} % 5 = 0 THEN sha256({' || '.join([*fields, changed])}) ELSE {leaf} END"
    parts = [
        f"x AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf} AS d, {altered} AS shown FROM documents)",
        "l0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n, d, doc_id, shown FROM x)",
    ]

    def storey(name: str, count: int) -> None:
        for k in range(count):
            parts.append(
                f"{name}{k + 1} AS (SELECT tree, pos // 16 AS pos, (max(n) + 15) // 16 AS n, "
                f"CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE max(d) END AS d FROM {name}{k} GROUP BY tree, pos // 16)"
            )
            parts.append(
                f"w{name}{k} AS (SELECT a.tree, a.pos, a.n > 1 AS up, coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, "
                f"coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r "
                f"FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.pos // 16 = b.pos // 16 GROUP BY a.tree, a.pos, a.n)"
            )

    storey("l", levels)
    parts.append(f"t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, d, tree AS key FROM l{levels})")
    storey("t", top_levels)
    joins, steps = "l0", []
    for name, count, pos in (("l", levels, "l0.pos"), ("t", top_levels, "t0.pos")):
        joins += " JOIN t0 ON t0.key = l0.tree" if name == "t" else ""
        for k in range(count):
            joins += f" JOIN w{name}{k} ON w{name}{k}.tree = {name}0.tree AND w{name}{k}.pos = {pos} // {16**k}"
            steps.append(f"w{name}{k}")
    parts.append(f"j AS (SELECT l0.doc_id, l0.d AS leaf, l0.shown, t0.d AS subroot, {', '.join(f'{s}.up AS {s}_u, {s}.l AS {s}_l, {s}.r AS {s}_r' for s in steps)} FROM {joins})")
    before = "j"
    for k, s in enumerate(steps):
        parts.append(f"f{k} AS (SELECT * REPLACE (CASE WHEN {s}_u THEN sha256({s}_l || shown || {s}_r) ELSE shown END AS shown) FROM {before})")
        before = f"f{k}"
    siblings = " || ".join(f"CASE WHEN {s}_u THEN {s}_l || {s}_r ELSE '' END" for s in steps)
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, t{top_levels}.d AS root, sha256({siblings}) AS proof_sha256, shown AS folded_root, "
        f"shown = t{top_levels}.d AS verified FROM {before} CROSS JOIN t{top_levels}"
    )


@query("op13_merkle", _merkle_sql(levels=4, top_levels=3))
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    altered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    shown = merkle.leaf_digest([*map(F.col, fields), F.when(tampered, altered).otherwise(F.col("text"))])
    found = merkle.manifest(documents, [*fields, "text"], carry={"shown": shown})
    folded = merkle.folded(F.col("shown"), F.col("steps"))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def _quarter_replaced(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the following one."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _digest_sql() -> str:
    """Fingerprints by unnested triplets; the table fp holds those of the texts (side 0) and of the edited ones (side 1)."""
    at, b = "list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)", digest.BUCKETS
    length = f"len(list_filter({digest.length_ladder()}, lambda x: x <= n_bytes))"
    apart = f"list_sum(list_transform(range(1, {b + 3}), lambda i: abs(x.code[i] - y.code[i])))"
    score = f"{apart} + {digest.LENGTH_WEIGHT} * least({digest.LENGTH_STEPS}, abs(x.size_code - y.size_code))"
    near = f"CAST({digest.LIMIT} - least({digest.LIMIT}, {score}) AS DOUBLE) / {digest.LIMIT}"
    return f"""WITH o AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM documents),
e AS (SELECT a.doc_id, a.t, b.doc_id AS next_id, a.t[:length(a.t) - length(a.t) // 4] || b.t[:length(a.t) // 4] AS ed
      FROM o a JOIN o b ON b.r = (a.r + 1) % a.n),
u AS (SELECT doc_id, 0 AS side, t AS s FROM e UNION ALL SELECT doc_id, 1, ed FROM e),
bs AS (SELECT doc_id, side, strlen(s) AS n_bytes, {at} AS b FROM (SELECT doc_id, side, s, hex(encode(s)) AS h FROM u)),
tr AS (SELECT doc_id, side, unnest(list_transform(range(1, len(b) - 1), lambda i: (b[i] + 256 * b[i + 1] + 65536 * b[i + 2]) * {digest.FACTOR} % 4294967296 // 16777216)) AS k FROM bs),
c AS (SELECT doc_id, side, k, count(*) AS c FROM tr GROUP BY ALL),
m AS (SELECT bs.doc_id, bs.side, max(n_bytes) AS n_bytes, list(coalesce(c, 0) ORDER BY range) AS counts
      FROM bs CROSS JOIN range({b}) LEFT JOIN c ON bs.doc_id = c.doc_id AND bs.side = c.side AND k = range GROUP BY bs.doc_id, bs.side),
q AS (SELECT *, list_sort(counts) AS so FROM m),
z AS (SELECT doc_id, side, {length} AS size_code, so[{b // 4}] AS q1, so[{b // 2}] AS q2, so[{3 * b // 4}] AS q3, counts FROM q),
fp AS (SELECT doc_id, side, size_code, list_concat([15 * q1 // greatest(q3, 1), 15 * q2 // greatest(q3, 1)],
         list_transform(counts, lambda c: (c > q1)::BIGINT + (c > q2)::BIGINT + (c > q3)::BIGINT)) AS code FROM z),
f AS (SELECT *, format('{{:03x}}{{:x}}{{:x}}', size_code, code[1], code[2]) ||
        array_to_string(list_transform(range(3, {b + 3}, 2), lambda i: format('{{:x}}', 4 * code[i] + code[i + 1])), '') AS mark FROM fp)
SELECT e.doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(ed) AS edited_sha256, x.mark AS fingerprint, y.mark AS edited_fingerprint,
       {near} AS near_edited, {near.replace("y.", "v.")} AS near_next
FROM e JOIN f x ON x.doc_id = e.doc_id AND x.side = 0 JOIN f y ON y.doc_id = e.doc_id AND y.side = 1 JOIN f v ON v.doc_id = e.next_id AND v.side = 0"""


@query("op12_fingerprints", _digest_sql())
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.compare_with_next(table(spark, sf_dir, "documents"), _quarter_replaced)


_RUNS_SQL = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws, {CRC32} AS h FROM documents),
a AS (SELECT doc_id, ws, len(ws) AS n, h, h // 10 AS g, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM w),
p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - a) // (3 + g % 8) END AS p FROM a),
t AS (SELECT doc_id, n, CASE WHEN p IS NULL THEN ws ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END) END AS ws FROM p),
x AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') AS six FROM (SELECT doc_id, ws, unnest(range(n - 5)) AS i FROM t)),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM x JOIN x y ON x.doc_id = y.doc_id AND x.six = y.six AND x.i < y.i),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM m) GROUP BY doc_id, q, stretch),
r AS (SELECT doc_id, start, length, min(q) AS q FROM s WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
o AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed,
             min(struct_pack(k := -length, s := start, q := q)) AS best FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS c FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(n)) AS i FROM t) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, CAST(-best.k AS BIGINT) AS length, best.q AS period,
       CAST(-1000 * best.k // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM t LEFT JOIN o ON t.doc_id = o.doc_id LEFT JOIN kept ON t.doc_id = kept.doc_id"""


@query("op11_periods", _RUNS_SQL)
def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)))
    planted = documents.select("doc_id", "text", chosen.alias("ws"), F.expr("crc32(string(doc_id)) div 10").alias("g")).withColumn("n", F.size("ws"))
    planted = planted.withColumn("a", F.expr("int(g % nullif(greatest(n, 0), 0))")).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    tail = F.expr("slice(flatten(array_repeat(slice(ws, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)")
    text = F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("ws", F.lit(1), F.col("a")), tail), " ")).otherwise(F.col("text"))
    found = periods.periodic_runs(planted.select("doc_id", text.alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"], r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
