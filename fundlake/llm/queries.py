"""The registered queries opN_* over the driver tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    from fundlake.llm.simhash import simhash_groups
    return simhash_groups(table(spark, sf_dir, "documents")).drop("root", "digest")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside benchmark windows of ten words."""
    from fundlake.llm.decontaminate import decontaminate
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE["op8_decontaminate"] = r"""
WITH it AS (
  SELECT DISTINCT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, w[s:s + least(len(w), 10) - 1] AS g, least(len(w), 10) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM it WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), pos AS (
  SELECT d.rid, d.s, k.k, d.w[d.s:d.s + k.k - 1] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS s FROM dw) d
  JOIN (SELECT DISTINCT k FROM win) k ON d.s + k.k - 1 <= len(d.w)
), occ AS (
  SELECT p.rid, p.s, p.k, win.item_id FROM pos p JOIN win ON p.g = win.g
), hit AS (
  SELECT rid, count(DISTINCT i) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS i FROM occ) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM occ WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""


@query
def op5_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, bit-packed into files and read back."""
    import public_tokenizers

    from fundlake.llm.tokens import read_tokens, write_tokens
    manifest = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), None, 2)
    return read_tokens(manifest)


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the source targets and placed in training order."""
    from fundlake.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents")).drop("row_key")


ORACLE["op6_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * source_size AS cap, sum(source_size) OVER () AS total FROM s
), l AS (
  SELECT *, coalesce(sum(cap) OVER a, 0) AS c_before, sum(w) OVER () - coalesce(sum(w) OVER a, 0) AS w_rest
  FROM w WINDOW a AS (ORDER BY cap / CAST(w AS DOUBLE), rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, cap * w_rest * 2 < (3 * total - 2 * c_before) * w AS over_cap FROM l
), g AS (
  SELECT *, 3 * total - 2 * coalesce(sum(cap) FILTER (over_cap) OVER (), 0) AS num,
         coalesce(sum(w) FILTER (NOT over_cap) OVER (), 0) AS den FROM f
), t AS (
  SELECT source, rank, source_size, CASE WHEN over_cap THEN CAST(cap AS DOUBLE)
         ELSE CAST(num AS DOUBLE) * w / CAST(den * 2 AS DOUBLE) END AS target FROM g
), c AS (
  SELECT doc_id, size, rank, source_size, target, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS okey,
         CAST(floor(target + 0.5) AS BIGINT) AS demand,
         CAST(coalesce(sum(size) OVER (PARTITION BY rank ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS c
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, unnest([0, 1]) AS k FROM c
), kw AS (
  SELECT *, greatest(least(demand - c - source_size * k, size), 0) AS words, CAST(c + source_size * k AS DOUBLE) / nullif(target, 0) AS x FROM k
), kt AS (
  SELECT *, sum(words) OVER (PARTITION BY rank, okey, doc_id, size, c) AS taken, CASE WHEN words > 0 THEN CASE rank % 3
    WHEN 0 THEN CASE WHEN x * 1.0 < 1.0 THEN 0.0 + 2.0 * x / (1.5 + sqrt(greatest(2.25 + -2.0 * x, 0.0))) ELSE 1.0 END
    WHEN 1 THEN CASE WHEN x * 1.0 < 1.0 THEN 0.0 + 2.0 * x / (1.0 + sqrt(greatest(1.0 + 0.0 * x, 0.0))) ELSE 1.0 END
    ELSE CASE WHEN x * 0.875 < 0.25 THEN 0.0 + 2.0 * (x * 0.875) / (0.5 + sqrt(greatest(0.25 + 0.0 * (x * 0.875), 0.0)))
              WHEN x * 0.875 < 0.875 THEN 0.5 + 2.0 * (x * 0.875 - 0.25) / (0.5 + sqrt(greatest(0.25 + 6.0 * (x * 0.875 - 0.25), 0.0)))
              ELSE 1.0 END END END AS train_time
  FROM kw
), p AS (
  SELECT *, coalesce(sum(words) OVER (ORDER BY train_time NULLS LAST, rank, okey, doc_id, size, k
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM kt WHERE k = 0 OR words > 0
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken, CAST(train_time AS DOUBLE) AS train_time,
       CASE WHEN words > 0 THEN CAST(pos AS BIGINT) END AS position
FROM p WHERE k = 0
"""


@query
def op1_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without chunks of lines that occur before elsewhere."""
    from fundlake.llm.linededup import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents"))


@query
def op3_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records into ZIP packages and read back by range."""
    from fundlake.llm.warc import read_packages, write_packages
    return read_packages(write_packages(table(spark, sf_dir, "pages"))).drop("url")


@query
def op7_classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and verdict for all documents, from the labelled ones."""
    from fundlake.llm.quality import classify, graded, train
    docs = table(spark, sf_dir, "documents")
    model = train(docs, graded(table(spark, sf_dir, "labels")))
    return classify(docs, model, ["doc_id"]).select("row.doc_id", "expected_grade", "tail", "kept")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and distances to the language references of all documents."""
    from fundlake.llm.rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"))


@query
def op2_scan_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, labels and detections of all documents."""
    from fundlake.llm.licenses import scan_licenses
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op10_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored secret candidates of all documents."""
    from fundlake.llm.secrets import scan_secrets
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as fill-in-the-middle examples, and restored from them."""
    from fundlake.llm.pieces import fill_in_middle, restore
    made = fill_in_middle(table(spark, sf_dir, "documents"), ["doc_id"])
    told = ["n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    back = restore(made.select("row.doc_id", *told, "output"), ["doc_id", *told])
    return back.select("row.doc_id", *[f"row.{c}" for c in told], "restored_sha256")


ORACLE["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), r AS (
  SELECT *, len(u) AS n, [CAST('0x' || substr(h, 1 + 8 * k, 8) AS BIGINT) FOR k IN range(4)] AS x FROM d
), c AS (
  SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 90 THEN 'plain'
              WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM r
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@query
def op11_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule and repaired by the cheapest edits."""
    from fundlake.llm.turns import damaged, repair, summarize
    given = table(spark, sf_dir, "conversations")
    found = summarize(repair(damaged(given))).withColumnRenamed("conv_id", "_found")
    ids = given.groupBy("conv_id").agg(F.lit(0).alias("_n")).drop("_n")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, ids["conv_id"].eqNullSafe(found["_found"]), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


ORACLE["op11_repair_turns"] = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), h AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(k[i]) AS BIGINT) FOR i IN range(1, length(k) + 1)]),
      LAMBDA a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], LAMBDA x, y: xor(x >> 1, 3988292384 * (x & 1)))),
      CAST(4294967295 AS BIGINT)) % 20 AS m FROM c
), dmg AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
         CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN m = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM h WHERE m <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM dmg
), f AS (
  SELECT *, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault,
      lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o
), told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id
), e AS (
  -- cheapest ways after the row and before any insertion: nothing yet, after s, after u, after a
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': 0, 'a': '', 't': ''} AS p0, {'c': 1000000, 'a': '', 't': ''} AS p1,
         {'c': 1000000, 'a': '', 't': ''} AS p2, {'c': 1000000, 'a': '', 't': ''} AS p3 FROM told
  UNION ALL
  SELECT conv_id, i, list_min([{'c': e0.c + 3, 'a': e0.a || 'D', 't': e0.t}]),
    list_min([{'c': e1.c + 3, 'a': e1.a || 'D', 't': e1.t}, {'c': e0.c + u + CASE WHEN ini = 's' THEN 0 ELSE 1000000 END, 'a': e0.a || 'K', 't': e0.t || chr(10) || line}]),
    list_min(list_concat([{'c': e2.c + 3, 'a': e2.a || 'D', 't': e2.t}],
      [{'c': x.c + u + CASE WHEN ini = 'u' THEN 0 ELSE 1000000 END, 'a': x.a || 'K', 't': x.t || chr(10) || line} FOR x IN [e0, e1, e3]],
      [{'c': x.c + u + 2, 'a': x.a || 'R', 't': x.t || chr(10) || 'user:' || text} FOR x IN [e0, e1, e3]])),
    list_min([{'c': e3.c + 3, 'a': e3.a || 'D', 't': e3.t}, {'c': e2.c + u + CASE WHEN ini = 'a' THEN 0 ELSE 1000000 END, 'a': e2.a || 'K', 't': e2.t || chr(10) || line},
      {'c': e2.c + u + 2, 'a': e2.a || 'R', 't': e2.t || chr(10) || 'assistant:' || text}])
  FROM (
    SELECT e.conv_id, f.i, f.text, f.ini, f.role || ':' || f.text AS line,
      CASE f.fault WHEN 'truncated' THEN 1 WHEN '' THEN 0 ELSE 1000000 END AS u, p0 AS e0, p1 AS e1,
      list_min(list_concat([p2], [{'c': x.c + 2, 'a': x.a || 'I', 't': x.t || chr(10) || 'user:'} FOR x IN [p0, p1, p3]])) AS e2,
      list_min(list_concat([p3, {'c': p2.c + 2, 'a': p2.a || 'I', 't': p2.t || chr(10) || 'assistant:'}],
        [{'c': x.c + 4, 'a': x.a || 'II', 't': x.t || chr(10) || 'user:' || chr(10) || 'assistant:'} FOR x IN [p0, p1]])) AS e3
    FROM e JOIN f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = e.i + 1
  )
), last AS (
  SELECT told.*, list_min(list_concat([p0, p3, {'c': p2.c + 2, 'a': p2.a || 'I', 't': p2.t || chr(10) || 'assistant:'}],
      [{'c': x.c + 4, 'a': x.a || 'II', 't': x.t || chr(10) || 'user:' || chr(10) || 'assistant:'} FOR x IN [p0, p1]])) AS w
  FROM e JOIN told ON e.conv_id IS NOT DISTINCT FROM told.conv_id AND e.i = told.n
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.c, 0) AS BIGINT) AS cost, coalesce(w.a, '') AS audit,
       sha256(coalesce(w.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN last ON a.conv_id IS NOT DISTINCT FROM last.conv_id
"""


@query
def op12_minmax_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by min-max hashing."""
    from fundlake.llm.minmax import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op12_minmax_groups"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), t AS (
  -- sets that are alike share one of each set's few least frequent shingles
  SELECT s.rid, s.g, n.n, row_number() OVER (PARTITION BY s.rid ORDER BY f.c, s.g) AS at
  FROM s JOIN n USING (rid) JOIN (SELECT g, count(*) AS c FROM s GROUP BY g) f USING (g)
), p AS (
  SELECT DISTINCT a.rid AS u, b.rid AS v FROM t a JOIN t b ON a.g = b.g AND a.rid < b.rid
  WHERE a.at <= a.n - (85 * a.n + 99) // 100 + 1 AND b.at <= b.n - (85 * b.n + 99) // 100 + 1 AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
), l AS (
  SELECT u, v FROM p JOIN s a ON a.rid = u JOIN s b ON b.rid = v AND a.g = b.g JOIN n x ON x.rid = u JOIN n y ON y.rid = v
  GROUP BY u, v, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), r AS (
  SELECT rid AS a, rid AS b FROM d
  UNION
  SELECT r.a, e.v FROM r JOIN (SELECT u, v FROM l UNION ALL SELECT v, u FROM l) e ON r.b = e.u
), c AS (
  SELECT a, min(x.doc_id) AS component_id FROM r JOIN d x ON x.rid = r.b GROUP BY a
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN c ON c.a = d.rid LEFT JOIN n ON n.rid = d.rid
"""
