"""The registered queries: each operator over its whole tables, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensario.llm import alignment, cover, decontam, fuzzy_lines, html_main, langid, mixing, pieces, secrets, shards, simhash, toxicity, vector_codes
from mensario.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.learn(docs))
    label = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.concat_ws(",", F.transform(F.filter("spans", lambda s: s["kind"] != "grammar"), label))
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"), of("grammar"),
        F.sha2(base, 256).alias("base_sha256"), F.concat_ws(",", F.transform("spans", label)).alias("spans"),
    )


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_main.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.deduplicate(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover.links(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: rows that are alike in id, source and size are planned as one unit and given out again."""
    unit = mixing.plan(table(spark, sf_dir, "documents"))
    each = unit.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "position")


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def vocabulary_file(name: str) -> str:
    """Where the installed package of public vocabularies keeps one."""
    import public_tokenizers

    return public_tokenizers.path(name)


BYTES_50K, PIECES_32K = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), vocabulary_file(BYTES_50K), vocabulary_file(PIECES_32K), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary_file(PIECES_32K)
    found = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.sha2("codebooks", 256).alias("codebooks_sha256"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_secrets, op3_html, op4_lines, op5_decontamination, op6_language, op7_toxicity, op8_embeddings, op9_mixing, op10_shards,
        op11_alignment, op12_pieces, op13_vector_codes,
    )
}

# The same results as DuckDB SQL, for the operators SQL can express.

_OP5 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g FROM s),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
hits AS (SELECT DISTINCT p.doc_id, p.i, p.n, win.item FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM pos) p JOIN win USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP8 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c"""

_OP9 = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS r FROM d GROUP BY source),
w AS (SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
             CASE (r - 1) % 3 WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0::DOUBLE ELSE 0.5::DOUBLE END AS tilt, 2 * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
                 - coalesce(CAST(sum(cap) OVER (ORDER BY cap / weight::DOUBLE, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
                / CAST(sum(weight) OVER (ORDER BY cap / weight::DOUBLE, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level FROM w),
f AS (SELECT *, first_value(CASE WHEN cap > weight * level THEN level END IGNORE NULLS)
                  OVER (ORDER BY cap / weight::DOUBLE, r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM l),
t AS (SELECT source, source_size, tilt, CASE WHEN stop IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, weight * stop) END AS target FROM f),
u AS (SELECT doc_id, source, size, count(*) AS n, size * count(*) AS mass, md5(concat_ws(':', doc_id, size)) AS k FROM d GROUP BY doc_id, source, size),
o AS (SELECT *, coalesce(CAST(sum(mass) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start FROM u),
c AS (SELECT o.*, t.source_size, t.target, t.tilt,
             CASE WHEN mass = 0 THEN 0 ELSE least(2, greatest(0, CAST(ceil((target - start - mass / 2::DOUBLE) / nullif(source_size, 0)) AS BIGINT))) END AS copies
      FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, least(1.0::DOUBLE, start / nullif(target, 0)) AS x FROM c)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN greatest(0.0::DOUBLE, CASE WHEN tilt = 0 THEN x ELSE (sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * x) - (1 - tilt)) / (2 * tilt) END) END AS position
FROM p, unnest(range(n)) AS g(i)"""

# One step of assignment: the nearest entry of each part, as distance times 64 plus entry. Integers this small are exact in doubles.
_OP13_NEAREST = """
n{k} AS (SELECT p.rid, p.pos, min(CAST(list_inner_product(p.part, p.part) - 2 * list_inner_product(p.part, b.part) + list_inner_product(b.part, b.part) AS BIGINT) * 64 + b.e) AS best
         FROM p JOIN b{k} b USING (pos) GROUP BY p.rid, p.pos)"""
_OP13_MOVE = """
m{k} AS (SELECT pos, e, list(mean ORDER BY j) AS part FROM
          (SELECT p.pos, n.best % 64 AS e, j, floor(sum(p.part[j]) / count(*)) AS mean FROM n{k} n JOIN p USING (rid, pos), range(1, 5) AS r(j) GROUP BY p.pos, n.best % 64, j) GROUP BY pos, e),
b{l} AS (SELECT pos, e, coalesce(m.part, b.part) AS part FROM b{k} b LEFT JOIN m{k} m USING (pos, e))"""
_OP13 = f"""
WITH k AS (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT rid, pos, w[pos * 4 + 1 : pos * 4 + 4] AS part FROM k, range(16) AS r(pos)),
first AS (SELECT rid, row_number() OVER (ORDER BY vec_id, w) - 1 AS e FROM k QUALIFY e < 64),
b0 AS (SELECT pos, e, part FROM p JOIN first USING (rid)),{_OP13_NEAREST.format(k=0)},{_OP13_MOVE.format(k=0, l=1)},{_OP13_NEAREST.format(k=1)},{_OP13_MOVE.format(k=1, l=2)},{_OP13_NEAREST.format(k=2)},
v AS (SELECT rid, string_agg(printf('%02x', best % 64), '' ORDER BY pos) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM n2 GROUP BY rid),
books AS (SELECT sha256(string_agg(CAST(CAST(b2.part[j] AS BIGINT) AS VARCHAR), ',' ORDER BY pos, e, j)) AS h FROM b2, range(1, 5) AS r(j))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM v JOIN k USING (rid), books"""

ORACLE_SQL: dict[str, str] = {"op5_decontamination": _OP5, "op8_embeddings": _OP8, "op9_mixing": _OP9, "op13_vector_codes": _OP13}
