"""The registered queries of this subpackage; each runs one operator with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import brown, decontaminate, language, licenses, line_dedup, near_dedup, nearest, packing, pii, sharding, spelling, units, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hamming")


def op2_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated(table(spark, sf_dir, "documents"))


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op5_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op6_jump_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_line_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.repeated(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_brown_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), added=packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summarised(licenses.scan(table(spark, sf_dir, "documents")))


def op12_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op13_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.words(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_simhash_decontamination, op2_fuzzy_line_dedup, op3_minhash_forest, op4_learned_partitions, op5_pii_deobfuscation, op6_jump_hash_sharding, op7_line_hash_dedup, op8_brown_class_scores, op9_best_fit_packing, op10_language_id, op11_license_rules, op12_qdwh_whitening, op13_spelling_trie)}


WORDS = ("regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         "'[^\\x20\\x09-\\x0D]+')")

# every window that shares a shingle with the item, by exact similarity (items and texts of five words or more)
OP1_SQL = f"""
WITH t AS (SELECT doc_id, {WORDS.format('text')} AS w, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+') AS spaced
           FROM documents),
sh AS (SELECT doc_id, p, len(w) - 4 AS last, array_to_string(w[p:p + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - 3)) AS p FROM t WHERE len(w) >= 5)),
b AS (SELECT item_id, {WORDS.format('text')} AS w FROM benchmark),
items AS (SELECT item_id, k, s, count(*) AS c FROM (
            SELECT item_id, len(w) - 4 AS k, array_to_string(w[p:p + 4], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - 3)) AS p FROM b WHERE len(w) >= 5)) GROUP BY ALL),
hits AS (SELECT doc_id, item_id, last, k, c, p, s FROM sh JOIN items USING (s)),
windows AS (SELECT DISTINCT doc_id, item_id, k, last, unnest(range(greatest(1, p - k + 1), least(p, last - k + 1) + 1)) AS start FROM hits),
common AS (SELECT doc_id, item_id, k, start, sum(n) AS c FROM (
             SELECT w.doc_id, w.item_id, w.k, w.start, h.s, least(count(*), any_value(h.c)) AS n
             FROM windows w JOIN hits h ON h.doc_id = w.doc_id AND h.item_id = w.item_id AND h.p BETWEEN w.start AND w.start + w.k - 1
             GROUP BY ALL) GROUP BY ALL),
best AS (SELECT *, CAST(c AS DOUBLE) / (2 * k - c) AS similarity FROM common WHERE CAST(c AS DOUBLE) / (2 * k - c) >= {decontaminate.SIMILARITY}
         QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY CAST(c AS DOUBLE) / (2 * k - c) DESC, start) = 1),
ends AS (SELECT doc_id, i, sum(size) OVER (PARTITION BY doc_id ORDER BY i) AS e, own
         FROM (SELECT doc_id, unnest(list_transform(spaced, lambda x: length(x))) AS size, unnest(list_transform(w, lambda x: length(x))) AS own,
                      generate_subscripts(w, 1) AS i FROM t))
SELECT doc_id, item_id, CAST(x.e - x.own AS BIGINT) AS start, CAST(y.e AS BIGINT) AS "end", similarity
FROM best JOIN ends x USING (doc_id) JOIN ends y USING (doc_id) WHERE x.i = best.start AND y.i = best.start + best.k + 3"""

OP3_SQL = f"""
WITH RECURSIVE t AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
           GROUP BY 1, 2),
linked AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM t UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id, r.doc_id = min(r.root) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""

_A, _B, _C, _EVERY = units.BOUNDARY
# units: lines, cut after the words that their first and last byte and their size pick; runs of repeated ones by letters
OP7_SQL = f"""
WITH l AS (SELECT doc_id, length(text) AS size, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE doc_id IS NOT NULL),
p AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
             {WORDS.format('line')} AS w, regexp_extract_all(line, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+') AS spaced FROM l),
x AS (SELECT doc_id, size, i, pos, length(line) AS line_size, unnest(w) AS word, unnest(spaced) AS piece, generate_subscripts(w, 1) AS k FROM p WHERE len(w) > 0),
y AS (SELECT *, pos + sum(length(piece)) OVER o - length(word) AS begin, hex(encode(word)) AS h FROM x WINDOW o AS (PARTITION BY doc_id, i ORDER BY k)),
z AS (SELECT *, ({_A} * CAST('0x' || left(h, 2) AS INT) + {_B} * CAST('0x' || right(h, 2) AS INT) + {_C} * length(h) // 2) % {_EVERY} = 0 AS last FROM y),
n AS (SELECT *, coalesce(sum(CAST(last AS INT)) OVER (PARTITION BY doc_id, i ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS u FROM z),
e AS (SELECT doc_id, size, i, u, pos, line_size, string_agg(word, ' ' ORDER BY k) AS words, count(*) AS n_words, min(begin) AS begin,
             sum(length(regexp_replace(word, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]', '', 'g'))) AS letters
      FROM n GROUP BY ALL),
t AS (SELECT *, CASE WHEN u = 0 THEN pos ELSE begin END AS start, row_number() OVER (PARTITION BY doc_id ORDER BY i, u) AS number,
             lead(begin) OVER (PARTITION BY doc_id, i ORDER BY u) AS next FROM e),
f AS (SELECT *, first_value(doc_id) OVER o AS first_doc_id, first_value(start) OVER o AS first_start FROM t
      WINDOW o AS (PARTITION BY words ORDER BY doc_id, start)),
r AS (SELECT *, number - row_number() OVER (PARTITION BY doc_id ORDER BY number) AS run FROM f WHERE doc_id <> first_doc_id OR start <> first_start),
s AS (SELECT *, sum(letters) OVER (PARTITION BY doc_id, run) AS total FROM r)
SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(coalesce(next, least(pos + line_size + 1, size)) AS BIGINT) AS "end", n_words,
       first_doc_id, CAST(first_start AS BIGINT) AS first_start
FROM s WHERE total >= {units.LETTERS}"""


def oracle_sql() -> dict[str, str]:
    """Exact twins, where SQL has one that runs over whole tables. The others are tested by brute force: their
    methods need signatures, models, tokenizers or hash functions (crc32, xxhash64) that DuckDB's SQL hasn't."""
    return {"op1_simhash_decontamination": OP1_SQL, "op3_minhash_forest": OP3_SQL, "op7_line_hash_dedup": OP7_SQL}
