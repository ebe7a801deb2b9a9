"""One query for each operator over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup,
    language,
    main_text,
    merkle,
    near_dedup,
    packing,
    pii,
    sentencepieces,
    token_counts,
    topk,
    toxicity,
    url_filter,
    word_runs,
)


def tokenizer(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(column: str, divisor: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def held_out(divisor: int, rest: int):
    return F.coalesce(remainder("doc_id", divisor) == rest, F.lit(False)).alias("held_out")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.assign(table(spark, folder, "documents"), in_files=True)
    return found.select(F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256"))


def op2_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, F.col("id") % 20 == 0, 20)


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"), pii.train(pii.labelled_examples()), ["doc_id"])


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", held_out(4, 2))
    # A document without an id is not held out, and nothing is learned from it.
    model = language.fit(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return language.identify(docs, model, ["doc_id", "held_out"])


# The rules that a page's url is held against (host, path, verdict), and
# the words in a host's name that put it on the list of blocked hosts.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
BLOCKED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")
BLOCKED_HOST = f"(^|[.-])({'|'.join(BLOCKED_WORDS)})([.-]|$)"


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    host, path = url_filter.url_parts(F.col("url"))
    pages = table(spark, folder, "pages").select("page_id", host.alias("host"), path.alias("path"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = pages.select("host").where(F.col("host").rlike(BLOCKED_HOST)).distinct()
    listed = listed.select("host", F.lit("").alias("path"), F.lit("block").alias("verdict"))
    ruled = url_filter.match(pages, rules, ["page_id"], "host", "path")
    ruled = ruled.select("page_id", "host", "path", F.col("entry").alias("rule"), F.col("verdict").alias("by_rule"))
    both = url_filter.match(ruled, listed, ["page_id", "rule", "by_rule"], "host", "path")
    return both.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "verdict", F.lit("allow")).alias("verdict"))


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.encode(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", held_out(5, 0))
    labels = table(spark, folder, "labels").where(remainder("doc_id", 5) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = main_text.extract(table(spark, folder, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    described = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = merkle.row_digest(*described, F.translate("text", "\n", ""))
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.row_digest(*described, F.col("text")).alias("leaf"),
        F.when(remainder("doc_id", 2) == 0, tampered).alias("tampered"),
    )
    found = merkle.witnesses(leaves, "source", "doc_id", "leaf", ["tampered"])
    proof = F.sha2(merkle.siblings(F.col("steps")).cast("binary"), 256)
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("steps"))
    found = found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    # Runs are planted in a tenth of the documents, by a hash of their id.
    planted = F.when(remainder("doc_id", 10) == 0, F.expr("crc32(cast(cast(doc_id AS string) AS binary)) div 10"))
    found = word_runs.word_runs(table(spark, folder, "documents"), ["doc_id"], looped=planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    found = found.select("doc_id", "runs", "collapsed", word_runs.strongest(F.col("runs")).alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        digest(F.array_join(lines, "")).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_exact_topk,
        op3_pii,
        op4_language,
        op5_url_filter,
        op6_sentencepiece,
        op7_token_counts,
        op8_toxicity,
        op9_packing,
        op10_near_dedup,
        op11_main_text,
        op12_merkle_manifest,
        op13_word_runs,
    )
}

def _tree_sql(name: str, leaves: str) -> str:
    """Two relations: the nodes of all levels, and each node's siblings to both sides.
    `leaves` is SQL for rows (tree, pos, digest, size)."""
    run = f"(PARTITION BY tree, lvl, pos // 3 ORDER BY pos ROWS BETWEEN"
    return f"""
        {name} AS (
            SELECT tree, 0 AS lvl, pos, digest, size FROM ({leaves})
            UNION ALL
            SELECT tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (size + 2) // 3
            FROM {name} WHERE size > 1 GROUP BY tree, lvl, pos // 3, size),
        {name}_sides AS (
            SELECT tree, lvl, pos, size,
                   coalesce(string_agg(digest, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                   coalesce(string_agg(digest, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM {name} WHERE size > 1)"""


def _climb_sql(name: str, tree: str, start: str) -> str:
    """Rows (id, tree, lvl, pos, proof, folded) on their way up a tree."""
    return f"""
        {name} AS (
            {start}
            UNION ALL
            SELECT c.row, c.tree, c.lvl + 1, c.pos // 3, c.proof || s.before || s.after, sha256(s.before || c.folded || s.after)
            FROM {name} c JOIN {tree}_sides s ON s.tree = c.tree AND s.lvl = c.lvl AND s.pos = c.pos),
        {name}_end AS (SELECT row, arg_max(tree, lvl) AS tree, arg_max(proof, lvl) AS proof, arg_max(folded, lvl) AS folded FROM {name} GROUP BY row)"""


def _leaf_sql(text: str) -> str:
    parts = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"


# The checksum's lowest bit; a bit of the text's bytes at a time.
_CRC_SQL = """list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda sum, byte: list_reduce(
        list_prepend(xor(sum, byte), [0::BIGINT FOR i IN range(8)]),
        lambda s, i: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))"""

_MERKLE_SQL = f"""
    WITH RECURSIVE
        docs AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
                   CASE WHEN xor({_CRC_SQL}, 4294967295) % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS tampered
            FROM documents),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY tree) AS size
            FROM docs),
        {_tree_sql("inner_tree", "SELECT tree, pos, leaf AS digest, size FROM placed")},
        subroots AS (
            SELECT tree AS source_tree, digest AS subroot, '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos,
                   count(*) OVER () AS size
            FROM inner_tree WHERE size = 1),
        {_tree_sql("outer_tree", "SELECT tree, pos, subroot AS digest, size FROM subroots")},
        {_climb_sql("up", "inner_tree", "SELECT row, tree, 0 AS lvl, pos, '' AS proof, coalesce(tampered, leaf) AS folded FROM placed")},
        {_climb_sql("top", "outer_tree", "SELECT u.row, '' AS tree, 0 AS lvl, s.pos, u.proof, u.folded FROM up_end u JOIN subroots s ON s.source_tree = u.tree")},
        root AS (SELECT digest AS root FROM outer_tree WHERE size = 1)
    SELECT doc_id, leaf, subroot, root, sha256(t.proof) AS proof_sha256, t.folded AS folded_root, t.folded = root AS verified
    FROM placed p JOIN subroots s ON s.source_tree = p.tree JOIN top_end t ON t.row = p.row CROSS JOIN root"""

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

SQL = {
    "op12_merkle_manifest": _MERKLE_SQL,
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op2_exact_topk": """
        WITH v AS (
            SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 20 = 0),
        r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op5_url_filter": f"""
        WITH u AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        p AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u),
        rules(h, p, v) AS (VALUES {_RULE_ROWS}),
        best AS (
            SELECT page_id, arg_max(h || rules.p, length(h || rules.p)) AS rule, arg_max(v, length(h || rules.p)) AS v
            FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(p.path, rules.p)
            GROUP BY page_id)
        SELECT page_id, host, path, rule,
               coalesce(v, CASE WHEN regexp_matches(host, '{BLOCKED_HOST}') THEN 'block' ELSE 'allow' END) AS verdict
        FROM p LEFT JOIN best USING (page_id)""",
}
